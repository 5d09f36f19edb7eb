"""Page reading on broken and very long pages, roles in class names, and alignment against plain dynamic programming."""

import random
import time

import pytest

from cubelake.llm import html_text

MB5 = {
    "script": "<script " * 700_000,
    "p": "<p " * 1_700_000,
    "a": '<a href="x ' * 450_000,
    "open quotes": '<p ">" ' * 700_000 + '"',
    "divs": "<div class=x>" * 100_000 + "x" + "</div>" * 100_000,
    "ends": "<div class=x>" * 100_000 + "</p>" * 100_000,
    "inline": "<li><div>" + "<b>" * 100_000 + "<li></li>" * 100_000,
    "lines": "".join(f"<p>line {k}</p>" for k in range(200_000)),
    "comments": "<!--" * 1_000_000,
    "signs": "<" * 5_000_000,
}


@pytest.mark.parametrize("name", MB5)
def test_broken_pages_are_read_in_one_pass(name):
    start = time.process_time()
    lines, marked = html_text.lines_of(MB5[name])
    html_text.keys_of(lines, marked)
    assert time.process_time() - start < 15
    if name == "lines":
        assert len(lines) == 200_000 and lines[7][0] == "line 7"


@pytest.mark.parametrize("case", ["order", "same", "few"])
def test_long_pages_are_aligned_in_bounded_memory(case):
    rng = random.Random(2)
    n = 60_000
    a = list(range(n)) if case != "few" else [rng.randrange(5) for _ in range(n)]
    b = {"order": rng.sample(a, n), "same": a, "few": rng.sample(a, n)}[case]
    start = time.process_time()
    found = html_text.aligned(a, b)
    assert time.process_time() - start < 15
    rest = iter(b)
    assert all(a[k] in rest for k in sorted(found))  # a subsequence of both


def longest(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_alignment_is_a_longest_one():
    rng = random.Random(3)
    for _ in range(400):
        kinds = rng.choice([2, 6, 40])
        a, b = ([rng.randrange(kinds) for _ in range(rng.randrange(60))] for _ in range(2))
        found = html_text.aligned(a, b)
        rest = iter(b)
        assert len(found) == longest(a, b) and all(a[k] in rest for k in sorted(found))


def test_pages_without_article_lose_what_they_share():
    rng = random.Random(5)
    words = ["Home", "About", "Imprint", "More", "Contact", "Terms"]
    for _ in range(60):
        one, two = ([rng.choice(words) if rng.random() < 0.6 else f"Own{rng.random()}" for _ in range(rng.randrange(1, 25))] for _ in range(2))
        pages = ["".join(f"<div>{t}</div>" for t in x) for x in (one, two)]
        lines = html_text.lines_of(pages[0])[0]
        assert [t for t, *_ in lines] == one
        text = html_text.main_text(pages[0], [k for k in html_text.keys_of(*html_text.lines_of(pages[1])) if k is not None])
        shared = longest(one, two)
        kept = [] if not text else text.split(" ")
        if shared == len(one):
            assert kept == one  # a copy of its neighbour tells nothing
        else:
            assert len(kept) == len(one) - shared
            rest = iter(one)
            assert all(t in rest for t in kept)  # in page order
            assert [t for t in kept if t.startswith("Own")] == [t for t in one if t.startswith("Own")]


@pytest.mark.parametrize(
    "name", ["user-comments", "comments-area", "cookie-notice", "ad-slot", "sidebar-left", "site-footer", "siteFooter", "x_newsletter"]
)
def test_class_names_of_several_parts(name):
    page = f"<main><div>Story</div><div class='{name}'>Other things</div></main>"
    assert html_text.main_text(page, None) == "Story"


@pytest.mark.parametrize("name", ["has-sidebar", "no-comments", "related-work", "search-results", "ad-hoc", "commentary", "shared-page"])
def test_class_names_that_only_look_so(name):
    assert html_text.main_text(f"<article><div class='{name}'>Story</div></article>", None) == "Story"
    assert html_text.main_text(f"<article><h2 id='comment-on-{name}'>Story</h2></article>", None) == "Story"
