"""What the nearest page of the host decides in pages that mark an article."""

import random
import time

import pytest

from cubelake.llm import html_text
from cubelake.llm.queries import QUERIES


def keys(page):
    return [k for k in html_text.keys_of(*html_text.lines_of(page)) if k is not None]


def page(article, after=""):
    return f'<body><nav><a href="/">Home</a></nav><article>{article}</article>{after}<footer>Imprint</footer></body>'


BOX = '<div class="about-us"><h2>About</h2><p>Written at the desk.</p></div>'
CARD = '<div class="more"><article><h3>Elsewhere</h3><p>A card</p></article></div>'
LINKS = '<ul><li><a href="/a">Back</a></li><li> <a href="/b"><b>All</b> stories</a> </li></ul>'
OWN = (
    "<h1>Title one</h1><p>What only this page tells, and tells at some length, as a story does.</p>",
    "<h1>Two</h1><p>Another story is told here, of things that were seen elsewhere.</p>",
)
TEXT = "Title one What only this page tells, and tells at some length, as a story does."


@pytest.mark.parametrize(
    "one, two",
    [
        (page(OWN[0] + BOX), page(OWN[1] + BOX)),
        (page(BOX + OWN[0]), page(BOX + OWN[1] + "<p>more</p>")),
        (page(OWN[0] + LINKS), page(OWN[1] + LINKS)),
        (page(OWN[0], CARD), page(OWN[1], CARD)),
        (page(OWN[0].replace("</p>", "<br>") + BOX), page(OWN[1] + BOX)),
        (page(f'<div class="entry">{OWN[0]}</div>{BOX}'), page(f'<div class="entry">{OWN[1]}</div>{BOX}')),
        (page(f'<div class="entry">{OWN[0]}{BOX}{LINKS}</div>', CARD), page(f'<div class="entry">{OWN[1]}{BOX}{LINKS}</div>', CARD)),
    ],
    ids=["box", "box first", "links", "card", "open p", "beside the text", "in the text"],
)
def test_boxes_of_the_template_go(one, two):
    assert html_text.main_text(one, keys(two)) == TEXT
    alone = html_text.main_text(one, None)
    assert alone != TEXT and html_text.main_text(one, keys("<p>Another template")) == alone


QUOTE = "<p>A passage that both pages hold.</p>"


@pytest.mark.parametrize(
    "body",
    [
        "{}" + QUOTE,
        '<div class="entry">{}' + QUOTE + "</div>",
        '<div class="par">{}</div><div class="par">' + QUOTE + "</div>",
        '{}<div class="listing"><pre>import this</pre><table class="t"><tr><td>1</table></div>',
        '{}<blockquote><div class="said">' + QUOTE + "</div></blockquote>",
        '{}<p>See <a href="/x">there</a></p><p class="quote">' + QUOTE,
        '<a name="top">{}<p>' + "A passage that both pages hold.",
        '{}<section class="own">Only here<p>shared in part</section>',
    ],
)
def test_shared_text_of_the_article_stays(body):
    one, two = page(body.format(OWN[0])), page(body.format(OWN[1]).replace("Only here", "Only there"))
    assert html_text.main_text(one, keys(two)) == html_text.main_text(one, None)


@pytest.mark.parametrize("title", ["One", "A title much longer than the text below it, and then some"])
def test_copies_stay_whole(title):
    body = '<h1>{}</h1><div class="entry"><p>A text on two pages.</p></div>' + BOX
    one, two = page(body.format(title), CARD), page(body.format("Other"), CARD)
    assert html_text.main_text(one, keys(two)) == html_text.main_text(one, None)
    assert html_text.main_text(one, keys(one)) == html_text.main_text(one, None)


def test_copies_in_running_text_stay_whole():
    body = "<h1>{}</h1><p>{}</p><p>A longer text that stands on two pages of the host.</p>" + BOX
    one, two = page(body.format("One", "Printed at noon.")), page(body.format("Two", "Printed in the evening."))
    assert html_text.main_text(one, keys(two)) == html_text.main_text(one, None)
    assert html_text.main_text(one, keys(one)) == html_text.main_text(one, None)


def test_random_templates_against_the_parts_they_are_made_of():
    rng = random.Random(8)
    for _ in range(200):
        shared = [f'<div class="box{c}"><p>Said on every page {c}</p></div>' for c in "abcd"[: rng.randrange(1, 5)]]
        made = []
        for n in range(2):
            own = [f"<p>Own {n} {k} " + "word " * 12 + "</p>" for k in range(len(shared) + rng.randrange(1, 4))]
            places = sorted(rng.randrange(len(own) + 1) for _ in shared)
            parts = [x for k in range(len(own) + 1) for x in (*[b for b, at in zip(shared, places, strict=True) if at == k], *own[k : k + 1])]
            made.append((page("".join(parts)), " ".join(" ".join(x[3:-4].split()) for x in own)))
        assert html_text.main_text(made[0][0], keys(made[1][0])) == made[0][1]
        assert html_text.main_text(made[1][0], keys(made[0][0])) == made[1][1]


def test_query_drops_what_the_nearest_page_repeats(spark, local_tmp):
    rows = [
        (1, "http://h.org/a/1", page(OWN[0] + BOX)),
        (2, "http://h.org/a/2", page(OWN[1] + BOX)),
        (3, "http://h.org/b/1", page("<h1>Three</h1><p>Far away.</p>" + LINKS)),
        (5, "http://copy.org/a?1", page(OWN[0] + BOX)),
        (6, "http://copy.org/a?2", page(OWN[0] + BOX)),
        (4, "http://alone.org/a/1", page(OWN[0] + BOX)),
    ]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{local_tmp}/pages.parquet")
    got = {r.page_id: (r.text, r.n_chars) for r in QUERIES["op10_page_differencing"](spark, local_tmp).collect()}
    expected = {
        1: TEXT,
        2: "Two Another story is told here, of things that were seen elsewhere.",
        3: "Three Far away. Back All stories",
        **{k: TEXT + " About Written at the desk." for k in (4, 5, 6)},
    }
    assert got == {k: (t, len(t)) for k, t in expected.items()}


DEEP = {
    "links": "<li>" + "<a>" * 100_000 + "<p></p>x" * 100_000,
    "boxes": "<div class=x>" * 100_000 + "x" + "</div>x" * 100_000,
    "articles": "<article>x" * 100_000 + "</article>x" * 100_000,
    "quotes": "<blockquote><p>x" * 50_000 + "</blockquote><div class=x>y" * 50_000,
}


@pytest.mark.parametrize("name", DEEP)
def test_broken_articles_are_read_in_one_pass(name):
    one = page(DEEP[name])
    start = time.process_time()
    html_text.main_text(one, keys(one))
    assert time.process_time() - start < 15
