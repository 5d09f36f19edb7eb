"""N-gram Jaccard join, neighbour search and page differencing against brute force, with odd inputs."""

import itertools
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cubelake.llm import ann, html_text, jaccard


def gram_set(text, size):
    words = "".join(c.lower() if c.isascii() else c for c in text or "")
    for white in "\t\n\x0b\x0c\r":
        words = words.replace(white, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1)))


def brute_components(rows, size, percent):
    sets = [gram_set(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b]:
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        least.setdefault(find(k), []).append(i)
    return [(i, len(sets[k]), min(least[find(k)])) for k, (i, _) in enumerate(rows)]


def near_copies(seed, groups=12, copies=14):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    passage = rng.choices(vocabulary, k=30)
    texts = [None, "", " \t\n", "one", "ONE", "two words", "Two  words", "three more words", "\xa0 x"]
    for _ in range(groups):
        base = rng.choices(vocabulary, k=rng.randint(20, 160))
        for _ in range(rng.randint(1, copies)):
            own = list(base)
            for _ in range(rng.randint(0, 4)):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            texts.append(" ".join(own + (passage if rng.random() < 0.3 else [])))
    texts += texts[10:16]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("column, block", [(64, 512), (3, 4)])
def test_components_match_brute_force(documents, monkeypatch, column, block):
    """Also with columns and blocks so short that most links come from block products."""
    monkeypatch.setattr(jaccard, "COLUMN", column)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    for size, percent in ((3, 90), (5, 80)) if column == 64 else ((3, 90),):
        rows = near_copies(size)
        got = jaccard.link_components(documents(rows).repartition(3), size, percent).collect()
        assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(brute_components(rows, size, percent))


def test_components_of_odd_tables(documents):
    assert jaccard.link_components(documents([])).collect() == []
    rows = [(3, "a b c d"), (3, "a b c d"), (None, "A b\tc d"), (None, None), (9, None)]
    wide = "doc_id long, text string, class string, n int, gram string, grams int"
    got = jaccard.link_components(documents(rows, wide)).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == sorted(
        [("3", 2, "3"), ("3", 2, "3"), ("None", 2, "3"), ("None", 0, "None"), ("9", 0, "9")]
    )


def test_star_steps_find_components(spark):
    chain = [(k, k + 1) for k in range(40)]
    edges = [*chain, *[(100, 100 + k) for k in range(1, 30)], (200, 201), (201, 202), (200, 202), (7, 7)]
    random.Random(1).shuffle(edges)
    got = dict(jaccard.components(spark.createDataFrame(edges, "a long, b long"), "t").collect())
    assert got == {k: 0 for k in range(41)} | {100 + k: 100 for k in range(30)} | {200: 200, 201: 200, 202: 200}


def brute_nearest(rows, k):
    usable = [
        (i, np.array(v, float)) for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    out = []
    for place, (q, v) in enumerate(usable):
        if q % 20 == 0:
            near = sorted((-float((v * w).sum()), i) for at, (i, w) in enumerate(usable) if at != place)
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(near[:k])]
    return out


def embeddings(spark, rows):
    return spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, score string")


def test_small_searches_are_exact(spark):
    rng = np.random.default_rng(0)
    rows = [(k, [float(np.float32(x)) for x in rng.standard_normal(8)]) for k in range(150)]
    rows += [(150 + k, rows[20][1]) for k in range(60)]  # many copies of a query
    rows += [(300, None), (320, []), (340, [0.0] * 8), (360, [float("nan")] + [1.0] * 7), (380, [None] + [1.0] * 7),
             (400, [float("inf")] + [1.0] * 7), (None, [1.0] * 8)]
    for table in (rows, rows[:5], []):
        got = ann.search(embeddings(spark, table), F.col("vec_id") % 20 == 0).collect()
        expected = brute_nearest(table, 20)
        assert sorted(r[:3] for r in got) == sorted(e[:3] for e in expected)
        scores = {e[:2]: e[3] for e in expected}
        assert all(r.score == pytest.approx(scores[r[:2]], abs=1e-12) for r in got)


def recall_of(x, got):
    """Share of the true 20 nearest found; every query has its 20 ranks."""
    x = x.astype(float)
    hits = 0
    for q, part in got.groupby("query_id"):
        score = x @ x[q]
        score[q] = -np.inf
        hits += len(set(part.vec_id) & set(np.argsort(-score)[:20]))
        assert list(part.sort_values("rank")["rank"]) == list(range(1, 21))
    return hits / (20 * got.query_id.nunique())


def clustered(rng, clusters, rows, dim):
    centres = rng.standard_normal((clusters, dim))
    return (centres[rng.integers(0, clusters, rows)] + 0.4 * rng.standard_normal((rows, dim))).astype(np.float32)


@pytest.mark.parametrize("one_level", [256, 8])
def test_partitions_reach_the_recall(spark, monkeypatch, caplog, one_level):
    monkeypatch.setattr(ann, "LEAF_ROWS", 32)
    monkeypatch.setattr(ann, "ONE_LEVEL", one_level)
    monkeypatch.setattr(ann, "BLOCK", 100)
    x = clustered(np.random.default_rng(2), 12, 1500, 16)
    rows = [(k, [float(c) for c in v]) for k, v in enumerate(x)]
    with caplog.at_level("INFO", logger=ann.__name__):
        got = ann.search(embeddings(spark, rows), F.col("vec_id") % 20 == 0).toPandas()
    assert got.query_id.nunique() == 75 and recall_of(x, got) >= 0.95
    count, leaves, probes = caplog.records[-1].args[:3]
    assert count == 1500 and leaves >= 36 and probes <= leaves // 2


def test_leaves_rank_all_once_and_start_at_home():
    rng = np.random.default_rng(5)
    x = clustered(rng, 6, 400, 8)
    tree = ann.Tree(ann.fit(x, 4), [ann.fit(x, 3), ann.fit(x, 1), ann.fit(x, 5), ann.fit(x, 2)])
    ranked = tree.ranked(x[:50])
    assert tree.leaves == 11 and (np.sort(ranked, axis=1) == np.arange(11)).all()
    assert (ranked[:, 0] == tree.home(x[:50])).all()
    assert tree.top.probabilities(x[:5]).sum(axis=1) == pytest.approx(1)


def test_leaves_grow_with_the_root_of_the_rows():
    assert [ann.leaf_count(n) for n in (0, 1, 127, 128, 2000, 10_256, 200_000, 10**9)] == [1, 1, 1, 2, 31, 102, 448, 31_623]


def test_lengths_are_searched_apart(spark):
    rng = np.random.default_rng(6)
    short = [(k, [float(np.float32(c)) for c in rng.standard_normal(4)]) for k in range(30)]
    long = [(100 + k, [float(np.float32(c)) for c in rng.standard_normal(9)]) for k in range(30)]
    got = ann.search(embeddings(spark, short + long), F.col("vec_id") % 20 == 0).collect()
    assert sorted(r[:3] for r in got) == sorted(e[:3] for part in (short, long) for e in brute_nearest(part, 20))


def test_partition_sizes_are_balanced():
    rng = np.random.default_rng(4)
    x = rng.standard_normal((600, 8)).astype(np.float32)
    label = ann.balanced_partition(x, ann.neighbour_graph(x, 10), 6, rng)
    assert np.bincount(label, minlength=6).max() <= math.ceil(ann.SLACK * 100)


PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t='</p>';</script></head><body>"
    '<nav><ul><li><a href="/a">{0}</a></li></ul></nav><!-- <p>no</p> --><div class="ad banner">buy {0}</div>'
    '<article class="main-menu"><h1>Title {0}</h1><p><b>First &lt;{0}&gt;\n  line<br><p>caf&eacute; &amp;&nbsp;x</p>'
    '<form>mail</form><div id="comments"><p>I say</p></div><p>Last<i>ly</i></article><footer>&copy; {0}</footer></body>'
)


def test_article_without_its_surroundings():
    for neighbour in (None, [1, 2, 3]):
        text = html_text.main_text(PAGE.format(7), neighbour)
        assert text == "Title 7 First <7> line café & x Lastly"


@pytest.mark.parametrize(
    "page, text",
    [
        ('<div class="page has-sidebar"><nav>menu</nav><article><p>Story</article></div>', "Story"),
        ('<div class="widget"><main><p>Story<nav>menu</nav></main></div>', "Story"),
        ('<form id="aspnetForm"><div class="nav">menu</div><article><p>Story</article></form>', "Story"),
        ("<body><nav><ul><li>menu</ul><article><p>Story</article></body>", "Story"),
        ('<article><p>One</article><div class="ad">buy<article><p>Two</article></body>', "One Two"),
        ('<article><p>One<div class="related-work"><p>Two</div><div id="search-results">3</div></article>', "One Two 3"),
        ('<article><p>One<div class="x related">no</div></article><div class=ad>no</div>', "One"),
        ('<article><p>One</article><div id="comments"><article>I say</article></div>', "One"),
        ('<form><article><p>One</article><aside><article>More</article></aside></form>', "One"),
        ('<div class="ad"><article><p>One</article></div><aside>no</aside><p>no', "One"),
    ],
)
def test_articles_start_afresh(page, text):
    assert html_text.main_text(page, None) == text


def test_plain_pages_lose_what_they_share():
    one = "<body><p>Site menu<p>Story one<p>shared quote<div>Imprint</div></body>"
    two = "<body><p>Site menu<p>Another story<div>Imprint</div></body>"
    keys = [k for k in html_text.keys_of(*html_text.lines_of(two)) if k is not None]
    assert html_text.main_text(one, keys) == "Story one shared quote"
    assert html_text.main_text(one, None) == "Site menu Story one shared quote Imprint"


def test_template_places_align_by_path():
    lines, marked = html_text.lines_of(PAGE.format(1))
    other = [k for k in html_text.keys_of(*html_text.lines_of(PAGE.format(2))) if k is not None]
    shared = html_text.aligned(html_text.keys_of(lines, marked), other)
    assert {lines[k][0] for k in shared} >= {"1", "buy 1", "© 1"} and not any(lines[k][1] and not lines[k][2] for k in shared)


def subsequence(a, b):
    rest = iter(b)
    return all(any(x == y for y in rest) for x in a)


def test_alignment_is_a_longest_common_subsequence():
    rng = random.Random(3)
    for _ in range(400):
        a = [rng.choice([None, 1, 2, 3, 4]) for _ in range(rng.randint(0, 9))]
        b = [rng.randint(1, 4) for _ in range(rng.randint(0, 9))]
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, j in itertools.product(range(len(a)), range(len(b))):
            best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else max(best[i][j + 1], best[i + 1][j])
        found = html_text.aligned(a, b)
        assert len(found) == best[-1][-1] and subsequence([a[k] for k in sorted(found)], b)


def test_pages_pair_with_the_nearest_url(spark):
    body = "<p>{}<p>{}"
    rows = [
        (1, "http://h.org/a/1", body.format("menu a", "text 1")),
        (2, "https://H.org/a/2?x=1", body.format("menu a", "text 2")),
        (3, "http://h.org/b/9", body.format("menu a", "text 3")),
        (4, "http://other.org/a/1", body.format("menu a", "text 4")),
        (4, "http://other.org/a/1", body.format("menu a", "text 4")),
        (5, None, None),
        (6, "not a url", ""),
        (None, "http://single.org", "<p>alone</p>" + "y" * 200_000),
    ]
    pages = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string")
    got = html_text.extract(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    texts = {}
    for r in got.collect():
        assert r.n_chars == len(r.text)
        texts.setdefault(r.page_id, []).append(r.text)
    assert texts == {1: ["text 1"], 2: ["text 2"], 3: ["text 3"], 4: ["menu a text 4"] * 2, 5: [""], 6: [""],
                     None: ["alone " + "y" * 200_000]}
    assert html_text.extract(pages.limit(0)).collect() == []


def test_block_links_are_a_forest():
    sets = [[1, 2, 3, 4], [1, 2, 3, 4, 5], [1, 2, 3, 4, 6], [9, 10]]
    rows = pd.DataFrame({"class": range(4), "grams": sets, "block": 0, "i": 0, "j": 0})
    got = jaccard.block_links(rows, 80)
    assert {tuple(x) for x in got.to_numpy().tolist()} == {(0, 1), (0, 2)}
    rows["block"], rows["j"] = [0, 0, 1, 1], 1
    assert {tuple(x) for x in jaccard.block_links(rows, 80).to_numpy().tolist()} == {(0, 2)}
