"""Language filters, toxicity, URL lists and the pipeline: accuracy, brute force, odd inputs."""

import datetime as dt
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cubelake.llm import lang_id, queries, toxicity, url_filter

from .test_similarity import brute_components

SMALL = "/root/testdata/sf0.001"
ODD = [(1001, None), (1002, ""), (1003, "12 34 ... !"), (1004, "\n"), (1004, "\n"), (None, "the of and"), (1005, "ing " * 300_000)]


# Language ID


def test_bit_slices_agree_with_sets():
    rng = np.random.default_rng(0)
    grams = rng.integers(0, 1 << 60, 3000).astype(np.uint64)
    members = {f"l{k:02d}": grams[rng.random(3000) < 0.3] for k in range(70)}  # more than one mask word
    filters = lang_id.LanguageFilters.build(members)
    found = filters.containing(grams)
    for k, name in enumerate(filters.languages):
        word, bit = divmod(k, 63)
        held = (found[word] >> bit & 1).astype(bool)
        true = np.isin(grams, members[name])
        assert held[true].all()  # a Bloom filter forgets nothing
        assert held[~true].mean() < 0.01
        assert filters.false_rate[k] < 0.01


def test_counts_of_long_texts_in_slices(monkeypatch):
    texts = ["The quick brown fox, été! " * 9, None, "", "x", "ab " * 50]

    def counted():
        total = {}
        for grams, rows in lang_id._slices(texts):
            for g, r in zip(grams.tolist(), rows.tolist(), strict=True):
                total[g, r] = total.get((g, r), 0) + 1
        return total

    whole = counted()
    brute = {}
    for r, text in enumerate(texts):
        folded = [ord(c) if c.isalpha() else 32 for c in f" {(text or '').lower()} "]
        for a, b, c in zip(folded, folded[1:], folded[2:]):
            if b != 32:
                brute[a << 42 | b << 21 | c, r] = brute.get((a << 42 | b << 21 | c, r), 0) + 1
    assert whole == brute
    monkeypatch.setattr(lang_id, "SLICE", 7)
    assert counted() == brute


def test_language_accuracy_on_the_held_out_fold(spark):
    got = queries.op1_language_filters(spark, SMALL).toPandas()
    truth = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang").toPandas()
    both = got.merge(truth, on="doc_id")
    assert len(both) == len(truth)
    assert (both.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in both.doc_id]).all()
    assert (both[both.held_out].lang_pred == both[both.held_out].lang).mean() >= 0.95
    assert both.score.between(0, 1).all()


def test_language_of_odd_tables(documents):
    train = [(k, "the thing and that", "en") for k in range(8)] + [(20 + k, "für schön ich und", "de") for k in range(8)]
    rows = train + ODD + [(30, "anything", None), (31, None, "en")]
    got = lang_id.identify_documents(documents(rows, "doc_id long, text string, lang string, score string")).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert {by_id[k].lang_pred for k in (1001, 1002, 1003, 1004)} == {"und"}
    assert by_id[0].lang_pred == "en" and by_id[20].lang_pred == "de" and not by_id[None].held_out
    assert all(0 <= r.score <= 1 for r in got)
    assert lang_id.identify_documents(documents([])).collect() == []
    untrained = lang_id.identify_documents(documents([(1, "the")])).collect()
    assert [(r.lang_pred, r.score) for r in untrained] == [("und", 0.0)]


# Toxicity


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    net = toxicity.Network()
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    lex = toxicity.Lexicon.of([b"alpha", b"be", b"gamma", b"d", "été".encode()])
    rows = rng.integers(0, 6, (5, toxicity.WINDOW))
    rows[0, 10:] = 5  # padding
    rows[:, 0] = 1
    label, kept = np.array([1.0, 0, 1, 0, 1]), np.array([1.0, 1, 0, 1, 1])

    def loss():
        p = toxicity._sigmoid(net.forward(net.inputs(net.vectors(lex, kept)), rows).astype(np.float64))
        return -(label * np.log(p) + (1 - label) * np.log(1 - p)).mean()

    grads = net.gradients(lex, rows, label, kept)
    for name, value in net.p.items():
        flat = value.reshape(-1)
        spots = np.flatnonzero(np.abs(grads[name].reshape(-1)) > 1e-4)
        for at in rng.choice(spots, min(4, len(spots)), replace=False):
            was = flat[at]
            flat[at] = was + 1e-2
            up = loss()
            flat[at] = was - 1e-2
            down = loss()
            flat[at] = was
            assert grads[name].reshape(-1)[at] == pytest.approx((up - down) / 2e-2, rel=0.05, abs=2e-4), name


def test_windows_cover_every_word():
    lengths = np.array([0, 1, 32, 33, 48, 49, 500, 0])
    text, start = toxicity._windows(lengths)
    first = np.cumsum(lengths) - lengths
    for k, n in enumerate(lengths):
        own = start[text == k] - first[k]
        if n == 0:
            assert len(own) == 0
            continue
        covered = np.unique(np.concatenate([np.arange(s, min(s + toxicity.WINDOW, n)) for s in own]))
        assert len(covered) == n and (np.diff(own) == toxicity.STRIDE).all()


def toxic_rows(n, seed):
    rng = random.Random(seed)
    plain = ["".join(rng.choices("abcdeinorst", k=rng.randint(2, 8))) for _ in range(300)]
    rows = []
    for _ in range(n):
        words = rng.choices(plain, k=rng.randint(5, 200))
        toxic = rng.random() < 0.3
        for _ in range(1 + len(words) // 40 if toxic else 0):
            words[rng.randrange(len(words))] = rng.choice(["vezz", "quox"]) + rng.choice(["a", "ier", "ment", "on", "ux"])
        rows.append((" ".join(words), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def network():
    rows = toxic_rows(500, 1)
    return toxicity.fit([t for t, _ in rows], [y for _, y in rows])


def test_held_out_accuracy(network):
    rows = toxic_rows(300, 2)
    scores = network.scores([t for t, _ in rows])
    assert np.mean((scores >= 0.5) == [bool(y) for _, y in rows]) >= 0.95


def test_scores_of_odd_texts(network, monkeypatch):
    texts = [None, "", "...", "quoxon", "ab cd " * 50_000, toxic_rows(1, 3)[0][0]]
    scores = network.scores(texts)
    assert ((scores >= 0) & (scores <= 1)).all() and (scores[:3] == 0).all()
    assert len(network.scores([])) == 0
    long = " ".join(t for t, _ in toxic_rows(40, 4))
    whole = network.scores([long])
    monkeypatch.setattr(toxicity, "CHUNK_WORDS", 160)
    assert network.scores([long]) == pytest.approx(whole, abs=1e-5)
    assert network.scores(texts[3:4] * 3) == pytest.approx([scores[3]] * 3, abs=1e-5)


def test_one_class_of_labels():
    assert toxicity.fit([], []).scores(["a"]) == [0]
    assert toxicity.fit(["a", "b"], [0, 0]).scores(["a", None]).tolist() == [0, 0]
    assert toxicity.fit(["a"], [1]).scores(["b"]) == [1]


def test_toxicity_of_odd_tables(spark, documents):
    labels = spark.createDataFrame(
        [(1001, 1), (1002, None), (None, 1), (5, 0), (6, 1), (6, 1)], "doc_id long, toxic int"
    )
    docs = documents(ODD + [(5, "clean words"), (6, "bad words"), (6, "bad words")], "doc_id long, text string, score int, predicted int")
    got = toxicity.score_documents(docs, labels).collect()
    assert len(got) == docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert toxicity.score_documents(documents([]), labels.limit(0)).collect() == []


def test_labels_of_other_documents_change_no_score(spark, documents, monkeypatch):
    monkeypatch.setattr(toxicity, "MAX_ROWS", 40)
    rows = [(k, f"word{k % 7} " * 12 + ("vile scum " * 5 if k % 3 == 0 else "fine day ")) for k in range(150)]
    docs = documents(rows)
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(150)], "doc_id long, toxic int")
    strangers = spark.range(10_000, 15_000).select(F.col("id").alias("doc_id"), F.lit(1).alias("toxic"))
    sample = toxicity.training_sample(docs, labels.unionByName(strangers)).groupBy("toxic").count().collect()
    assert {r.toxic: r["count"] for r in sample} == {0: 40, 1: 40}
    alone, among = (
        {r.doc_id: r.score for r in toxicity.score_documents(docs, found).collect()}
        for found in (labels, labels.unionByName(strangers))
    )
    assert alone == among


def plain_logit(net, words):
    """The forward pass written out for one window."""
    h, p = toxicity.HIDDEN, {k: v.astype(np.float64) for k, v in net.p.items()}
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    vectors = []
    for w in words:
        lex = toxicity.Lexicon.of([w])
        vectors.append(np.concatenate([p["word"][lex.word[0]], 0.3 * sum(p["char"][g] for g in lex.grams)]))
    directions = []
    for d, order in ((0, vectors), (1, vectors[::-1])):
        state, states = np.zeros(h), []
        for v in order:
            given, own = v @ p["x"][d] + p["b"][d, 0], state @ p["h"][d]
            z, r = sigmoid(given[:h] + own[:h]), sigmoid(given[h : 2 * h] + own[h : 2 * h])
            state = (1 - z) * np.tanh(given[2 * h :] + r * own[2 * h :]) + z * state
            states.append(state)
        directions.append(states if d == 0 else states[::-1])
    both = np.array([np.concatenate(x) for x in zip(*directions)])
    weight = np.exp(both @ p["att"])
    return float((weight / weight.sum()) @ both @ p["out"] + p["bias"][0])


def test_scores_are_those_of_the_worst_of_all_windows(network):
    texts = ["one", "same same same " * 40, " ".join(f"w{k % 13} bad{k % 5}" for k in range(70)), "Été scum " * 33]
    size, stride = toxicity.WINDOW, toxicity.STRIDE
    for text, score in zip(texts, network.scores(texts)):
        words = [w.encode() for w in text.lower().split()]
        starts = range(0, max(len(words) - size + stride, 1), stride)
        worst = max(plain_logit(network, words[s : s + size]) for s in starts)
        assert abs(score - 1 / (1 + np.exp(-(worst - network.cut) * network.scale))) < 1e-4
        assert starts[-1] + size >= len(words)


# URL lists

DAY = dt.datetime(2024, 1, 1)


def at(day):
    return DAY + dt.timedelta(days=day)


ENTRIES = [
    ("deny", "domain", "bad.org", "add", at(1)),
    ("deny", "domain", "bad.org", "add", at(1)),
    ("deny", "domain", "Bad.org.", "remove", at(5)),
    ("deny", "domain", "bad.org", "add", at(8)),
    ("allow", "host", "good.bad.org", "add", at(2)),
    ("deny", "prefix", "good.bad.org/x/", "add", at(3)),
    ("deny", "host", "same.org", "add", at(4)),
    ("allow", "host", "same.org", "add", at(4)),
    ("deny", "host", "blink.org", "add", at(4)),
    ("deny", "host", "blink.org", "remove", at(4)),
    ("deny", "host", None, "add", at(4)),
    ("deny", "host", "odd.org", "pause", at(4)),
    ("grey", "host", "grey.org", "add", at(0)),
]
CAPTURES = [
    (1, "http://bad.org/", at(0), "unlisted"),
    (2, "http://a.b.bad.org/q", at(1), "blocked"),
    (3, "http://bad.org", at(5), "unlisted"),
    (4, "https://bad.org:8080/", at(9), "blocked"),
    (5, "http://notbad.org/", at(9), "unlisted"),
    (6, "http://user@good.bad.org/y", at(3), "allowed"),
    (7, "http://GOOD.bad.org/X/z?q=1", at(3), "blocked"),
    (8, "http://good.bad.org/xy", at(3), "allowed"),
    (9, "http://same.org/", at(4), "allowed"),
    (10, "http://blink.org/", at(4), "unlisted"),
    (11, None, at(4), "unlisted"),
    (12, "http://bad.org/", None, "unlisted"),
    (13, "no host", at(9), "unlisted"),
    (14, "http://odd.org/", at(9), "unlisted"),
    (15, "http://grey.org/", at(9), "unlisted"),
    (2, "http://a.b.bad.org/q", at(1), "blocked"),
    (16, "http://bad.org/" + "p/" * 300, at(2), "blocked"),
]
LIST_SCHEMA = "list string, kind string, pattern string, action string, at timestamp"
CAPTURE_SCHEMA = "id long, url string, fetched_at timestamp, expected string"


def test_lists_as_of_the_fetch_time(spark):
    entries = spark.createDataFrame(ENTRIES, LIST_SCHEMA)
    captures = spark.createDataFrame(CAPTURES, CAPTURE_SCHEMA)
    got = url_filter.evaluate(captures, entries).collect()
    assert sorted((r.id, r.verdict) for r in got) == sorted((c[0], c[3]) for c in CAPTURES)
    since = {r.id: r.valid_from for r in got}
    assert since[2] == at(1) and since[4] == at(8) and since[1] is None
    assert url_filter.evaluate(captures.limit(0), entries).collect() == []
    assert {r.verdict for r in url_filter.evaluate(captures, entries.limit(0)).collect()} == {"unlisted"}


def test_as_of_join_against_every_entry(spark, monkeypatch):
    """One pattern with most entries and captures, over many spans and within one."""
    rng = random.Random(4)
    def when():
        return DAY + dt.timedelta(minutes=rng.randrange(0, 3000))

    hosts = ["hot.org"] * 6 + ["a.org", "b.org"]
    entries = [
        (rng.choice(["allow", "deny"]), "host", rng.choice(hosts), rng.choice(["add", "remove"]), when()) for _ in range(400)
    ]
    captures = [(k, f"http://{rng.choice(hosts)}/", when(), k, "own", "x") for k in range(300)]
    expected = {}
    for k, url, time, *_ in captures:
        holds = {}
        for name in ("allow", "deny"):
            past = [(at, action) for li, _, host, action, at in entries if li == name and f"http://{host}/" == url and at <= time]
            if past and max(past)[1] == "add":
                holds[name] = max(past)[0]
        expected[k] = ("allowed", holds["allow"]) if "allow" in holds else ("blocked", holds["deny"]) if holds else ("unlisted", None)
    log = spark.createDataFrame(entries, LIST_SCHEMA)
    rows = spark.createDataFrame(captures, "id long, url string, fetched_at timestamp, __row long, verdict string, `a.b` string")
    for span in (600, 10**9):
        monkeypatch.setattr(url_filter, "SPAN", span)
        got = url_filter.evaluate(rows, log).collect()
        assert {r.id: (r.verdict, r.valid_from) for r in got} == expected and len(got) == 300
        assert all(r["__row"] == r.id and r["a.b"] == "x" for r in got)


# Pipeline


def test_stages_keep_the_columns_and_the_clean_rows(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").withColumn("__row2", F.lit(1)).withColumn("score", F.lit("x"))
    extra = docs.limit(4).withColumn("doc_id", F.col("doc_id") + 10_000)  # copies
    empty = docs.limit(2).withColumn("doc_id", F.col("doc_id") + 20_000).withColumn("text", F.lit(None).cast("string"))
    rows = docs.unionByName(extra).unionByName(empty)
    sizes = [rows.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, rows, SMALL)
        assert rows.columns == docs.columns, name
        kept = rows.toPandas()
        sizes.append(len(kept))
        rows = spark.createDataFrame(kept, docs.schema)
    assert sizes[1] == sizes[0] - 2  # only the texts without letters go
    assert sizes[2] >= 0.75 * sizes[1]
    assert kept.text.is_unique
    pieces = corpus_pipeline.pack(spark, rows, SMALL).toPandas()
    assert set(pieces.doc_id) == set(kept.doc_id)
    assert (pieces.groupby("doc_id").length.sum() == pieces.groupby("doc_id").doc_tokens.first()).all()


def test_stages_against_brute_force(spark, monkeypatch):
    """Each stage on what the one before kept, computed a second way."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for name in ("__lang", "__row", "__toxicity", "document", "language", "__file", "__place", "__number"):
        docs = docs.withColumn(name, F.lit(f"their {name}"))
    order = docs.columns
    rows = [r.asDict() for r in docs.collect()]

    def frame(kept):
        return spark.createDataFrame([tuple(r[c] for c in order) for r in kept], docs.schema).coalesce(1)

    def same(got, wanted):
        key = lambda r: (r["doc_id"], r["text"])
        assert sorted((r.asDict() for r in got.collect()), key=key) == sorted(wanted, key=key)

    found = {r.doc_id: r for r in lang_id.identify_documents(frame(rows)).collect()}
    wanted = [r for r in rows if found[r["doc_id"]].lang_pred != "und" and found[r["doc_id"]].score >= 0.25]
    same(corpus_pipeline.keep_identified(spark, frame(rows), SMALL), wanted)
    rows = wanted

    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    model = toxicity.train(frame(rows), labels)
    wanted = [r for r, s in zip(rows, model.scores([r["text"] for r in rows])) if s < 0.5]
    same(corpus_pipeline.drop_toxic(spark, frame(rows), SMALL), wanted)
    rows = wanted

    first = brute_components([(k, r["text"]) for k, r in enumerate(rows)], 5, 80)
    wanted = [rows[k] for k, _, least in first if k == least]
    same(corpus_pipeline.drop_near_copies(spark, frame(rows), SMALL), wanted)


def test_near_copies_leave_one_of_each_group(documents, spark):
    base = " ".join(f"w{k}" for k in range(100))
    rows = [(1, base), (2, base), (3, base + " more"), (4, "other text entirely " * 3), (5, None), (6, None), (1, base)]
    kept = corpus_pipeline.drop_near_copies(spark, documents(rows).coalesce(1), SMALL).collect()
    assert sorted((r.doc_id for r in kept)) == [1, 4, 5, 6]
    assert corpus_pipeline.drop_near_copies(spark, documents([]), SMALL).collect() == []
