"""Filter interaction audit against a plain count per order."""

import re
from itertools import permutations

from pyspark.sql import functions as F

from cubelake.llm import filter_audit

LABELS = "doc_id long, quality int, toxic int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fails(text):
    words = WORD.findall(text)
    return {
        "A": len(words) < 200,
        "B": 100 * len(set(words)) < 50 * len(words),
        "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
        "D": bool(re.search(r"[#$%&*|]", text)),
    }


def brute(docs, labels):
    docs = [(i, t or "", s or "") for i, t, s in docs]
    firsts = {}
    for i, t, _ in docs:
        if i is not None:
            firsts[t] = min(i, firsts.get(t, i))
    marked = [(i, s, {**fails(t), "E": i is not None and i > firsts[t]}) for i, t, s in docs]
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    rows, total = {}, {}
    for part in {s for _, s, _ in marked}:
        for order in map("".join, permutations("ABCDE")):
            left = [m for m in marked if m[1] == part]
            for step, f in enumerate(order, 1):
                hit = [m for m in left if m[2][f]]
                left = [m for m in left if not m[2][f]]
                failing = [m for m in marked if m[1] == part and m[2][f]]
                alone = [m for m in failing if sum(m[2].values()) == 1]
                rows[part, order, step] = [
                    len(left), len(hit), len(failing) - len(hit), len(alone),
                    sum(m[0] in good for m in hit), sum(m[0] in toxic for m in hit),
                ]
                total[part, f] = total.get((part, f), 0) + len(hit)
    return sorted((*k, *v, total[k[0], k[1][k[2] - 1]]) for k, v in rows.items())


def long_text(seed, distinct=150):
    return " ".join(f"w{seed}x{k % distinct}" for k in range(240))


def case():
    docs = [
        (1, long_text(1), "a"), (2, long_text(1), "b"), (3, long_text(1), None), (3, long_text(1), None),
        (4, None, "a"), (5, "", "a"), (None, "", "b"), (6, " \t\n", "b"), (7, "one # two", None),
        (8, long_text(2, 30), "a"), (9, long_text(2, 30) + " $", "a"), (10, "SHOUT " * 220, "b"),
        (11, long_text(3) + "  É\U0001f600", "a"), (12, long_text(3).replace(" ", "\x0b"), "b"), (13, "x" * 300_000, "a"),
        (None, long_text(1), "a"), (0, "only", "zero"),
    ]
    labels = [(1, 1, 0), (2, 1, 0), (2, 0, 1), (3, 0, 1), (10, 1, 1), (99, 1, 1), (None, 1, 1), (5, None, None)]
    return docs, labels


def test_against_a_plain_count(spark):
    docs, labels = case()
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(5)
    # columns named like the helpers' own
    for name in ("hash", "block", "words", "mask", "body", "id", "keys", "part", "first"):
        frame = frame.withColumn(name, F.lit("theirs"))
    got = filter_audit.audit(frame, spark.createDataFrame(labels, LABELS))
    assert sorted(map(tuple, got.collect())) == brute(docs, labels)


def test_cleared_texts_are_unique_and_no_copy_is_cleared(spark):
    texts = [f"text {k}" for k in range(3000)] + [f"text {k}" for k in range(0, 3000, 50)] * 2
    frame = spark.createDataFrame([(t,) for t in texts], "t string").repartition(7)
    hashed = frame.select("t", F.xxhash64("t").alias("hash"))
    sketch, blocks = filter_audit.repeat_sketch(hashed.select("hash"), len(texts))
    block, places = filter_audit.cell_numbers(F.col("hash"), blocks)
    probed = hashed.withColumn("block", block).join(sketch, "block", "left")
    maybe = {r.t for r in probed.filter(filter_audit._may_repeat(F.col("words"), places)).collect()}
    copies = {f"text {k}" for k in range(0, 3000, 50)}
    assert copies <= maybe and len(maybe) < len(copies) + 150


def test_a_sketch_that_is_too_small_changes_no_result(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "MAX_SKETCH_BYTES", filter_audit.BLOCK // 8)
    monkeypatch.setattr(filter_audit, "TASK_TEXTS", 100)
    docs = [(k, f"t{k % 4000}", "s") for k in range(5000)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string")
    masks = filter_audit.masks(frame, {"doc_id": F.col("doc_id")}).collect()
    assert {r.doc_id for r in masks if r.mask & filter_audit.COPY} == set(range(4000, 5000)) and len(masks) == 5000


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert filter_audit.audit(empty, spark.createDataFrame([], LABELS)).collect() == []
