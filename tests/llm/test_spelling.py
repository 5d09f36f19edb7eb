"""Spelling variants against a plain search over all pairs."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cubelake.llm import spelling

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(docs):
    counts = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", (text or "").translate(LOW)):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(docs):
    words = words_of(docs)
    rows, form = [], {}
    for w, n in words.items():
        near = [v for v in words if abs(len(v) - len(w)) < 2 and one_edit(v, w)]
        best = min(near, key=lambda v: (-words[v], v), default=None)
        form[w] = best if near and words[best] >= 2 * n else None
        rows.append((w, n, len(near)))
    out = []
    for w, n, n_near in rows:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, n_near, words[form[w]] if form[w] else None))
    return sorted(out)


@pytest.fixture(scope="module")
def case():
    rng = random.Random(3)
    bases = ["haanth", "reoush", "Ouheré", "thinking", "aaaaab", "aabaab", "ÀÉÎõüx", "banana", "mississippi"]
    letters = "abhétüÿ"
    docs = []
    for k in range(400):
        words = []
        for _ in range(40):
            w = rng.choice(bases)
            for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
                at = rng.randrange(len(w))
                w = [w[:at] + w[at + 1 :], w[:at] + rng.choice(letters) + w[at:], w[:at] + rng.choice(letters) + w[at + 1 :]][rng.randrange(3)]
            words.append(w.upper() if rng.random() < 0.1 and w.isascii() else w)
        docs.append((k, rng.choice([" ", "-", "1", "\n", "\U0001f600"]).join(words)))
    long = "longrun" * 6  # 42 code points
    ends = [long, long + "x", long[:-1], "y" + long, long[:20] + "q" + long[21:], long[:32], long[:31], long[:33], "z" + long[1:33]]
    docs += [(1000 + k, " ".join(ends[: 3 + k % 9])) for k in range(30)]
    docs += [(2000, None), (2001, ""), (None, "banana banana bananb"), (5, docs[5][1]), (2002, "x÷y×zabc " * 4), (2003, "abcd " * 9)]
    return docs


def test_against_all_pairs(spark, case):
    frame = spark.createDataFrame(case, "doc_id long, text string").repartition(5)
    for name in ("word", "n", "node", "depth", "run", "sum", "id"):
        frame = frame.withColumn(name, F.lit("theirs"))
    got = sorted(map(tuple, spelling.spelling_groups(frame).collect()))
    wanted = brute(case)
    assert got == wanted
    assert any(r[1] and r[2] != r[1] for r in wanted) and any(len(r[0]) > spelling.LEVELS and r[4] for r in wanted)


def test_a_run_of_any_length(spark):
    run = "".join(random.Random(1).choices("abcdefgh", k=100_000))
    other = run[:50_000] + "z" + run[50_001:]
    docs = [(k, run) for k in range(5, 11)] + [(k, other) for k in range(20, 23)] + [(30, run[1:] + " " + run[1:] + " " + run[1:])]
    words = words_of(docs)
    got = spelling.spelling_groups(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.word: r.n for r in got} == words
    best = max(words, key=words.get)
    assert {r.word: r.n_near for r in got} == {w: sum(one_edit(w, v) for v in words) for w in words}
    assert all(r.root == best for r in got if r.form)


def test_variant_keys():
    for word in ("abcde", "aabbccé", "x" * 50):
        keys = spelling._variant_keys(word)
        assert len(keys) == len(word) + 1
        assert all(keys[k + 1] == spelling._variant_keys(word[:k] + word[k + 1 :])[0] for k in range(len(word)))
        assert keys.dtype == np.int64


def test_chains_of_forms(spark):
    chain = [(f"w{k:02d}", f"w{k + 1:02d}" if k < 20 else None) for k in range(21)]
    found = spelling.roots(spark.createDataFrame(chain, "word string, form string")).collect()
    assert {r.word: r.root for r in found} == {f"w{k:02d}": "w20" for k in range(20)}


def test_no_words(spark):
    for docs in ([], [(1, None), (2, "a b c"), (3, "word")]):
        assert spelling.spelling_groups(spark.createDataFrame(docs, "doc_id long, text string")).collect() == []
