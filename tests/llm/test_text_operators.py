"""Shards, fingerprints, BPE and packing against brute force, with odd inputs."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cubelake.llm import bpe, merkle, packing, shards

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")

TEXTS = [
    None,
    "",
    " ",
    "one",
    "One two, three.\nFour five; six!\n\nSeven",
    "tie tie tie. " * 40,
    "tie tie tie. " * 40,
    "It's  they're\t 'll \r\n x y 　z \x85q \x1cr 12 3.5 ...",
    "ÉCOLE Straße naïve İstanbul ΑΣ 日本語 🙂é",
    "a<|endoftext|>b <|startoftext|> c",
    "long " * 9000 + "end",
    "x" * 3000,
]
ROWS = [(k, t) for k, t in enumerate(TEXTS)] + [(4, TEXTS[4]), (None, "no id")]
#: Columns named like those of the results.
CLASHING = "doc_id long, text string, size int, shard int, slot int, fingerprint string, n_tokens int, ids int, start int"


def tables(documents):
    yield documents(ROWS), ROWS
    yield documents(ROWS, CLASHING), ROWS
    yield documents([(7, "alone")]), [(7, "alone")]
    yield documents([]), []


def by_id(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))


def test_shards_are_contiguous_and_balanced(documents):
    for docs, rows in tables(documents):
        got = shards.shard_documents(docs, shards=5).collect()
        sizes = sorted((r.doc_id if r.doc_id is not None else -1, r.size, r.text_crc32) for r in got)
        raw = [(-1 if i is None else i, (t or "").encode()) for i, t in rows]
        assert sizes == sorted((i, len(b) + 8, zlib.crc32(b)) for i, b in raw)
        total = sum(r.size for r in got)
        heavy = max((r.size for r in got), default=0)
        order = sorted(got, key=lambda r: (r.shard, r.slot))
        ids = [-1 if r.doc_id is None else r.doc_id for r in order]
        assert ids == sorted(ids)
        for k in range(5):
            part = [r for r in order if r.shard == k]
            assert [r.slot for r in part] == list(range(len(part)))
            assert abs(sum(r.size for r in part) - total / 5) <= heavy
        assert all(r.law == "bytes" and r.grown_shard is None for r in got)


def test_fingerprints_of_edits(documents):
    for docs, rows in tables(documents):
        got = merkle.fingerprint_edits(docs).collect()
        order = [t or "" for _, t in by_id(rows)]
        ids = [i for i, _ in by_id(rows)]
        expected = []
        for k, text in enumerate(order):
            cut = len(text) // 4
            edited = text[: len(text) - cut] + order[(k + 1) % len(order)][:cut]
            expected.append((ids[k] if ids[k] is not None else -1, len(text), hashlib.sha256(edited.encode()).hexdigest()))
        assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_chars, r.edited_sha256) for r in got) == sorted(expected)
        assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
        by_print = {}
        for r in got:
            if r.doc_id is not None:
                by_print.setdefault(TEXTS[r.doc_id] if len(rows) > 1 else "alone", set()).add(r.fingerprint)
        assert all(len(v) == 1 for v in by_print.values())


def test_fingerprint_locates_edits(spark):
    a = "\n".join(f"paragraph {k}, of many." for k in range(40))
    b = a.replace("paragraph 17", "Paragraph 17")
    rows = spark.createDataFrame([(a, b)], "a string, b string")
    fa, fb = merkle.fingerprint(F.col("a")), merkle.fingerprint(F.col("b"))
    row = rows.select(
        merkle.differing_paragraphs(fa, fb).alias("d"), merkle.likeness(fa, fb).alias("l"), merkle.likeness(fa, fa).alias("s")
    ).first()
    assert row.d == [17] and 0.9 < row.l < 1 and row.s == 1
    # Independent digest of a two-paragraph tree.
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    paragraphs = [sha("p" + sha("x,") + sha(" y.") + sha("\n")), sha("p" + sha("z"))]
    top = sha("r" + sha("s" + "".join(paragraphs)))
    got = spark.createDataFrame([("x, y.\nz",)], "t string").select(merkle.root(merkle.fingerprint(F.col("t"))))
    assert got.first()[0] == top


@pytest.fixture(scope="module")
def byte_library():
    return Tokenizer.from_file(BYTE_BPE)


def test_byte_bpe_matches_the_library(documents, byte_library):
    for docs, rows in tables(documents):
        got = bpe.round_trip_digest(docs, BYTE_BPE).collect()
        expected = []
        for i, text in rows:
            ids = byte_library.encode(text or "", add_special_tokens=False).ids
            back = byte_library.decode(ids, skip_special_tokens=False)
            sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
            expected.append((-1 if i is None else i, len(ids), sha(",".join(map(str, ids))), sha(back)))
        assert sorted((-1 if r[0] is None else r[0], *r[1:]) for r in got) == sorted(expected)


def test_byte_bpe_columns_round_trip(documents):
    coded = bpe.encode_documents(documents(ROWS), BYTE_BPE)
    for row in bpe.decode_documents(coded, BYTE_BPE).collect():
        assert row.decoded == (row.text or "")


def test_byte_bpe_cache_that_overflows(monkeypatch, byte_library):
    monkeypatch.setattr(bpe, "CACHE_UNITS", 8)
    coder = bpe.ByteBPE(bpe.read_vocabulary(BYTE_BPE))
    text = " ".join(f"word{k} thing{k}," for k in range(50)) * 2
    assert coder.encode(text) == byte_library.encode(text, add_special_tokens=False).ids
    assert len(coder._cache) <= 8


def test_packing_places_every_token_once(documents):
    library = Tokenizer.from_file(WORD_BPE)
    for docs, rows in tables(documents):
        for limit in (4096, 64):
            got = packing.pack(docs, WORD_BPE, limit=limit).collect()
            whole = {}
            for i, text in rows:
                ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
                whole.setdefault(i, []).append(np.array(ids, "<u4"))
            for i, copies in whole.items():
                pieces = sorted((r for r in got if r.doc_id == i), key=lambda r: r.start)
                assert sum(r.length for r in pieces) == sum(map(len, copies))
                assert {r.doc_tokens for r in pieces} == {len(copies[0])}
                for r in pieces:
                    assert r.ids_crc32 == zlib.crc32(copies[0][r.start : r.start + r.length].tobytes())
                    assert r.length > 0
            sequences = {}
            for r in got:
                sequences.setdefault(r.sequence_id, []).append(r)
            for parts in sequences.values():
                parts.sort(key=lambda r: r.offset)
                ends = np.cumsum([r.length for r in parts])
                assert [r.offset for r in parts] == [0, *ends[:-1]] and ends[-1] <= limit


def test_packing_finds_added_tokens_in_the_raw_text_only():
    with open(WORD_BPE, encoding="utf-8") as f:
        words = packing.WordIds(f.read())
    library = Tokenizer.from_file(WORD_BPE)
    rng = np.random.default_rng(4)
    parts = ["<|endoftext|>", "<|ENDOFTEXT|>", "<|EndOfText|>", "<|startoftext|>", "<|STARTOFTEXT|>", "Hello", "WORLD", " ", ".", ","]
    parts += ["é", "É", "x", "1", "<|", "|>", "endoftext", "\n", "don't", "'S", "İ", "ß", "ﬁ"]
    for _ in range(3000):
        text = "".join(rng.choice(parts, rng.integers(1, 9)))
        assert words.encode(text.encode(), b"").tolist() == library.encode(text, add_special_tokens=False).ids, text


def brute_plan(total, ends, sentences, limit, free):
    """Least cost over all sets of the cuts that ``plan`` may use."""
    cost = {0: 0.0, total: 0.0} | dict.fromkeys(free, packing.FREE_CUT)
    cost |= dict.fromkeys(sentences, packing.SENTENCE_CUT) | dict.fromkeys(ends, 0.0)
    cost[total] = 0.0
    best = {0: 0.0}
    for at in sorted(cost):
        if at:
            best[at] = cost[at] + packing.WINDOW_COST + min(
                best[b] + (0 if (at - b) & (at - b - 1) == 0 else limit - at + b) for b in best if 0 < at - b <= limit
            )
    return best[total]


def test_plan_is_optimal():
    rng = np.random.default_rng(5)
    for _ in range(60):
        total, limit = int(rng.integers(1, 300)), int(rng.choice([16, 48, 64]))
        ends = np.unique(np.append(rng.integers(1, total + 1, 6), total))
        sentences = np.unique(rng.integers(1, total + 1, 20))
        cuts = packing.plan(total, ends, sentences, limit)
        assert cuts[-1] == total and max(np.diff([0, *cuts])) <= limit
        powers = [1 << k for k in range(limit.bit_length()) if 1 << k <= limit]
        tail = total - np.cumsum([0, *(p for p in powers if total & p)])
        free = [int(x) for x in [*range(0, total, min(packing.GRID, limit)), *tail] if 0 <= x <= total]
        cost, last = 0.0, 0
        for c in cuts:
            n = c - last
            cost += packing.WINDOW_COST + (0 if n & (n - 1) == 0 else limit - n)
            if c != total and c not in ends:
                cost += packing.SENTENCE_CUT if c in sentences else packing.FREE_CUT
            last = c
        assert cost == pytest.approx(brute_plan(total, ends.tolist(), sentences.tolist(), limit, free))


def test_packing_across_plans(monkeypatch):
    """Windows that go on from one plan into the next keep every token in order."""
    monkeypatch.setattr(packing, "PLAN_TOKENS", 500)
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, 50, int(n)).astype("<u4") for n in rng.integers(1, 400, 60)]
    run = packing.Run(64, np.arange(60) < 5)
    got = [p for k, d in enumerate(docs) for p in run.add(k, d)] + list(run.finish())
    stream = np.concatenate(docs)
    rebuilt = np.concatenate([docs[p[0]][p[1] : p[1] + p[2]] for p in got])
    assert (rebuilt == stream).all()
    filled = {}
    for p in got:
        assert p[6] == filled.get(p[5], 0)
        filled[p[5]] = p[6] + p[2]
    assert max(filled.values()) <= 64
    padding = sum(0 if n & (n - 1) == 0 else 64 - n for n in filled.values())
    assert padding < 0.3 * len(stream)
