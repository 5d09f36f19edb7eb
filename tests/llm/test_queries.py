"""The registered queries over the whole sf0.001 tables, against independent computations."""

import hashlib
import html
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cubelake.llm.queries import ORACLE, QUERIES

from .test_similarity import brute_components, brute_nearest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_op2(spark, docs):
    got = {r.doc_id: r for r in QUERIES["op2_byte_shards"](spark, SF).collect()}
    total, before, slots = sum(len(t.encode()) + 8 for _, t in docs), 0, {}
    for doc_id, text in docs:
        r, size = got[doc_id], len(text.encode()) + 8
        shard = min(23, 24 * (2 * before + size) // (2 * total))
        assert (r.size, r.text_crc32, r.shard, r.slot) == (size, zlib.crc32(text.encode()), shard, slots.get(shard, 0))
        slots[shard] = slots.get(shard, 0) + 1
        before += size
    assert len(got) == len(docs)


def test_op4(spark, docs):
    got = {r.doc_id: r for r in QUERIES["op4_merkle_fingerprints"](spark, SF).collect()}
    assert len(got) == len(docs)
    for k, (doc_id, text) in enumerate(docs):
        cut = len(text) // 4
        edited = text[: len(text) - cut] + docs[(k + 1) % len(docs)][1][:cut]
        assert got[doc_id].n_chars == len(text) and got[doc_id].edited_sha256 == sha(edited)
    assert np.mean([r.near_edited > r.near_next for r in got.values()]) > 0.95
    assert len({r.fingerprint for r in got.values()}) == len({t for _, t in docs})


def test_op5(spark, docs):
    got = QUERIES["op5_ngram_jaccard"](spark, SF).collect()
    assert sorted(map(tuple, got)) == sorted(brute_components(docs, 3, 90))


def test_op6(spark, docs):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op6_byte_bpe"](spark, SF).collect()}
    for doc_id, text in docs:
        ids = library.encode(text, add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        assert got[doc_id] == (len(ids), sha(",".join(map(str, ids))), sha(back))


def test_op7(spark):
    got = QUERIES["op7_toxicity_gru"](spark, SF).toPandas()
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    both = got.merge(labels, on="doc_id")
    assert len(got) == 200 and got.score.between(0, 1).all()
    assert ((got.score >= 0.5) == (got.predicted == 1)).all()
    assert (both[~both.held_out].predicted == both[~both.held_out].toxic).mean() > 0.9


def test_op8(spark, docs):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = QUERIES["op8_window_packing"](spark, SF).toPandas()
    for doc_id, text in docs:
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 2], "<u4")
        place = 0
        for r in got[got.doc_id == doc_id].sort_values("start").itertuples():
            assert (r.start, r.doc_tokens) == (place, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[place : place + r.length].tobytes())
            place += r.length
        assert place == len(ids)
    sizes = got.groupby("sequence_id").length.sum()
    padding = sum(0 if n & (n - 1) == 0 else 4096 - n for n in sizes)
    assert sizes.max() <= 4096 and padding < 0.02 * sizes.sum()


def test_op9(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = QUERIES["op9_learned_partitions"](spark, SF).collect()
    expected = brute_nearest(rows, 20)
    assert len(got) == len(expected)
    hits = {(r.query_id, r.vec_id) for r in got} & {(q, v) for q, _, v, _ in expected}
    assert len(hits) >= 0.9 * len(expected)


def test_op10(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = QUERIES["op10_page_differencing"](spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        source = pages[r.page_id].html
        article = source[source.index("<article>") : source.index("</article>")]
        plain = html.unescape(re.sub("<[^>]*>", lambda m: "" if m[0] in ("<b>", "</b>") else " ", article))
        assert r.text == " ".join(plain.split()) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_queries_with_sql(spark):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for name in ("documents", "pages", "events", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    for name, sql in ORACLE.items():
        result = con.execute(sql)
        names = [d[0] for d in result.description]
        got = QUERIES[name](spark, SF)
        assert sorted(got.columns) == sorted(names)
        assert sorted(map(str, (tuple(r) for r in got.select(*names).collect()))) == sorted(map(str, result.fetchall()))
