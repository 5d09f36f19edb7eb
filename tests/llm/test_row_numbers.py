"""Row numbers that stay when a table's files are split otherwise from one job to the next."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cubelake.llm import html_text, jaccard, merkle
from cubelake.llm.common import numbered

SPLIT = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def resplit(spark, monkeypatch):
    """Files are read in many splits until the named function has run, then in few."""
    spark.conf.set(SPLIT, "4k")

    def after(module, name):
        real = getattr(module, name)

        def run(*args, **kwargs):
            out = real(*args, **kwargs)
            spark.conf.set(SPLIT, "128m")
            return out

        monkeypatch.setattr(module, name, run)

    yield after
    spark.conf.unset(SPLIT)


def stored(spark, tmp_dir, rows, schema):
    spark.createDataFrame(rows, schema).repartition(7).write.parquet(f"{tmp_dir}/t")
    return spark.read.parquet(f"{tmp_dir}/t")


def test_numbers_are_the_same_in_every_split(spark, resplit, tmp_dir):
    docs = stored(spark, tmp_dir, [(k % 9, f"text {k}") for k in range(300)], "doc_id long, text string")
    for df in (docs, docs.filter("doc_id < 8")):
        spark.conf.set(SPLIT, "4k")
        rows = numbered(df, [F.col("text")], "t")
        one = sorted(rows.collect())
        spark.conf.set(SPLIT, "128m")
        assert rows.columns == ["text", "__row"] and sorted(rows.collect()) == one
        assert len({r["__row"] for r in one}) == df.count()


def test_fingerprints_when_splits_change(spark, resplit, tmp_dir):
    rows = [(k, f"Text {k}, " * (k % 5 + 1)) for k in range(200)]
    docs = stored(spark, tmp_dir, rows, "doc_id long, text string")
    expected = sorted(merkle.fingerprint_edits(spark.createDataFrame(rows, docs.schema).coalesce(1)).collect())
    spark.conf.set(SPLIT, "4k")
    resplit(merkle, "ordered")
    assert sorted(merkle.fingerprint_edits(docs).collect()) == expected


def test_pages_when_splits_change(spark, resplit, tmp_dir):
    rows = [(k, f"http://h.org/{k // 2}/{k}", f"<p>menu<p>text {k}") for k in range(200)]
    pages = stored(spark, tmp_dir, rows, "page_id long, url string, html string")
    resplit(html_text, "ordered")
    got = html_text.extract(pages).collect()
    assert sorted((r.page_id, r.text) for r in got) == [(k, f"text {k}") for k in range(200)]


def test_near_copies_when_splits_change(spark, resplit, tmp_dir):
    words = [" ".join(f"w{k}x{n}" for n in range(40)) for k in range(60)]
    rows = [(k, words[k % 60] + (" end" if k >= 60 else "")) for k in range(120)]
    docs = stored(spark, tmp_dir, rows, "doc_id long, text string")
    resplit(jaccard, "components")  # after the prefixes are written, before the sets are read
    kept = corpus_pipeline.drop_near_copies(spark, docs, "").collect()
    assert sorted(r.doc_id % 60 for r in kept) == list(range(60))
