"""The corpus pipeline: language ID, toxicity, near copies, packing.

Each stage takes (spark, docs, sf_dir) and returns what it keeps, with the
columns of documents; the last returns the packed pieces. ``run`` writes each
stage's result to the shared folder and reads it back for the next, so a lost
executor costs at most one stage's tasks.

SQL cannot express the trained stages, so there is no ORACLE_SQL; the tests
hold the stages against brute force.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cubelake.llm import jaccard, lang_id, packing, toxicity
from cubelake.llm.common import cut, numbered, table

#: A document goes if it has no letters, or if no language contains this share of its n-grams.
MIN_LANGUAGE_SCORE = 0.25
#: Near copies: words of an n-gram, and percent of Jaccard similarity.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def _whole(docs: DataFrame):
    """All columns as one, so that no name of them can clash with a helper's."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document")


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text some learned language claims; learned from the rows of ``docs`` that name theirs.

    Null texts and texts without a letter go; repeated rows share their fate.
    If no row names a language, nothing is claimed. An empty table stays empty.
    """
    filters = lang_id.train(docs.filter(~lang_id.held_out_fold(F.col("doc_id"))))
    found = docs.select(_whole(docs), lang_id.identify(docs, filters).alias("language"))
    identified = (F.col("language.lang_pred") != lang_id.UNDETERMINED) & (F.col("language.score") >= MIN_LANGUAGE_SCORE)
    return found.filter(identified).select("document.*")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network, trained on the labelled rows of ``docs``, does not find toxic.

    Null and empty texts stay; repeated rows share their fate. With labels of
    one class only, all go (all toxic) or stay. An empty table stays empty.
    """
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    found = docs.select(_whole(docs), toxicity.score(docs, model).alias("score"))
    return found.filter("score < 0.5").select("document.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the first in the order of the table.

    Wordless texts (null ones too) all stay, repeated rows are copies, null
    doc_ids matter to nothing. An empty table stays empty.
    """
    rows = numbered(docs, [_whole(docs), F.col("text")], "rows")
    keyed = rows.select(F.col("__row").alias("doc_id"), "text")
    linked = jaccard.link_components(keyed, NEAR_WORDS, NEAR_PERCENT)
    copies = cut(linked.filter("component_id <> doc_id").select(F.col("doc_id").alias("__row")), "near-copies")
    return rows.join(copies, "__row", "left_anti").select("document.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 4096 tokens; null and empty texts are one token each."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language ID", keep_identified),
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_copies),
    ("packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)
