"""Spelling variants: words one edit apart, each led to its most frequent neighbour.

The vocabulary is a trie kept as a table: one row per node, with its parent and
the code point between them. Neighbours are found by a frontier that walks the
trie against itself, one level a round. A state of the frontier is a pair of
nodes whose strings are exactly one edit apart: the prefix of a word, as far as
it has been read, and the node that matches it after the edit. All words that
share a prefix share its states. A round

* starts a replacement at each pair of siblings, and a deletion at each edge
  (an insertion is the deletion seen from the other word),
* takes every state a code point further by joining the edge table twice: to
  the edges that leave the word's node, and to the same code points from the other,
* hands out the states of which both nodes end a word: neighbours.

Words without edits yet need no state of their own: they are the trie. Each
pair of neighbours is found once: a replacement by its place, a deletion by the
last of a run of equal code points.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cubelake.llm.common import cut, ship
from cubelake.session import scratch_dir

#: Words are runs of these; only A to Z are lower-cased.
RUN = r"A-Za-zÀ-ÿ"
MIN_LENGTH, MIN_COUNT = 5, 3
#: A run is mangled if this divides its checksum.
MANGLE = 97
#: Levels of the trie. A longer word (a run without spaces can have any length) would cost a
#: round for each of its code points; such words meet by their deletion variants instead.
LEVELS = 32


def word_counts(docs: DataFrame) -> DataFrame:
    """``word`` and its occurrences ``n``, for the words of ``docs`` (doc_id, text) that count.

    Runs lose a code point where the checksum of ``<doc_id>:<run>`` says so
    (a null doc_id stands as nothing before the colon). Null texts have no
    runs; repeated rows count again.
    """
    low = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    # shorter runs give no word, whatever the checksum
    runs = F.regexp_extract_all(low, F.lit(f"[{RUN}]{{{MIN_LENGTH},}}"), F.lit(0))
    rows = docs.select(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":")).alias("id"), F.explode(runs).alias("run"))
    sum_ = F.crc32(F.concat("id", "run").cast("binary"))
    at = (F.col("sum") % F.length("run")).cast("int")
    mangled = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("sum") % MANGLE == 0, mangled).otherwise(F.col("run"))
    words = rows.withColumn("sum", sum_).select(word.alias("word"))
    counted = words.filter(F.length("word") >= MIN_LENGTH).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") >= MIN_COUNT)


def edge_table(words: DataFrame, path: str) -> DataFrame:
    """The trie of ``words`` (word, n) as a table: node, its parent, the code point between, ``n`` where a word ends.

    Written to ``path`` in a folder per depth, so that a round reads its own levels.
    """
    places = words.withColumn("depth", F.explode(F.sequence(F.lit(1), F.length("word"))))
    ends = F.when(F.col("depth") == F.length("word"), F.col("n"))
    nodes = places.groupBy(F.substring("word", F.lit(1), F.col("depth")).alias("node"), "depth").agg(F.max(ends).alias("n"))
    edges = nodes.select(
        "depth",
        "node",
        F.substring("node", F.lit(1), F.col("depth") - 1).alias("parent"),
        F.substring("node", F.col("depth"), F.lit(1)).alias("char"),
        "n",
    )
    edges.hint("rebalance", "depth").write.partitionBy("depth").parquet(path)
    return words.sparkSession.read.schema("node string, parent string, char string, n long, depth int").parquet(path)


def _started(edges: DataFrame, depth: int) -> DataFrame:
    """States whose edit is the last code point read, the node of the other word being at ``depth``."""
    level = edges.filter(F.col("depth") == depth)
    left = level.select("parent", *[F.col(c).alias(f"{c}_a") for c in ("node", "char", "n")])
    right = level.select("parent", *[F.col(c).alias(f"{c}_b") for c in ("node", "char", "n")])
    # siblings: at most one per letter of the alphabet, so a parent gives a bounded number of pairs
    replaced = left.join(right, "parent").filter("char_a < char_b")
    replaced = replaced.select("node_a", "n_a", "node_b", "n_b", F.lit(None).cast("string").alias("barred"))
    below = edges.filter(F.col("depth") == depth + 1)
    here = level.select(F.col("node").alias("node_b"), F.col("n").alias("n_b"))
    deleted = below.select(F.col("node").alias("node_a"), F.col("n").alias("n_a"), F.col("parent").alias("node_b"), F.col("char").alias("barred"))
    deleted = deleted.join(here, "node_b").select("node_a", "n_a", "node_b", "n_b", "barred")
    return replaced.unionByName(deleted)


def _advanced(states: DataFrame, edges: DataFrame, depth: int) -> DataFrame:
    """States a code point further, the node of the other word being at ``depth`` then."""
    # the word's node is as deep as the other one, or one deeper after a deletion
    out = edges.filter(F.col("depth").isin(depth, depth + 1))
    out = out.select(F.col("parent").alias("node_a"), F.col("node").alias("next_a"), F.col("n").alias("next_n"), "char")
    stepped = states.select("node_a", "node_b", "barred").join(out, "node_a")
    # of equal code points in a row, only the last counts as deleted
    stepped = stepped.filter("barred IS NULL OR barred <> char")
    other = edges.filter(F.col("depth") == depth).select("node", F.col("n").alias("n_b"))
    stepped = stepped.withColumn("node", F.concat("node_b", "char")).drop("node_b", "node_a")
    return stepped.join(other, "node").select(
        F.col("next_a").alias("node_a"),
        F.col("next_n").alias("n_a"),
        F.col("node").alias("node_b"),
        "n_b",
        F.lit(None).cast("string").alias("barred"),
    )


def _roots_deleted(edges: DataFrame) -> DataFrame:
    """States of the root: the first code point of the word deleted."""
    first = edges.filter("depth = 1")
    return first.select(
        F.col("node").alias("node_a"), F.col("n").alias("n_a"), F.lit("").alias("node_b"),
        F.lit(None).cast("long").alias("n_b"), F.col("char").alias("barred"),
    )


def trie_neighbours(words: DataFrame) -> DataFrame:
    """Pairs (``a``, ``n_a``, ``b``, ``n_b``) of words of up to ``LEVELS`` code points one edit apart, each once."""
    spark = words.sparkSession
    short = words.filter(F.length("word") <= LEVELS)
    edges = edge_table(short, scratch_dir(spark, "trie"))
    deepest = edges.agg(F.max("depth")).first()[0] or 0
    found = scratch_dir(spark, "neighbours")
    states = _roots_deleted(edges)
    for depth in range(1, deepest + 1):
        states = cut(_started(edges, depth).unionByName(_advanced(states, edges, depth)), f"frontier-{depth}")
        ended = states.filter("n_a IS NOT NULL AND n_b IS NOT NULL")
        ended.select(F.col("node_a").alias("a"), "n_a", F.col("node_b").alias("b"), "n_b").write.mode("append").parquet(found)
    form = "a string, n_a long, b string, n_b long"
    return spark.read.schema(form).parquet(found) if deepest else spark.createDataFrame([], form)


_ODD, _INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)


def _variant_keys(word: str) -> np.ndarray:
    """Hashes of the word (first) and of it without each of its code points, in linear time."""
    points = np.frombuffer(word.encode("utf-32-le"), "<u4").astype(np.uint64) + np.uint64(1)
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(points) - 1, _ODD, np.uint64)]), dtype=np.uint64)
        sums = np.cumsum(points * powers, dtype=np.uint64)
        before = sums - points * powers
        without = before + (sums[-1] - sums) * np.uint64(_INVERSE)
    return np.concatenate([sums[-1:], without]).view(np.int64)


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for word_id, word in zip(batch.column(0), batch.column(1)):
            keys = _variant_keys(word.as_py())
            place = np.arange(-1, len(keys) - 1)
            for k in range(0, len(keys), 1 << 16):
                part = slice(k, k + (1 << 16))
                yield pa.RecordBatch.from_pydict(
                    {
                        "id": pa.array(np.full(len(keys[part]), word_id.as_py())),
                        "key": pa.array(keys[part]),
                        "place": pa.array(place[part]),
                    }
                )


def long_neighbours(words: DataFrame) -> DataFrame:
    """Pairs as ``trie_neighbours`` gives them, of words one of which has over ``LEVELS`` code points.

    Words that differ at one place agree without it: they meet by the hash of
    that variant (and its place), and are compared whole afterwards. A word
    has as many variants as code points.
    """
    long = cut(words.filter(F.length("word") >= LEVELS).withColumn("id", F.monotonically_increasing_id()), "long-words")
    rows = cut(long.select("id", "word").mapInArrow(_variants, "id long, key long, place long"), "variants")
    less = rows.filter("place >= 0")
    replaced = less.alias("l").join(less.alias("r"), ["key", "place"]).filter("l.id < r.id").select("l.id", "r.id")
    whole = rows.filter("place < 0")
    deleted = less.alias("l").join(whole.alias("r"), "key").filter("l.id <> r.id").select("l.id", "r.id")
    pairs = replaced.toDF("id_a", "id_b").unionByName(deleted.toDF("id_a", "id_b")).distinct()
    left = long.select(F.col("id").alias("id_a"), F.col("word").alias("a"), F.col("n").alias("n_a"))
    right = long.select(F.col("id").alias("id_b"), F.col("word").alias("b"), F.col("n").alias("n_b"))
    both = pairs.join(left, "id_a").join(right, "id_b").filter(F.levenshtein("a", "b", 1) == 1)
    # a pair of words that both are short enough was found in the trie
    both = both.filter(F.greatest(F.length("a"), F.length("b")) > LEVELS)
    return both.select("a", "n_a", "b", "n_b")


def forms(words: DataFrame, pairs: DataFrame) -> DataFrame:
    """``words`` (word, n) with ``n_near``, and ``form`` and ``form_n`` where a neighbour is twice as frequent."""
    near = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("n_b").alias("m")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("n_a").alias("m"))
    )
    # the least of (-n, word): the most frequent neighbour, of equals the first in code-point order
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct(-F.col("m"), "other")).alias("best"))
    best = best.select("word", "n_near", (-F.col("best.col1")).alias("m"), F.col("best.other").alias("other"))
    twice = F.col("m") >= 2 * F.col("n")
    return words.join(best, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(twice, F.col("other")).alias("form"),
        F.when(twice, F.col("m")).alias("form_n"),
    )


def roots(formed: DataFrame) -> DataFrame:
    """``word`` and ``root`` for the words with a form: where their chain of forms ends.

    Every form is at least twice as frequent as its word, so chains end, and
    after at most log2 of the largest count; each round doubles the steps
    taken, so there are few.
    """
    reached = cut(formed.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), "forms")
    while True:
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = reached.join(further, "root", "left")
        if stepped.filter("next IS NOT NULL").isEmpty():
            return reached
        reached = cut(stepped.select("word", F.coalesce("next", "root").alias("root")), "forms")


def spelling_groups(docs: DataFrame) -> DataFrame:
    """Words of ``docs`` (doc_id, text) with their forms: word, form, root, n, n_near, form_n.

    Ties between neighbours go to the first word in code-point order. Null
    and empty texts have no words, repeated rows count again, an empty table
    (or one without words) gives no rows, and other columns are not looked
    at. Texts and words may have any length.
    """
    ship(docs.sparkSession)
    words = cut(word_counts(docs.select("doc_id", "text")), "words")
    pairs = trie_neighbours(words).unionByName(long_neighbours(words))
    formed = cut(forms(words, pairs), "formed")
    ends = roots(formed)
    root: Column = F.coalesce("root", "word")
    return formed.join(ends, "word", "left").select("word", "form", root.alias("root"), "n", "n_near", "form_n")
