"""How filters interact: what each one removes, in every order, and what that costs.

Each document gets a mask with a bit per filter it fails. All figures of a
report (what is kept, removed, redundant, lost, in any order of the filters)
are sums of counts per mask, so the documents are read for their masks once
and never again per order.

One failure is not a matter of a single text: being a copy. Its method is a
counting-Bloom prepass. Every task counts the hashes of its texts in a sketch
of small counters; the sketches are merged block by block. A text one of whose
counters stands at 1 occurs once: it is cleared where it is read. Only the
others (copies, and a few that share all counters by chance) are shuffled, and
the smallest id of each full text is found among them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import permutations
from operator import and_

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cubelake.llm.common import cut, ship

#: Counters in a block (a power of two), and counters that one text raises in its block.
BLOCK, HASHES = 1 << 12, 4
#: Counters per document: the merged sketch takes one bit for each.
PER_DOCUMENT = 8
#: Bound of the merged sketch, which every task gets: 64 MB. It serves 64 million documents
#: as above; on more it is fuller, so it clears fewer texts and more of them are shuffled.
#: No result depends on it: a cluster with larger executors can raise it in proportion.
MAX_SKETCH_BYTES = 1 << 26
#: Texts that a task counts before it hands its sketch on.
TASK_TEXTS = 1 << 20

LETTERS = "ABCDE"
COPY = 1 << LETTERS.index("E")


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def text_mask(text: Column) -> Column:
    """Bits of the failures A to D of a text.

    A: under 200 words; B: under half of the words distinct; C: over 2 % of
    the code points are ``[A-Z]``; D: holds any of ``#$%&*|``. A text without
    words fails A alone.
    """
    words = _words(text)
    fails = [
        F.size(words) < 200,
        100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        100 * F.regexp_count(text, F.lit("[A-Z]")) > 2 * F.length(text),
        text.rlike(r"[#$%&*|]"),
    ]
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))


def cell_numbers(hash_: Column, blocks: int) -> tuple[Column, list[Column]]:
    """Block of a text hash, and the places in it of the counters that the text raises."""
    bits = BLOCK.bit_length() - 1
    block = F.pmod(F.shiftrightunsigned(hash_, 32), F.lit(blocks))
    spread = F.xxhash64(hash_)
    return block, [F.shiftrightunsigned(spread, bits * i).bitwiseAND(BLOCK - 1) for i in range(HASHES)]


def _raised(cells: np.ndarray) -> np.ndarray:
    """Each row's counters once: a text raises a counter by one, though two of its places may agree."""
    ordered = np.sort(cells, axis=1)
    fresh = np.ones(ordered.shape, bool)
    fresh[:, 1:] = ordered[:, 1:] != ordered[:, :-1]
    return ordered[fresh]


def _task_sketches():
    """For ``mapInArrow`` over the cells of texts: this task's counters, a row per block it touched."""

    def sketch(cells: np.ndarray) -> pa.RecordBatch:
        cells, counts = np.unique(_raised(cells), return_counts=True)
        block, starts = np.unique(cells // BLOCK, return_index=True)
        ends = [*starts[1:], len(cells)]
        places, counts = (cells % BLOCK).astype("<u2"), np.minimum(counts, 2).astype("u1")
        return pa.RecordBatch.from_pydict(
            {
                "block": pa.array(block, pa.int64()),
                "places": pa.array([places[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
                "counts": pa.array([counts[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
            }
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1))
            n += len(held[-1])
            if n >= TASK_TEXTS:
                yield sketch(np.concatenate(held))
                held, n = [], 0
        if n:
            yield sketch(np.concatenate(held))

    return run


def _merge_block(key: tuple, sketches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counters of one block added up; its words have a bit for each that reached 2."""
    total = np.zeros(BLOCK, np.uint8)
    for part in sketches:
        for places, counts in zip(part["places"], part["counts"]):
            at = np.frombuffer(places, "<u2")
            total[at] = np.minimum(total[at] + np.frombuffer(counts, "u1"), 2)
    if (total >= 2).any():
        words = np.packbits(total >= 2, bitorder="little").view("<i8")
        yield pd.DataFrame({"block": [key[0]], "words": [words]})


def repeat_sketch(hashes: DataFrame, documents: int) -> tuple[DataFrame, int]:
    """Merged sketch of a frame of text hashes (``hash``): (rows of block and bits, number of blocks).

    A task hands on only the blocks it touched, with saturated counters, so a
    text that a third of the rows share is one counter of each task.
    """
    most = MAX_SKETCH_BYTES * 8 // BLOCK
    blocks = min(most, max(1, -(-documents * PER_DOCUMENT // BLOCK)))
    block, places = cell_numbers(F.col("hash"), blocks)
    cells = hashes.select(*[(block * BLOCK + p).alias(f"cell{i}") for i, p in enumerate(places)])
    parts = cells.mapInArrow(_task_sketches(), "block long, places binary, counts binary")
    merged = parts.groupBy("block").applyInPandas(_merge_block, "block long, words array<long>")
    return cut(merged, "sketch"), blocks


def _may_repeat(words: Column, places: list[Column]) -> Column:
    """Whether all of a text's counters reached 2 (``words`` is null for a block of which none did)."""
    bits = [F.getbit(F.get(words, F.shiftright(p, 6).cast("int")), (p % 64).cast("int")) for p in places]
    return words.isNotNull() & reduce(and_, (b == 1 for b in bits))


def masks(docs: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """``keys`` of every document with its ``mask``: a bit for each filter of ``LETTERS`` that it fails.

    ``docs`` needs ``doc_id`` and ``text``; a null text is an empty one, and
    the copy of other empty ones. Bit E: another row with the identical text
    has a smaller doc_id, whatever that row's own mask is. Rows with the
    smallest id of their text never have it, also where several rows share
    that id; a null id is neither smaller than another nor has any smaller.
    Texts are compared whole. An empty table gives no rows. Columns of ``docs``
    are read through ``keys`` alone, so no name of them can clash.
    """
    spark = docs.sparkSession
    ship(spark)
    text = F.coalesce(F.col("text"), F.lit(""))
    hashes = docs.select(F.xxhash64(text).alias("hash"))
    sketch, blocks = repeat_sketch(hashes, docs.count())
    rows = docs.select(
        F.struct(*[c.alias(k) for k, c in keys.items()]).alias("keys"),
        F.col("doc_id").alias("id"),
        text.alias("body"),
        F.xxhash64(text).alias("hash"),
        text_mask(text).alias("fails"),
    )
    block, places = cell_numbers(F.col("hash"), blocks)
    # at most MAX_SKETCH_BYTES, whatever the number of documents
    probed = rows.withColumn("block", block).join(F.broadcast(sketch), "block", "left")
    maybe = _may_repeat(F.col("words"), places) & F.col("id").isNotNull()
    # the whole texts are read for the second and last time here; cleared ones are let go
    marked = cut(
        probed.select("keys", "id", "fails", "hash", F.when(maybe, F.col("body")).alias("body")), "masked"
    )
    cleared = marked.filter("body IS NULL").select("keys.*", F.col("fails").alias("mask"))
    repeats = marked.filter("body IS NOT NULL")
    # the hash leads, so that sorting and dealing rarely look at a text
    firsts = cut(repeats.groupBy("hash", "body").agg(F.min("id").alias("first")), "firsts")
    compared = repeats.join(firsts, ["hash", "body"])
    copied = F.when(F.col("id") > F.col("first"), COPY).otherwise(0)
    return cleared.unionByName(compared.select("keys.*", (F.col("fails") + copied).alias("mask")))


def mask_counts(marked: DataFrame, labels: DataFrame, part: str = "part") -> DataFrame:
    """Documents, good ones and toxic ones per ``part`` and ``mask`` (``marked`` has these and doc_id).

    A document is good (toxic) if any of its rows in ``labels`` has quality
    (toxic) 1; without such a row it is neither. Labels of other documents
    and with a null id count for none.
    """
    known = labels.groupBy(F.col("doc_id").alias("id")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("bad")
    )
    found = marked.join(known.filter("id IS NOT NULL AND (good OR bad)"), F.col("doc_id") == F.col("id"), "left")
    one = {"n": F.lit(1), "good": F.col("good").cast("int"), "toxic": F.col("bad").cast("int")}
    sums = [F.coalesce(F.sum(v), F.lit(0)).alias(k) for k, v in one.items()]
    return found.groupBy(part, "mask").agg(*sums)


def _standing(measure: str) -> Column:
    """For every set of filters: documents that pass all of them (of one part's ``counts``)."""
    sets = F.sequence(F.lit(0), F.lit((1 << len(LETTERS)) - 1))
    add = lambda s: lambda total, c: total + F.when(c["mask"].bitwiseAND(s) == 0, c[measure]).otherwise(0)
    return F.transform(sets, lambda s: F.aggregate(F.col("counts"), F.lit(0).cast("long"), add(s)))


def interactions(counts: DataFrame, part: str = "part", filters: str = LETTERS) -> DataFrame:
    """One row per part, order of the filters and step, from ``mask_counts``.

    ``filters`` are applied from left to right in all their orders. The counts
    of a part: ``kept`` after the step; ``removed`` by it; ``redundant``: fail
    its filter but were removed earlier; ``unique_fails``: fail its filter
    only; ``good_lost`` and ``toxic_lost``: removed here and labelled so;
    ``shapley``: what its filter removes, summed over all orders. At most 32
    masks a part, so the counts of a part are one small row.
    """
    size = len(filters)
    orders = " ".join(map("".join, permutations(filters)))
    per_part = counts.groupBy(part).agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("counts"))
    stand = per_part.select(
        part, "counts", *[_standing(m).alias(f"standing_{m}") for m in ("n", "good", "toxic")]
    )
    steps = stand.withColumn("filter_order", F.explode(F.split(F.lit(orders), " "))).withColumn(
        "step", F.explode(F.sequence(F.lit(1), F.lit(size)))
    )
    bit = {c: 1 << LETTERS.index(c) for c in filters}

    def bits(of: Column) -> Column:
        return sum((F.when(of.contains(c), b).otherwise(0) for c, b in bit.items()), F.lit(0))

    order, step = F.col("filter_order"), F.col("step")
    steps = steps.withColumns(
        {
            "before": bits(F.substring(order, F.lit(1), step - 1)),
            "own": bits(F.substring(order, step, F.lit(1))),
        }
    ).withColumn("after", F.col("before") + F.col("own"))

    def gone(measure: str, before: Column, after: Column) -> Column:
        at = F.col(f"standing_{measure}")
        return F.get(at, before) - F.get(at, after)

    own = F.col("own")
    removed = gone("n", F.col("before"), F.col("after"))
    failing = gone("n", F.lit(0), own)
    alone = F.aggregate(
        F.col("counts"),
        F.lit(0).cast("long"),
        lambda total, c: total + F.when(c["mask"].bitwiseAND(F.lit(sum(bit.values()))) == own, c["n"]).otherwise(0),
    )
    earlier = _earlier_sets(list(bit.values())).items()
    shapley = F.coalesce(
        *[
            F.when(own == b, sum((times * gone("n", F.lit(s), F.lit(s + b)) for s, times in sets), F.lit(0)))
            for b, sets in earlier
        ]
    )
    return steps.select(
        part,
        "filter_order",
        F.col("step").cast("int").alias("step"),
        F.get("standing_n", F.col("after")).alias("kept"),
        removed.alias("removed"),
        (failing - removed).alias("redundant"),
        alone.alias("unique_fails"),
        gone("good", F.col("before"), F.col("after")).alias("good_lost"),
        gone("toxic", F.col("before"), F.col("after")).alias("toxic_lost"),
        shapley.cast("long").alias("shapley"),
    )


def _earlier_sets(bits: Sequence[int]) -> dict[int, list[tuple[int, int]]]:
    """For each filter: the sets of filters that can stand before it, and in how many orders they do."""
    found: dict[int, dict[int, int]] = {b: {} for b in bits}
    for order in permutations(bits):
        before = 0
        for b in order:
            found[b][before] = found[b].get(before, 0) + 1
            before += b
    return {b: list(sets.items()) for b, sets in found.items()}


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The report on the filters A to E over ``docs`` (doc_id, text, source), per source (null: empty).

    See ``masks``, ``mask_counts`` and ``interactions`` for nulls, ties,
    repeated rows and empty tables.
    """
    keys = {"doc_id": F.col("doc_id"), "part": F.coalesce(F.col("source"), F.lit(""))}
    return interactions(mask_counts(masks(docs, keys), labels))
