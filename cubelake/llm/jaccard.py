"""Similarity join of documents on the Jaccard coefficient of their word n-grams.

Exact for its definition, without all pairs:

1. Documents with equal n-gram sets are one class; from here on classes count.
2. All n-grams are put in one global order, those in rarely hit slots of a
   count table first. Of two linked classes, the first n - ceil(t n) + 1
   n-grams of each (its prefix) share one; prefixes make the sparse incidence
   matrix of classes by n-grams.
3. Its product with its transpose is formed by columns: a column with up to
   ``COLUMN`` classes gives the pairs of its classes, and pairs accumulate
   their overlap. A pair whose overlap, with all that could still overlap
   behind the prefixes, stays below what the two sizes demand is discarded.
   The rest are compared over their whole sets.
4. Longer columns give no pairs. Classes that they chain together form a
   group; a group is cut into blocks of bounded size, and each pair of blocks
   multiplies its part of the matrix over whole sets, slice by slice of
   n-grams, and returns no more links than connect what it found connected.
5. Links are contracted to components by alternating star steps.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cubelake.llm.common import cut, ship

#: Slots of the count table (a 32-bit count each).
SLOT_BITS, SLOT_BLOCKS = 21, 32
#: Longest column whose pairs are formed one by one; classes in a block of a longer one's group.
COLUMN, BLOCK = 64, 512
#: n-grams of a block product worked on at once.
SLICE = 4096

_K = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def ngrams(text: bytes, size: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct word n-grams; of the whole sequence if it is shorter, none without words."""
    words = text.lower().split()  # bytes: A-Z only; white space is 0x20 and 0x09 to 0x0D
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    width = min(n, size)
    with np.errstate(over="ignore"):
        v = np.full(n - width + 1, width, np.uint64)
        for k in range(width):
            v = (v ^ h[k : n - width + 1 + k]) * _K[k % 3]
            v ^= v >> np.uint64(29)
    return np.unique(v)


def _slot(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("__text"),
    )


def slot_counts(docs: DataFrame, size: int) -> np.ndarray:
    """How many documents' n-grams hit each slot: each task sums its own, then blocks of slots are summed."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SLOT_BITS, np.int32)
        first = None
        for batch in batches:
            for text in batch.column(0):
                grams = ngrams(text.as_buffer().to_pybytes(), size)
                np.add.at(total, _slot(grams), 1)
                first = first or int(grams[0]) if len(grams) else first
        if first is not None:
            parts = total.astype("<i4").reshape(SLOT_BLOCKS, -1)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(SLOT_BLOCKS), pa.int32()),
                    pa.array([first % 64] * SLOT_BLOCKS, pa.int32()),
                    pa.array([p.tobytes() for p in parts], pa.binary()),
                ],
                names=["block", "salt", "counts"],
            )

    def add(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros((1 << SLOT_BITS) // SLOT_BLOCKS, np.int64)
        for part in rows["counts"]:
            total += np.frombuffer(part, "<i4")
        clipped = np.minimum(total, np.iinfo(np.int32).max).astype("<i4").tobytes()
        return pd.DataFrame({"block": [key[0]], "salt": [0], "counts": [clipped]})

    kinds = "block int, salt int, counts binary"
    rows = _texts(docs).select("__text").mapInArrow(count, kinds)
    for keys in (["block", "salt"], ["block"]):
        rows = rows.groupBy(*keys).applyInPandas(add, kinds)
    table = np.zeros((SLOT_BLOCKS, (1 << SLOT_BITS) // SLOT_BLOCKS), np.int32)
    for row in rows.collect():  # SLOT_BLOCKS rows of a fixed size
        table[row.block] = np.frombuffer(row.counts, "<i4")
    return table.ravel()


def _least_overlap(a: Column, b: Column, percent: int) -> Column:
    """Smallest intersection with which sets of these sizes link."""
    return F.ceil((a + b) * percent / F.lit(100 + percent))


def _prefix(n, percent: int):
    return n - (percent * n + 99) // 100 + 1


def prefixes(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(doc_id, class, n, prefix) of each document; class is null and n 0 without words."""
    spark = docs.sparkSession
    counts = spark.sparkContext.broadcast(slot_counts(docs, size))

    def of_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()  # classes whose prefix this task has already given
        for batch in batches:
            classes, sizes, firsts = [], [], []
            for text in batch.column(1):
                grams = ngrams(text.as_buffer().to_pybytes(), size)
                n = len(grams)
                sizes.append(n)
                if not n:
                    classes.append(None)
                    firsts.append(None)
                    continue
                key = xxhash.xxh3_64_intdigest(grams.tobytes()) - (1 << 63)
                classes.append(key)
                if key in met:
                    firsts.append(None)
                    continue
                met.add(key)
                order = np.lexsort((grams, counts.value[_slot(grams)]))
                firsts.append(grams[order[: _prefix(n, percent)]].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(classes, pa.int64()), pa.array(sizes, pa.int64()),
                 pa.array(firsts, pa.list_(pa.int64()))],
                names=["doc_id", "class", "n", "prefix"],
            )

    return _texts(docs).mapInArrow(of_rows, "doc_id long, class long, n long, prefix array<long>")


def sets_of(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(class, grams) for the classes of ``wanted`` (class, doc_id: a document of it)."""

    def grams_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [ngrams(text.as_buffer().to_pybytes(), size) for text in batch.column(1)]
            same = [
                k for k, (s, c) in enumerate(zip(sets, batch.column(0).to_pylist(), strict=True))
                if xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63) == c
            ]  # fmt: skip  (another text may carry the same id)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(same, pa.int64())),
                 pa.array([sets[k].view(np.int64) for k in same], pa.list_(pa.int64()))],
                names=["class", "grams"],
            )

    wanted = wanted.withColumnRenamed("doc_id", "__id")
    found = _texts(docs).join(wanted, F.col("doc_id").eqNullSafe(F.col("__id")))
    return found.select("class", "__text").mapInArrow(grams_of, "class long, grams array<long>").dropDuplicates(["class"])


def components(edges: DataFrame, label: str) -> DataFrame:
    """(node, root): the smallest node of each node's component, by alternating large- and small-star steps.

    Every step shrinks paths; both sides of a step are joins and minima per
    node, never a component in one place.
    """
    edges = cut(edges.select("a", "b").filter("a <> b").distinct(), label)
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(low.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()
        edges = cut(small, label)
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def _forest(links: np.ndarray) -> np.ndarray:
    """Of links between places, as few as connect the same places."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for k, (a, b) in enumerate(links.tolist()):
        a, b = find(a), find(b)
        if a != b:
            parent[a] = b
            kept.append(k)
    return links[kept]


def block_links(rows: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links within a block (``i`` = ``j``) or between two (rows carry their ``block``), as a forest."""
    rows = rows.sort_values("class", ignore_index=True)
    sizes = np.array([len(g) for g in rows["grams"]], np.int64)
    owner = np.repeat(np.arange(len(rows)), sizes)
    _, gram, times = np.unique(np.concatenate(rows["grams"].tolist()), return_inverse=True, return_counts=True)
    shared = times[gram] > 1  # what one set alone has adds to no overlap
    place = np.cumsum(times > 1) - 1
    owner, gram = owner[shared], place[gram[shared]]
    order = np.argsort(gram, kind="stable")
    owner, gram = owner[order], gram[order]
    overlap = np.zeros((len(rows), len(rows)), np.float32)
    for start in range(0, int((times > 1).sum()), SLICE):
        a, b = np.searchsorted(gram, [start, start + SLICE])
        part = np.zeros((len(rows), SLICE), np.float32)
        part[owner[a:b], gram[a:b] - start] = 1
        overlap += part @ part.T
    overlap = overlap.astype(np.int64)
    union = sizes[:, None] + sizes[None, :] - overlap
    block = rows["block"].to_numpy()
    across = block[:, None] != block[None, :] if (rows["i"] != rows["j"]).iat[0] else True
    a, b = np.nonzero((100 * overlap >= percent * union) & across)
    links = np.stack([a, b], axis=1)[a < b]
    links = _forest(links)
    names = rows["class"].to_numpy()
    return pd.DataFrame({"a": names[links[:, 0]], "b": names[links[:, 1]]})


def link_components(docs: DataFrame, size: int = 3, percent: int = 90) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, and class (null without words).

    Two documents link when 100 * |A and B| >= percent * |A or B| over their
    distinct word ``size``-grams; a document of fewer words has its whole
    sequence as one. Null, empty and wordless texts have none, link with
    nothing and are their own component. component_id is the smallest doc_id
    that links reach; a null doc_id counts only where no other is there.
    Repeated rows are equal documents. No rows give no rows. Only doc_id and
    text are read, whole.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = cut(prefixes(docs, size, percent), "jaccard-prefixes")
    # A task gives a class's prefix with its first document; other tasks may give it again.
    given = rows.filter(F.col("prefix").isNotNull())
    classes = given.dropDuplicates(["class"])
    postings = classes.select("class", "n", F.explode("prefix").alias("gram"))
    lengths = postings.groupBy("gram").agg(F.count("*").alias("m")).filter("m > 1")
    shared = cut(postings.join(lengths, "gram"), "jaccard-columns")

    # Short columns: pairs and their overlaps within the prefixes.
    long_hits = shared.filter(F.col("m") > COLUMN).groupBy("class").agg(F.count("*").alias("h"))
    short = shared.filter(F.col("m") <= COLUMN).select("gram", "class", "n")
    left = short.select("gram", F.col("class").alias("a"), F.col("n").alias("na"))
    right = short.select("gram", F.col("class").alias("b"), F.col("n").alias("nb"))
    fits = (F.col("a") < F.col("b")) & (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    overlaps = left.join(right, "gram").filter(fits).groupBy("a", "b", "na", "nb").agg(F.count("*").alias("c"))
    for side in "ab":
        hits = long_hits.select(F.col("class").alias(side), F.col("h").alias(f"h{side}"))
        overlaps = overlaps.join(hits, side, "left").fillna(0, [f"h{side}"])

    def behind(n: Column) -> Column:
        return F.ceil(n * percent / F.lit(100)) - 1  # n-grams after the prefix

    reach = F.col("c") + F.least("ha", "hb") + F.greatest(behind(F.col("na")), behind(F.col("nb")))
    pairs = cut(
        overlaps.filter(reach >= _least_overlap(F.col("na"), F.col("nb"), percent)).select("a", "b"), "jaccard-pairs"
    )

    # Long columns: the groups they chain together, in blocks.
    longer = shared.filter(F.col("m") > COLUMN).select("gram", "class")
    heads = longer.groupBy("gram").agg(F.min("class").alias("head"))
    chains = longer.join(heads, "gram").select(F.col("class").alias("a"), F.col("head").alias("b"))
    grouped = components(chains, "jaccard-groups").select(F.col("node").alias("class"), F.col("root").alias("group"))
    grouped = cut(grouped, "jaccard-grouped")

    wanted = pairs.select(F.col("a").alias("class")).union(pairs.select("b")).union(grouped.select("class")).distinct()
    sample = rows.filter("class is not null").groupBy("class").agg(F.min("doc_id").alias("doc_id"))
    sets = cut(sets_of(docs, wanted.join(sample, "class"), size), "jaccard-sets")

    one = sets.select(F.col("class").alias("a"), F.col("grams").alias("ga"))
    two = sets.select(F.col("class").alias("b"), F.col("grams").alias("gb"))
    both = F.size(F.array_intersect("ga", "gb"))
    compared = pairs.join(one, "a").join(two, "b").withColumn("i", both)
    links = compared.filter(100 * F.col("i") >= percent * (F.size("ga") + F.size("gb") - F.col("i"))).select("a", "b")

    sizes = grouped.groupBy("group").agg(F.ceil(F.count("*") / F.lit(float(BLOCK))).cast("int").alias("blocks"))
    members = grouped.join(sizes, "group").join(sets, "class")
    members = members.withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    dealt = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "group", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "class", "grams"
    )
    linked = dealt.groupBy("group", "i", "j").applyInPandas(lambda part: block_links(part, percent), "a long, b long")

    roots = components(links.unionByName(linked), "jaccard-components")
    # Smallest doc_id of each class, then of each component.
    named = sample.join(roots.select(F.col("node").alias("class"), "root"), "class", "left")
    named = cut(named.select("class", "doc_id", F.coalesce("root", "class").alias("root")), "jaccard-named")
    firsts = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    of_class = named.join(firsts, "root").select("class", "component_id")
    return rows.join(of_class, "class", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        "class",
    )
