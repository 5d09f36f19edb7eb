"""Nearest neighbours through learned partitions.

On a bounded sample of the vectors an exact neighbour graph is built and cut
into balanced partitions (moves that bring a vector to the partition of most
of its neighbours, as long as that has room). A small classifier learns, from
a vector, how its neighbours spread over the partitions. Many partitions are
found in two levels: each part of the first is sampled, cut and learned anew
by its own task. Every vector lies in its most probable partition, its leaf.

How many leaves a query needs is measured, not assumed: vectors that no model
was fitted on are held out, one distributed pass finds their true neighbours
in the whole table, and the fewest leaves that hold ``RECALL`` of them are
probed. There the true inner products decide.

Equal vectors are one class, of which only the smallest ids can ever be among
the nearest; so copies make no leaf large. Leaves that follow each other share
a shelf, to which a query is sent once. A shelf's vectors and queries are
dealt into blocks of bounded size, and every block of vectors meets every
block of queries; only the leaves that a query asks for are multiplied.
"""

from __future__ import annotations

import logging
import pickle
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from cubelake.llm.common import cut, ship

#: Bound of the sample that the partitions and a classifier are fitted on (one for each part of the first level).
SAMPLE = 8192
#: Leaves grow with the square root of the distinct vectors, but hold this many at least.
LEAF_ROWS = 64
#: More leaves than this are found in two levels.
ONE_LEVEL = 256
NEIGHBOURS, SLACK, ROUNDS = 16, 1.15, 15
HIDDEN, EPOCHS, RATE = 128, 40, 0.004
#: Vectors held out to choose the probes, and the share of their true neighbours that the probed leaves must hold.
HELD_OUT, RECALL = 256, 0.97
BLOCK = 4096

_LOG = logging.getLogger(__name__)


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` largest inner products of each vector, its own left out."""
    out = np.empty((len(x), k), np.int64)
    for a in range(0, len(x), 512):
        near = x[a : a + 512] @ x.T
        near[np.arange(len(near)), np.arange(a, a + len(near))] = -np.inf
        out[a : a + 512] = np.argpartition(-near, k - 1, axis=1)[:, :k]
    return out


def balanced_partition(x: np.ndarray, graph: np.ndarray, parts: int, rng: np.random.Generator) -> np.ndarray:
    """A partition number for each vector, no partition over SLACK times its share."""
    n = len(x)
    label = np.zeros(n, np.int64)
    groups = [(np.arange(n), parts)]
    first = 0
    while groups:  # a start: halving along the direction of most spread
        rows, count = groups.pop()
        if count == 1:
            label[rows] = first
            first += 1
            continue
        mean = x[rows] - x[rows].mean(axis=0)
        axis = rng.standard_normal(x.shape[1]).astype(x.dtype)
        for _ in range(8):
            axis = mean.T @ (mean @ axis)
            axis /= np.linalg.norm(axis) + 1e-12
        order = rows[np.argsort(mean @ axis, kind="stable")]
        left = count // 2
        at = len(rows) * left // count
        groups += [(order[at:], count - left), (order[:at], left)]
    ends = np.concatenate([graph.ravel(), np.repeat(np.arange(n), graph.shape[1])])
    sides = np.concatenate([np.repeat(np.arange(n), graph.shape[1]), graph.ravel()])
    room = int(np.ceil(SLACK * n / parts))
    for _ in range(ROUNDS):
        votes = np.bincount(sides * parts + label[ends], minlength=n * parts).reshape(n, parts)
        own = votes[np.arange(n), label]
        want = votes.argmax(axis=1)
        gain = votes[np.arange(n), want] - own
        size = np.bincount(label, minlength=parts)
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if size[want[i]] < room:
                size[label[i]] -= 1
                size[want[i]] += 1
                label[i] = want[i]
                moved += 1
        if not moved:
            break
    return label


@dataclass
class Router:
    """The classifier: one hidden layer, probabilities of partitions."""

    scale: float
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray

    @property
    def parts(self) -> int:
        return len(self.b2)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        hidden = np.maximum(x * self.scale @ self.w1 + self.b1, 0)
        z = hidden @ self.w2 + self.b2
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def home(self, x: np.ndarray) -> np.ndarray:
        return self.probabilities(x).argmax(axis=1)


@dataclass
class Tree:
    """One router, or one that chooses among further routers; leaves are numbered through."""

    top: Router
    below: list[Router] = field(default_factory=list)

    @property
    def leaves(self) -> int:
        return sum(r.parts for r in self.below) if self.below else self.top.parts

    @property
    def first(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum([r.parts for r in self.below])]).astype(np.int64)

    def home(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector."""
        part = self.top.home(x)
        if not self.below:
            return part
        leaf, first = np.empty(len(x), np.int64), self.first
        for p in np.unique(part):
            rows = np.flatnonzero(part == p)
            leaf[rows] = first[p] + self.below[p].home(x[rows])
        return leaf

    def ranked(self, x: np.ndarray) -> np.ndarray:
        """All leaves for each vector: its own, then by falling probability."""
        chance = self.top.probabilities(x)
        if self.below:
            chance = np.hstack([chance[:, [p]] * r.probabilities(x) for p, r in enumerate(self.below)])
        chance[np.arange(len(x)), self.home(x)] = 2
        return np.argsort(-chance, axis=1, kind="stable")


def fit(x: np.ndarray, parts: int, seed: int = 3) -> Router:
    """Partitions and router from the sample ``x``."""
    x = np.ascontiguousarray(x, np.float32)
    rng = np.random.default_rng(seed)
    dim = x.shape[1]
    scale = float(1 / max(np.sqrt((x.astype(np.float64) ** 2).sum(axis=1).mean() / dim), 1e-30))
    if parts <= 1:
        one = np.zeros((dim, 1), np.float32)
        return Router(scale, one, np.zeros(1, np.float32), np.zeros((1, 1), np.float32), np.zeros(1, np.float32))
    graph = neighbour_graph(x * np.float32(scale), min(NEIGHBOURS, len(x) - 1))
    label = balanced_partition(x * np.float32(scale), graph, parts, rng)
    target = np.zeros((len(x), parts), np.float32)
    for column in (np.arange(len(x)), *graph.T):
        target[np.arange(len(x)), label[column]] += 1
    target /= target.sum(axis=1, keepdims=True)

    def normal(*shape):
        return (rng.standard_normal(shape) * (2 / shape[0]) ** 0.5).astype(np.float32)

    p = [normal(dim, HIDDEN), np.zeros(HIDDEN, np.float32), normal(HIDDEN, parts), np.zeros(parts, np.float32)]
    m = [(np.zeros_like(w), np.zeros_like(w)) for w in p]
    step = 0
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS) + 1e-5
        order = rng.permutation(len(x))
        for a in range(0, len(x), 256):
            rows = order[a : a + 256]
            given = x[rows] * np.float32(scale)
            pre = given @ p[0] + p[1]
            hidden = np.maximum(pre, 0)
            z = hidden @ p[2] + p[3]
            z = np.exp(z - z.max(axis=1, keepdims=True))
            d = (z / z.sum(axis=1, keepdims=True) - target[rows]) / len(rows)
            d_hidden = (d @ p[2].T) * (pre > 0)
            step += 1
            for w, (u, v), g in zip(p, m, (given.T @ d_hidden, d_hidden.sum(0), hidden.T @ d, d.sum(0)), strict=True):
                u += 0.1 * (g - u)
                v += 0.001 * (g * g - v)
                w -= rate * (u / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Router(scale, *p)


def usable(vector: Column) -> Column:
    """Not null or empty, all components finite, not all zero."""
    return F.coalesce(
        (F.size(vector) > 0)
        & F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
        & F.exists(vector, lambda v: v != 0),
        F.lit(False),
    )


def _matrix(column: pd.Series, dtype) -> np.ndarray:
    return np.array(column.tolist(), dtype) if len(column) else np.zeros((0, 0), dtype)


def leaf_count(rows: int) -> int:
    """Leaves for so many distinct vectors."""
    return max(1, min(rows // LEAF_ROWS, int(np.ceil(rows**0.5))))


def grow(classes: DataFrame, count: int) -> tuple[Tree, np.ndarray]:
    """The partitions of ``classes`` (``__class``, ``__v``), and the vectors held out from all fitting.

    Both ends of one order by hash: some vectors held out, and the sample. A
    second level is fitted by a task for each part, on the part's own sample
    of about ``SAMPLE`` at most; the routers together are as many numbers as
    the square root of the leaves times ``HIDDEN`` times their inputs and
    outputs, and the driver sees no more than these and the two samples.
    """
    leaves = leaf_count(count)
    out = min(HELD_OUT, count // 8)
    spread = F.xxhash64("__v")
    held = _matrix(classes.orderBy(F.desc(spread), F.desc("__v")).limit(out).toPandas()["__v"], np.float32)
    sample = classes.select("__v").orderBy(spread, "__v").limit(min(SAMPLE, count - out)).toPandas()
    parts = leaves if leaves <= ONE_LEVEL else int(np.ceil(leaves**0.5))
    tree = Tree(fit(_matrix(sample["__v"], np.float32), parts))
    if parts < leaves:
        tree.below = _second_level(classes, tree.top, int(np.ceil(leaves / parts)), held)
    return tree, held


def _second_level(classes: DataFrame, top: Router, parts: int, held: np.ndarray) -> list[Router]:
    spark = classes.sparkSession
    shared = spark.sparkContext.broadcast((top, {v.tobytes() for v in held}))

    def route(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        router, out = shared.value
        for batch in batches:
            if len(batch):
                x = _matrix(batch["__v"], np.float32)
                batch["__part"] = router.home(x)
                yield batch[[v.tobytes() not in out for v in x]]

    kind = classes.schema["__v"].dataType.simpleString()
    routed = cut(classes.select("__v").mapInPandas(route, f"__v {kind}, __part int"), "ann-parts")
    sizes = routed.groupBy("__part").agg(F.ceil(F.count("*") / F.lit(float(SAMPLE))).alias("__every"))
    some = routed.join(F.broadcast(sizes), "__part").filter(F.pmod(F.xxhash64("__v", F.lit(1)), "__every") == 0)

    def learn(part: pd.DataFrame) -> pd.DataFrame:
        x = _matrix(part["__v"], np.float32)
        x = x[np.lexsort(x.T)]  # the same model in whatever order the rows come
        router = fit(x, min(parts, max(1, len(x) // 2)))
        return pd.DataFrame({"__part": [part["__part"].iat[0]], "__model": [pickle.dumps(router)]})

    models = some.groupBy("__part").applyInPandas(learn, "__part int, __model binary").collect()
    found = {m["__part"]: pickle.loads(bytes(m["__model"])) for m in models}
    empty = fit(np.zeros((1, top.w1.shape[0]), np.float32), 1)
    return [found.get(p, empty) for p in range(top.parts)]


def choose_probes(placed: DataFrame, tree: Tree, held: np.ndarray, k: int) -> tuple[int, float]:
    """The fewest leaves that hold ``RECALL`` of the true ``k`` nearest of the held out vectors, and their recall.

    One pass over the whole table: a task keeps the k best of its rows for
    each of the ``HELD_OUT`` vectors, and lists of k are merged.
    """
    if not len(held):
        return tree.leaves, 1.0
    shared = placed.sparkSession.sparkContext.broadcast(held)

    def nearest(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        q = shared.value.astype(np.float64)
        score, leaf = np.zeros((len(q), 0)), np.zeros((len(q), 0), np.int64)
        for batch in batches:
            if len(batch):
                v = _matrix(batch["__v"], np.float32)
                near = q @ v.T.astype(np.float64)
                near[_same(shared.value, v)] = -np.inf  # the vector itself
                score = np.hstack([score, near])
                leaf = np.hstack([leaf, np.broadcast_to(batch["__leaf"].to_numpy(np.int64), near.shape)])
                if score.shape[1] > k:
                    best = np.argpartition(-score, k - 1, axis=1)[:, :k]
                    score, leaf = np.take_along_axis(score, best, 1), np.take_along_axis(leaf, best, 1)
        if score.shape[1]:
            yield pd.DataFrame({"__at": range(len(q)), "s": (-score).tolist(), "l": leaf.tolist()})

    lists = placed.select("__v", "__leaf").mapInPandas(nearest, "__at int, s array<double>, l array<int>")
    best = F.slice(F.array_sort(F.flatten(F.collect_list(F.arrays_zip("s", "l")))), 1, k)
    found = lists.groupBy("__at").agg(best.alias("near")).collect()
    ranked = tree.ranked(held)
    place = np.empty_like(ranked)
    place[np.arange(len(held))[:, None], ranked] = np.arange(tree.leaves)
    reached = np.array([place[r["__at"], x["l"]] for r in found for x in r["near"] if np.isfinite(x["s"])], np.int64)
    covered = np.cumsum(np.bincount(reached, minlength=tree.leaves)) / max(1, len(reached))
    probes = min(int(np.searchsorted(covered, RECALL) + 1), tree.leaves)
    return probes, float(covered[probes - 1])


def _same(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Which vectors of ``v`` are one of ``q``, as a matrix; few are compared whole."""
    same = np.zeros((len(q), len(v)), bool)
    for i, j in zip(*np.nonzero(q[:, :1] == v[:, 0])):
        same[i, j] = bool((q[i] == v[j]).all())
    return same


def search(rows: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found for each query row.

    ``rows`` has vec_id and embedding. Vectors that are null, empty, zero or
    hold null or non-finite components and rows without vec_id take no part.
    Vectors of different lengths have no inner product: each length is
    searched for itself, by jobs of its own. A query's own row is no
    candidate; repeated rows are candidates for each other, ties go to the
    smaller vec_id. A query probes more leaves than others where these hold
    too few vectors for k candidates, so only a table with fewer candidates
    gives fewer rows; an empty table gives none. Other columns are not read.
    """
    ship(rows.sparkSession)
    vectors = rows.select(
        F.col("vec_id").cast("long").alias("__id"), F.col("embedding").alias("__v"), is_query.alias("__query")
    )
    vectors = vectors.filter(F.col("__id").isNotNull() & usable(F.col("__v")))
    widths = [r["width"] for r in vectors.select(F.size("__v").alias("width")).distinct().orderBy("width").collect()]
    found = [_search(vectors.filter(F.size("__v") == w), k) for w in widths or [0]]
    return reduce(DataFrame.unionByName, found)


def _search(vectors: DataFrame, k: int) -> DataFrame:
    spark = vectors.sparkSession
    # Classes of equal vectors, each with its k + 1 smallest ids (one may be the query's own).
    nth = F.row_number().over(Window.partitionBy("__v").orderBy("__id"))
    classes = (
        vectors.select("__id", "__v")
        .withColumn("__n", nth)
        .filter(F.col("__n") <= k + 1)
        .groupBy("__v")
        .agg(F.array_sort(F.collect_list("__id")).alias("__ids"))
        .withColumn("__class", F.col("__ids")[0])
    )
    classes = cut(classes, "ann-classes")
    count = classes.count()
    tree, out = grow(classes, count) if count else (Tree(fit(np.zeros((1, 1), np.float32), 1)), np.zeros((0, 1)))
    shared = spark.sparkContext.broadcast(tree)

    def place(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                batch["__leaf"] = shared.value.home(_matrix(batch["__v"], np.float32))
                yield batch

    kind = classes.schema["__v"].dataType.simpleString()
    kinds = f"__class long, __v {kind}, __ids array<long>, __leaf int"
    placed = cut(classes.select("__class", "__v", "__ids").mapInPandas(place, kinds), "ann-placed")
    probes, recall = choose_probes(placed, tree, out, k)
    held_by = np.zeros(tree.leaves, np.int64)  # one number a leaf
    for r in placed.groupBy("__leaf").count().collect():
        held_by[r["__leaf"]] = r["count"]
    _LOG.info("%d vectors, %d leaves, %d probed, recall %.3f of %d held out", count, tree.leaves, probes, recall, len(out))

    # Leaves that follow each other, about BLOCK vectors and never more shelves than leaves.
    shelves = min(tree.leaves, int(np.ceil(max(tree.leaves**0.5, count / BLOCK))))
    chosen = spark.sparkContext.broadcast((probes, held_by, shelves))

    def route(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        least, size, n = chosen.value
        for batch in batches:
            rows = []
            for a in range(0, len(batch), 64):
                some = batch.iloc[a : a + 64]
                ranked = shared.value.ranked(_matrix(some["__v"], np.float32))
                # k others beside the query's own class
                enough = (np.cumsum(size[ranked], axis=1) <= k).sum(axis=1) + 1
                for asking, vector, order, least_here in zip(some["__class"], some["__v"], ranked, enough):
                    leaves = np.sort(order[: max(least, least_here)])
                    shelf = leaves * n // len(size)
                    for wanted in np.split(leaves, np.flatnonzero(np.diff(shelf)) + 1):
                        rows.append((asking, vector, int(wanted[0] * n // len(size)), wanted.tolist()))
            yield pd.DataFrame(rows, columns=["__asking", "__q", "__part", "__leaves"])

    # Each query row with its class; the classes asked for, a row for each shelf they go to.
    asked = vectors.filter("__query").select("__id", "__v").join(placed.select("__class", "__v"), "__v")
    asked = cut(asked.select(F.col("__id").alias("query_id"), "__class"), "ann-asked")
    wanted = placed.join(asked.select("__class").distinct(), "__class", "left_semi").select("__class", "__v")
    wanted = cut(
        wanted.mapInPandas(route, f"__asking long, __q {kind}, __part int, __leaves array<int>"), "ann-wanted"
    )

    # Blocks of bounded size on either side (one row per shelf decides how many).
    def blocks(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("__part").agg(F.ceil(F.count("*") / F.lit(float(BLOCK))).cast("int").alias(name))

    shelf = F.floor(F.col("__leaf").cast("long") * shelves / F.lit(tree.leaves)).cast("int")
    held = placed.select("__class", "__v", "__ids", "__leaf", shelf.alias("__part"))
    sizes = blocks(held, "__vb").join(blocks(wanted, "__qb"), "__part")

    def dealt(df: DataFrame, key: str, own: str, other: str) -> DataFrame:
        """Each row into one of its own side's blocks, for every block of the other side."""
        spread = df.join(F.broadcast(sizes), "__part")
        mine = F.pmod(F.xxhash64(key), F.col(own)).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        return spread.withColumn("__mine", mine).withColumn("__every", every)

    left = dealt(held, "__class", "__vb", "__qb").select(
        "__part", F.col("__mine").alias("__v_block"), F.col("__every").alias("__q_block"), "__leaf", "__class", "__v", "__ids"
    )
    right = dealt(wanted, "__asking", "__qb", "__vb").select(
        "__part", F.col("__every").alias("__v_block"), F.col("__mine").alias("__q_block"), "__asking", "__q", "__leaves"
    )

    def rerank(block: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        """One row per query of the block: its nearest here, each class with all the ids it may give."""
        rows = []
        if len(block) and len(queries):
            block = block.sort_values(["__leaf", "__class"], ignore_index=True)
            v = _matrix(block["__v"], np.float64)
            q = _matrix(queries["__q"], np.float64)
            ids = block["__ids"].tolist()
            leaves, starts = np.unique(block["__leaf"].to_numpy(), return_index=True)
            ends = np.append(starts[1:], len(v))
            asks = [set(wanted) for wanted in queries["__leaves"]]
            n = min(k + 1, len(v))
            for a in range(0, len(q), 512):
                near = np.full((len(q[a : a + 512]), len(v)), -np.inf)
                for leaf, start, end in zip(leaves, starts, ends):
                    who = np.flatnonzero([leaf in wanted for wanted in asks[a : a + 512]])
                    near[who, start:end] = q[a + who] @ v[start:end].T
                best = np.argpartition(-near, n - 1, axis=1)[:, :n]
                edge = np.take_along_axis(near, best, axis=1).min(axis=1)
                for row, low in enumerate(edge):
                    # The product is summed anew in one fixed order, so equal vectors score equal anywhere.
                    some = np.flatnonzero((near[row] >= low - 1e-9 * (1 + abs(low))) & (near[row] > -np.inf))
                    if not len(some):
                        continue
                    score = (v[some] * q[a + row]).sum(axis=1)
                    kept = [(0.0 - score[i], m) for i in np.lexsort((block["__class"].to_numpy()[some], -score))[:n] for m in ids[some[i]]]
                    kept = sorted(kept)[: k + 1]
                    rows.append((queries["__asking"].iat[a + row], block["__part"].iat[0], *map(list, zip(*kept))))
        return pd.DataFrame(rows, columns=["__asking", "__part", "s", "v"])

    keys = ["__part", "__v_block", "__q_block"]
    near = (
        left.groupBy(*keys)
        .cogroup(right.groupBy(*keys))
        .applyInPandas(rerank, "__asking long, __part int, s array<double>, v array<long>")
        .select("__asking", "__part", F.arrays_zip("s", "v").alias("__near"))
    )
    # Lists of k + 1 are merged per shelf, then per query; least negated score first, then least id.
    best = F.slice(F.array_sort(F.flatten(F.collect_list("__near"))), 1, k + 1).alias("__near")
    lists = near.groupBy("__asking", "__part").agg(best).groupBy("__asking").agg(best)
    answers = asked.join(lists, F.col("__class") == F.col("__asking"))
    # The query's own row (one entry of its id) goes, if it is there at all.
    ids = F.transform("__near", lambda x: x["v"])
    own = F.array_position(ids, F.col("query_id"))
    others = F.filter("__near", lambda x, i: (i + 1) != F.col("__own"))
    return (
        answers.withColumn("__own", own)
        .select("query_id", F.posexplode(F.slice(others, 1, k)).alias("__i", "__x"))
        .select(
            "query_id",
            (F.col("__i") + 1).cast("int").alias("rank"),
            F.col("__x.v").alias("vec_id"),
            (F.lit(0.0) - F.col("__x.s")).alias("score"),
        )
    )
