"""A store of keyed rows (product, vector, ...) as well-sized files with an index.

Files are not bound to folders per product, whose number has nothing to do
with the bytes in them: a file holds many small products or a slice of a
large one. What a store consists of is decided by a commit log: every entry
names an actions table, with a row for each file it adds or takes away, and
for each product in an added file the range of its vectors there. Files that
were written in key order also carry a Bloom filter of their keys.

* ``append_rows`` adds the rows of a batch as a few files (one shuffle);
* ``compact`` rewrites files that are small, in key order;
* ``merge_rows`` finds the files that hold keys of a delta, and rewrites those
  alone: a product with a third of all rows and ten changed vectors costs at
  most ten files.

Vectors are dealt into ``SLOTS`` by their hash, and files are cut along
(product, slot). The index is asked by equal keys only: a file that covers few
slot groups of a product is listed under each of them, one that covers most
under the product. So neither a hot product nor a wide file meets all keys.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cubelake import fs
from cubelake.operators.merge import latest_per_key, merge_values
from cubelake.session import scratch_dir, ship_package
from cubelake.sources.commit_log import commit, last_entry, read_entries

#: Slots of a product's vectors, and slots that one row of the index can stand for.
SLOTS, GROUP = 1 << 16, 1 << 6
GROUPS = SLOTS // GROUP
#: Rows of a file at most; files under half of it are small.
FILE_ROWS = 1_000_000
#: Bits of a Bloom filter per key, and how many of them a key sets.
KEY_BITS, KEY_HASHES = 10, 4

ENTRY = "kind string, batch string, actions string, snapshot boolean"
FILES = "file string, added boolean, rows long, bytes long, words array<long>"
RANGES = "file string, product long, rows long, first_slot int, last_slot int, first_vector long, last_vector long"


class ConcurrentChange(RuntimeError):
    """Another writer took away or merged files that this one was about to replace: start again."""


def log_path(store: str) -> str:
    return f"{store.rstrip('/')}/log"


def slot_of(vector: Column) -> Column:
    return F.pmod(F.xxhash64(vector), F.lit(SLOTS)).cast("int")


def _key_hash(product: Column, vector: Column) -> Column:
    return F.xxhash64(product, vector)


# ------------------------------------------------------------- reading


def _entries(spark: SparkSession, store: str, upto: int | None) -> list:
    """The entries that make up the store: from the last snapshot on, in order (small rows)."""
    rows = read_entries(spark, log_path(store), ENTRY)
    if upto is not None:
        rows = rows.filter(F.col("entry") <= upto)
    found = sorted(rows.collect(), key=lambda r: r["entry"])
    starts = [i for i, r in enumerate(found) if r["snapshot"]]
    return found[starts[-1] :] if starts else found


def _actions(spark: SparkSession, store: str, entries: list, kind: str, schema: str) -> DataFrame:
    paths = [f"{store.rstrip('/')}/actions/{e['actions']}/{kind}" for e in entries if e["actions"]]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def live_files(spark: SparkSession, store: str, upto: int | None = None) -> DataFrame:
    """The files of the store, as of an entry of its log (default: the last)."""
    seen = _actions(spark, store, _entries(spark, store, upto), "files", FILES)
    gone = seen.filter("NOT added").select("file")
    return seen.filter("added").join(gone, "file", "left_anti").drop("added")


def _paths(store: str, files: DataFrame) -> list[str]:
    """Paths of files, for Spark's reader, which keeps a status of each on the driver anyway."""
    return [f"{store.rstrip('/')}/data/{r['file']}" for r in files.select("file").collect()]


def _read(spark: SparkSession, store: str, files: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows of these files, each with the name of its ``__file``."""
    paths = _paths(store, files)
    if not paths:
        return spark.createDataFrame([], schema).withColumn("__file", F.lit(""))
    name = F.regexp_extract("_metadata.file_path", r"([0-9a-f]{32}/[^/]+)$", 1)
    return spark.read.schema(schema).parquet(*paths).withColumn("__file", name)


def _schema(given: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(given) if isinstance(given, str) else given


def read_store(
    spark: SparkSession, store: str, schema: T.StructType | str, product: int | None = None, name: str = "productId"
) -> DataFrame:
    """The rows of the store; with ``product``, those of that product, from the files that hold it."""
    entries = _entries(spark, store, None)
    files = live_files(spark, store, entries[-1]["entry"] if entries else 0)
    if product is None:
        return _read(spark, store, files, _schema(schema)).drop("__file")
    held = _actions(spark, store, entries, "ranges", RANGES).filter(F.col("product") == product)
    rows = _read(spark, store, files.join(held, "file", "left_semi"), _schema(schema)).drop("__file")
    return rows.filter(F.col(name) == product)


# ------------------------------------------------------------- writing


def _bloom_words(rows: pd.DataFrame) -> pd.DataFrame:
    """For one file: a filter of its distinct keys, sized by their number."""
    hashes = np.unique(rows["key_hash"].to_numpy(np.int64)).view(np.uint64)
    words = np.zeros(max(1, -(-len(hashes) * KEY_BITS // 64)), np.uint64)
    for i in range(KEY_HASHES):
        bit = ((hashes >> np.uint64(16 * i)) & np.uint64(0xFFFF)) * np.uint64(0x9E3779B1) + (hashes & np.uint64(0xFFFFFFFF))
        at = bit % np.uint64(64 * len(words))
        np.bitwise_or.at(words, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
    return pd.DataFrame({"file": rows["file"].iloc[:1], "words": [words.view(np.int64)]})


def may_hold(words: Column, key_hash: Column) -> Column:
    """Whether a file's filter has the key (true without a filter)."""
    size = F.size(words).cast("long") * 64
    found = F.lit(True)
    for i in range(KEY_HASHES):
        # below 2^49, so the sum is the same as with the unsigned numbers above
        part = F.shiftrightunsigned(key_hash, 16 * i).bitwiseAND(0xFFFF) * 0x9E3779B1
        at = (part + key_hash.bitwiseAND(0xFFFFFFFF)) % size
        bit = F.getbit(F.get(words, F.shiftright(at, 6).cast("int")), (at % 64).cast("int"))
        found = found & (bit == 1)
    return words.isNull() | found


def _index(spark: SparkSession, store: str, folder: str, product: str, vector: str, bloom: bool, target: str) -> None:
    """Write the actions of the files in a new folder, from their key columns alone."""
    name = F.concat(F.lit(f"{folder}/"), F.col("_metadata.file_name"))
    rows = spark.read.parquet(f"{store}/data/{folder}").select(
        name.alias("file"),
        F.col("_metadata.file_size").alias("bytes"),
        F.col(product).cast("long").alias("product"),
        F.col(vector).cast("long").alias("vector"),
        slot_of(F.col(vector)).alias("slot"),
        _key_hash(F.col(product), F.col(vector)).alias("key_hash"),
    )
    ranges = rows.groupBy("file", "product").agg(
        F.count("*").alias("rows"),
        F.min("slot").alias("first_slot"),
        F.max("slot").alias("last_slot"),
        F.min("vector").alias("first_vector"),
        F.max("vector").alias("last_vector"),
        F.first("bytes").alias("bytes"),
    )
    ranges.write.mode("append").parquet(f"{target}/ranges")
    written = spark.read.schema(f"{RANGES}, bytes long").parquet(f"{target}/ranges")
    files = written.groupBy("file").agg(F.sum("rows").alias("rows"), F.first("bytes").alias("bytes"))
    if bloom:  # one group is one file, so FILE_ROWS bounds it
        ship_package(spark)
        keys = rows.select("file", "key_hash").distinct()
        words = keys.groupBy("file").applyInPandas(_bloom_words, "file string, words array<long>")
        files = files.join(words, "file", "left")
    else:
        files = files.withColumn("words", F.lit(None).cast("array<long>"))
    files.select("file", F.lit(True).alias("added"), "rows", "bytes", "words").write.mode("append").parquet(f"{target}/files")


def _commit(
    spark: SparkSession,
    store: str,
    rows: DataFrame | None,
    keys: tuple[str, str],
    kind: str,
    after: int,
    removed: DataFrame | None = None,
    ordered: bool = True,
    batch: str | None = None,
    files: int | None = None,
) -> int:
    """Write ``rows`` as new files, index them, and commit them together with the files they replace."""
    product, vector = keys
    store, folder, actions = store.rstrip("/"), uuid.uuid4().hex, uuid.uuid4().hex
    target = f"{store}/actions/{actions}"
    if removed is not None:
        # they go together with the coming of what takes their place
        removed.select("file", F.lit(False).alias("added")).write.parquet(f"{target}/files")
        spark.createDataFrame([], f"{RANGES}, bytes long").write.parquet(f"{target}/ranges")
    if rows is not None:
        slot = slot_of(F.col(vector))
        by = [F.col(product), slot]
        dealt = rows.repartitionByRange(*([files] if files else []), *by) if ordered else rows.hint("rebalance", product)
        dealt = dealt.sortWithinPartitions(F.col(product), slot, F.col(vector))
        dealt.write.option("maxRecordsPerFile", FILE_ROWS).parquet(f"{store}/data/{folder}")
        if any(n.endswith(".parquet") for n in fs.list_names(spark, f"{store}/data/{folder}")):
            _index(spark, store, folder, product, vector, ordered, target)

    written = fs.exists(spark, f"{target}/files")
    mine = set()
    if removed is not None:
        mine = {r["file"] for r in removed.select("file").collect()}

    def passed(number: int) -> None:
        other = [e for e in _entries(spark, store, number) if e["entry"] == number]
        if removed is None or not other:
            return
        taken = _actions(spark, store, other, "files", FILES).filter("NOT added").select("file").collect()
        if mine & {r["file"] for r in taken} or (kind == "merge" and other[0]["kind"] != "compact"):
            raise ConcurrentChange(f"entry {number} changed what this {kind} has read")

    row = {"kind": kind, "batch": batch, "actions": actions if written else None, "snapshot": False}
    return commit(spark, log_path(store), [row], after, passed)


def append_rows(
    spark: SparkSession, store: str, rows: DataFrame, keys: tuple[str, str] = ("productId", "vectorId"), batch: str | None = None
) -> int:
    """Add rows as a few files, hot products split over several; returns the entry.

    With ``batch`` (a name no other batch has) rows are added once, however often a batch is repeated.
    """
    seen = last_entry(spark, log_path(store))
    if batch is not None and seen:
        done = read_entries(spark, log_path(store), ENTRY).filter(F.col("batch") == batch).select("entry").first()
        if done:
            return done["entry"]
    return _commit(spark, store, rows, keys, "append", seen, ordered=False, batch=batch)


def create_store(spark: SparkSession, store: str, rows: DataFrame, keys: tuple[str, str] = ("productId", "vectorId")) -> int:
    """A store of ``rows``, in key order and with filters."""
    return _commit(spark, store, rows, keys, "append", last_entry(spark, log_path(store)))


def compact(
    spark: SparkSession,
    store: str,
    schema: T.StructType | str,
    keys: tuple[str, str] = ("productId", "vectorId"),
    small_rows: int | None = None,
) -> int | None:
    """Rewrite the files with fewer than ``small_rows`` rows into few, in key order; returns the entry.

    Rows stay as they are. Nothing happens with fewer than two such files. If
    another writer replaced any of them meanwhile, raises ``ConcurrentChange``.
    """
    seen = last_entry(spark, log_path(store))
    small_rows = FILE_ROWS // 2 if small_rows is None else small_rows
    files = live_files(spark, store, seen).filter(F.col("rows") < small_rows).select("file", "rows")
    held = f"{scratch_dir(spark, 'compact')}/files"
    files.write.parquet(held)
    small = spark.read.schema("file string, rows long").parquet(held)
    n, rows = small.agg(F.count("*"), F.sum("rows")).first()
    if n < 2:
        return None
    wanted = -(-rows // max(1, small_rows))
    rows_of = _read(spark, store, small, _schema(schema)).drop("__file")
    return _commit(spark, store, rows_of, keys, "compact", seen, removed=small, files=wanted)


# -------------------------------------------------------------- merging


def touched_files(
    spark: SparkSession, store: str, keys: DataFrame, upto: int, names: tuple[str, str] = ("productId", "vectorId")
) -> DataFrame:
    """Files that may hold any of the ``keys`` (product and vector), by the ranges and filters of the index."""
    live = live_files(spark, store, upto)
    ranges = _actions(spark, store, _entries(spark, store, upto), "ranges", RANGES).join(live.select("file"), "file", "left_semi")
    first, last = F.floor(F.col("first_slot") / GROUP).cast("int"), F.floor(F.col("last_slot") / GROUP).cast("int")
    wide = last - first > GROUPS // 2
    groups = F.when(wide, F.array(F.lit(-1))).otherwise(F.sequence(first, last))
    listed = ranges.select("file", "product", "first_slot", "last_slot", "first_vector", "last_vector", F.explode(groups).alias("group"))
    asked = keys.select(F.col(names[0]).cast("long").alias("product"), F.col(names[1]).cast("long").alias("vector")).distinct()
    asked = asked.withColumn("slot", slot_of(F.col("vector"))).withColumn("key_hash", _key_hash(F.col("product"), F.col("vector")))
    own = F.floor(F.col("slot") / GROUP).cast("int")
    asked = asked.withColumn("group", F.explode(F.array(F.lit(-1), own)))
    met = asked.join(listed, ["product", "group"]).filter(
        F.col("slot").between(F.col("first_slot"), F.col("last_slot"))
        & F.col("vector").between(F.col("first_vector"), F.col("last_vector"))
    )
    held = met.select("file", "key_hash").join(live.select("file", "words"), "file")
    return held.filter(may_hold(F.col("words"), F.col("key_hash"))).select("file").distinct()


def merge_rows(
    spark: SparkSession,
    store: str,
    delta: DataFrame,
    schema: T.StructType | str,
    keys: Sequence[str] = ("vectorId",),
    insert_new: bool = False,
    names: tuple[str, str] = ("productId", "vectorId"),
) -> int:
    """Merge a delta into the store (as ``merge_into_store``); returns the entry.

    The product is part of the key. Only files that the index finds for a key
    of the delta are read, and of those only the ones that really hold one
    are replaced; with ``insert_new``, delta rows that no file holds come in
    new files. Rows of a null product or vector match nothing.
    """
    product, vector = names
    seen = last_entry(spark, log_path(store))
    keyed = [product, *(k for k in keys if k != product)]
    schema = _schema(schema)
    carry = [c for c in schema.names if c in delta.columns and c not in keyed] if insert_new else []
    work = scratch_dir(spark, "merge-rows")
    latest_per_key(delta, keyed, "value", carry=carry).write.parquet(f"{work}/delta")
    winners = spark.read.parquet(f"{work}/delta")
    touched_files(spark, store, winners, seen, names).write.parquet(f"{work}/may-hold")
    likely = _read(spark, store, spark.read.schema("file string").parquet(f"{work}/may-hold"), schema)
    holds = likely.join(winners.select(*keyed), keyed, "left_semi").select(F.col("__file").alias("file")).distinct()
    holds.write.parquet(f"{work}/holds")
    touched = spark.read.schema("file string").parquet(f"{work}/holds")
    stored = _read(spark, store, touched, schema).drop("__file")
    merged = merge_values(stored, winners, keyed, "value", insert_new)
    return _commit(spark, store, merged, names, "merge", seen, removed=touched)


def snapshot(spark: SparkSession, store: str) -> int:
    """Write the live files as one entry, so that readers need none before it."""
    seen = last_entry(spark, log_path(store))
    store = store.rstrip("/")
    entries, actions = _entries(spark, store, seen), uuid.uuid4().hex
    live = live_files(spark, store, seen)
    live.withColumn("added", F.lit(True)).select("file", "added", "rows", "bytes", "words").write.parquet(f"{store}/actions/{actions}/files")
    ranges = _actions(spark, store, entries, "ranges", RANGES).join(live.select("file"), "file", "left_semi")
    ranges.write.parquet(f"{store}/actions/{actions}/ranges")

    def passed(number: int) -> None:
        raise ConcurrentChange(f"entry {number} is not in this snapshot")

    row = {"kind": "snapshot", "batch": None, "actions": actions, "snapshot": True}
    return commit(spark, log_path(store), [row], seen, passed)
