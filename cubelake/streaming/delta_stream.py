"""Incremental delta ingest with Structured Streaming.

Daily delta files dropped into a landing folder are read as a file stream
with the fixed delta schema and appended to a delta store split by
``productId``. The file sink's commit log and the query checkpoint make each
landed file count exactly once, across restarts and lost executors. The
current table is then "stored table merged with every delta so far"
(merge on read): the winner rule is deterministic, so the result does not
depend on how files were grouped into micro-batches. ``ingest_compacted``
keeps the store in few, well-sized files behind a commit log; ``ingest_and_merge``
merges on write instead. The result is the same. Daily ``.zip`` files are
unpacked where they landed before the stream starts.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cubelake import fs
from cubelake import schemas as S
from cubelake.operators.merge import WINNER_ORDER, latest_per_key, merge_values
from cubelake.plans import indexed_store
from cubelake.sources.cube_csv import CSV_GLOB
from cubelake.sources.lake import read_folders
from cubelake.sources.delta_csv import DELTA_OPTIONS, DELTA_TEXT_SCHEMA, type_delta


#: Landed files a micro-batch takes at most, so a first run over a long backlog stays bounded.
FILES_PER_BATCH = 500
#: Small files in a compacted store before they are rewritten.
COMPACT_FILES = 64


#: Tables of winning rows beside a stream's checkpoint before they are made one.
WINNER_TABLES = 16
#: Marks a table of winners as whole.
_WHOLE = "_WHOLE"


class DamagedArchives(RuntimeError):
    """Archives that could not be unpacked: ``archives`` (status rows) and ``query``, which took all whole files."""

    def __init__(self, archives: list, query):
        super().__init__("not ingested: " + ", ".join(f"{x.archive} ({x.reason})" for x in archives))
        self.archives, self.query = archives, query


def _finish(query, damaged: list, wait: bool):
    """The query, awaited if asked for; damaged archives are an error once it has the whole files."""
    if wait:
        query.awaitTermination()
    if damaged:
        raise DamagedArchives(damaged, query)
    return query


def land_archives(spark: SparkSession, landing: str) -> list:
    """Unpack daily ``.zip`` files beside themselves; those whose CSV is already there are left alone.

    One job for all folders that the landing path or glob stands for. A member
    appears only when it is whole, so the stream never sees part of one.
    Returns the status rows of the archives that could not be unpacked.
    """
    from cubelake.sources.archives import unzip_to_landing

    return unzip_to_landing(spark, landing, None, rule="stem", skip_landed=True).where("NOT ok").collect()


def delta_stream(spark: SparkSession, landing: str, max_files_per_trigger: int | None = FILES_PER_BATCH) -> DataFrame:
    """Landed delta files (``.csv`` in either case) as typed rows."""
    reader = spark.readStream.schema(DELTA_TEXT_SCHEMA).options(**DELTA_OPTIONS).option("pathGlobFilter", CSV_GLOB)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return type_delta(reader.csv(landing))


def ingest_deltas(
    spark: SparkSession,
    landing: str,
    store: str,
    checkpoint: str,
    max_files_per_trigger: int | None = FILES_PER_BATCH,
    wait: bool = True,
):
    """Process every delta file landed so far (``availableNow``) into ``store``.

    Archives that cannot be unpacked raise ``DamagedArchives`` after the whole
    files are ingested (without ``wait``: after the query has started).
    Rows are written by the tasks that read them: a hot product never meets
    in one task, at the price of one file per product and input split. Use
    ``ingest_compacted`` unless another tool needs the ``productId=`` folders.
    """
    damaged = land_archives(spark, landing)
    query = (
        delta_stream(spark, landing, max_files_per_trigger)
        .writeStream.format("parquet")
        .option("path", store)
        .option("checkpointLocation", checkpoint)
        .partitionBy("productId")
        .trigger(availableNow=True)
        .start()
    )
    return _finish(query, damaged, wait)


def ingest_compacted(
    spark: SparkSession,
    landing: str,
    store: str,
    checkpoint: str,
    max_files_per_trigger: int | None = FILES_PER_BATCH,
    compact_files: int = COMPACT_FILES,
    wait: bool = True,
):
    """As ``ingest_deltas``, into a store whose number of files follows its bytes (``plans.indexed_store``).

    Each micro-batch is dealt by product once and becomes a few files, however
    many products and input splits it has. When ``compact_files`` files are
    small, they are rewritten as one step with the batch that made them so
    many; readers see the rows once, before and after. A replayed batch (same
    stream, same batch id) is recognised by the log and adds nothing. Read the
    result with ``delta_rows`` or ``current_compacted``.
    """
    damaged = land_archives(spark, landing)

    def apply(batch, batch_id):
        stream = json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
        indexed_store.append_rows(spark, store, batch, batch=f"{stream}/{batch_id}")
        small = indexed_store.live_files(spark, store).filter(F.col("rows") < indexed_store.FILE_ROWS // 2)
        if small.count() >= compact_files:
            indexed_store.compact(spark, store, S.DELTA_SCHEMA)

    query = (
        delta_stream(spark, landing, max_files_per_trigger)
        .writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    return _finish(query, damaged, wait)


def delta_rows(spark: SparkSession, store: str) -> DataFrame:
    """The delta rows that ``ingest_compacted`` has stored."""
    return indexed_store.read_store(spark, store, S.DELTA_SCHEMA)


def current_compacted(
    spark: SparkSession, original: DataFrame, store: str, keys: Sequence[str] = ("vectorId",), insert_new: bool = False
) -> DataFrame:
    """Stored table with every delta of a compacted store applied."""
    return merge_values(original, delta_rows(spark, store), keys=keys, value="value", insert_new=insert_new)


def current_table(
    spark: SparkSession,
    original: DataFrame,
    store: str,
    keys: Sequence[str] = ("vectorId",),
    insert_new: bool = False,
) -> DataFrame:
    """Stored table with every ingested delta applied."""
    deltas = spark.read.schema(S.DELTA_SCHEMA).parquet(store)
    return merge_values(original, deltas, keys=keys, value="value", insert_new=insert_new)


def _write_whole(spark: SparkSession, rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").parquet(path)
    fs.put_if_absent(spark, f"{path}/{_WHOLE}", "")


def _earlier_winners(
    spark: SparkSession, tables: str, folders: str, schema: T.StructType, winners_of: Callable[[DataFrame], DataFrame]
) -> list[str]:
    """The tables with the winners so far; made one if they are many.

    ``folders``: where streams kept them before, a folder per product; those rows
    go into a table first. A crash on the way leaves rows in two tables, which
    changes no winner.
    """
    found = [f"{tables}/{n}" for n in sorted(fs.list_names(spark, tables))]
    whole = [t for t in found if fs.exists(spark, f"{t}/{_WHOLE}")]
    old = fs.first_folder(spark, folders) is not None
    if not old and len(whole) < WINNER_TABLES:
        return whole
    rows = [spark.read.schema(schema).parquet(*whole)] if whole else []
    if old:
        rows.append(read_folders(spark, folders, "productId", schema=schema, whole=True).select(*schema.names))
    one = f"{tables}/upto-{uuid.uuid4().hex}"
    _write_whole(spark, winners_of(reduce(DataFrame.unionByName, rows)), one)
    for path in [*found, *([folders] if old else [])]:
        fs.delete(spark, path)
    return [one]


def ingest_and_merge(
    spark: SparkSession,
    landing: str,
    store: str,
    checkpoint: str,
    keys: Sequence[str] = ("vectorId",),
    insert_new: bool = False,
    max_files_per_trigger: int | None = FILES_PER_BATCH,
    wait: bool = True,
):
    """Merge on write: each micro-batch of landed delta files is merged into a
    ``productId=``-partitioned store (only the products it touches are
    rewritten).

    The winning delta row of every key so far, with the columns that rank it,
    is kept beside the checkpoint, in a table per batch: the winners of the
    keys that the batch has. ``WINNER_TABLES`` of them are made one. A batch competes
    with those before it, so the store ends the same however files were grouped and in
    whatever order they came.
    Damaged archives raise as in ``ingest_deltas``.
    A replayed batch (after a failure, same batch id) finds the same winners
    and leaves the same store.
    """
    from cubelake.plans.delta_jobs import merge_winners, product_keys

    damaged = land_archives(spark, landing)
    tables = f"{checkpoint}/winner-tables"
    keyed = product_keys(keys)
    fields = [f for f in S.DELTA_SCHEMA.fields if f.name in {*keyed, *WINNER_ORDER, "value"} or insert_new]
    schema = T.StructType(fields)
    carry = [n for n in schema.names if n not in {*keyed, *WINNER_ORDER, "value"}]

    def winners_of(rows: DataFrame) -> DataFrame:
        return latest_per_key(rows, keyed, "value", carry=carry).select(*schema.names)

    def apply(batch, batch_id):
        own, work = f"{tables}/{batch_id}", f"{checkpoint}/merge-work/{batch_id}"
        if not fs.exists(spark, f"{own}/{_WHOLE}"):  # else the batch is repeated, and its winners stand
            rows = batch.select(*schema.names)
            earlier = _earlier_winners(spark, tables, f"{checkpoint}/winners", schema, winners_of)
            if earlier:
                # Written once: the choice of keys and the competition both read it.
                winners_of(rows).write.mode("overwrite").parquet(f"{work}/batch")
                rows = spark.read.schema(schema).parquet(f"{work}/batch")
                before = spark.read.schema(schema).parquet(*earlier)
                rows = rows.unionByName(before.join(rows.select(*keyed), keyed, "left_semi").select(*schema.names))
            _write_whole(spark, winners_of(rows), own)
        merge_winners(spark, store, spark.read.schema(schema).parquet(own), keys, insert_new, work=work)
        fs.delete(spark, work)

    query = (
        delta_stream(spark, landing, max_files_per_trigger)
        .writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    return _finish(query, damaged, wait)
