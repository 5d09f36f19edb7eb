"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cubelake.session import scratch_dir, ship_package

#: Low bits of monotonically_increasing_id: the row's number inside its partition.
ROW_BITS = 33


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back.

    Cuts the lineage: what follows neither recomputes ``df`` nor depends on
    any executor that took part in it.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _is_parquet_scan(df: DataFrame) -> bool:
    """Whether ``df`` is one Parquet folder or file as read, with nothing done to it."""
    plan = df._jdf.queryExecution().analyzed()
    if plan.getClass().getSimpleName() != "LogicalRelation":
        return False
    relation = plan.relation()
    return (
        relation.getClass().getSimpleName() == "HadoopFsRelation"
        and relation.fileFormat().toString() == "Parquet"
        and relation.location().rootPaths().size() == 1
    )


def numbered(df: DataFrame, columns: list[Column], label: str) -> DataFrame:
    """``columns`` of ``df`` with ``__row``: a number per row, the same in every job that scans the result.

    Spark splits files by the cores it has when a job starts, so ids made from
    partitions change between the jobs of one query when an executor comes or
    goes. A Parquet table is numbered by its files in the order of their paths
    and the places of the rows in them, through a table with one row per file;
    any other frame is written once with its ids and read back.
    """
    if not _is_parquet_scan(df):
        return cut(df.select(*columns, F.monotonically_increasing_id().alias("__row")), label)
    meta = df.metadataColumn("_metadata")
    path, place = meta.getField("file_path").alias("__file"), meta.getField("row_index").alias("__place")
    number = F.row_number().over(Window.orderBy("__file"))  # one row per file
    files = cut(df.select(path).distinct().select("__file", number.cast("long").alias("__number")), label)
    row = F.shiftleft("__number", ROW_BITS) + F.col("__place")
    rows = df.select(*columns, path, place).join(F.broadcast(files), "__file")
    return rows.withColumn("__row", row).drop("__file", "__number", "__place")


_ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers, and bound what is sent to them at once.

    Rows here are whole texts. Spark's default of 10,000 of them a batch is
    held several times over (in the JVM, as Arrow, in Python); 512 keep that
    small. A number that the session has set itself stays.
    """
    ship_package(spark)
    if spark.conf.get(_ARROW_ROWS) == "10000":
        spark.conf.set(_ARROW_ROWS, "512")


_HELD: dict = {}


def held(kind: str, key: object, make):
    """Something large that a Python worker keeps from task to task, made when it is new.

    A worker keeps one such thing: when it turns to another operator, what
    the last one kept goes (``make`` None: nothing takes its place).
    """
    if (kind, key) not in _HELD:
        _HELD.clear()
        if make is None:
            return None
        _HELD[kind, key] = make()
    return _HELD[kind, key]


def text_remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id written as text, modulo ``n`` (the contract's folds)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def ordered(df: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Rows dealt into ranges of ``keys``, with ``__pid`` (range) and ``__pos`` (place).

    ``__pos`` ascends with the keys inside a range and ranges ascend with
    ``__pid``, so (``__pid``, ``__pos``) is the global order. ``keys`` should
    end in a unique column: then equal keys can be split between ranges.
    """
    dealt = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return cut(
        dealt.select("*", F.spark_partition_id().alias("__pid"), F.monotonically_increasing_id().alias("__pos")),
        label,
    )


def following(rows: DataFrame, value: str, alias: str, circular: bool = False, back: bool = False) -> DataFrame:
    """Add ``alias``: ``value`` of the next row (``back``: the previous one) in the order of ``ordered``.

    Within a range by lead/lag; across ranges through a table with one row
    per range. The last row gets null, or with ``circular`` the first row's
    value. No window spans more than one range of rows.
    """
    inside = Window.partitionBy("__pid").orderBy(F.desc("__pos") if back else "__pos")
    edge = F.max_by if back else F.min_by
    over = Window.orderBy(F.desc("__pid") if back else "__pid")  # one row per range
    edges = rows.groupBy("__pid").agg(edge(value, "__pos").alias("__edge"))
    beyond = F.lead("__edge").over(over)
    if circular:
        whole = over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        beyond = F.coalesce(beyond, F.first("__edge").over(whole))
    edges = edges.select("__pid", beyond.alias("__beyond"))
    return (
        rows.withColumn("__last", F.lead("__pos").over(inside).isNull())
        .withColumn("__next", F.lead(value).over(inside))
        .join(F.broadcast(edges), "__pid")
        .withColumn(alias, F.when(F.col("__last"), F.col("__beyond")).otherwise(F.col("__next")))
        .drop("__last", "__next", "__beyond")
    )
