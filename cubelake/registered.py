"""Registered queries over the driver's tables (their SQL oracles are in ``__spark_entry__``).

Each query runs one operator of the pipeline (or a whole job) on inputs that
Spark derives from the driver's tables, over the whole tables. Timestamps are
returned as ``yyyy-MM-dd HH:mm:ss`` text so that both engines render them
the same way.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cubelake import derive
from cubelake import schemas as S
from cubelake.derive import table
from cubelake.functions.columns import ref_year
from cubelake.operators.freshness import freshness_diff, refresh_plan
from cubelake.operators.inference import value_kinds
from cubelake.operators.merge import merge_values
from cubelake.operators.scaling import scale_cube_value, scale_delta_value
from cubelake.operators.stats import multiset_difference
from cubelake.plans import indexed_store, versions
from cubelake.plans.cube_etl import prepare_cubes
from cubelake.plans.delta_jobs import merge_delta, split_delta
from cubelake.plans.layout import write_keyed, write_year_partitioned
from cubelake.plans.refresh import plan_changed, refresh
from cubelake.session import scratch_dir, ship_package, tune_session
from cubelake.sources.archives import read_envelopes, unzip_to_landing
from cubelake.sources.catalog import read_catalog
from cubelake.sources.json_rows import read_json_rows
from cubelake.sources.lake import cube_path, query_cube, read_cube, read_cubes, read_folders
from cubelake.sources.registry import append_registry, latest_registry, read_registry
from cubelake.streaming.delta_stream import current_compacted, delta_rows, ingest_compacted

TS_OUT = "yyyy-MM-dd HH:mm:ss"
LINEITEM_CUBE = 1


def _prep(spark: SparkSession) -> None:
    tune_session(spark)
    ship_package(spark)


def _ts(c: str) -> F.Column:
    return F.date_format(F.col(c), TS_OUT).alias(c)


# ------------------------------------------------------------ analytic reads

def _publish_lineitem_cube(spark: SparkSession, sf_dir: str) -> str:
    """``lineitem`` as a published cube with hive ``year=`` folders."""
    li = table(spark, sf_dir, "lineitem")
    cube = li.select(
        "l_orderkey",
        "l_linenumber",
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("REF_DATE"),
        F.col("l_returnflag").alias("GEO"),
        F.col("l_linestatus").alias("Sex"),
        F.col("l_extendedprice").alias("VALUE"),
    ).withColumn(S.YEAR_COLUMN, ref_year("REF_DATE"))
    lake = scratch_dir(spark, "lake")
    write_year_partitioned(cube, cube_path(lake, LINEITEM_CUBE))
    return lake


def cube_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Analytic read: ``GEO IN (..) AND Sex <> .. AND year > ..`` on a published cube."""
    _prep(spark)
    lake = _publish_lineitem_cube(spark, sf_dir)
    cube = read_cube(spark, lake, LINEITEM_CUBE)
    return cube.where(F.col("GEO").isin("A", "R") & (F.col("Sex") != "F") & (F.col("year") > 1996))


def year_equals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partition-equality read: ``year = 1998`` prunes to one folder."""
    _prep(spark)
    lake = _publish_lineitem_cube(spark, sf_dir)
    return read_cube(spark, lake, LINEITEM_CUBE).where(F.col("year") == 1998)


def cube_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Free SQL text over a registered cube."""
    _prep(spark)
    lake = _publish_lineitem_cube(spark, sf_dir)
    return query_cube(
        spark,
        lake,
        LINEITEM_CUBE,
        """
        SELECT GEO, Sex, year, COUNT(*) AS n_rows,
               MIN(VALUE) AS min_value, MAX(VALUE) AS max_value
        FROM cube
        WHERE year >= 1996 AND Sex <> 'O'
        GROUP BY GEO, Sex, year
        """,
    )


# ---------------------------------------------------------------- delta jobs

def _split_events(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    landing = derive.landed(spark, sf_dir, "events_delta_csv")
    target = f"{scratch_dir(spark, 'split')}/split"
    split_delta(spark, landing, target)
    return landing, target


def _read_split(spark: SparkSession, target: str) -> DataFrame:
    df = read_folders(spark, target, "productId", schema=S.DELTA_SCHEMA)
    return df.select(*[F.col(n).cast(t).alias(n) for n, t in S.DELTA_COLUMNS])


def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delta CSV -> ``productId=`` dataset; per-product counts read back."""
    _prep(spark)
    _, target = _split_events(spark, sf_dir)
    return _read_split(spark, target).groupBy("productId").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("refPer").alias("n_periods"),
        F.min("refPer").alias("first_period"),
        F.max("refPer").alias("last_period"),
        F.count_if(F.col("value").isNull()).alias("n_null_values"),
    )


def split_multiset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in, rows out, and rows whose multiplicity differs after the split."""
    _prep(spark)
    from cubelake.sources.delta_csv import read_delta

    landing, target = _split_events(spark, sf_dir)
    before = read_delta(spark, landing)
    after = _read_split(spark, target)
    diff = multiset_difference(before, after)
    unmatched = diff.agg(
        F.coalesce(F.sum(F.abs(F.col("n_left") - F.col("n_right"))), F.lit(0)).cast("bigint").alias("n")
    )
    return reduce(
        DataFrame.unionByName,
        [
            before.agg(F.count(F.lit(1)).alias("n")).select(F.lit("input_rows").alias("measure"), "n"),
            after.agg(F.count(F.lit(1)).alias("n")).select(F.lit("split_rows").alias("measure"), "n"),
            unmatched.select(F.lit("unmatched_rows").alias("measure"), "n"),
        ],
    )


def delta_zip_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zipped daily delta files: distributed unzip (stem rule), read, split by product."""
    _prep(spark)
    from cubelake.plans.layout import split_by_key
    from cubelake.sources.delta_csv import read_delta

    work = scratch_dir(spark, "delta-zips")
    zips = derive.landed(spark, sf_dir, "daily_delta_zips")
    status = unzip_to_landing(spark, zips, f"{work}/landing", rule="stem").collect()
    if not status or not all(s["ok"] for s in status):
        raise RuntimeError(f"unzip failed: {[s for s in status if not s['ok']]}")
    split_by_key(spark, read_delta(spark, f"{work}/landing"), f"{work}/split", "productId")
    return _read_split(spark, f"{work}/split").groupBy("productId").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("refPer").alias("n_periods"),
        F.min("refPer").alias("first_period"),
        F.max("refPer").alias("last_period"),
        F.count_if(F.col("value").isNull()).alias("n_null_values"),
    )


def merge_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Split a delta, then merge it into a stored table on ``vectorId`` (files in, file out)."""
    _prep(spark)
    _, split = _split_events(spark, sf_dir)
    work = scratch_dir(spark, "merge")
    original = f"{work}/original.parquet"
    derive.customer_as_stored(table(spark, sf_dir, "customer")).write.mode("overwrite").parquet(original)
    merged = f"{work}/merged.parquet"
    merge_delta(spark, original, split, merged)
    return spark.read.parquet(merged)


def _period_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    ev = table(spark, sf_dir, "events")
    latest = F.max_by(F.struct("event_type", "value"), F.col("ts"))
    original = (
        ev.where(F.col("event_type") != "purchase")
        .groupBy(F.col("user_id").cast("bigint").alias("vectorId"), F.date_format("ts", "yyyy-MM-dd").alias("refPer"))
        .agg(latest.alias("w"))
        .select(
            F.col("vectorId").alias("productId"),
            "vectorId",
            "refPer",
            F.col("w.event_type").alias("coordinate"),
            F.col("w.value").alias("value"),
        )
    )
    delta = derive.events_as_delta(ev.where(F.col("event_type") == "purchase"))
    return original, delta


def merge_vector_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merge keyed on ``(vectorId, refPer)``; new periods are not added."""
    _prep(spark)
    original, delta = _period_inputs(spark, sf_dir)
    return merge_values(original, delta, keys=("vectorId", "refPer"))


def merge_vector_period_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merge keyed on ``(vectorId, refPer)`` that also inserts new periods."""
    _prep(spark)
    original, delta = _period_inputs(spark, sf_dir)
    return merge_values(original, delta, keys=("vectorId", "refPer"), insert_new=True)


def merge_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merge a delta into a product-partitioned store, rewriting touched products only."""
    _prep(spark)
    from cubelake.plans.delta_jobs import merge_into_store

    original, delta = _period_inputs(spark, sf_dir)
    store = f"{scratch_dir(spark, 'store')}/store"
    write_keyed(original, store, "productId")
    merge_into_store(spark, store, delta, keys=("vectorId", "refPer"))
    back = read_folders(spark, store, "productId", schema=original.schema, whole=True)
    return back.select(*[F.col(c).cast(original.schema[c].dataType).alias(c) for c in original.columns])


def _hot_product(rows: DataFrame) -> DataFrame:
    """Three quarters of the series in one product."""
    product = F.when(F.col("vectorId") % 4 == 0, F.col("vectorId")).otherwise(F.lit(0))
    return rows.withColumn("productId", product.cast("bigint"))


def merge_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merge a delta with few series into an indexed store: only files that hold one of them are rewritten."""
    _prep(spark)
    original, delta = map(_hot_product, _period_inputs(spark, sf_dir))
    store = f"{scratch_dir(spark, 'indexed')}/store"
    indexed_store.create_store(spark, store, original)
    few = delta.where(F.col("vectorId") % 25 == 1)
    indexed_store.merge_rows(spark, store, few, original.schema, keys=("vectorId", "refPer"))
    return indexed_store.read_store(spark, store, original.schema)


def publish_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cubes published by the commit log: a first release of all, a second of some, a crash, a late old release."""
    _prep(spark)
    lake = f"{scratch_dir(spark, 'versions')}/lake"
    brand = F.regexp_extract("p_brand", r"([0-9]+)$", 1).cast("bigint")
    part = table(spark, sf_dir, "part").select(brand.alias("product_id"), "p_partkey", "p_size")

    def publish(rows: DataFrame, release: str | None) -> None:
        written = versions.write_release(spark, lake, rows).collect()
        if release is not None:  # without: the job died before its entry
            versions.publish_versions(spark, lake, [{**r.asDict(), "release_time": release} for r in written])

    publish(part.where("p_size <= 25"), "2024-01-01 08:30:00")
    publish(part.where("product_id % 2 = 0"), "2024-03-01 08:30:00")
    publish(part.where("product_id % 3 = 0 AND p_size > 40"), None)
    publish(part.where("product_id % 5 = 0 AND p_size > 10"), "2024-02-01 08:30:00")
    registry = latest_registry(versions.version_registry(spark, lake).drop("created_at").withColumn("created_at", F.col("release_time")))
    rows = versions.read_versions(spark, lake, "p_partkey long, p_size int")
    data = rows.groupBy("product_id").agg(F.count("*").alias("n_rows"), F.sum("p_size").alias("sum_size"))
    return data.join(registry, data["product_id"] == registry["number"]).select(
        "product_id", _ts("release_time"), "n_rows", "sum_size"
    )


def scale_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delta value scaling: empty as 0, times ``10 ** scalarFactorCode``."""
    _prep(spark)
    d = scale_delta_value(derive.events_as_delta(table(spark, sf_dir, "events")))
    return d.select("vectorId", "releaseTime", "scalarFactorCode", "scaled_value")


def stream_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily delta files ingested by a stream (availableNow), merged on read."""
    _prep(spark)
    work = scratch_dir(spark, "stream")
    landing = derive.landed(spark, sf_dir, "daily_delta_csv")
    ingest_compacted(spark, f"{landing}/day=*", f"{work}/store", f"{work}/checkpoint")
    return current_compacted(spark, derive.customer_as_stored(table(spark, sf_dir, "customer")), f"{work}/store")


def stream_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily delta files streamed in small batches, then compacted: per product the rows before and after."""
    _prep(spark)
    work = scratch_dir(spark, "compaction")
    landing, store = derive.landed(spark, sf_dir, "daily_delta_csv"), f"{work}/store"
    # so many small files on purpose: nothing is compacted during the ingest
    ingest_compacted(spark, f"{landing}/day=*", store, f"{work}/checkpoint", max_files_per_trigger=5, compact_files=1 << 30)
    before, files = delta_rows(spark, store), indexed_store.live_files(spark, store).count()
    indexed_store.compact(spark, store, S.DELTA_SCHEMA)
    fewer = indexed_store.live_files(spark, store).count() < files

    def counts(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("productId").agg(F.count("*").alias(f"rows_{name}"), F.sum("value").alias(f"sum_{name}"))

    both = counts(before, "before").join(counts(delta_rows(spark, store), "after"), "productId", "full")
    same = F.abs(F.col("sum_before") - F.col("sum_after")) < 1e-6
    return both.select(
        "productId", "rows_before", "rows_after", F.coalesce(same, F.lit(True)).alias("same_sum"), F.lit(fewer).alias("fewer_files")
    )


def stream_merge_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily delta files merged on write into a product-partitioned store by a stream."""
    _prep(spark)
    from cubelake.streaming.delta_stream import ingest_and_merge

    original, _ = _period_inputs(spark, sf_dir)
    work = scratch_dir(spark, "stream-store")
    store, landing = f"{work}/store", derive.landed(spark, sf_dir, "daily_purchase_csv")
    write_keyed(original, store, "productId")
    ingest_and_merge(spark, f"{landing}/day=*", store, f"{work}/checkpoint", keys=("vectorId", "refPer"))
    back = read_folders(spark, store, "productId", schema=original.schema, whole=True)
    return back.select(*[F.col(c).cast(original.schema[c].dataType).alias(c) for c in original.columns])


# ------------------------------------------------------ catalog and registry

def _orders_catalog(orders: DataFrame) -> DataFrame:
    return orders.groupBy(F.col("o_custkey").cast("bigint").alias("product_id")).agg(
        F.max("o_orderdate").cast("timestamp").alias("release_time")
    )


def _orders_registry(spark: SparkSession, orders: DataFrame) -> str:
    path = f"{scratch_dir(spark, 'registry')}/products"
    rows = orders.where(F.col("o_orderstatus") == "F").select(
        F.col("o_custkey").alias("product_id"), F.col("o_orderdate").cast("timestamp").alias("release_time")
    )
    append_registry(spark, path, rows, created_at=F.col("release_time"))
    return path


def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog rows missing from, or newer than, the registry."""
    _prep(spark)
    orders = table(spark, sf_dir, "orders")
    registry = read_registry(spark, _orders_registry(spark, orders))
    return freshness_diff(_orders_catalog(orders), registry).select("product_id", _ts("release_time"))


def refresh_planning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Diff, then start-from, order, limit and skip (skip after the limit)."""
    _prep(spark)
    orders = table(spark, sf_dir, "orders")
    registry = read_registry(spark, _orders_registry(spark, orders))
    plan = refresh_plan(_orders_catalog(orders), registry, start_from=100, max_products=50, skip=[105, 110, 120])
    return plan.select("product_id", _ts("release_time"))


def changed_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changed-cube lists per day over a date range, latest release per product."""
    _prep(spark)
    root = derive.landed(spark, sf_dir, "changes")
    plan = plan_changed(spark, root, "1996-03-01", "1999-06-30")
    return plan.select("product_id", _ts("release_time"))


def changed_on_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changed-cube list of one day, as listed (no dedup); one folder is read."""
    _prep(spark)
    from cubelake.sources.catalog import read_changed_on

    day = read_changed_on(spark, derive.landed(spark, sf_dir, "changes"), "1998-08-02")
    return day.select("product_id", _ts("release_time"))


def catalog_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog JSON arrays -> (product_id, release_time)."""
    _prep(spark)
    root = derive.landed(spark, sf_dir, "catalog")
    return read_catalog(spark, root).select("product_id", _ts("release_time"))


def registry_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three appended registry batches, one per order status; the latest row per product wins."""
    _prep(spark)
    orders = table(spark, sf_dir, "orders")
    path = f"{scratch_dir(spark, 'registry')}/products"
    for status, when in (("F", "2024-01-01 00:00:00"), ("O", "2024-02-01 00:00:00"), ("P", "2024-03-01 00:00:00")):
        batch = orders.where(F.col("o_orderstatus") == status).select(
            F.col("o_custkey").alias("product_id"), F.col("o_orderdate").cast("timestamp").alias("release_time")
        )
        append_registry(spark, path, batch, created_at=F.lit(when).cast("timestamp"))
    latest = latest_registry(read_registry(spark, path))
    return latest.select("number", _ts("release_time"), _ts("created_at"))


# ---------------------------------------------------------------- cube ETL

def value_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VALUE type per cube from ``max(DECIMALS)``."""
    _prep(spark)
    return value_kinds(derive.part_cube_rows(table(spark, sf_dir, "part"))).select(
        "product_id", "max_decimals", "value_type", "n_rows"
    )


def scale_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``VALUE * 10 ** SCALAR_ID`` on an integral cube, scaling columns dropped."""
    _prep(spark)
    part = table(spark, sf_dir, "part")
    cube = part.select(
        "p_partkey",
        F.col("p_size").cast("bigint").alias("VALUE"),
        F.pmod(F.col("p_partkey"), F.lit(4)).cast("bigint").alias("SCALAR_ID"),
        F.lit(0).cast("bigint").alias("DECIMALS"),
        F.lit(1).cast("bigint").alias("UOM_ID"),
        F.lit("units").alias("SCALAR_FACTOR"),
    )
    return scale_cube_value(cube)


def csv_folder_scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every CSV under a folder -> parquet next to it with VALUE scaled (one file per brand)."""
    _prep(spark)
    from cubelake.plans.csv_folder import transform_csv_folder

    part = table(spark, sf_dir, "part")
    brand = F.regexp_extract("p_brand", r"([0-9]+)$", 1).cast("bigint")
    folder = f"{scratch_dir(spark, 'csv-folder')}/tables"
    (
        part.select(
            "p_partkey",
            F.col("p_name").alias("GEO"),
            F.lit(1).alias("UOM_ID"),
            F.lit("units").alias("SCALAR_FACTOR"),
            F.pmod(F.col("p_partkey"), F.lit(4)).alias("SCALAR_ID"),
            F.col("p_size").alias("VALUE"),
            F.lit(0).alias("DECIMALS"),
            brand.alias("brand"),
        )
        .repartition("brand")
        .write.partitionBy("brand")
        .option("header", True)
        .csv(folder)
    )
    status = transform_csv_folder(spark, folder).collect()
    bad = [s for s in status if not s["ok"]]
    if bad or not status:
        raise RuntimeError(f"transform failed: {bad[:3]}")
    return spark.read.parquet(*[s["output"] for s in status]).select("p_partkey", "GEO", "SCALAR_ID", "VALUE")


TYPED_CUBE_COLUMNS = [
    ("REF_DATE", "string"), ("GEO", "string"), ("DGUID", "string"), ("Symbol", "string"),
    ("Symbol.1", "string"), ("STATUS", "string"), ("UOM_ID", "bigint"), ("SCALAR_ID", "bigint"),
    ("VALUE", "double"), ("DECIMALS", "bigint"), ("NOTE", "bigint"), ("FLAG", "boolean"),
    ("DAY", "date"), ("year", "int"),
]


def _land_part_cubes(spark: SparkSession, sf_dir: str, ragged: bool = False) -> tuple[str, str]:
    """A fresh work folder and the landed part cubes (one ragged cube, 13, if asked)."""
    landing = derive.landed(spark, sf_dir, "part_cubes_ragged" if ragged else "part_cubes")
    return scratch_dir(spark, "cubes"), landing


def typed_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed cube CSVs (junk-prefixed, repeated names, quotes, NA) -> typed lake, read back."""
    _prep(spark)
    return _typed_cubes(spark, sf_dir)


def typed_cube_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same cubes forced into ``year=`` folders (threshold 0), read back."""
    _prep(spark)
    return _typed_cubes(spark, sf_dir, threshold=0)


def _typed_cubes(spark: SparkSession, sf_dir: str, threshold: int = S.FLAT_LAYOUT_THRESHOLD_BYTES) -> DataFrame:
    work, landing = _land_part_cubes(spark, sf_dir)
    lake = f"{work}/lake"
    status = prepare_cubes(spark, landing, lake, glob="*.txt", work=f"{work}/etl", threshold=threshold).collect()
    good = {r["product_id"]: r for r in status if r["ok"]}
    # What the stored type of VALUE was; reading the cubes together makes it DOUBLE.
    doubles = [p for p, r in good.items() if T.StructType.fromDDL(r["schema"])["VALUE"].dataType == T.DoubleType()]
    cubes = read_cubes(
        spark, lake, good, schemas={p: r["schema"] for p, r in good.items()}, layouts={p: r["layout"] for p, r in good.items()}
    )
    return cubes.select(
        "product_id",
        *[F.col(f"`{n}`").cast(t).alias(n) for n, t in TYPED_CUBE_COLUMNS],
        F.when(F.col("product_id").isin(doubles), "double").otherwise("bigint").alias("value_type"),
    )


def large_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One large cube (lineitem, multi-part CSV) through the ETL with the default layout rule."""
    _prep(spark)
    landing = derive.landed(spark, sf_dir, "lineitem_cube")
    work = scratch_dir(spark, "large-cube")
    status = prepare_cubes(spark, landing, f"{work}/lake", work=f"{work}/etl").collect()
    if len(status) != 1 or not status[0]["ok"]:
        raise RuntimeError(f"large cube failed: {status}")
    cube = read_cube(spark, f"{work}/lake", 1, status[0]["schema"])
    return cube.groupBy("year", "GEO", "Sex").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("VALUE").alias("min_value"),
        F.max("VALUE").alias("max_value"),
        F.countDistinct("ORDER_ID").alias("n_orders"),
    )


LAYOUT_THRESHOLD = 4096


def layout_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size-adaptive layout with a small threshold, held against the published files.

    ``layout_agrees``: a cube with ``year=`` folders measured at or above the
    threshold when staged; any other lies there with its staged size, below it.
    """
    _prep(spark)
    from cubelake.sources.cube_csv import list_files

    work, landing = _land_part_cubes(spark, sf_dir)
    lake = f"{work}/lake"
    status = prepare_cubes(spark, landing, lake, glob="*.txt", work=f"{work}/etl", threshold=LAYOUT_THRESHOLD)
    published = (
        list_files(spark, lake, "*.parquet")
        .groupBy(F.regexp_extract("path", r"/([0-9]+)\.parquet/", 1).cast("bigint").alias("product_id"))
        .agg(F.max(F.col("path").contains("/year=")).alias("folders"), F.sum("length").alias("size"))
    )
    agrees = F.when(
        F.col("folders"), (F.col("layout") == "partitioned") & (F.col("bytes") >= LAYOUT_THRESHOLD)
    ).otherwise((F.col("layout") == "flat") & (F.col("bytes") == F.col("size")) & (F.col("size") < LAYOUT_THRESHOLD))
    return status.join(published, "product_id", "left").select("product_id", "ok", "rows", agrees.alias("layout_agrees"))


def refresh_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Diff-based refresh over landed cubes; one malformed cube fails alone."""
    _prep(spark)
    part = table(spark, sf_dir, "part")
    work, landing = _land_part_cubes(spark, sf_dir, ragged=True)
    brand = F.regexp_extract("p_brand", r"([0-9]+)$", 1).cast("bigint")
    released = F.timestamp_seconds(F.unix_timestamp(F.lit("2024-01-01 12:30:00")) + F.col("p_size") * F.lit(86400))
    catalog = part.groupBy(brand.alias("product_id")).agg(F.max(released).alias("release_time"))
    registry = f"{work}/registry"
    plan = refresh_plan(catalog, read_registry(spark, registry))
    status = refresh(spark, plan, landing, f"{work}/lake", registry, work=f"{work}/refresh", glob="*.txt")
    reason = F.when(F.col("reason").startswith("malformed"), F.lit("malformed")).otherwise(F.col("reason"))
    return status.select("product_id", "ok", reason.alias("reason_kind"), "rows")


def _released_cubes(spark: SparkSession, sf_dir: str) -> DataFrame:
    brand = F.regexp_extract("p_brand", r"([0-9]+)$", 1).cast("bigint")
    return (
        table(spark, sf_dir, "part")
        .groupBy(brand.alias("product_id"))
        .agg(F.max(F.timestamp_seconds(F.lit(1704112200) + F.col("p_size") * F.lit(86400))).alias("release_time"))
    )


def refresh_zip_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refresh over zipped cubes, three of them damaged; what failed is neither published nor registered."""
    _prep(spark)
    landing = derive.landed(spark, sf_dir, "damaged_zips")
    work = scratch_dir(spark, "refresh-zips")
    registry, lake = f"{work}/registry", f"{work}/lake"
    plan = refresh_plan(_released_cubes(spark, sf_dir), read_registry(spark, registry))
    status = refresh(spark, plan, landing, lake, registry, work=f"{work}/refresh")
    registered = read_registry(spark, registry).select(F.col("number").alias("product_id"), F.lit(True).alias("r"))
    return status.join(registered, "product_id", "left").select(
        "product_id", "ok", "reason", "rows", F.coalesce("r", F.lit(False)).alias("registered")
    )


def refresh_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Succeeded and planned cubes of the refresh over zipped cubes."""
    from cubelake.operators.stats import status_counts

    return status_counts(refresh_zip_status(spark, sf_dir))


def changed_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changed-list refresh end to end: planned from the day lists, built from landed zips where there are any."""
    _prep(spark)
    plan = plan_changed(spark, derive.landed(spark, sf_dir, "changes"), "1996-03-01", "1999-06-30", skip=[11])
    landing = derive.landed(spark, sf_dir, "damaged_zips")
    work = scratch_dir(spark, "refresh-changed")
    status = refresh(spark, plan, landing, f"{work}/lake", f"{work}/registry", work=f"{work}/refresh")
    return status.select("product_id", "ok", "reason", "rows", _ts("release_time"))


def delta_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A delta file whose missing values are spelled in several ways, typed strictly."""
    _prep(spark)
    from cubelake.sources.delta_csv import read_delta

    delta = read_delta(spark, derive.landed(spark, sf_dir, "odd_nulls_csv"))
    return delta.select("vectorId", "coordinate", "releaseTime", "scalarFactorCode", "value")


def split_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The delta split written as ORC, CSV and JSON, each read back."""
    _prep(spark)
    landing, work = derive.landed(spark, sf_dir, "events_delta_csv"), scratch_dir(spark, "formats")
    counts = []
    for fmt in ("csv", "json", "orc"):
        split_delta(spark, landing, f"{work}/{fmt}", fmt=fmt)
        back = read_folders(spark, f"{work}/{fmt}", "productId", fmt, S.DELTA_SCHEMA, whole=True, header="true", escape='"')
        counts.append(
            back.groupBy("productId")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.count("value").alias("n_values"), F.max("releaseTime").alias("latest"))
            .select(F.lit(fmt).alias("format"), "*")
        )
    return reduce(DataFrame.unionByName, counts)


def stream_merge_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merge on write when the newest file comes first and every file is a batch of its own."""
    _prep(spark)
    from cubelake.streaming.delta_stream import ingest_and_merge

    original, _ = _period_inputs(spark, sf_dir)
    work = scratch_dir(spark, "stream-late")
    write_keyed(original, f"{work}/store", "productId")
    landing = derive.landed(spark, sf_dir, "late_thirds_csv")
    ingest_and_merge(
        spark, f"{landing}/batch=*", f"{work}/store", f"{work}/checkpoint", keys=("vectorId",), max_files_per_trigger=1
    )
    back = read_folders(spark, f"{work}/store", "productId", schema=original.schema, whole=True)
    return back.select(*[F.col(c).cast(original.schema[c].dataType).alias(c) for c in original.columns])


# ---------------------------------------------------------- other sources

def json_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Array-of-arrays JSON responses -> text table named by row 0."""
    _prep(spark)
    return read_json_rows(spark, derive.landed(spark, sf_dir, "array_rows"))


def zip_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelope check, distributed unzip, then a plain CSV read of the members."""
    _prep(spark)
    landed = derive.landed(spark, sf_dir, "zipped_cubes")
    work = scratch_dir(spark, "zips")
    ready = [r["product_id"] for r in read_envelopes(spark, f"{landed}/envelopes").where("ok").collect()]
    status = unzip_to_landing(spark, f"{landed}/zips", f"{work}/landing", rule="digits", only=ready).collect()
    if not all(s["ok"] for s in status):
        raise RuntimeError(f"unzip failed: {[s for s in status if not s['ok']]}")
    df = (
        spark.read.option("header", True)
        .option("inferSchema", True)
        .option("escape", '"')
        .csv(f"{work}/landing")
        .withColumn("product_id", F.regexp_replace(F.col("_metadata.file_name"), "[^0-9]", "").cast("bigint"))
    )
    return df.where(F.col("product_id").isin(ready)).select(
        "product_id",
        F.col("c_custkey").cast("bigint").alias("c_custkey"),
        F.col("c_name").cast("string").alias("c_name"),
        F.col("c_nationkey").cast("int").alias("c_nationkey"),
        F.col("c_acctbal").cast("double").alias("c_acctbal"),
        F.col("c_mktsegment").cast("string").alias("c_mktsegment"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "cube_filter": cube_filter,
    "year_equals": year_equals,
    "cube_sql": cube_sql,
    "split_counts": split_counts,
    "split_multiset": split_multiset,
    "delta_zip_split": delta_zip_split,
    "merge_vector": merge_vector,
    "merge_vector_period": merge_vector_period,
    "merge_vector_period_insert": merge_vector_period_insert,
    "merge_store": merge_store,
    "scale_delta": scale_delta,
    "stream_merge": stream_merge,
    "stream_compaction": stream_compaction,
    "merge_indexed": merge_indexed,
    "publish_versions": publish_versions,
    "stream_merge_store": stream_merge_store,
    "freshness_diff": freshness,
    "refresh_plan": refresh_planning,
    "changed_latest": changed_latest,
    "changed_on_day": changed_on_day,
    "catalog_json": catalog_json,
    "registry_latest": registry_latest,
    "value_kind": value_kind,
    "scale_value": scale_value,
    "csv_folder_scaled": csv_folder_scaled,
    "typed_cube": typed_cube,
    "typed_cube_partitioned": typed_cube_partitioned,
    "large_cube": large_cube,
    "layout_choice": layout_choice,
    "refresh_status": refresh_status,
    "refresh_zip_status": refresh_zip_status,
    "refresh_counts": refresh_counts,
    "changed_refresh": changed_refresh,
    "delta_nulls": delta_nulls,
    "split_formats": split_formats,
    "stream_merge_late": stream_merge_late,
    "json_rows": json_rows,
    "zip_ingest": zip_ingest,
}
