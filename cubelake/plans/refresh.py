"""Refresh jobs: plan which cubes to rebuild, rebuild them, record them.

Downloads are not part of this package: cubes are expected as ``.zip`` or
``.csv`` files in a landing folder (one per product id).
"""

from __future__ import annotations

import datetime as dt
import threading
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cubelake.operators.freshness import latest_release, refresh_plan
from cubelake.plans.cube_etl import STATUS_SCHEMA, prepare_cubes
from cubelake.session import scratch_dir
from cubelake.sources.archives import unzip_to_landing
from cubelake.sources.cube_csv import CSV_GLOB
from cubelake.sources.catalog import read_catalog, read_changed
from cubelake.sources.registry import append_registry, read_registry


def plan_refresh(
    spark: SparkSession,
    catalog_path: str,
    registry_path: str,
    start_from: int = 0,
    max_products: int = 0,
    skip: Iterable[int] = (),
    multi_line: bool = False,
) -> DataFrame:
    """Cubes missing from, or newer than, the registry (the diff-based refresh)."""
    return refresh_plan(
        read_catalog(spark, catalog_path, multi_line=multi_line),
        read_registry(spark, registry_path),
        start_from=start_from,
        max_products=max_products,
        skip=skip,
    )


def plan_changed(
    spark: SparkSession,
    changed_root: str,
    start: str | dt.date | None = None,
    end: str | dt.date | None = None,
    skip: Iterable[int] = (),
) -> DataFrame:
    """Cubes changed between two days (inclusive), latest release each."""
    plan = latest_release(read_changed(spark, changed_root, start, end))
    skip = [int(s) for s in skip]
    return plan.where(~F.col("product_id").isin(skip)) if skip else plan


def refresh(
    spark: SparkSession,
    plan: DataFrame,
    landing: str,
    lake: str,
    registry_path: str,
    work: str | None = None,
    **prepare_options,
) -> DataFrame:
    """Rebuild the planned cubes from the landing folder and register them.

    A cube fails alone (missing file, bad zip, malformed CSV); the others are
    published and appended to the registry in one batch. Returns one status
    row per planned cube with its release time.

    The plan stays a table (written once, as it is read several times): only
    what has landed reaches the driver, however many cubes are planned.
    """
    work = work or scratch_dir(spark, "refresh")
    planned_at = f"{work}/plan"
    # A cube that is planned twice is built once, for its latest release.
    latest = plan.groupBy(F.col("product_id").cast("bigint").alias("product_id"))
    latest.agg(F.max("release_time").alias("release_time")).write.mode("overwrite").parquet(planned_at)
    planned = spark.read.schema("product_id bigint, release_time timestamp").parquet(planned_at)
    if planned.isEmpty():
        return spark.createDataFrame([], STATUS_SCHEMA + ", release_time timestamp")

    # Register each group of cubes as soon as it is published, so an aborted
    # run keeps what it finished (appends to one table never overlap).
    lock = threading.Lock()
    registered: set[int] = set()

    def on_published(pids: list[int]) -> None:
        with lock:
            fresh = sorted(set(pids) - registered)
            if not fresh:
                return
            append_registry(spark, registry_path, planned.join(_ids(spark, fresh), "product_id", "left_semi"))
            registered.update(fresh)

    prepare_options = {**prepare_options, "on_published": on_published}

    unzipped = f"{work}/unzipped"
    zip_status = unzip_to_landing(spark, landing, unzipped, rule="digits", only=planned).collect()
    failed_zip: dict[int, str] = {}
    landed: set[int] = set()
    for z in zip_status:
        digits = "".join(ch for ch in z["archive"].rsplit("/", 1)[-1] if ch.isdigit())
        if digits and z["ok"]:
            landed.add(int(digits))
        elif digits:
            failed_zip[int(digits)] = z["reason"]
    landed -= failed_zip.keys()  # two archives of one cube, one of them damaged: the cube fails

    status = None
    if landed:
        zopts = {k: v for k, v in prepare_options.items() if k != "glob"}
        status = prepare_cubes(spark, unzipped, lake, only=landed, work=f"{work}/etl", **zopts)
    glob = prepare_options.get("glob", CSV_GLOB)
    plain = None
    if _has_files(spark, landing, glob):
        # a cube whose archive is damaged is not made from something else
        rest = planned.join(_ids(spark, _ok_ids(status) | failed_zip.keys()), "product_id", "left_anti")
        plain = prepare_cubes(spark, landing, lake, only=rest, work=f"{work}/etl-csv", **prepare_options)

    rows = {pid: (pid, False, reason, *[None] * 5) for pid, reason in failed_zip.items()}
    for df in (status, plain):
        if df is None:
            continue
        for r in df.collect():
            if r["product_id"] is not None and (r["product_id"] not in rows or r["ok"]):
                rows[r["product_id"]] = tuple(r)
    built = spark.createDataFrame(list(rows.values()), STATUS_SCHEMA)
    names = [n for n in built.columns if n not in ("product_id", "ok", "reason")]
    return (
        planned.join(built.withColumn("_landed", F.lit(True)), "product_id", "left")
        .select(
            "product_id",
            F.coalesce("ok", F.lit(False)).alias("ok"),
            F.when(F.col("_landed"), F.col("reason")).otherwise(F.lit("not landed")).alias("reason"),
            *names,
            "release_time",
        )
        .orderBy("product_id")
    )


def _ids(spark: SparkSession, ids: Iterable[int]) -> DataFrame:
    return F.broadcast(spark.createDataFrame([(int(i),) for i in ids], "product_id bigint"))


def _ok_ids(status: DataFrame | None) -> set[int]:
    if status is None:
        return set()
    return {int(r["product_id"]) for r in status.where("ok").select("product_id").collect()}


def _has_files(spark: SparkSession, landing: str, glob: str) -> bool:
    from cubelake.sources.cube_csv import list_files

    return bool(list_files(spark, landing, glob).take(1))
