"""Publishing cubes by a commit log: data and registry change in one step.

Each release of a cube is written once, to a folder of its own under
``<lake>/versions/``, and never touched again. An entry of the lake's log
(``sources.commit_log``) names the folder, the release time and the rows of
every cube that a publish brings. The newest entry of a cube is both its
current data and its registry row, so neither can be seen without the other,
and no rename is needed, which object stores do not have.

Newest means the latest release; of two publishes of one release, the later
entry. A slow publish of an old release can therefore end after a newer one
without hiding it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cubelake import fs
from cubelake.plans.layout import copy_tree, write_keyed
from cubelake.sources.commit_log import commit, last_entry, read_entries
from cubelake.sources.cube_csv import list_files, plain_path
from cubelake.sources.lake import normalise_year

VERSION = "product_id long, folder string, release_time timestamp, rows long, created_at timestamp"


def log_path(lake: str) -> str:
    return f"{lake.rstrip('/')}/commits"


def _root(lake: str) -> str:
    return f"{lake.rstrip('/')}/versions"


def _folder_of(path: Column) -> Column:
    """The version folder of a file, under ``versions``; files of large cubes lie in ``year=`` folders there."""
    return F.regexp_extract(plain_path(path), r"^.*/versions/(.+?)(?:/year=[^/]*)?/[^/]+$", 1)


def stage_copy(spark: SparkSession, source: str, lake: str, product_id: int) -> str:
    """A staged cube (on any file system) copied to a new version folder; returns the folder's name."""
    folder = f"{uuid.uuid4().hex}/product_id={int(product_id)}"
    copy_tree(spark, source, f"{_root(lake)}/{folder}")
    return folder


def write_release(spark: SparkSession, lake: str, rows: DataFrame) -> DataFrame:
    """The cubes in ``rows`` (by ``product_id``) written to new version folders by one job.

    Returns ``product_id``, ``folder`` and ``rows`` of each. They are no part
    of the lake before ``publish_versions`` names them.
    """
    release = uuid.uuid4().hex
    write_keyed(rows, f"{_root(lake)}/{release}", "product_id")
    found = spark.read.parquet(f"{_root(lake)}/{release}").groupBy(F.col("product_id").cast("long").alias("product_id"))
    folder = F.concat(F.lit(f"{release}/product_id="), F.col("product_id"))
    return found.agg(F.count("*").alias("rows")).select("product_id", folder.alias("folder"), "rows")


def publish_versions(spark: SparkSession, lake: str, versions: Iterable[dict]) -> int:
    """Make version folders current, all at once; returns the number of the entry.

    ``versions``: ``product_id``, ``folder``, ``release_time`` (UTC) and
    ``rows`` of each cube. The whole publish is one log
    entry: readers see all of its cubes or none.
    """
    now = spark.range(1).select(F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")).first()[0]
    rows = [
        {
            "product_id": int(v["product_id"]),
            "folder": v["folder"],
            "release_time": str(v["release_time"]),
            "rows": v["rows"],
            "created_at": now,
        }
        for v in versions
    ]
    return commit(spark, log_path(lake), rows, last_entry(spark, log_path(lake)))


def published(spark: SparkSession, lake: str) -> DataFrame:
    """All publishes of all cubes, with the entry that made each."""
    return read_entries(spark, log_path(lake), VERSION).filter("product_id IS NOT NULL")


def current_versions(spark: SparkSession, lake: str) -> DataFrame:
    """One row per cube: its current folder and its registry row."""
    best = F.max(F.struct("release_time", "entry", "folder", "rows", "created_at")).alias("best")
    return published(spark, lake).groupBy("product_id").agg(best).select("product_id", "best.*")


def version_registry(spark: SparkSession, lake: str) -> DataFrame:
    """The log in the form of the registry table: what ``freshness_diff`` and ``latest_registry`` take."""
    return published(spark, lake).select(
        F.col("product_id").alias("number"),
        "release_time",
        F.lit(True).alias("is_uploaded"),
        "created_at",
        F.col("created_at").alias("updated_at"),
    )


def read_version(spark: SparkSession, lake: str, product_id: int, entry: int | None = None) -> DataFrame:
    """The current data of a cube, or the data as of a log entry."""
    seen = published(spark, lake).filter(F.col("product_id") == product_id)
    if entry is not None:
        seen = seen.filter(F.col("entry") <= entry)
    best = seen.agg(F.max(F.struct("release_time", "entry", "folder")).alias("best")).first()["best"]
    if best is None:
        raise LookupError(f"cube {product_id} is not published")
    return normalise_year(spark.read.parquet(f"{_root(lake)}/{best['folder']}"))


def read_versions(spark: SparkSession, lake: str, schema: str) -> DataFrame:
    """All current cubes as one table with their ``product_id``: a single scan, whatever their number.

    ``schema`` is the wanted columns (DDL), of one type in all cubes: a cube
    without one of them has nulls there. Superseded folders are skipped by joining the files to the
    log, a broadcast of one row per cube where Spark measures it as small.
    """
    current = current_versions(spark, lake).select("product_id", "folder")
    rows = (
        spark.read.schema(schema)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .parquet(_root(lake))
        .withColumn("folder", _folder_of(F.col("_metadata.file_path")))
    )
    return rows.join(current, "folder").drop("folder")


def vacuum(spark: SparkSession, lake: str, keep_entries: int = 0) -> int:
    """Delete the version folders that no current version and no entry of the last ``keep_entries`` names.

    Run it when no publish is under way: the folder of one that has not
    committed yet looks like that of one that crashed. Returns the number deleted.
    """
    recent = published(spark, lake).filter(F.col("entry") > last_entry(spark, log_path(lake)) - keep_entries)
    used = current_versions(spark, lake).select("folder").union(recent.select("folder"))
    found = list_files(spark, _root(lake), "*.parquet").select(_folder_of(F.col("path")).alias("folder"))
    unused = found.filter("folder <> ''").distinct().join(used, "folder", "left_anti").collect()
    for row in unused:
        fs.delete(spark, f"{_root(lake)}/{row['folder']}")
    return len(unused)
