"""The registry of published cubes: an append-only parquet table.

One row per successful publish: ``number`` (product id), ``release_time``,
``is_uploaded``, ``created_at``, ``updated_at``. Rows are never updated; the
current state of a product is its latest row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cubelake import fs
from cubelake import schemas as S


def ensure_registry(spark: SparkSession, path: str) -> None:
    """Create an empty registry table if there is none yet."""
    if not fs.exists(spark, path):
        spark.createDataFrame([], S.REGISTRY_SCHEMA).write.mode("ignore").parquet(path)


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """Every registry row (no ``is_uploaded`` filter, duplicates kept)."""
    ensure_registry(spark, path)
    return spark.read.schema(S.REGISTRY_SCHEMA).parquet(path)


def latest_registry(registry: DataFrame) -> DataFrame:
    """One row per product: the latest ``created_at`` wins, then ``release_time``.

    Partial aggregation runs before the shuffle, so a product with a huge
    number of rows costs one row per map task.
    """
    best = F.max(F.struct("created_at", "release_time")).alias("best")
    return registry.groupBy("number").agg(best).select(
        "number",
        F.col("best.release_time").alias("release_time"),
        F.col("best.created_at").alias("created_at"),
    )


def registry_rows(published: DataFrame, created_at: Column | None = None) -> DataFrame:
    """Registry rows for published ``(product_id, release_time)`` pairs."""
    now = created_at if created_at is not None else F.current_timestamp()
    return published.select(
        F.col("product_id").cast("bigint").alias("number"),
        F.col("release_time").cast("timestamp").alias("release_time"),
        F.lit(True).alias("is_uploaded"),
        now.cast("timestamp").alias("created_at"),
        now.cast("timestamp").alias("updated_at"),
    )


def append_registry(spark: SparkSession, path: str, published: DataFrame, created_at: Column | None = None) -> None:
    """Append one batch of rows (one write per run, never an update)."""
    registry_rows(published, created_at).write.mode("append").parquet(path)
