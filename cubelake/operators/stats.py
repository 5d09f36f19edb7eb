"""Counts, sizes and multiset checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def status_counts(status: DataFrame) -> DataFrame:
    """``(succeeded, planned)`` of a refresh status table."""
    return status.agg(
        F.count_if(F.col("ok")).alias("succeeded"),
        F.count(F.lit(1)).alias("planned"),
    )


def dataset_sizes(spark: SparkSession, root: str, key: str | None = None, glob: str = "*") -> DataFrame:
    """Bytes under ``root`` (total, or per ``key=value`` path segment).

    A file listing job: no file content is read.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .load(root)
        .select("path", "length")
    )
    if key is None:
        return files.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"), F.count(F.lit(1)).alias("files"))
    k = F.regexp_extract("path", f"/{key}=([^/]+)/", 1)
    return files.groupBy(k.alias(key)).agg(F.sum("length").alias("bytes"), F.count(F.lit(1)).alias("files"))


def distinct_keys(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def multiset_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` not matched one-for-one in ``right`` and vice versa.

    One aggregate over both sides, each row counting for its side, so
    duplicates and nulls compare exactly and there is one shuffle. The sides
    may derive from one frame.
    """
    cols = [F.col(f"`{c}`") for c in left.columns]
    one, none = F.lit(1), F.lit(0)
    both = left.select(*cols, one.alias("_l"), none.alias("_r")).unionByName(
        right.select(*cols, none.alias("_l"), one.alias("_r"))
    )
    counts = both.groupBy(*cols).agg(F.sum("_l").alias("n_left"), F.sum("_r").alias("n_right"))
    return counts.where(F.col("n_left") != F.col("n_right"))
