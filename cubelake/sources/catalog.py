"""Catalog and changed-cube list sources.

A catalog file is one JSON array of product records (the web service's
response, landed as a file). Changed-cube lists are the same records, one
landing folder per day: ``<root>/change_date=YYYY-MM-DD/*.json``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cubelake import schemas as S
from cubelake.functions.columns import parse_release_time

# productId may be a JSON number or text; read it as text and cast.
_RAW_SCHEMA = T.StructType(
    [
        T.StructField("productId", T.StringType()),
        T.StructField("releaseTime", T.StringType()),
    ]
)


def _read_records(
    spark: SparkSession, path: str | list[str], schema: T.StructType = _RAW_SCHEMA, multi_line: bool = False
) -> DataFrame:
    """Records from JSON text.

    Line mode (default) reads one JSON value per line; a line that is an
    array yields one row per element, so compact service responses and JSON
    lines both work and large files stay splittable. ``multi_line`` reads
    each file as one (pretty-printed) document.
    """
    return spark.read.schema(schema).option("multiLine", multi_line).option("mode", "FAILFAST").json(path)


def catalog_projection(records: DataFrame) -> DataFrame:
    """JSON record -> (product_id, release_time); order kept, no dedup."""
    return records.select(
        F.col("productId").cast("bigint").alias("product_id"),
        parse_release_time("releaseTime").alias("release_time"),
    )


def read_catalog(spark: SparkSession, path: str | list[str], multi_line: bool = False) -> DataFrame:
    """All products with their latest release time (JSON arrays or JSON lines)."""
    return catalog_projection(_read_records(spark, path, multi_line=multi_line))


def _date_lit(d: str | dt.date | dt.datetime | None) -> Column:
    if d is None:
        return F.current_date()
    if isinstance(d, (dt.date, dt.datetime)):
        d = d.strftime("%Y-%m-%d")
    return F.to_date(F.lit(d), S.CHANGE_DATE_FORMAT)


def read_changed(
    spark: SparkSession,
    root: str,
    start: str | dt.date | None = None,
    end: str | dt.date | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Products changed on each day in ``[start, end]`` (both inclusive).

    A missing end point means today; ``start > end`` gives no rows. The day
    comes from the folder name, so the range prunes whole folders before any
    file is opened.
    """
    schema = T.StructType(_RAW_SCHEMA.fields + [T.StructField("change_date", T.DateType())])
    records = (
        spark.read.schema(schema)
        .option("multiLine", multi_line)
        .option("mode", "FAILFAST")
        .option("basePath", root)
        .json(root)
    )
    in_range = F.col("change_date").between(_date_lit(start), _date_lit(end))
    return records.where(in_range).select(
        "change_date",
        F.col("productId").cast("bigint").alias("product_id"),
        parse_release_time("releaseTime").alias("release_time"),
    )


def read_changed_on(spark: SparkSession, root: str, day: str | dt.date) -> DataFrame:
    """Products changed on one day (a date, or its ``YYYY-MM-DD`` text)."""
    return read_changed(spark, root, day, day).drop("change_date")
