"""Which cubes need a refresh, and in what order.

``freshness_diff`` keeps catalog rows that are not in the registry or whose
release time is newer than the registry's (equal is fresh). ``refresh_plan``
adds the start-from filter, the order, the optional limit and the skip list,
in that order: skipped ids still use up limit slots.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubelake.sources.registry import latest_registry


def freshness_diff(catalog: DataFrame, registry: DataFrame, registry_is_latest: bool = False) -> DataFrame:
    """Catalog rows that are missing from, or newer than, the registry.

    One left join against one row per registered product (the registry is
    reduced first, with partial aggregation). The catalog is not deduplicated.
    """
    latest = registry if registry_is_latest else latest_registry(registry)
    reg = latest.select(F.col("number").alias("_number"), F.col("release_time").alias("_registered"))
    joined = catalog.join(reg, catalog["product_id"] == reg["_number"], "left")
    stale = F.col("_number").isNull() | (F.col("release_time") > F.col("_registered"))
    return joined.where(stale).select(*catalog.columns)


def refresh_plan(
    catalog: DataFrame,
    registry: DataFrame,
    start_from: int = 0,
    max_products: int = 0,
    skip: Iterable[int] = (),
    registry_is_latest: bool = False,
) -> DataFrame:
    """Cubes to refresh: diff, ``product_id >= start_from``, sorted, limited, skipped.

    The limit is the feature (``max_products > 0`` caps one run); it plans as
    a single top-k over the filtered diff.
    """
    diff = freshness_diff(catalog.where(F.col("product_id") >= F.lit(int(start_from))), registry, registry_is_latest)
    plan = diff.orderBy("product_id", "release_time")
    if max_products and max_products > 0:
        plan = plan.limit(int(max_products))
    skip = [int(s) for s in skip]
    if skip:
        plan = plan.where(~F.col("product_id").isin(skip))
    return plan


def latest_release(changed: DataFrame) -> DataFrame:
    """Deduplicated changes reduced to the latest release per product, sorted."""
    pairs = changed.select("product_id", "release_time").distinct()
    return (
        pairs.groupBy("product_id")
        .agg(F.max("release_time").alias("release_time"))
        .orderBy("product_id", "release_time")
    )
