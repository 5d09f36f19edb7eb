"""Merging a delta into a stored table (UPDATE ... FROM as a left join).

Parity semantics: rows are matched on ``keys`` (``vectorId`` by default);
a matched row takes the delta's value, even a null one; unmatched stored rows
stay as they are; unmatched delta rows are not added; no other column
changes and the stored row count is kept.

When the delta holds several rows for one key, the winner is the row with the
greatest ``(releaseTime, refPer, coordinate)``, then the greatest value. It is
picked with one ``max(struct)`` aggregate, which is partial before the
shuffle, so a hot key never gathers its rows in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINNER_ORDER = ("releaseTime", "refPer", "coordinate")


def latest_per_key(
    delta: DataFrame,
    keys: Sequence[str],
    value: str = "value",
    order: Sequence[str] = WINNER_ORDER,
    carry: Sequence[str] = (),
) -> DataFrame:
    """One delta row per key: the winner of ``order`` then ``value``."""
    order = [c for c in order if c in delta.columns and c not in keys]
    fields = list(order) + [value] + [c for c in carry if c not in order and c != value and c not in keys]
    best = F.max(F.struct(*[F.col(c) for c in fields])).alias("_best")
    return delta.groupBy(*keys).agg(best).select(
        *keys, *[F.col(f"_best.{c}").alias(c) for c in fields]
    )


def merge_values(
    original: DataFrame,
    delta: DataFrame,
    keys: Sequence[str] = ("vectorId",),
    value: str = "value",
    insert_new: bool = False,
    order: Sequence[str] = WINNER_ORDER,
) -> DataFrame:
    """Overwrite ``value`` in ``original`` from ``delta`` on ``keys``.

    ``insert_new`` also appends delta rows whose key is not stored (columns
    the delta lacks are null). Every join has the deduplicated delta on its
    build side: AQE broadcasts it when it is small at run time (the stored
    table is then read without a shuffle) and splits skewed stored keys of
    the sort-merge join otherwise. Finding the unmatched delta keys reads
    only the stored key columns.
    """
    keys = list(keys)
    carry = [c for c in original.columns if c in delta.columns and c not in keys] if insert_new else []
    winners = latest_per_key(delta, keys, value, order, carry).withColumn("_matched", F.lit(True))
    upd = winners.select(*keys, F.col(value).alias("_new_value"), "_matched")
    joined = original.join(upd, keys, "left")
    merged_value = F.when(F.col("_matched"), F.col("_new_value")).otherwise(F.col(value))
    result = joined.select(
        *[
            (merged_value.cast(original.schema[c].dataType) if c == value else F.col(c)).alias(c)
            for c in original.columns
        ]
    )
    if not insert_new:
        return result
    # Keys of the delta that exist in the stored table: a semi join with the
    # (small) winners as the build side, over the stored key columns only.
    matched = original.select(*keys).join(winners.select(*keys), keys, "left_semi").distinct()
    has_key = F.lit(True)
    for k in keys:
        has_key = has_key & F.col(k).isNotNull()
    new_rows = winners.where(has_key).join(matched, keys, "left_anti")  # a null key is never inserted
    new_rows = new_rows.select(
        *[
            (F.col(c) if c in new_rows.columns else F.lit(None)).cast(original.schema[c].dataType).alias(c)
            for c in original.columns
        ]
    )
    return result.unionByName(new_rows)
