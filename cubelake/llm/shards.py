"""Contiguous shards of near-equal bytes.

Every document weighs its UTF-8 bytes plus a fixed overhead. Rows are put in
the order of doc_id (repeated ids in the order of the table), the bytes of
each range are totalled, prefix sums over these few totals give each range
its global offset, and the running sum inside the range gives each row its
own. A row belongs to the shard in whose equal share of all bytes its middle
byte lies, so shards are contiguous and each is off its target by less than
the two documents at its edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cubelake.llm.common import ROW_BITS, ordered


def shard_documents(docs: DataFrame, shards: int = 24, overhead: int = 8) -> DataFrame:
    """Per row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Null text has no bytes: size is ``overhead`` and the checksum 0. A null
    doc_id comes first. Repeated rows each get a slot. No row gives no row.
    A document larger than a shard's share leaves shards empty; they are the
    ones whose share it covers. Other columns of ``docs`` are not read.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + F.lit(overhead)).cast("long").alias("size"),
        F.crc32(text).cast("long").alias("text_crc32"),
        F.monotonically_increasing_id().alias("__row"),
    )
    rows = ordered(slim, ["doc_id", "__row"], "shards")

    # One row per range: what lies before it, and the grand total.
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = (
        rows.groupBy("__pid")
        .agg(F.sum("size").alias("__bytes"), F.count("*").alias("__rows"))
        .select(
            "__pid",
            F.coalesce(F.sum("__bytes").over(before), F.lit(0)).alias("__bytes_before"),
            F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__rows_before"),
            F.sum("__bytes").over(everything).alias("__total"),
        )
    )
    running = Window.partitionBy("__pid").orderBy("__pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (
        rows.withColumn("__through", F.sum("size").over(running))
        .join(F.broadcast(totals), "__pid")
        .withColumn("__index", F.col("__rows_before") + F.expr(f"__pos & {(1 << ROW_BITS) - 1}"))
        .withColumn(
            "shard",
            F.expr(
                f"cast(least({shards - 1}, {shards} * (2 * (__bytes_before + __through) - size) div (2 * __total)) as int)"
            ),
        )
    )
    firsts = placed.groupBy("shard").agg(F.min("__index").alias("__first"))  # one row per shard
    return placed.join(F.broadcast(firsts), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("__index") - F.col("__first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
