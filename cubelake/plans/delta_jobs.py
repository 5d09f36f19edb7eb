"""Delta file jobs: split a daily delta by product, merge a delta into a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cubelake.operators.merge import latest_per_key, merge_values
from cubelake.plans import folders
from cubelake.plans.layout import split_by_key, write_copy
from cubelake.session import folder_parallel_writes, scratch_dir
from cubelake.sources.archives import unzip_to_landing
from cubelake.sources.delta_csv import read_delta
from cubelake.sources.lake import folder_schema, read_folders, read_path


def split_delta(spark: SparkSession, source: str, target: str, fmt: str = "parquet", work: str | None = None) -> None:
    """Daily delta (``.csv`` or ``.zip``) -> dataset in ``productId=`` folders.

    The target must not exist (an existing empty folder is accepted).
    """
    if source.lower().endswith(".zip"):
        landing = f"{work or scratch_dir(spark, 'split')}/landing"
        status = unzip_to_landing(spark, source, landing, rule="stem").collect()
        bad = [s for s in status if not s["ok"]]
        if bad or not status:
            raise ValueError(f"cannot unpack {source}: {bad[0]['reason'] if bad else 'no archive'}")
        source = status[0]["landed"]
    split_by_key(spark, read_delta(spark, source), target, "productId", fmt)


def merge_delta(
    spark: SparkSession,
    original_path: str,
    delta_path: str,
    new_path: str,
    keys: Sequence[str] = ("vectorId",),
    insert_new: bool = False,
) -> None:
    """Merge a delta table into a stored table and write the result to ``new_path``."""
    merged = merge_delta_frames(read_path(spark, original_path), read_path(spark, delta_path), keys, insert_new)
    write_copy(merged, new_path)


def merge_delta_frames(
    original: DataFrame, delta: DataFrame, keys: Sequence[str] = ("vectorId",), insert_new: bool = False
) -> DataFrame:
    return merge_values(original, delta, keys=keys, value="value", insert_new=insert_new)


def product_keys(keys: Sequence[str], product: str = "productId") -> list[str]:
    """The key of a store row: a product's folder is merged with that product's delta rows only."""
    return [product, *(k for k in keys if k != product)]


def merge_into_store(
    spark: SparkSession,
    store: str,
    delta: DataFrame,
    keys: Sequence[str] = ("vectorId",),
    insert_new: bool = False,
    product: str = "productId",
    work: str | None = None,
) -> None:
    """Merge a delta into a ``productId=``-partitioned store, in place.

    The product is part of the key: a series stored under one product is not
    touched by a delta row that names another. Only the products that occur
    in the delta are read (the files of others are not opened); every other
    product folder is left untouched:

    1. the delta's winners per key are written once, as both the choice of
       products and the merge read them;
    2. the merged rows of the touched products are written to a flat staging
       table (this also cuts the lineage to the store being replaced);
    3. of the staged products, those of which a row has changed or come are
       written into the store, which replaces exactly their folders. The others
       would get the rows they have.

    If the job dies in step 3, ``apply_staged(spark, staging, store)`` redoes
    it from the staged copy.
    """
    work = work or scratch_dir(spark, "merge-store")
    keyed = product_keys(keys, product)
    stored = _store_schema(spark, store, product, delta)
    shared = [c for c in stored.names if c in delta.columns and c not in keyed] if insert_new else []
    latest_per_key(delta, keyed, "value", carry=shared).write.mode("overwrite").parquet(f"{work}/delta")
    merge_winners(spark, store, spark.read.parquet(f"{work}/delta"), keys, insert_new, product, work)


def _store_schema(spark: SparkSession, store: str, product: str, delta: DataFrame) -> T.StructType:
    if isinstance(delta.schema[product].dataType, T.IntegralType):
        return folder_schema(spark, store, product)
    return spark.read.parquet(store).schema


def merge_winners(
    spark: SparkSession,
    store: str,
    winners: DataFrame,
    keys: Sequence[str] = ("vectorId",),
    insert_new: bool = False,
    product: str = "productId",
    work: str | None = None,
) -> None:
    """``merge_into_store`` of a delta that is stored and has one row per key (steps 2 and 3)."""
    work = work or scratch_dir(spark, "merge-store")
    schema = _store_schema(spark, store, product, winners)
    # Rows of a null product match none of the delta, so leaving them alone is right.
    if isinstance(winners.schema[product].dataType, T.IntegralType):
        stored = read_folders(spark, store, product, schema=schema, touched=winners, whole=True)
    else:  # the filter lets the planner take the product list as one worth pruning with
        touched = winners.select(F.col(product).cast(schema[product].dataType)).distinct()
        stored = spark.read.parquet(store).join(touched.where(F.col(product).isNotNull()), product, "left_semi")
    stored = stored.withColumn(_BEFORE, F.struct(F.col("value").alias("value")))
    merged = merge_values(stored, winners, product_keys(keys, product), "value", insert_new)
    staging = f"{work}/staged"
    merged.write.mode("overwrite").parquet(staging)  # flat: a few files, not a folder per product
    apply_staged(spark, staging, store, product)


#: In the staged rows: the value as it was stored (null for rows that come).
_BEFORE = "__before"


def apply_staged(spark: SparkSession, staging: str, store: str, product: str = "productId") -> None:
    """Replace the store's product folders with the staged ones that differ (others untouched)."""
    staged = spark.read.parquet(staging)
    if _BEFORE in staged.columns:
        before = F.col(f"{_BEFORE}.value")
        # as text too, since -0.0 and 0.0 are equal
        same = before.eqNullSafe(F.col("value")) & before.cast("string").eqNullSafe(F.col("value").cast("string"))
        changed = staged.where(F.col(_BEFORE).isNull() | ~same).select(product).distinct()
        staged = staged.drop(_BEFORE).join(changed, product, "left_semi").select(*[c for c in staged.columns if c != _BEFORE])
    replace_folders(staged, store, product)


def replace_folders(rows: DataFrame, store: str, product: str = "productId") -> None:
    """Replace the folders of the products in ``rows`` (others untouched)."""
    if folders.can_write(rows, store, product, "parquet"):
        folders.write_folders(rows, store, product, replace=True)
        return
    with folder_parallel_writes(rows.sparkSession):
        (
            rows.hint("rebalance", product)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(product)
            .parquet(store)
        )
