"""Writers: copies, keyed splits, year partitions, size-adaptive layout, publish."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from cubelake import fs
from cubelake import schemas as S
from cubelake.plans import folders
from cubelake.session import folder_parallel_writes


def write_copy(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write a table to one path (must differ from any path it reads)."""
    df.write.mode("overwrite").format(fmt).save(path)


def split_by_key(spark: SparkSession, df: DataFrame, path: str, key: str = "productId", fmt: str = "parquet") -> None:
    """Hive folders ``key=…``; the target must not exist or must be empty.

    ``rebalance`` hashes on the key so a product's rows meet in few files,
    while AQE splits a hot product over several tasks and merges tiny ones.
    """
    if not fs.is_missing_or_empty_dir(spark, path):
        raise FileExistsError(f"target exists and is not empty: {path}")
    if folders.can_write(df, path, key, fmt):
        _write_aside(spark, df, path, key, fmt)
        return
    mode = "overwrite" if fs.exists(spark, path) else "errorifexists"
    writer = df.hint("rebalance", key).write.partitionBy(key).mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"')
    with folder_parallel_writes(spark):
        writer.save(path)


def write_keyed(df: DataFrame, path: str, key: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Hive folders ``key=…`` with one or a few files each (``rebalance`` on the key)."""
    if mode == "overwrite" and folders.can_write(df, path, key, fmt):
        _write_aside(df.sparkSession, df, path, key, fmt)
        return
    with folder_parallel_writes(df.sparkSession):
        df.hint("rebalance", key).write.mode(mode).partitionBy(key).format(fmt).save(path)


def _write_aside(spark: SparkSession, df: DataFrame, path: str, key: str, fmt: str) -> None:
    """Folders written beside ``path`` and put there whole, by one rename."""
    import uuid

    parent, _, name = path.rstrip("/").rpartition("/")
    aside = f"{parent}/_writing-{name}-{uuid.uuid4().hex[:8]}" if parent else f"_writing-{name}-{uuid.uuid4().hex[:8]}"
    try:
        folders.write_folders(df, aside, key, fmt)
        fs.put_if_absent(spark, f"{aside}/_SUCCESS", "")
        publish(spark, aside, path)
    except BaseException:
        fs.delete(spark, aside)
        raise


def write_year_partitioned(df: DataFrame, path: str, rebalance: bool = True) -> None:
    """Hive ``year=`` folders; a null year goes to the default partition.

    ``rebalance`` hashes rows on the year first (AQE splits a hot year), so
    each folder gets one or a few well-sized files rather than one per input
    task; turn it off when the input is already clustered by year.
    """
    out = df.hint("rebalance", S.YEAR_COLUMN) if rebalance else df
    with folder_parallel_writes(df.sparkSession):
        out.write.mode("overwrite").partitionBy(S.YEAR_COLUMN).parquet(path)


def publish(spark: SparkSession, staged: str, destination: str) -> None:
    """Replace ``destination`` with the staged folder (exact folder, no prefix match).

    The old folder is first moved aside, the staged one moved in, and only
    then the old one deleted; if the move in fails the old folder is put
    back. Readers see no folder only between the two renames, and a crash at
    any point leaves either the old or the new data (plus, at worst, a
    hidden ``_replaced-*`` folder to clean up). A folder staged on another
    file system is first copied next to the destination.
    """
    import uuid

    if not fs.same_store(spark, staged, destination):
        staged = _incoming(spark, staged, destination)
    backup = None
    if fs.exists(spark, destination):
        parent, _, name = destination.rstrip("/").rpartition("/")
        # a leading "_" keeps a left-over backup out of Spark's file listings
        backup = f"{parent}/_replaced-{name}-{uuid.uuid4().hex[:8]}"
        if not fs.rename(spark, destination, backup):
            raise OSError(f"could not move {destination} aside")
    if not fs.rename(spark, staged, destination):
        if backup is not None:
            fs.rename(spark, backup, destination)
        raise OSError(f"could not move {staged} to {destination}")
    if backup is not None:
        fs.delete(spark, backup)


def publish_all(spark: SparkSession, moves: list[tuple[str, str]], threads: int = 16) -> None:
    """``publish`` for many (staged, destination) pairs side by side; each is a few metadata calls."""
    if not moves:
        return
    with ThreadPoolExecutor(max_workers=min(threads, len(moves))) as pool:
        for done in [pool.submit(publish, spark, *move) for move in moves]:
            done.result()


def copy_tree(spark: SparkSession, source: str, target: str) -> None:
    """Copy every file under ``source`` to the same place under ``target``, on any two file systems.

    One listing and one job: each task streams its files.
    """
    from cubelake.session import ship_package
    from cubelake.sources.archives import copy_files
    from cubelake.sources.cube_csv import list_files

    ship_package(spark)
    root = fs.qualify(spark, source).rstrip("/")
    fs.mkdirs(spark, target)
    files = list_files(spark, root, "*").select("path")
    files.mapInPandas(copy_files(root, fs.qualify(spark, target).rstrip("/")), "path string").count()


def push(spark: SparkSession, source: str, destination: str) -> None:
    """Publish a copy of ``source``; the source stays as it is."""
    publish(spark, _incoming(spark, source, destination), destination)


def _incoming(spark: SparkSession, source: str, destination: str) -> str:
    import uuid

    parent, _, name = destination.rstrip("/").rpartition("/")
    hidden = f"{parent}/_incoming-{name}-{uuid.uuid4().hex[:8]}"
    copy_tree(spark, source, hidden)
    return hidden
