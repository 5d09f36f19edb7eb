"""Zip landing: one distributed job unpacks archives into a landing folder.

Each task opens its archives and streams the wanted member into the landing
folder (no whole-file rows, no driver copy) under a hidden name; only a member
read to its end, with a right checksum, gets its own name. The file listing is a
``binaryFile`` scan without content, which packs small archives together and
gives large ones their own task.
"""

from __future__ import annotations

import re
import shutil
import uuid
import zipfile
import zlib

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cubelake.sources.cube_csv import _filesystem, _open_random_access


def member_for(zip_name: str, rule: str) -> str:
    """Name of the CSV inside an archive.

    ``digits``: all digits of the archive name + ``.csv`` (full cubes,
    ``14100287-eng.zip`` -> ``14100287.csv``). ``stem``: the archive name with
    ``.csv`` instead of ``.zip`` (delta files, ``20230803.zip``).
    """
    if rule == "digits":
        return "".join(ch for ch in zip_name if ch.isdigit()) + ".csv"
    if rule == "stem":
        return re.sub(r"\.zip$", "", zip_name, flags=re.IGNORECASE) + ".csv"
    raise ValueError(rule)


def open_output(path: str):
    """Stream to a new file; its folder is made if need be."""
    filesystem, inner = _filesystem(path)
    filesystem.create_dir(inner.rpartition("/")[0], recursive=True)
    return filesystem.open_output_stream(inner)


def _land(source, target: str) -> None:
    """Copy a stream to ``target``, which appears only when the stream has ended well."""
    filesystem, inner = _filesystem(target)
    parent, _, name = inner.rpartition("/")
    filesystem.create_dir(parent, recursive=True)
    # Spark's listings pass over names that start with a dot.
    hidden = f"{parent}/.{name}.{uuid.uuid4().hex}.part"
    try:
        with filesystem.open_output_stream(hidden) as out:
            shutil.copyfileobj(source, out, 1 << 20)
        filesystem.move(hidden, inner)
    except BaseException:
        if filesystem.get_file_info(hidden).is_file:
            filesystem.delete_file(hidden)
        raise


def _is_there(path: str) -> bool:
    filesystem, inner = _filesystem(path)
    return filesystem.get_file_info(inner).is_file


def _unzip_udf(landing: str | None, rule: str, skip_landed: bool = False):
    def run(batches):
        import pyarrow as pa

        for pdf in batches:
            rows = []
            for path in pdf["path"]:
                name = path.rsplit("/", 1)[-1]
                member = member_for(name, rule)
                folder = path.rpartition("/")[0] if landing is None else landing.rstrip("/")
                target = f"{folder}/{member}"
                try:
                    if skip_landed and _is_there(target):
                        rows.append((path, member, target, True, None))
                        continue
                    # the archive is read in place through a seekable handle and
                    # the member streamed out in 1 MiB pieces
                    with _open_random_access(path) as raw, zipfile.ZipFile(raw) as archive:
                        with archive.open(member) as src:
                            _land(src, target)
                    rows.append((path, member, target, True, None))
                except (zipfile.BadZipFile, pa.ArrowInvalid, zlib.error, EOFError, NotImplementedError, RuntimeError):
                    # wrong checksum, damaged or encrypted member, too short or
                    # no central directory (pyarrow refuses the seek zipfile
                    # uses to find the end record)
                    rows.append((path, member, None, False, "bad zip"))
                except KeyError:
                    rows.append((path, member, None, False, "member missing"))
            yield pd.DataFrame(rows, columns=["archive", "member", "landed", "ok", "reason"])

    return run


def copy_files(root: str, target: str):
    """For ``mapInPandas`` over file paths: each file under ``root`` to its place under ``target``."""

    def run(batches):
        for pdf in batches:
            for path in pdf["path"]:
                with _open_random_access(path) as source:
                    _land(source, target + path[len(root):])
            yield pdf

    return run


UNZIP_SCHEMA = "archive string, member string, landed string, ok boolean, reason string"


def unzip_to_landing(
    spark: SparkSession,
    source: str | list[str],
    landing: str | None,
    rule: str = "digits",
    only: list[int] | DataFrame | None = None,
    skip_landed: bool = False,
) -> DataFrame:
    """Unpack every ``*.zip`` under ``source`` into ``landing`` (None: each beside itself).

    ``only`` keeps archives whose name's digits are one of these product ids
    (a list, or a table with a ``product_id``, which stays on the executors);
    ``skip_landed`` leaves archives alone whose member is there already.
    Returns one status row per archive (lazy; collect it to run the job).
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.[zZ][iI][pP]")
        .option("recursiveFileLookup", True)
        .load(source)
        .select("path")
    )
    if only is not None:
        from cubelake.functions.columns import file_name, only_products, product_id_from_name

        named = files.withColumn("product_id", product_id_from_name(file_name("path")))
        files = only_products(named, only).select("path")
    from cubelake.session import ship_package

    ship_package(files.sparkSession)
    return files.mapInPandas(_unzip_udf(landing, rule, skip_landed), UNZIP_SCHEMA)


def read_envelopes(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Download envelopes ``{"status", "object"}``, one JSON object per line.

    Adds ``ok`` (status is ``SUCCESS``), ``file_name`` (base name of the
    object URL, the name the archive is landed under) and ``product_id``
    (the digits of that name).
    """
    from cubelake import schemas as S
    from cubelake.functions.columns import product_id_from_name, url_basename

    env = spark.read.schema(S.ENVELOPE_SCHEMA).json(path)
    name = url_basename("object")
    return env.select(
        product_id_from_name(name).alias("product_id"),
        "status",
        "object",
        (F.col("status") == F.lit("SUCCESS")).alias("ok"),
        name.alias("file_name"),
    )
