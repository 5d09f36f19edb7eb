"""Full-cube CSV sources.

A landed cube is a CSV file, or a folder of CSV parts that each start with
the same header. The product id is the digits of the first path component
under the landing root (``14100287.csv``, ``14100287-eng/part-0.csv``).

Headers are read by a distributed job that opens each file and reads only
its first line; only ``(path, names)`` reach the driver. Data is then read
by Spark's CSV scan with every column as text, names applied by position.
"""

from __future__ import annotations

import csv
import io
import re
import sys
from urllib.parse import quote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cubelake import fs
from cubelake.functions.columns import digits_only

CORRUPT = "_corrupt_record"
#: CSV files, whatever the case of their ending.
CSV_GLOB = "*.[cC][sS][vV]"


def list_files(spark: SparkSession, root: str | list[str], glob: str = CSV_GLOB) -> DataFrame:
    """Every file matching ``glob`` under ``root`` (recursive); no content read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .load(root)
        .select("path", "length", "modificationTime")
    )


def cube_key(path: Column | str, root: str) -> Column:
    """Product id from a file path: digits of the first component under ``root``."""
    p = F.col(path) if isinstance(path, str) else path
    first = F.regexp_extract(p, "^" + re.escape(root.rstrip("/")) + r"/([^/]+)", 1)
    d = digits_only(first)
    return F.when(F.length(d) > 0, d.cast("bigint"))


def plain_path(encoded: Column) -> Column:
    """A file path as listed (``binaryFile.path``) from the URL-encoded form of ``_metadata.file_path``."""
    return F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))


def strip_junk_prefix(line: str) -> str:
    """Drop the non-ASCII characters that sometimes precede the header."""
    return re.sub(r"^[^\x00-\x7f]+", "", line)


def unique_names(names: list[str]) -> list[str]:
    """Column names made distinct; a repeat of ``X`` becomes ``X.1``, ``X.2``, ... skipping names in use."""
    used: dict[str, int] = {}  # name -> last number tried for its repeats

    def claim(name: str) -> str:
        if name in used:
            base, number = name, used[name]
            while name in used:
                number += 1
                name = f"{base}.{number}"
            used[base] = number
        used[name] = 0
        return name

    return [claim(name) for name in names]


def parse_header(first_line: str) -> list[str]:
    csv.field_size_limit(sys.maxsize)  # a field may be as long as the line
    row = next(csv.reader(io.StringIO(strip_junk_prefix(first_line))), [])
    return unique_names(row)


def _filesystem(path: str):
    """pyarrow file system + inner path for a Hadoop path (not URL-encoded)."""
    import pyarrow.fs as pafs

    uri = quote(path, safe="/:@=,+~!$&'()*;")
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    if "://" not in uri:
        uri = "file://" + uri
    if uri.startswith("s3a://"):
        uri = "s3://" + uri[len("s3a://"):]
    return pafs.FileSystem.from_uri(uri)


def _open_input(path: str):
    filesystem, inner = _filesystem(path)
    return filesystem.open_input_stream(inner)


def _open_random_access(path: str):
    """Seekable input (what zip archives need), read in place, never copied."""
    filesystem, inner = _filesystem(path)
    return filesystem.open_input_file(inner)


def _first_line(path: str) -> str:
    buf = bytearray()
    with _open_input(path) as stream:
        while chunk := stream.read(64 * 1024):
            buf.extend(chunk)
            if b"\n" in chunk:
                break
    line = bytes(buf).split(b"\n", 1)[0].rstrip(b"\r")
    return line.decode("utf-8", errors="replace")


def _headers_udf(batches):
    for pdf in batches:
        names, errors = [], []
        for path in pdf["path"]:
            try:
                parsed = parse_header(_first_line(path))
                names.append(parsed if parsed else None)
                errors.append(None if parsed else "empty file")
            except Exception as exc:  # unreadable file -> that cube fails
                names.append(None)
                errors.append(f"unreadable: {type(exc).__name__}")
        yield pd.DataFrame({"path": pdf["path"], "names": names, "error": errors})


HEADER_SCHEMA = "path string, names array<string>, error string"


def read_headers(files: DataFrame) -> DataFrame:
    """``(path, names, error)`` for each file, reading only its first line."""
    from cubelake.session import ship_package

    ship_package(files.sparkSession)
    return files.select("path").mapInPandas(_headers_udf, HEADER_SCHEMA)


def read_headers_spark(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Header lines through Spark's own text reader (any Hadoop file system).

    The first line of a file is the first row of the split that starts at
    offset 0; rows of one split keep their order, so the row with the
    smallest ``monotonically_increasing_id`` is the header. This reads the
    whole first split of each file, so it is the fallback for file systems
    the Python reader cannot open.
    """
    lines = spark.read.text(paths).select(
        "value",
        plain_path(F.col("_metadata.file_path")).alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("pos"),
    )
    return lines.where(F.col("start") == 0).groupBy("path").agg(F.min_by("value", "pos").alias("line"))


def headers_from_lines(rows) -> dict[str, tuple[list[str] | None, str | None]]:
    """Per path its names, or why it has none; one bad line is that file's failure only."""
    out: dict[str, tuple[list[str] | None, str | None]] = {}
    for r in rows:
        try:
            names = parse_header(r["line"] or "")
            out[r["path"]] = (names or None, None if names else "empty file")
        except Exception as exc:
            out[r["path"]] = (None, f"unreadable: {type(exc).__name__}")
    return out


def text_schema(names: list[str]) -> T.StructType:
    fields = [T.StructField(n, T.StringType(), True) for n in names]
    return T.StructType(fields + [T.StructField(CORRUPT, T.StringType(), True)])


def read_cube_text(spark: SparkSession, paths: list[str], names: list[str]) -> DataFrame:
    """All-text scan of cube files sharing one header.

    The first line of every file is skipped; rows with the wrong number of
    fields keep their raw text in ``_corrupt_record``. ``_path`` is the file.
    """
    return (
        spark.read.schema(text_schema(names))
        .option("header", True)
        .option("enforceSchema", True)
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("maxColumns", max(20480, len(names) + 1))
        .option("maxCharsPerColumn", -1)
        .csv(paths)
        .withColumn("_path", plain_path(F.col("_metadata.file_path")))
    )


def qualified_root(spark: SparkSession, root: str) -> str:
    return fs.qualify(spark, root).rstrip("/")
