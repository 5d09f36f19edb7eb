"""Every CSV under a folder -> parquet next to it, with VALUE scaled.

Each file is its own table: ``x.csv`` becomes ``x.parquet`` (a folder of
parquet files) holding the file's columns with plain type inference, VALUE
multiplied by ``10 ** SCALAR_ID`` and DECIMALS, UOM_ID, SCALAR_FACTOR dropped
(they must exist). All files are handled by a few jobs: one header job, per
header one inference aggregate (one row per file) and one write per
(header, types) group, keyed by a hash of the file path; the per-file
folders are then moved next to their sources.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from cubelake.functions.typing import cast_text
from cubelake.operators.inference import decide_types, inference_aggregates
from cubelake.operators.scaling import scale_cube_value
from cubelake.plans.layout import publish_all
from cubelake.session import scratch_dir
from cubelake.sources.cube_csv import (
    CSV_GLOB,
    headers_from_lines,
    list_files,
    read_cube_text,
    read_headers,
    read_headers_spark,
)

FILE_KEY = "_file"


def _file_key(path: str) -> str:
    return hashlib.sha256(path.encode("utf-8")).hexdigest()


def sibling_parquet(path: str) -> str:
    return (path[: -len(".csv")] if path.lower().endswith(".csv") else path) + ".parquet"


def transform_csv_folder(spark: SparkSession, folder: str, glob: str = CSV_GLOB, work: str | None = None) -> DataFrame:
    """Write ``<name>.parquet`` next to every ``<name>.csv`` under ``folder``.

    Returns one status row per file: ``(path, ok, reason, rows, output)``.
    A file fails alone (malformed rows, missing scaling columns).
    """
    work = work or scratch_dir(spark, "csv-folder")
    headers = read_headers(list_files(spark, folder, glob).select("path")).collect()
    unreadable = [h.path for h in headers if h.error and h.error.startswith("unreadable")]
    if unreadable:  # by Python; Spark's own reader knows more file systems
        fixed = headers_from_lines(read_headers_spark(spark, unreadable).collect())
        headers = [h if h.path not in fixed else Row(h.path, *fixed[h.path]) for h in headers]
        headers = [Row(path=h[0], names=h[1], error=h[2]) for h in headers]
    status: dict[str, tuple] = {}
    by_header: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for h in headers:
        if h.error or not h.names:
            status[h.path] = (h.path, False, h.error or "no header", None, None)
        else:
            by_header[tuple(h.names)].append(h.path)

    for gi, (names_t, paths) in enumerate(sorted(by_header.items())):
        names = list(names_t)
        keyed = lambda df: df.withColumn(FILE_KEY, F.sha2(F.col("_path"), 256))
        text = keyed(read_cube_text(spark, paths, names))
        decided = [
            decide_types(r, names, key=FILE_KEY, overrides=False)
            for r in inference_aggregates(text, names, key=FILE_KEY, overrides=False).collect()
        ]
        key_to_path = {_file_key(p): p for p in paths}
        seen = {key_to_path[d.product_id] for d in decided}
        for p in paths:
            if p not in seen:  # header only: an empty table with the file's columns
                empty = spark.createDataFrame([], ", ".join(f"`{n}` string" for n in names))
                try:
                    scale_cube_value(empty).write.mode("overwrite").parquet(sibling_parquet(p))
                    status[p] = (p, True, None, 0, sibling_parquet(p))
                except KeyError as exc:
                    status[p] = (p, False, f"cannot scale: {exc}", 0, None)
        by_types: dict[tuple[str, ...], list[str]] = defaultdict(list)
        for d in decided:
            path = key_to_path[d.product_id]
            if not d.ok:
                status[path] = (path, False, d.reason, d.rows, None)
            else:
                status[path] = (path, True, None, d.rows, sibling_parquet(path))
                by_types[d.types].append(path)
        for ti, (types, tpaths) in enumerate(sorted(by_types.items())):
            typed = keyed(read_cube_text(spark, tpaths, names)).select(
                FILE_KEY,
                *[
                    (F.lit(None).cast("string") if t == "null" else cast_text(F.col(f"`{n}`"), t)).alias(n)
                    for n, t in zip(names, types)
                ],
            )
            try:
                scaled = scale_cube_value(typed)
            except KeyError as exc:
                for p in tpaths:
                    status[p] = (p, False, f"cannot scale: {exc}", status[p][3], None)
                continue
            stage = f"{work}/g{gi}-t{ti}"
            scaled.write.mode("overwrite").partitionBy(FILE_KEY).parquet(stage)
            publish_all(spark, [(f"{stage}/{FILE_KEY}={_file_key(p)}", sibling_parquet(p)) for p in tpaths])

    rows = [status[p] for p in sorted(status)]
    return spark.createDataFrame(rows, "path string, ok boolean, reason string, rows bigint, output string")
