"""Full-cube ETL: landed CSVs -> typed parquet cubes in the lake.

One run handles any number of cubes, whatever their headers:

1. list the landed files and read each file's header line (one small job);
2. per header width, the CSV text is parsed once, into columnar staging with
   positional text columns;
3. one aggregate over that staging gives, per cube, the row count, the malformed
   rows, the type evidence of the positions that need it and the largest DECIMALS;
4. per (header, types) group one typed write from there into cube staging,
   partitioned by ``product_id`` with ``year`` stored in the files; groups run
   side by side;
5. a listing job measures each staged cube; small cubes are moved into
   place as they are (flat), large ones are rewritten into ``year=`` folders
   by one job per group, then moved into place.

Only per-file and per-cube metadata reach the driver. A cube with any bad row
fails as a whole; the other cubes go on.
"""

from __future__ import annotations

import logging
import time
import uuid
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor
from collections.abc import Callable, Iterable
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from cubelake import fs
from cubelake import schemas as S
from cubelake.functions.columns import blank_if_null, only_products, ref_year
from cubelake.functions.typing import cast_text
from cubelake.operators.inference import (
    decide_positional,
    empty_cube_types,
    positional_aggregates,
    positional_names,
)
from cubelake.plans import layout
from cubelake.session import folder_parallel_writes, scratch_dir
from cubelake.sources.cube_csv import CSV_GLOB, cube_key, list_files, qualified_root, read_cube_text, read_headers, text_schema
from cubelake.sources.lake import cube_path

log = logging.getLogger(__name__)


@contextmanager
def _step(name: str):
    start = time.perf_counter()
    yield
    log.info("prepare_cubes %s: %.2fs", name, time.perf_counter() - start)


STATUS_SCHEMA = (
    "product_id bigint, ok boolean, reason string, layout string, rows bigint, bytes bigint, destination string, "
    "schema string"
)


@dataclass
class CubeStatus:
    product_id: int | None
    ok: bool
    reason: str | None = None
    layout: str | None = None
    rows: int | None = None
    bytes: int | None = None
    destination: str | None = None
    schema: str | None = None  # DDL of the published cube


def cube_schema(names: list[str], types: tuple[str, ...]) -> str:
    """DDL of a published cube (what ``read_cube(..., schema=)`` expects).

    ``year`` is declared as text: flat cubes store it as text and a
    partition value reads as text too; ``read_cube`` turns it into INT.
    """
    cols = [f"`{n}` {'string' if t in ('string', 'null') else t}" for n, t in zip(names, types)]
    return ", ".join(cols + [f"`{S.YEAR_COLUMN}` string"])


def typed_columns(names: list[str], types: tuple[str, ...], blank_strings: bool = True) -> list:
    """Projection from the all-text scan to typed columns plus ``year``."""
    cols = []
    for name, t in zip(names, types):
        c = F.col(f"`{name}`")
        if t == "string":
            c = blank_if_null(c) if blank_strings else c
        elif t == "null":
            c = F.lit(None).cast("string")
        else:
            c = cast_text(c, t)
        cols.append(c.alias(name))
    ref = blank_if_null(F.col(f"`{S.REF_DATE_COLUMN}`")) if blank_strings else F.col(f"`{S.REF_DATE_COLUMN}`")
    cols.append(ref_year(ref).alias(S.YEAR_COLUMN))
    return cols


def prepare_cubes(
    spark: SparkSession,
    landing: str,
    lake: str | None = None,
    destination: Callable[[int], str] | None = None,
    only: Iterable[int] | DataFrame | None = None,
    threshold: int = S.FLAT_LAYOUT_THRESHOLD_BYTES,
    blank_strings: bool = True,
    work: str | None = None,
    glob: str = CSV_GLOB,
    files: list[str] | None = None,
    parallel_groups: int = 4,
    on_published: Callable[[list[int]], None] | None = None,
) -> DataFrame:
    """Turn every landed cube under ``landing`` into a published parquet cube.

    ``destination(product_id)`` names the output folder (default
    ``<lake>/<product_id>.parquet``); ``only`` restricts the run to some ids
    (or to those of a table with a ``product_id``);
    ``glob`` selects the landed files, ``files`` names them one by one
    instead (paths under ``landing``); ``parallel_groups`` typed writes run
    at the same time; ``on_published(ids)`` is called (from worker threads)
    as soon as a group of cubes is in place. Returns a status table, one row
    per cube.
    """
    if destination is None:
        if lake is None:
            raise ValueError("give lake or destination")
        destination = lambda pid: cube_path(lake, pid)
    work = work or scratch_dir(spark, "prepare")
    root = qualified_root(spark, landing)

    listed = list_files(spark, files, "*") if files else list_files(spark, landing, glob)
    listed = listed.withColumn("product_id", cube_key("path", root))
    if only is not None:
        listed = only_products(listed, only)
    with _step("headers"):
        headers = (
            read_headers(listed.select("path"))
            .withColumn("product_id", cube_key("path", root))
            .collect()
        )

    unreadable = [r.path for r in headers if r.error and r.error.startswith("unreadable")]
    if unreadable:
        # file systems the Python reader cannot open: Spark reads the first lines
        from cubelake.sources.cube_csv import headers_from_lines, read_headers_spark

        fixed = headers_from_lines(read_headers_spark(spark, unreadable).collect())
        headers = [
            r if r.path not in fixed else Row(path=r.path, names=fixed[r.path][0], error=fixed[r.path][1],
                                              product_id=r.product_id)
            for r in headers
        ]

    statuses: dict[int | None, CubeStatus] = {}
    by_cube: dict[int, list] = defaultdict(list)
    for row in headers:
        if row.product_id is None:
            statuses.setdefault(None, CubeStatus(None, False, f"no product id in {row.path}"))
            continue
        by_cube[row.product_id].append(row)

    by_header: dict[tuple[str, ...], list[int]] = defaultdict(list)
    for pid, rows in by_cube.items():
        errors = [r.error for r in rows if r.error]
        if errors:
            statuses[pid] = CubeStatus(pid, False, errors[0])
            continue
        signatures = {tuple(r.names) for r in rows}
        if len(signatures) != 1:
            statuses[pid] = CubeStatus(pid, False, "parts disagree on the header")
            continue
        names = signatures.pop()
        if S.REF_DATE_COLUMN not in names:
            statuses[pid] = CubeStatus(pid, False, "no REF_DATE column")
            continue
        by_header[names].append(pid)

    # One scan of the CSV and one aggregate per header width (few), whatever the names.
    names_of = {pid: names for names, pids in by_header.items() for pid in pids}
    parsed = f"{work}/parsed-{uuid.uuid4().hex}"
    if names_of:
        decided = {}
        for width in sorted({len(n) for n in names_of.values()}):
            pids = sorted(p for p, n in names_of.items() if len(n) == width)
            text = read_cube_text(spark, [r.path for pid in pids for r in by_cube[pid]], positional_names(width))
            with _step(f"parse cubes of {width} columns"):
                text.withColumn("product_id", cube_key("_path", root)).drop("_path").write.parquet(f"{parsed}/w{width}")
            headers_here = [list(n) for n in sorted({names_of[p] for p in pids})]
            with _step(f"infer cubes of {width} columns"):
                stats = positional_aggregates(_parsed(spark, parsed, width), headers_here)
                for r in stats.collect():  # one row per cube
                    decided[r["product_id"]] = decide_positional(r, list(names_of[r["product_id"]]))
        for pid, names in names_of.items():  # header-only files have no rows
            decided.setdefault(pid, empty_cube_types(pid, list(names)))

        groups: dict[tuple, list[int]] = defaultdict(list)
        for pid, d in decided.items():
            if not d.ok:
                statuses[pid] = CubeStatus(pid, False, d.reason, rows=d.rows)
            else:
                statuses[pid] = CubeStatus(pid, True, rows=d.rows)
                groups[(names_of[pid], d.types)].append(pid)

        def build(gi: int, names_t: tuple, types: tuple, gpids: list[int]) -> None:
            names = list(names_t)
            stage = f"{work}/stage/g{gi}"
            text = _parsed(spark, parsed, len(names)).where(F.col("product_id").isin(gpids))
            text = text.select("product_id", *[F.col(c).alias(n) for c, n in zip(positional_names(len(names)), names)])
            typed = text.select("product_id", *typed_columns(names, types, blank_strings))
            with _step(f"stage group {gi}"):
                typed.write.mode("overwrite").partitionBy("product_id").parquet(stage)
            with _step(f"place group {gi}"):
                empty_schema = typed.drop("product_id").schema
                _place(spark, stage, f"{work}/large/g{gi}", gpids, statuses, destination, threshold, empty_schema)
            for pid in gpids:
                statuses[pid].schema = cube_schema(names, types)
            if on_published is not None:
                on_published(list(gpids))

        # Typed writes differ in schema per (header, types) group, so each is
        # its own job; they run side by side so that many small cubes do not
        # queue behind each other.
        ordered = sorted(groups.items(), key=lambda kv: min(kv[1]))
        with ThreadPoolExecutor(max_workers=max(1, min(parallel_groups, len(ordered)))) as pool:
            futures = [pool.submit(build, gi, key[0], key[1], gpids) for gi, (key, gpids) in enumerate(ordered)]
            for f in futures:
                f.result()
        fs.delete(spark, parsed)

    rows = [
        (s.product_id, s.ok, s.reason, s.layout, s.rows, s.bytes, s.destination, s.schema)
        for s in sorted(statuses.values(), key=lambda s: (s.product_id is None, s.product_id or 0))
    ]
    return spark.createDataFrame(rows, STATUS_SCHEMA)


def _parsed(spark: SparkSession, folder: str, width: int) -> DataFrame:
    """The staged text of the cubes with so many columns, and their ``product_id``."""
    schema = text_schema(positional_names(width)).add("product_id", "long")
    return spark.read.schema(schema).parquet(f"{folder}/w{width}")


def _place(spark, stage, large_stage, pids, statuses, destination, threshold, empty_schema) -> None:
    from cubelake.operators.stats import dataset_sizes

    sizes = {
        int(r["product_id"]): int(r["bytes"])
        for r in dataset_sizes(spark, stage, key="product_id", glob="*.parquet").collect()
        if r["product_id"]
    }
    large, moves = [], []
    for pid in pids:
        size = sizes.get(pid, 0)
        statuses[pid].bytes = size
        if pid not in sizes:
            # a header without rows: publish an empty table with the cube's columns
            spark.createDataFrame([], empty_schema).write.mode("overwrite").parquet(destination(pid))
            statuses[pid].layout = "flat"
            statuses[pid].destination = destination(pid)
        elif size < threshold:
            moves.append((f"{stage}/product_id={pid}", destination(pid)))
            statuses[pid].layout = "flat"
            statuses[pid].destination = destination(pid)
        else:
            large.append(pid)
    layout.publish_all(spark, moves)
    if not large:
        return
    # One shuffle so that every (cube, year) folder gets one or a few
    # well-sized files (AQE splits a hot year) instead of one file per input
    # task and year.
    staged = spark.read.parquet(stage).where(F.col("product_id").isin(large))
    with folder_parallel_writes(spark):
        (
            staged.hint("rebalance", "product_id", S.YEAR_COLUMN)
            .write.mode("overwrite")
            .partitionBy("product_id", S.YEAR_COLUMN)
            .parquet(large_stage)
        )
    layout.publish_all(spark, [(f"{large_stage}/product_id={pid}", destination(pid)) for pid in large])
    for pid in large:
        statuses[pid].layout = "partitioned"
        statuses[pid].destination = destination(pid)


def prepare_cube(spark: SparkSession, source: str, outfile: str | None = None, work: str | None = None, **kw) -> DataFrame:
    """One cube from a ``.zip`` or ``.csv`` file to ``outfile``.

    The default output is ``<digits of the file name>.parquet`` next to the
    current folder's lake, as the single-cube command does.
    """
    from cubelake.sources.archives import unzip_to_landing

    work = work or scratch_dir(spark, "prepare-one")
    landing = f"{work}/landing"
    name = source.rstrip("/").rsplit("/", 1)[-1]
    digits = "".join(ch for ch in name if ch.isdigit())
    if name.lower().endswith(".zip"):
        status = unzip_to_landing(spark, source, landing, rule="digits").collect()
        if not status or not status[0]["ok"]:
            reason = status[0]["reason"] if status else "no archive"
            row = (int(digits) if digits else None, False, reason, None, None, None, None, None)
            return spark.createDataFrame([row], STATUS_SCHEMA)
        landing_src = landing
    else:
        # a plain CSV: exactly this file, whatever lies beside it
        if not digits:
            row = (None, False, f"no product id in {name}", None, None, None, None, None)
            return spark.createDataFrame([row], STATUS_SCHEMA)
        exact = fs.qualify(spark, source.rstrip("/"))
        landing_src = exact.rsplit("/", 1)[0]
        if not fs.exists(spark, exact):
            row = (int(digits), False, "not landed", None, None, None, None, None)
            return spark.createDataFrame([row], STATUS_SCHEMA)
        kw["files"] = [exact]
    out = outfile or f"{digits}.parquet"
    return prepare_cubes(spark, landing_src, destination=lambda pid: out, work=f"{work}/etl", **kw)
