"""Hive folders ``key=…`` of a whole-number key, written by Arrow inside the tasks.

On a file system of the machine (or one mounted there) Hadoop's writer starts a
process for every file it makes, to set its mode, and Spark's commit moves each
folder again from the driver. With a folder per product both outgrow the data. Here
Spark deals and sorts the rows as before, and a task writes the folders of its
products one after the other, a batch at a time. CSV and JSON lines are made by
Spark's own ``to_csv`` and ``to_json``.

A file gets its name when it is whole, and the name depends on run and partition
only, so a task that is repeated replaces its files by the same rows.

What was written here is read here too (``read_files``): Spark's readers spend some
ten milliseconds on a file, however small, and list all folders on the driver.
"""

from __future__ import annotations

import csv
import fcntl
import io
import os
import re
import uuid
from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cubelake import fs
from cubelake.session import folder_parallel_writes, scratch_dir, ship_package

_WHOLE = (T.LongType, T.IntegerType, T.ShortType)
_COLUMNAR = (*_WHOLE, T.DoubleType, T.StringType, T.BooleanType, T.DateType)
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
#: Bytes of rows up to which an ORC file is not compressed.
_PLAIN_BYTES = 64 << 10
#: The names that files get here.
_OWN = r"part-[0-9]{5,}-[0-9a-f]{16}[.]"
#: Files and bytes that a reading task takes, and rows and bytes that it hands on at once.
_TASK_FILES, _TASK_BYTES, _OUT_ROWS, _OUT_BYTES = 2_000, 64 << 20, 20_000, 8 << 20


def can_write(df: DataFrame, path: str, key: str, fmt: str) -> bool:
    """Whether ``write_folders`` takes this table there; otherwise Spark's own writer does."""
    if not fs.qualify(df.sparkSession, path).startswith("file:") or not isinstance(df.schema[key].dataType, _WHOLE):
        return False
    return fmt in ("csv", "json") or (
        fmt in ("parquet", "orc") and all(isinstance(f.dataType, _COLUMNAR) for f in df.schema)
    )


class _Lines:
    def __init__(self, out, header: str):
        self.out = out
        out.write(header.encode())

    def write(self, rows: pa.RecordBatch) -> None:
        self.out.write(("\n".join(rows.column(0).to_pylist()) + "\n").encode())

    def close(self) -> None:
        pass


class _Orc:
    """A file of a few rows is not compressed: it fills a block or two of the disk either way, and a compressor a column costs several times what the rows do."""

    def __init__(self, out):
        self.out, self.writer, self.held, self.size = out, None, [], 0

    def write(self, rows: pa.RecordBatch) -> None:
        self.held.append(rows)
        self.size += rows.nbytes
        if self.writer is not None or self.size > _PLAIN_BYTES:
            self._put(compression="zstd")

    def _put(self, **options) -> None:
        from pyarrow import orc

        if self.writer is None:
            self.writer = orc.ORCWriter(self.out, **options)
        self.writer.write(pa.Table.from_batches(self.held))
        self.held = []

    def close(self) -> None:
        if self.held:
            self._put(compression="uncompressed")
        self.writer.close()


def _writer(out, fmt: str, schema: pa.Schema, header: str):
    if fmt == "parquet":
        import pyarrow.parquet as pq

        return pq.ParquetWriter(out, schema, compression="snappy", store_schema=False)
    return _Orc(out) if fmt == "orc" else _Lines(out, header)


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int | None, pa.RecordBatch]]:
    """Pieces of one key each (the first column), which is taken off; equal keys follow each other."""
    for batch in batches:
        keys, rows, start = batch.column(0).to_pylist(), batch.select(batch.schema.names[1:]), 0
        for value, same in groupby(keys):
            size = sum(1 for _ in same)
            yield value, rows.slice(start, size)
            start += size


def _keep_heap() -> None:
    """Let the allocator keep freed memory for the next file, up to 64 MB.

    An ORC writer takes and frees megabytes of buffers; given back each time, they
    cost more in page faults than the file does. Only the GNU C library is asked.
    """
    import ctypes

    try:
        mallopt = ctypes.CDLL(None).mallopt
    except (OSError, AttributeError):
        return
    mallopt(-1, 64 << 20)  # M_TRIM_THRESHOLD
    mallopt(-3, 16 << 20)  # M_MMAP_THRESHOLD


def _make_folders(root: str, names: list[str], there: bool) -> None:
    """Make folders that do not exist, the writers of a root one after the other.

    Processes that add to one folder at the same time wait for each other in the kernel
    and together get less done than one alone. ``there``: as a rule they exist.
    """
    if there:
        names = [n for n in names if not os.path.isdir(f"{root}/{n}")]
    if not names:
        return
    os.makedirs(root, exist_ok=True)
    held = os.open(root, os.O_RDONLY)
    try:
        try:
            fcntl.flock(held, fcntl.LOCK_EX)
        except OSError:  # a mounted disk without locks
            pass
        for name in names:
            try:
                os.mkdir(f"{root}/{name}")
            except FileExistsError:
                pass
    finally:
        os.close(held)


def _write_task(root: str, key: str, fmt: str, header: str, run: str, replace: bool):
    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs as pafs

        from cubelake.sources.cube_csv import _filesystem

        filesystem, inner = _filesystem(root)
        task = TaskContext.get()
        if fmt == "orc":
            _keep_heap()
        name = f"part-{task.partitionId():05d}-{run}.{fmt}"
        files = 0

        def named(value: int | None) -> str:
            return f"{key}={_NO_VALUE if value is None else value}"

        def ready() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                _make_folders(inner, [named(v) for v, _ in groupby(batch.column(0).to_pylist())], replace)
                yield batch

        for value, pieces in groupby(_runs(ready()), lambda piece: piece[0]):
            folder = f"{inner}/{named(value)}"
            hidden = f"{folder}/.{name}.{task.taskAttemptId()}"
            with filesystem.open_output_stream(hidden) as out:
                writer = None
                for _, rows in pieces:
                    writer = writer or _writer(out, fmt, rows.schema, header)
                    writer.write(rows)
                writer.close()
            old = []
            if replace:  # what other tasks of this run have put here stays
                there = filesystem.get_file_info(pafs.FileSelector(folder))
                old = [f.path for f in there if not f.base_name.startswith(".part-") and run not in f.base_name]
                old += [f.path for f in there if f.base_name.endswith(".crc")]
            filesystem.move(hidden, f"{folder}/{name}")
            for path in dict.fromkeys(old):
                if filesystem.get_file_info(path).type != pafs.FileType.NotFound:
                    try:
                        filesystem.delete_file(path)
                    except FileNotFoundError:  # another task of this product was first
                        pass
            files += 1
        yield pa.RecordBatch.from_arrays([pa.array([files], pa.int64())], names=["files"])

    return write


def write_folders(df: DataFrame, root: str, key: str, fmt: str = "parquet", replace: bool = False) -> int:
    """Write ``df`` into ``key=…`` folders under ``root``; returns the number of files.

    ``rebalance`` deals the rows by key and splits a hot key over several tasks.
    With ``replace`` each folder that gets rows loses its old files, folder by
    folder; the source must not be what is replaced, so that the write can be
    done again after a failure.
    """
    spark = df.sparkSession
    ship_package(spark)
    names = [c for c in df.columns if c != key]
    columns = [F.col(f"`{c}`") for c in names]
    header = ""
    rows = df.hint("rebalance", key)
    if fmt == "csv":
        text = io.StringIO()
        csv.writer(text, lineterminator="\n").writerow(names)
        header = text.getvalue()
        columns = [F.to_csv(F.struct(*columns), {"escape": '"'}).alias("value")]
    elif fmt == "json":
        columns = [F.to_json(F.struct(*columns)).alias("value")]
    dealt = rows.select(F.col(key).alias("__key"), *columns).sortWithinPartitions("__key")
    write = _write_task(fs.qualify(spark, root).rstrip("/"), key, fmt, header, uuid.uuid4().hex[:16], replace)
    with folder_parallel_writes(spark):
        return sum(r["files"] for r in dealt.mapInArrow(write, "files long").collect())


# ------------------------------------------------------------- reading


def _folders(root: str):
    """The visible entries of a folder, by one task."""

    def names(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from cubelake.sources.cube_csv import _filesystem

        inner = _filesystem(root)[1]
        found: list[str] = []
        for _ in batches:
            with os.scandir(inner) as entries:
                found += [e.name for e in entries if not e.name.startswith(("_", "."))]
        for start in range(0, len(found), 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(found[start : start + 10_000], pa.string())], names=["name"])

    return names


def _files(root: str, key: str, fmt: str):
    """The visible files of these folders, with the key from the path and whether they were written here."""
    own, whole, prefix = re.compile(f"{_OWN}{fmt}"), re.compile(r"[+-]?[0-9]{1,18}"), f"{key}="

    def key_of(folder: str) -> tuple[int | None, bool]:
        value = folder[len(prefix) :]
        if folder == f"{prefix}{_NO_VALUE}":
            return None, True
        return (int(value), True) if folder.startswith(prefix) and whole.fullmatch(value) else (None, False)

    def files(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from cubelake.sources.cube_csv import _filesystem

        inner = _filesystem(root)[1]
        for batch in batches:
            out = []
            for name in batch.column(0).to_pylist():
                try:
                    entries = list(os.scandir(f"{inner}/{name}"))
                except NotADirectoryError:
                    out.append((name, None, 0, False))
                    continue
                value, known = key_of(name)
                for e in entries:
                    if not e.name.startswith(("_", ".")):
                        ours = known and e.is_file() and own.fullmatch(e.name) is not None
                        out.append((f"{name}/{e.name}", value, e.stat().st_size, ours))
            rows = list(zip(*out, strict=True)) or [[], [], [], []]
            types = (pa.string(), pa.int64(), pa.int64(), pa.bool_())
            arrays = [pa.array(c, t) for c, t in zip(rows, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["path", "key", "bytes", "own"])

    return files


def _lines(path: str, header: bool) -> Iterator[pa.Array]:
    """The lines of a file as Spark's readers tell them apart, without blank ones, some megabytes at a time."""
    with open(path, "rb") as f:
        rest = b""
        while chunk := f.read(_OUT_BYTES):
            chunk = rest + chunk
            cut = chunk.rfind(b"\n") + 1
            lines, rest = chunk[:cut].splitlines(), chunk[cut:]
            if header and lines:
                lines, header = lines[1:], False
            yield pa.array([x for x in lines if x.strip()], pa.binary()).cast(pa.string())
        if rest:
            yield pa.array([x for x in rest.splitlines()[int(header) :] if x.strip()], pa.binary()).cast(pa.string())


def _tables(path: str, size: int, fmt: str, schema: pa.Schema) -> Iterator[pa.Table]:
    """The rows of a columnar file: a small one at once, others by batches (Parquet) or stripes (ORC)."""

    def as_asked(table: pa.Table) -> pa.Table:
        if table.schema.equals(schema):
            return table
        there = set(table.schema.names)
        columns = [table[f.name].cast(f.type) if f.name in there else pa.nulls(len(table), f.type) for f in schema]
        return pa.Table.from_arrays(columns, schema=schema)

    if size <= _OUT_BYTES:
        with open(path, "rb") as f:
            source = pa.BufferReader(f.read())
    else:
        source = pa.memory_map(path)
    names = set(schema.names)
    if fmt == "parquet":
        import pyarrow.parquet as pq

        file = pq.ParquetFile(source)
        wanted = [n for n in file.schema_arrow.names if n in names]
        if size <= _OUT_BYTES:
            yield as_asked(file.read(wanted, use_threads=False))
        else:
            for batch in file.iter_batches(_OUT_ROWS, columns=wanted, use_threads=False):
                yield as_asked(pa.Table.from_batches([batch]))
        return
    from pyarrow import orc

    file = orc.ORCFile(source)
    wanted = [n for n in file.schema.names if n in names]
    for stripe in range(file.nstripes):
        yield as_asked(pa.Table.from_batches([file.read_stripe(stripe, wanted)]))


def _read_task(root: str, fmt: str, schema: pa.Schema, header: bool):
    text = fmt in ("csv", "json")
    shape = pa.schema([*([pa.field("value", pa.string())] if text else schema), pa.field("__key", pa.int64())])

    def pieces(path: str, size: int) -> Iterator[pa.Table]:
        if not text:
            yield from _tables(path, size, fmt, schema)
            return
        for lines in _lines(path, header):
            yield pa.Table.from_arrays([lines], names=["value"])

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from cubelake.sources.cube_csv import _filesystem

        inner, held, rows, size = _filesystem(root)[1], [], 0, 0

        def hand_on() -> Iterator[pa.RecordBatch]:
            for batch in pa.concat_tables(held).combine_chunks().to_batches(max_chunksize=_OUT_ROWS):
                yield batch

        for batch in batches:
            for path, value, length in zip(*(batch.column(n).to_pylist() for n in ("path", "key", "bytes")), strict=True):
                for table in pieces(f"{inner}/{path}", length):
                    if not len(table):
                        continue
                    keys = pa.nulls(len(table), pa.int64()) if value is None else pa.repeat(pa.scalar(value, pa.int64()), len(table))
                    held.append(pa.Table.from_arrays([*table.columns, keys], schema=shape))
                    rows, size = rows + len(table), size + table.nbytes
                    if rows >= _OUT_ROWS or size >= _OUT_BYTES:
                        yield from hand_on()
                        held, rows, size = [], 0, 0
        if held:
            yield from hand_on()

    return read


def read_files(
    spark: SparkSession, root: str, key: str, fmt: str, schema: T.StructType, options: dict[str, str], touched: DataFrame | None = None
) -> DataFrame | None:
    """The rows of ``key=…`` folders that ``write_folders`` has written, read by Arrow in the tasks.

    The files are listed by a job when this is called, and the list is kept as a
    table. ``touched`` leaves the files of all keys it does not have unread, however many
    it has. CSV and JSON lines are parsed by Spark's own ``from_csv`` and
    ``from_json``. None if Spark's reader has to do it: another file system, column
    types or options that are not known here, or files of another writer.
    """
    columns = [f for f in schema if f.name != key]
    if not fs.qualify(spark, root).startswith("file:") or not all(isinstance(f.dataType, _COLUMNAR) for f in columns):
        return None
    if fmt not in ("csv", "json", "parquet", "orc") or not columns or set(options) - {"header", "escape"}:
        return None
    from pyspark.sql.pandas.types import to_arrow_schema

    ship_package(spark)
    path = fs.qualify(spark, root).rstrip("/")
    kept = f"{scratch_dir(spark, 'listing')}/files"
    names = spark.range(1, numPartitions=1).mapInArrow(_folders(path), "name string").repartition("name")
    names.mapInArrow(_files(path, key, fmt), "path string, key long, bytes long, own boolean").write.parquet(kept)
    files = spark.read.schema("path string, key long, bytes long, own boolean").parquet(kept)
    n, size, own = files.agg(F.count("*"), F.sum("bytes"), F.min("own")).first()
    if n and not own:
        return None
    if touched is not None:
        keys = touched.select(F.col(key).cast("bigint").alias("key")).where("key IS NOT NULL").distinct()
        files = files.join(keys, "key", "left_semi")
    tasks = max(1, -(-n // _TASK_FILES), -(-(size or 0) // _TASK_BYTES), min(n, spark.sparkContext.defaultParallelism))
    asked = to_arrow_schema(T.StructType([T.StructField(f.name, f.dataType) for f in columns]))
    header = fmt == "csv" and str(options.get("header", "false")).lower() == "true"
    ddl = ", ".join([*(["value string"] if fmt in ("csv", "json") else [f"`{f.name}` {f.dataType.simpleString()}" for f in columns]), "__key long"])
    read = files.where("bytes > 0").select("path", "key", "bytes").repartition(tasks, "path").mapInArrow(_read_task(path, fmt, asked, header), ddl)
    if fmt in ("csv", "json"):
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
        parse = {k: v for k, v in options.items() if k != "header"}
        row = F.from_csv("value", fields, parse) if fmt == "csv" else F.from_json("value", fields, parse)
        read = read.select(row.alias("__row"), "__key").select("__row.*", "__key")
    return read.select(*[F.col(f"`{f.name}`") for f in columns], F.col("__key").alias(key))
