"""Reading published cubes.

Every cube lives at ``<lake>/<product_id>.parquet``: flat parquet files for
small cubes (``year`` stored as text inside them), hive ``year=`` folders for
large ones (``year`` discovered from the path). Readers normalise ``year`` to
INT so that ``year > 2000`` means the same in both layouts.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cubelake import fs
from cubelake import schemas as S


def cube_path(lake: str, product_id: int) -> str:
    return f"{lake.rstrip('/')}/{int(product_id)}.parquet"


def normalise_year(df: DataFrame) -> DataFrame:
    if S.YEAR_COLUMN in df.columns:
        return df.withColumn(S.YEAR_COLUMN, F.expr(f"try_cast({S.YEAR_COLUMN} AS INT)"))
    return df


def read_cube(spark: SparkSession, lake: str, product_id: int, schema: str | None = None) -> DataFrame:
    """One published cube; read from its root so ``year`` is kept.

    ``schema`` (the DDL the ETL reports per cube) skips footer inference,
    which otherwise costs a small job per cube.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    return normalise_year(reader.parquet(cube_path(lake, product_id)))


def _scans(cubes: dict[int, tuple[T.StructType, bool]]) -> list[tuple[list[int], list[T.StructField], bool]]:
    """Cubes that one scan can read: the same layout, and no column that has another type elsewhere in it.

    Gives product ids, merged columns (``year`` left out) and the layout. Names
    are compared without case, as Spark does; the first spelling stays.
    """
    scans: list[tuple[list[int], dict[str, T.StructField], bool]] = []
    for pid, (schema, by_year) in cubes.items():
        own = {f.name.lower(): f for f in schema if f.name.lower() != S.YEAR_COLUMN}
        for ids, columns, layout in scans:
            if layout == by_year and all(columns[n].dataType == f.dataType for n, f in own.items() if n in columns):
                ids.append(pid)
                for name, column in own.items():
                    columns.setdefault(name, column)
                break
        else:
            scans.append(([pid], own, by_year))
    return [(ids, list(columns.values()), layout) for ids, columns, layout in scans]


def read_cubes(
    spark: SparkSession,
    lake: str,
    product_ids,
    widen_value: bool = True,
    schemas: dict | None = None,
    layouts: dict | None = None,
) -> DataFrame:
    """Several cubes as one table with a ``product_id`` column.

    Cubes of one layout whose columns agree in type are one scan over all their
    roots, so the plan grows with the kinds of cubes and not with their number: as a
    rule VALUE is BIGINT in some and DOUBLE in others, and ``widen_value`` makes it
    DOUBLE on purpose. A cube without a column of the others has nulls there.
    ``product_id``, and ``year`` of cubes in year folders, come from the path;
    filters on them drop files before any is opened.

    ``schemas`` (DDL) and ``layouts`` (``flat`` or ``partitioned``) map product ids to
    what the ETL's status says; a cube without them costs a footer and a listing.
    """
    cubes = {}
    for pid in dict.fromkeys(int(p) for p in product_ids):
        path, ddl, layout = cube_path(lake, pid), (schemas or {}).get(pid), (layouts or {}).get(pid)
        if layout is None:
            by_year = any(n.startswith(f"{S.YEAR_COLUMN}=") for n in fs.list_names(spark, path))
        else:
            by_year = layout != "flat"
        cubes[pid] = (T.StructType.fromDDL(ddl) if ddl else spark.read.parquet(path).schema, by_year)
    if not cubes:
        raise ValueError("no cubes given")
    file = F.col("_metadata.file_path")
    frames = []
    for ids, columns, by_year in _scans(cubes):
        stored = T.StructType([*columns] + ([] if by_year else [T.StructField(S.YEAR_COLUMN, T.StringType())]))
        scan = (
            spark.read.schema(stored)
            .option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.parquet")
            .parquet(*[cube_path(lake, pid) for pid in ids])
        )
        product = F.regexp_extract(file, r"/([0-9]+)[.]parquet/[^/]*$", 1)
        if by_year:
            product = F.regexp_extract(file, rf"/([0-9]+)[.]parquet/{S.YEAR_COLUMN}=[^/]*/[^/]*$", 1)
            scan = scan.withColumn(S.YEAR_COLUMN, F.regexp_extract(file, rf"/{S.YEAR_COLUMN}=([^/]*)/[^/]*$", 1))
        scan = normalise_year(scan).withColumn("product_id", product.cast("bigint"))
        if widen_value:
            for column in columns:
                if column.name == S.VALUE_COLUMN:
                    scan = scan.withColumn(column.name, F.col(column.name).cast(T.DoubleType()))
        frames.append(scan)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def register_cube(spark: SparkSession, lake: str, product_id: int, view: str | None = None) -> str:
    """Expose a cube to SQL as a temp view (default name ``cube_<id>``)."""
    name = view or f"cube_{int(product_id)}"
    read_cube(spark, lake, product_id).createOrReplaceTempView(name)
    return name


def query_cube(spark: SparkSession, lake: str, product_id: int, sql: str, view: str = "cube") -> DataFrame:
    """Run free SQL text against one cube, visible as ``view``."""
    register_cube(spark, lake, product_id, view)
    return spark.sql(sql)


#: Touched keys up to which the folders of all others are left unread.
FEW_KEYS = 10_000


def read_folders(
    spark: SparkSession, root: str, key: str, fmt: str = "parquet", schema: T.StructType | None = None,
    touched: DataFrame | None = None, whole: bool = False, **options: str,
) -> DataFrame:
    """A dataset in ``key=…`` folders of a whole-number key (BIGINT, last column; null for the default folder).

    The key comes from the file's path. Spark's own discovery compares the values of
    all folders on the driver, in time that grows with the square of their number.
    A filter on the key drops files before any is opened. ``touched`` (a table
    with the key) keeps the rows of its keys, and leaves the others' files
    unread if it has at most ``FEW_KEYS``. ``schema`` (with or without the key)
    saves the look into a file.

    ``whole`` is for jobs that read every row (of the touched keys): folders that
    ``plans.folders`` has written are then read by Arrow, in a fraction of the time a
    file costs Spark, and ``touched`` may have any number of keys. A filter put on the
    result drops no files.
    """
    if whole:
        from cubelake.plans import folders

        known = folder_schema(spark, root, key, fmt, **options) if schema is None else schema
        rows = folders.read_files(spark, root, key, fmt, known, options, touched)
        if rows is not None:
            return rows
    reader = spark.read.format(fmt).option("recursiveFileLookup", True).options(**options)
    if schema is not None:
        reader = reader.schema(T.StructType([f for f in schema if f.name != key]))
    rows = reader.load(root)
    value = F.regexp_extract("_metadata.file_path", rf"/{key}=([^/]*)/[^/]*$", 1).try_cast("bigint")
    rows = rows.select(*[F.col(f"`{c}`") for c in rows.columns if c != key], value.alias(key))
    if touched is None:
        return rows
    keys = touched.select(F.col(key).cast("bigint").alias(key)).where(F.col(key).isNotNull()).distinct()
    few = [r[0] for r in keys.limit(FEW_KEYS + 1).collect()]
    if len(few) <= FEW_KEYS:
        return rows.where(F.col(key).isin(few))
    return rows.join(keys, key, "left_semi").select(*rows.columns)


def folder_schema(spark: SparkSession, root: str, key: str, fmt: str = "parquet", **options: str) -> T.StructType:
    """The columns of a dataset in ``key=…`` folders by a file of one of them, without a listing of all; the key is the last."""
    folder = fs.first_folder(spark, root)
    path = f"{root.rstrip('/')}/{folder}"
    if folder is None or not any(n.endswith(f".{fmt}") and not n.startswith(("_", ".")) for n in fs.list_names(spark, path)):
        return read_folders(spark, root, key, fmt, **options).schema
    columns = spark.read.format(fmt).options(**options).load(path).schema
    return T.StructType([*[f for f in columns if f.name != key], T.StructField(key, T.LongType())])


_FORMATS = {".parquet": "parquet", ".csv": "csv", ".json": "json", ".orc": "orc", ".ndjson": "json"}


def read_path(spark: SparkSession, path: str, fmt: str | None = None, **options: str) -> DataFrame:
    """Read a table straight from a path; the format follows the extension."""
    if fmt is None:
        lowered = path.rstrip("/").lower()
        fmt = next((f for ext, f in _FORMATS.items() if lowered.endswith(ext)), "parquet")
    if fmt == "parquet" and not options and re.match(r"productId=([0-9]+|__HIVE.*)$", fs.first_folder(spark, path) or ""):
        return read_folders(spark, path, "productId")
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("inferSchema", True).option("escape", '"')
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path)
