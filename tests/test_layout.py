"""Writers, sizes, counts, lake reads, header fallback, selective unzip."""

import os
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cubelake.operators.stats import dataset_sizes, distinct_keys, status_counts
from cubelake.plans.cube_etl import prepare_cubes
from cubelake.plans.layout import push, split_by_key, write_copy
from cubelake.sources.archives import unzip_to_landing
from cubelake.sources.cube_csv import headers_from_lines, list_files, read_headers, read_headers_spark
from cubelake.sources.lake import read_cubes, read_path


def _df(spark):
    return spark.createDataFrame(
        [(1, "a", 1.0, "1999"), (1, "b", 2.0, "2000"), (2, "c", 3.0, "2000")],
        "productId bigint, coordinate string, value double, year string",
    )


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_split_formats(spark, tmp_dir, fmt):
    out = os.path.join(tmp_dir, f"split-{fmt}")
    split_by_key(spark, _df(spark), out, "productId", fmt)
    assert sorted(os.listdir(out))[:2] == ["_SUCCESS", "productId=1"] or "productId=1" in os.listdir(out)
    back = spark.read.format(fmt).option("header", fmt == "csv").load(out)
    assert back.count() == 3
    assert distinct_keys(back, "productId").count() == 2


def test_sizes_and_counts(spark, tmp_dir):
    out = os.path.join(tmp_dir, "split")
    split_by_key(spark, _df(spark), out, "productId")
    total = dataset_sizes(spark, out, glob="*.parquet").first()
    per = {r.productId: r.bytes for r in dataset_sizes(spark, out, key="productId", glob="*.parquet").collect()}
    assert total.bytes == sum(per.values()) and set(per) == {"1", "2"}
    status = spark.createDataFrame([(1, True), (2, False), (3, True)], "product_id bigint, ok boolean")
    r = status_counts(status).first()
    assert (r.succeeded, r.planned) == (2, 3)


def test_path_literal_reads(spark, tmp_dir):
    p = os.path.join(tmp_dir, "t.parquet")
    write_copy(_df(spark), p)
    assert read_path(spark, p).count() == 3
    assert spark.sql(f"SELECT count(*) AS n FROM parquet.`{p}`").first().n == 3
    c = os.path.join(tmp_dir, "t.csv")
    write_copy(_df(spark), c, "csv")
    assert read_path(spark, c, header="false").count() == 3


def test_header_fallback_matches(spark, tmp_dir):
    land = os.path.join(tmp_dir, "landing")
    os.makedirs(land)
    with open(os.path.join(land, "1.csv"), "w", encoding="utf-8") as f:
        f.write('\ufeff"REF_DATE","Symbol","Symbol"\n1999,a,b\n2000,c,d\n')
    with open(os.path.join(land, "2.csv"), "w") as f:
        f.write("REF_DATE,GEO\n")
    files = list_files(spark, land)
    py = {r.path: list(r.names) for r in read_headers(files).collect()}
    sp = {p: names for p, (names, _) in headers_from_lines(read_headers_spark(spark, sorted(py)).collect()).items()}
    assert py == sp
    assert sorted(py.values()) == [["REF_DATE", "GEO"], ["REF_DATE", "Symbol", "Symbol.1"]]


def test_unzip_only_selected(spark, tmp_dir):
    zips = os.path.join(tmp_dir, "zips")
    os.makedirs(zips)
    for pid in (11, 12):
        with zipfile.ZipFile(os.path.join(zips, f"{pid}-eng.zip"), "w") as zf:
            zf.writestr(f"{pid}.csv", "REF_DATE,GEO,VALUE,DECIMALS\n1999,A,1,0\n")
    landing = os.path.join(tmp_dir, "landing")
    status = unzip_to_landing(spark, zips, landing, only=[12]).collect()
    assert [s.member for s in status] == ["12.csv"] and os.listdir(landing) == ["12.csv"]


def test_read_cubes_widens_value(spark, tmp_dir):
    land = os.path.join(tmp_dir, "landing")
    os.makedirs(land)
    with open(os.path.join(land, "1.csv"), "w") as f:
        f.write("REF_DATE,GEO,VALUE,DECIMALS\n1999,A,1,0\n")
    with open(os.path.join(land, "2.csv"), "w") as f:
        f.write("REF_DATE,GEO,VALUE,DECIMALS,Extra\n2001,B,1.5,1,x\n")
    lake = os.path.join(tmp_dir, "lake")
    prepare_cubes(spark, land, lake).collect()
    both = read_cubes(spark, lake, [1, 2])
    assert both.schema["VALUE"].dataType == T.DoubleType()
    rows = sorted((r.product_id, r.VALUE, r.Extra, r.year) for r in both.collect())
    assert rows == [(1, 1.0, None, 1999), (2, 1.5, "x", 2001)]
    late = both.where(F.col("year") > 2000).collect()
    assert [(r.product_id, r.year) for r in late] == [(2, 2001)]


def _scans_and_files(df):
    """Scans of a plan that has run, and the files they read."""
    df = df.select("*")  # a plan of its own: files are counted when a plan first runs
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    scans = [leaves.apply(i) for i in range(leaves.size())]
    return len(scans), sum(s.metrics().apply("numFiles").value() for s in scans)


def test_many_cubes_are_as_many_scans_as_kinds(spark, tmp_dir):
    lake = os.path.join(tmp_dir, "lake.d")
    expected = []
    for pid in range(1, 13):
        value = "cast(id as bigint)" if pid % 2 else "cast(id as double) + 0.5"
        rows = spark.range(4).selectExpr(
            f"'g{pid}' AS GEO", f"{value} AS VALUE", *([f"id AS Only{pid}"] if pid == 5 else []),
            "cast(CASE id WHEN 3 THEN NULL ELSE 1999 + id END AS string) AS year",
        )
        out = rows.coalesce(1).write
        (out.partitionBy("year") if pid % 3 == 0 else out).parquet(os.path.join(lake, f"{pid}.parquet"))
        expected += [(pid, f"g{pid}", k + (0.0 if pid % 2 else 0.5), None if k == 3 else 1999 + k, k if pid == 5 else None) for k in range(4)]
    cubes = read_cubes(spark, lake, range(1, 13))
    key = lambda r: (r[0], r[2])
    got = [(r.product_id, r.GEO, r.VALUE, r.year, r.Only5) for r in cubes.collect()]
    assert sorted(got, key=key) == sorted(expected, key=key)
    scans, files = _scans_and_files(cubes)
    assert (scans, files) == (4, 8 + 4 * 4)  # two layouts, two types of VALUE
    recent = cubes.where(F.col("year") >= 2001)
    assert _scans_and_files(recent) == (4, 8 + 4)
    assert sorted(r.product_id for r in recent.collect()) == list(range(1, 13))
    assert _scans_and_files(cubes.where(F.col("product_id") == 6))[1] == 4


def test_publish_replaces_and_hides_backup(spark, tmp_dir):
    from cubelake.plans.layout import publish

    store = os.path.join(tmp_dir, "store")
    _df(spark).write.partitionBy("productId").parquet(store)
    staged = os.path.join(tmp_dir, "staged")
    spark.createDataFrame([("z", 9.0, "2001")], "coordinate string, value double, year string").write.parquet(staged)
    publish(spark, staged, os.path.join(store, "productId=1"))
    assert not any(n.startswith("_replaced") for n in os.listdir(store))
    back = spark.read.parquet(store)
    assert sorted((r.productId, r.coordinate) for r in back.collect()) == [(1, "z"), (2, "c")]
    os.makedirs(os.path.join(store, "_replaced-productId=2-deadbeef"))  # a left-over backup
    assert spark.read.parquet(store).count() == 2


def test_transform_csv_folder(spark, tmp_dir):
    from cubelake.plans.csv_folder import transform_csv_folder

    folder = os.path.join(tmp_dir, "folder")
    os.makedirs(os.path.join(folder, "sub"))
    head = "REF_DATE,GEO,UOM_ID,SCALAR_FACTOR,SCALAR_ID,VALUE,DECIMALS\n"
    with open(os.path.join(folder, "a.csv"), "w") as f:
        f.write(head + "2001,A,1,units,3,5,0\n2002,B,1,units,0,,0\n")
    with open(os.path.join(folder, "sub", "b.csv"), "w") as f:
        f.write(head + "2001,C,1,units,1,1.5,1\n")
    with open(os.path.join(folder, "c.csv"), "w") as f:
        f.write("REF_DATE,GEO,VALUE\n2001,D,1\n")  # no scaling columns
    with open(os.path.join(folder, "d.csv"), "w") as f:
        f.write(head)  # header only
    status = {os.path.basename(r.path): r for r in transform_csv_folder(spark, folder).collect()}
    assert status["a.csv"].ok and status["b.csv"].ok and not status["c.csv"].ok
    assert status["d.csv"].ok and spark.read.parquet(os.path.join(folder, "d.parquet")).count() == 0
    a = spark.read.parquet(os.path.join(folder, "a.parquet"))
    assert a.columns == ["REF_DATE", "GEO", "SCALAR_ID", "VALUE"]
    assert sorted((r.GEO, r.VALUE) for r in a.collect() if r.VALUE is not None) == [("A", 5000)]
    b = spark.read.parquet(os.path.join(folder, "sub", "b.parquet")).first()
    assert b.VALUE == 15.0 and b.REF_DATE == 2001  # plain inference: REF_DATE is a number here


def test_folder_parallel_writes_restores_setting(spark):
    from concurrent.futures import ThreadPoolExecutor

    from cubelake.session import folder_parallel_writes

    key = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    before = spark.conf.get(key)

    def work(_):
        with folder_parallel_writes(spark):
            assert spark.conf.get(key) == "1KB"
            with folder_parallel_writes(spark):
                pass

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(work, range(16)))
    assert spark.conf.get(key) == before


def test_push_copies(spark, tmp_dir):
    source, lake = os.path.join(tmp_dir, "7.parquet"), os.path.join(tmp_dir, "lake dir")
    spark.range(5).selectExpr("id", "id % 2 AS year").write.partitionBy("year").parquet(source)
    for _ in range(2):  # the second replaces the first
        push(spark, source, f"{lake}/7.parquet")
    assert spark.read.parquet(source).count() == 5
    assert spark.read.parquet(f"{lake}/7.parquet").where("year = 1").count() == 2
    assert os.listdir(lake) == ["7.parquet"]


def test_folders_of_many_products(spark, tmp_dir):
    """Every kind of row comes back from every format, hot products over several files, in one listing."""
    from cubelake import fs
    from cubelake.plans.delta_jobs import merge_into_store, replace_folders
    from cubelake.plans.layout import write_keyed
    from cubelake.sources.lake import read_folders

    text = F.when(F.col("id") % 5 == 0, F.lit("")).when(F.col("id") % 5 == 1, F.lit('a "b", c')).otherwise(F.lit("x"))
    value = F.when(F.col("id") % 3 != 0, F.col("id") / 7).when(F.col("id") % 2 == 0, F.lit(float("nan")))
    product = F.when(F.col("id") >= 20_000, F.lit(7)).otherwise(F.col("id") % 300).cast("bigint")
    rows = spark.range(40_000).select(
        F.when(F.col("id") == 11, F.lit(None)).otherwise(product).alias("productId"), F.col("id").alias("vectorId"),
        F.when(F.col("id") % 4 > 0, text).alias("refPer"), (F.col("id") % 4).cast("smallint").alias("code"), value.alias("value"),
    )
    for fmt in ("parquet", "orc", "csv", "json"):
        out = os.path.join(tmp_dir, fmt)
        split_by_key(spark, rows, out, "productId", fmt)
        names = os.listdir(out)
        assert len([n for n in names if n.startswith("productId=")]) == 301 and "_SUCCESS" in names
        assert not any(f.endswith(".crc") for _, _, files in os.walk(out) for f in files if "part" in f)
        options = {"header": "true", "escape": '"'} if fmt == "csv" else {}
        back = read_folders(spark, out, "productId", fmt, rows.schema, **options).select(*rows.columns)
        # Spark's CSV reader gives null for an empty text, by whomever it is written
        want = rows.withColumn("refPer", F.nullif("refPer", F.lit(""))) if fmt == "csv" else rows
        assert back.exceptAll(want).count() == 0 and want.exceptAll(back).count() == 0
    store = os.path.join(tmp_dir, "store")
    write_keyed(rows.limit(0), store, "productId")
    write_keyed(rows, store, "productId")  # replaces the whole store
    held = {k: sorted(os.listdir(f"{store}/productId={k}")) for k in (3, 4)}
    few = rows.where("productId IN (3, 7)").withColumn("value", F.lit(-1.0)).localCheckpoint()
    replace_folders(few, store)
    replace_folders(few, store)  # once more, as after a failure
    back = read_folders(spark, store, "productId")
    assert back.count() == 40_000 and back.where("value = -1").count() == few.count()
    now = {k: sorted(os.listdir(f"{store}/productId={k}")) for k in (3, 4)}
    assert now[4] == held[4] and now[3] != held[3]
    merge_into_store(spark, store, few.withColumn("value", F.lit(-2.0)), work=os.path.join(tmp_dir, "w"))
    back = read_folders(spark, store, "productId")
    assert back.count() == 40_000 and back.where("value = -2").count() == few.count()
    assert fs.first_folder(spark, store).startswith("productId=")


@pytest.mark.parametrize("fmt", ["parquet", "orc", "csv", "json"])
def test_whole_folders_are_read_without_a_scan_of_each_file(spark, tmp_dir, fmt):
    from cubelake.plans import folders
    from cubelake.sources.lake import read_folders

    text = F.when(F.col("id") % 7 == 0, F.lit("")).when(F.col("id") % 7 == 1, F.lit('a "b", c\\')).otherwise(F.lit("é"))
    value = F.when(F.col("id") % 11 == 0, F.lit(float("nan"))).when(F.col("id") % 11 == 1, F.lit(float("-inf"))).otherwise(F.col("id") / 7)
    key = F.when(F.col("id") == 5, F.lit(None)).when(F.col("id") >= 3000, F.lit(-7)).otherwise(F.col("id") % 60)
    rows = spark.range(6000).select(
        key.cast("bigint").alias("productId"), F.when(F.col("id") % 3 > 0, text).alias("name"),
        F.when(F.col("id") % 13 != 1, value).alias("value"), (F.col("id") % 4).cast("smallint").alias("code"),
        (F.col("id") % 2 == 0).alias("flag"), F.date_add(F.lit("1900-01-01").cast("date"), F.col("id").cast("int")).alias("day"),
    )
    out = os.path.join(tmp_dir, fmt)
    split_by_key(spark, rows, out, "productId", fmt)
    options = {"header": "true", "escape": '"'}
    by_spark = read_folders(spark, out, "productId", fmt, rows.schema, **options)
    whole = read_folders(spark, out, "productId", fmt, rows.schema, whole=True, **options)
    assert whole.schema == by_spark.schema
    assert whole.exceptAll(by_spark).count() == 0 and by_spark.exceptAll(whole).count() == 0 and whole.count() == 6000
    assert len(by_spark.inputFiles()) >= 62 and len(whole.inputFiles()) < 20
    touched = spark.range(20, 20_000).select(F.col("id").alias("productId"))
    some = read_folders(spark, out, "productId", fmt, rows.schema, touched=touched, whole=True, **options)
    assert some.exceptAll(whole.where("productId >= 20")).count() == 0 and some.count() == whole.where("productId >= 20").count()
    fewer = read_folders(spark, out, "productId", fmt, rows.select("day", "productId").schema, whole=True, **options)
    assert fewer.columns == ["day", "productId"] and fewer.count() == 6000
    # a file of another writer: Spark's reader takes them all
    spark.range(3).select(F.lit("o").alias("name")).coalesce(1).write.option("header", True).format(fmt).save(f"{out}/productId=9999")
    assert folders.read_files(spark, out, "productId", fmt, rows.schema, {}) is None
    if fmt != "csv":
        assert read_folders(spark, out, "productId", fmt, rows.schema, whole=True, **options).where("productId = 9999").count() == 3


def test_large_files_of_a_folder_are_read_in_pieces(spark, tmp_dir, monkeypatch):
    from cubelake.plans import folders
    from cubelake.sources.cube_csv import list_files

    rows = spark.range(30_000).select(F.lit(1).cast("bigint").alias("productId"), F.col("id").alias("vectorId"), F.sha2(F.col("id").cast("string"), 256).alias("t"))
    asked = folders.pa.schema([("vectorId", folders.pa.int64()), ("t", folders.pa.string())])
    for fmt in ("parquet", "orc", "csv"):
        out = os.path.join(tmp_dir, fmt)
        split_by_key(spark, rows.coalesce(1), out, "productId", fmt)
        monkeypatch.setattr(folders, "_OUT_BYTES", 10_000)
        monkeypatch.setattr(folders, "_OUT_ROWS", 999)
        n = 0
        for path, size in [(r.path, r.length) for r in list_files(spark, out, f"*.{fmt}").collect()]:
            path = path.removeprefix("file:").replace("//", "/")
            parts = list(folders._lines(path, True) if fmt == "csv" else folders._tables(path, size, fmt, asked))
            assert len(parts) > 1 or fmt == "orc"
            n += sum(len(p) for p in parts)
        assert n == 30_000
        monkeypatch.undo()


def test_merge_rewrites_only_products_that_change(spark, tmp_dir):
    from cubelake.plans.delta_jobs import apply_staged, merge_into_store
    from cubelake.plans.layout import write_keyed
    from cubelake.sources.lake import read_folders

    schema = "productId bigint, vectorId bigint, value double"
    nan = float("nan")
    rows = [(1, 10, 1.0), (1, 11, 2.0), (2, 20, 0.0), (3, 30, nan), (4, 40, None), (5, 50, 5.0), (6, 60, 6.0), (7, 70, None)]
    store, work = os.path.join(tmp_dir, "store"), os.path.join(tmp_dir, "w")
    write_keyed(spark.createDataFrame(rows, schema), store, "productId")
    held = {k: os.listdir(f"{store}/productId={k}") for k in range(1, 8)}
    delta = [(1, 11, 2.5), (2, 20, -0.0), (3, 30, nan), (4, 40, None), (5, 50, 5.0), (6, 61, 1.0), (7, 70, 7.0)]
    for insert in (False, True):
        merge_into_store(spark, store, spark.createDataFrame(delta, schema), insert_new=insert, work=work)
        apply_staged(spark, f"{work}/staged", store)  # once more, as after a failure
        now = {k: os.listdir(f"{store}/productId={k}") for k in range(1, 8)}
        assert {k for k in now if now[k] != held[k]} == ({6} if insert else {1, 2, 7})
        held = now
    got = sorted(str(tuple(r)) for r in read_folders(spark, store, "productId").select("productId", "vectorId", "value").collect())
    want = [(1, 10, 1.0), (1, 11, 2.5), (2, 20, -0.0), (3, 30, nan), (4, 40, None), (5, 50, 5.0), (6, 60, 6.0), (6, 61, 1.0), (7, 70, 7.0)]
    assert got == sorted(str(r) for r in want)
