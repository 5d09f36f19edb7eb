"""Full-cube ETL: header rules, type rules, layout, failure isolation, zips."""

import os
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cubelake.plans.cube_etl import prepare_cube, prepare_cubes
from cubelake.plans.refresh import refresh
from cubelake.sources.cube_csv import parse_header, strip_junk_prefix, unique_names
from cubelake.sources.lake import read_cube, register_cube

CUBE = (
    '\ufeff"REF_DATE","GEO","DGUID","Sex","UOM_ID","SCALAR_FACTOR","SCALAR_ID","STATUS","Symbol","Symbol",'
    '"VALUE","DECIMALS","TERMINATED","Flag","Day","Stamp"\n'
    '1999-04,"Ontario, ""east""",2016A000235,Males,81,units,0,,,x,12,0,,true,1999-04-01,1999-04-01 10:00\n'
    "2001-01,Quebec,,Both sexes,81,units,0,..,,,,0,,False,2001-01-01,2001-01-01T11:30\n"
    "2002-01,Quebec,,Females,NA,units,0,,,,7,0,,TRUE,2002-01-01,2002-01-01 00:00\n"
)


def _land(root, name, text):
    os.makedirs(root, exist_ok=True)
    with open(os.path.join(root, name), "w", encoding="utf-8") as f:
        f.write(text)


def test_header_rules():
    assert strip_junk_prefix("\u00ef\u00bb\u00bfREF_DATE,GEO") == "REF_DATE,GEO"
    assert strip_junk_prefix("\ufeff\"REF_DATE\"") == '"REF_DATE"'
    assert unique_names(["A", "Symbol", "Symbol", "Symbol", "Symbol.1"]) == ["A", "Symbol", "Symbol.1", "Symbol.2", "Symbol.1.1"]
    assert parse_header('\ufeff"REF_DATE","a,b",c') == ["REF_DATE", "a,b", "c"]


def test_prepare_types_and_values(spark, tmp_dir):
    land = os.path.join(tmp_dir, "landing")
    _land(land, "14100287.csv", CUBE)
    lake = os.path.join(tmp_dir, "lake")
    status = prepare_cubes(spark, land, lake).collect()
    assert [(s.product_id, s.ok, s.layout, s.rows) for s in status] == [(14100287, True, "flat", 3)]
    cube = read_cube(spark, lake, 14100287)
    types = {f.name: f.dataType for f in cube.schema.fields}
    assert types["REF_DATE"] == T.StringType()
    assert types["UOM_ID"] == T.LongType()  # "NA" is a null spelling
    assert types["SCALAR_FACTOR"] == T.StringType()
    assert types["VALUE"] == T.LongType()  # max(DECIMALS) == 0
    assert types["DECIMALS"] == T.LongType()
    assert types["Flag"] == T.BooleanType()
    assert types["Day"] == T.DateType()
    assert types["Stamp"] == T.TimestampType()
    assert types["Symbol.1"] == T.StringType() and types["STATUS"] == T.StringType()
    assert types["TERMINATED"] == T.StringType()
    assert types["year"] == T.IntegerType()
    rows = sorted(cube.collect(), key=lambda r: r.REF_DATE)
    assert rows[0].GEO == 'Ontario, "east"' and rows[0].year == 1999
    assert rows[0].STATUS == "" and rows[1].STATUS == ".."  # empty text stays ''
    assert rows[1].VALUE is None and rows[2].UOM_ID is None


def test_value_double_when_decimals(spark, tmp_dir):
    land = os.path.join(tmp_dir, "landing")
    _land(land, "10100001.csv", "REF_DATE,GEO,VALUE,DECIMALS\n1999,Canada,2,1\n2000,Canada,,1\n")
    _land(land, "10100002.csv", "REF_DATE,GEO,VALUE,DECIMALS\n1999,Canada,2,0\n2000,Canada,1.5,0\n")
    _land(land, "10100003.csv", "REF_DATE,GEO,VALUE\n1999,Canada,2\n")  # no DECIMALS: inferred
    _land(land, "98100001.csv", "REF_DATE,GEO,Other\n2016,Canada,x\n")  # the 98 series: no VALUE
    status = {s.product_id: s for s in prepare_cubes(spark, land, os.path.join(tmp_dir, "lake")).collect()}
    lake = os.path.join(tmp_dir, "lake")
    assert read_cube(spark, lake, 10100001).schema["VALUE"].dataType == T.DoubleType()
    assert not status[10100002].ok and "VALUE" in status[10100002].reason  # 1.5 is not integral
    assert read_cube(spark, lake, 10100003).schema["VALUE"].dataType == T.LongType()
    assert status[98100001].ok


def test_ragged_cube_fails_alone(spark, tmp_dir):
    land = os.path.join(tmp_dir, "landing")
    _land(land, "1.csv", "REF_DATE,GEO,VALUE,DECIMALS\n1999,A,1,0\n2000,A\n")
    _land(land, "2.csv", "REF_DATE,GEO,VALUE,DECIMALS\n1999,A,1,0\n2000,A,1,0,extra\n")
    _land(land, "3.csv", "REF_DATE,GEO,VALUE,DECIMALS\n1999,A,1,0\n")
    _land(land, "4.csv", "GEO,VALUE\nA,1\n")
    status = {s.product_id: s for s in prepare_cubes(spark, land, os.path.join(tmp_dir, "lake")).collect()}
    assert not status[1].ok and status[1].reason.startswith("malformed")
    assert not status[2].ok and status[2].reason.startswith("malformed")
    assert status[3].ok
    assert not status[4].ok and "REF_DATE" in status[4].reason


def test_size_adaptive_layout(spark, tmp_dir):
    land = os.path.join(tmp_dir, "landing")
    body = "".join(f"{1990 + i % 20},GEO{i},{i},0\n" for i in range(3000))
    _land(land, "5.csv", "REF_DATE,GEO,VALUE,DECIMALS\n" + body)
    _land(land, "6.csv", "REF_DATE,GEO,VALUE,DECIMALS\n1999,A,1,0\n")
    lake = os.path.join(tmp_dir, "lake")
    status = {s.product_id: s for s in prepare_cubes(spark, land, lake, threshold=8 * 1024).collect()}
    assert status[5].layout == "partitioned" and os.path.isdir(os.path.join(lake, "5.parquet", "year=1990"))
    assert status[6].layout == "flat"
    big = read_cube(spark, lake, 5)
    assert big.count() == 3000 and big.schema["year"].dataType == T.IntegerType()
    plan = big.where("year = 1995")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    register_cube(spark, lake, 6, "small_cube")
    assert spark.sql("SELECT year FROM small_cube").first().year == 1999


def test_multi_part_cube_and_zip(spark, tmp_dir):
    land = os.path.join(tmp_dir, "landing")
    _land(os.path.join(land, "7"), "part-0.csv", "REF_DATE,GEO,VALUE,DECIMALS\n1999,A,1,0\n")
    _land(os.path.join(land, "7"), "part-1.csv", "\ufeffREF_DATE,GEO,VALUE,DECIMALS\n2000,B,2,0\n")
    status = prepare_cubes(spark, land, os.path.join(tmp_dir, "lake")).collect()
    assert status[0].ok and status[0].rows == 2

    csv_path = os.path.join(tmp_dir, "10100001.csv")
    _land(tmp_dir, "10100001.csv", "REF_DATE,GEO,VALUE,DECIMALS\n1999,A,1,0\n")
    z = os.path.join(tmp_dir, "zips", "10100001-eng.zip")
    os.makedirs(os.path.dirname(z))
    with zipfile.ZipFile(z, "w") as zf:
        zf.write(csv_path, "10100001.csv")
        zf.writestr("10100001_MetaData.csv", "x")
    out = os.path.join(tmp_dir, "one.parquet")
    st = prepare_cube(spark, z, out, work=os.path.join(tmp_dir, "w")).collect()
    assert st[0].ok and spark.read.parquet(out).count() == 1
    bad = os.path.join(tmp_dir, "zips2", "10100009-eng.zip")
    os.makedirs(os.path.dirname(bad))
    open(bad, "wb").write(b"not a zip")
    st = prepare_cube(spark, bad, os.path.join(tmp_dir, "bad.parquet"), work=os.path.join(tmp_dir, "w2")).collect()
    assert not st[0].ok and st[0].reason == "bad zip"


def test_refresh_isolates_failures_and_registers(spark, tmp_dir):
    import datetime as dt

    from cubelake.sources.registry import read_registry

    land = os.path.join(tmp_dir, "landing")
    _land(land, "1.csv", "REF_DATE,GEO,VALUE,DECIMALS\n1999,A,1,0\n")
    _land(land, "2.csv", "REF_DATE,GEO,VALUE,DECIMALS\n1999,A\n")
    plan = spark.createDataFrame([(1, dt.datetime(2023, 1, 1)), (2, dt.datetime(2023, 1, 1)), (3, dt.datetime(2023, 1, 1))],
                                 "product_id bigint, release_time timestamp")
    reg = os.path.join(tmp_dir, "registry")
    status = {r.product_id: r for r in refresh(spark, plan, land, os.path.join(tmp_dir, "lake"), reg).collect()}
    assert status[1].ok and not status[2].ok and status[3].reason == "not landed"
    assert [r.number for r in read_registry(spark, reg).collect()] == [1]


def test_refresh_twice_plans_nothing(spark, tmp_dir):
    import json

    from cubelake.plans.refresh import plan_refresh

    land = os.path.join(tmp_dir, "landing")
    for pid in (21, 22, 23):
        _land(land, f"{pid}.csv", "REF_DATE,GEO,VALUE,DECIMALS\n1999,A,1,0\n")
    catalog = os.path.join(tmp_dir, "catalog.json")
    with open(catalog, "w") as f:
        json.dump([{"productId": p, "releaseTime": "2023-08-01T12:30"} for p in (21, 22, 23)], f)
    reg, lake = os.path.join(tmp_dir, "registry"), os.path.join(tmp_dir, "lake")
    first = plan_refresh(spark, catalog, reg)
    assert sorted(r.product_id for r in first.collect()) == [21, 22, 23]
    status = refresh(spark, first, land, lake, reg).collect()
    assert all(s.ok for s in status)
    assert plan_refresh(spark, catalog, reg).count() == 0
    with open(catalog, "w") as f:  # one product gets a newer release
        json.dump([{"productId": 22, "releaseTime": "2023-09-01T12:30"}], f)
    assert [r.product_id for r in plan_refresh(spark, catalog, reg).collect()] == [22]


def test_status_schema_reads_back(spark, tmp_dir):
    land = os.path.join(tmp_dir, "landing")
    _land(land, "31.csv", CUBE)
    body = "".join(f"{1990 + i % 5},G{i},{i},0\n" for i in range(3000))
    _land(land, "32.csv", "REF_DATE,GEO,VALUE,DECIMALS\n" + body)
    lake = os.path.join(tmp_dir, "lake")
    status = {s.product_id: s for s in prepare_cubes(spark, land, lake, threshold=12 * 1024).collect()}
    assert status[31].layout == "flat" and status[32].layout == "partitioned"
    for pid, st in status.items():
        inferred = read_cube(spark, lake, pid)
        given = read_cube(spark, lake, pid, st.schema)
        assert given.schema == inferred.schema
        assert sorted(map(str, given.collect())) == sorted(map(str, inferred.collect()))


def test_header_only_cube_publishes_empty_table(spark, tmp_dir):
    land = os.path.join(tmp_dir, "landing")
    _land(land, "51.csv", "REF_DATE,GEO,VALUE,DECIMALS\n")
    _land(land, "52.csv", "REF_DATE,GEO,VALUE,DECIMALS\n1999,A,1,0\n")
    lake = os.path.join(tmp_dir, "lake")
    status = {s.product_id: s for s in prepare_cubes(spark, land, lake).collect()}
    assert status[51].ok and status[51].rows == 0 and status[52].ok
    empty = read_cube(spark, lake, 51)
    assert empty.count() == 0 and "VALUE" in empty.columns


def test_csv_folder_takes_every_spelling_of_the_ending(spark, tmp_dir):
    from cubelake.plans.csv_folder import transform_csv_folder

    line = "REF_DATE,VALUE,SCALAR_ID,DECIMALS,UOM_ID,SCALAR_FACTOR\n2020,5,1,0,1,units\n"
    for name in ("x.CSV", "y.csv", "z.Csv"):
        with open(os.path.join(tmp_dir, name), "w") as f:
            f.write(line)
    rows = transform_csv_folder(spark, tmp_dir).collect()
    assert [(os.path.basename(r.path), r.ok, r.rows) for r in rows] == [("x.CSV", True, 1), ("y.csv", True, 1), ("z.Csv", True, 1)]
    assert spark.read.parquet(os.path.join(tmp_dir, "x.parquet")).first().VALUE == 50


def test_the_csv_is_parsed_once(spark, tmp_dir, monkeypatch):
    from cubelake.plans import cube_etl

    calls = []
    read = cube_etl.read_cube_text
    monkeypatch.setattr(cube_etl, "read_cube_text", lambda *a: calls.append(a) or read(*a))
    for pid, value in ((1, "5"), (2, "5.5"), (3, "x")):  # three kinds of types
        with open(os.path.join(tmp_dir, f"{pid}.csv"), "w") as f:
            f.write(f"REF_DATE,GEO,NOTE\n2020-01,a,{value}\n2021-01,b,{value}\n")
    status = cube_etl.prepare_cubes(spark, tmp_dir, os.path.join(tmp_dir, "lake"), work=os.path.join(tmp_dir, "work")).collect()
    assert [r.ok for r in status] == [True] * 3 and len(calls) == 1
    assert not [n for n in os.listdir(os.path.join(tmp_dir, "work")) if n.startswith("parsed")]


def test_masks_are_those_of_the_guards(spark):
    from cubelake.functions.typing import CANDIDATES, guard, type_mask

    values = """0 1 +1 -1 007 9223372036854775807 9223372036854775808 1. .5 1.5 1.5e-3 1e5 1500-1 2020-01-01 2020-02-30
        2020-01-01T10:00 2020-01-01T25:00 2020-01-01T10:00:00.5Z 2020-01 true False y 1d NaN -Infinity 0x10 1,000 - . + e5 1.2.3""".split()
    values += [" 5 ", "\t5", "5\n", "2020-01-01 10:00", "", "1 2", "٣"]
    rows = spark.createDataFrame([(v,) for v in values], "v string")
    flags = [F.coalesce(guard(F.col("v"), t), F.lit(False)).alias(t) for t in CANDIDATES]
    for r in rows.select("v", type_mask(F.col("v")).alias("mask"), *flags).collect():
        if r["mask"] is not None:  # null spellings have none
            assert r["mask"] == sum(r[t] << i for i, t in enumerate(CANDIDATES)), r
