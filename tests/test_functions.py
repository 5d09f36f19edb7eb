"""Scalar functions, JSON rows, envelopes, value scaling."""

import json
import os

import pytest
from pyspark.sql import functions as F

from cubelake.functions import digits_only, ref_year, url_basename
from cubelake.functions.typing import guard
from cubelake.operators.scaling import scale_cube_value
from cubelake.sources.archives import member_for, read_envelopes
from cubelake.sources.json_rows import read_json_rows


def test_member_rules():
    assert member_for("14100287-eng.zip", "digits") == "14100287.csv"
    assert member_for("20230803.ZIP", "stem") == "20230803.csv"


def test_scalar_functions(spark):
    df = spark.createDataFrame([("1999-04", "https://h/n1/tbl/csv/14100287-eng.zip?x=1", "t1410a0287.zip")], "r string, u string, n string")
    r = df.select(ref_year("r").alias("y"), url_basename("u").alias("b"), digits_only("n").alias("d")).first()
    assert (r.y, r.b, r.d) == ("1999", "14100287-eng.zip", "14100287")


@pytest.mark.parametrize(
    "text,kind,ok",
    [
        ("12", "bigint", True), ("-3", "bigint", True), ("1.5", "bigint", False), ("1d", "double", False),
        ("1e3", "double", True), (".5", "double", True), ("1999-04", "date", False), ("1999-04-01", "date", True),
        ("y", "boolean", False), ("TRUE", "boolean", True), ("1999-04-01T10:00", "timestamp", True),
        ("1999-04-01", "timestamp", False), ("99999999999999999999", "bigint", False),
    ],
)
def test_type_guards(spark, text, kind, ok):
    df = spark.createDataFrame([(text,)], "c string")
    assert df.select(guard(F.col("c"), kind).alias("g")).first().g is ok


def test_scale_value_integral_and_fractional(spark):
    df = spark.createDataFrame([(5, 3, 0, 1, "u", "x"), (None, 1, 0, 1, "u", "y")],
                               "VALUE bigint, SCALAR_ID bigint, DECIMALS bigint, UOM_ID bigint, SCALAR_FACTOR string, GEO string")
    out = scale_cube_value(df)
    assert out.columns == ["SCALAR_ID", "GEO", "VALUE"]
    assert [r.VALUE for r in out.collect()] == [5000, None]
    with pytest.raises(KeyError):
        scale_cube_value(df.drop("UOM_ID"))


def test_json_rows(spark, tmp_dir):
    for i, rows in enumerate([[["NAME", "state"], ["Maine", "23"]], [["NAME", "state"], ["Ohio", "39"], ["Utah", "49"]]]):
        with open(os.path.join(tmp_dir, f"r{i}.json"), "w") as f:
            json.dump(rows, f)
    got = sorted(tuple(r) for r in read_json_rows(spark, tmp_dir).collect())
    assert got == [("Maine", "23"), ("Ohio", "39"), ("Utah", "49")]


def test_json_rows_header_mismatch(spark, tmp_dir):
    for i, rows in enumerate([[["A"], ["1"]], [["B"], ["2"]]]):
        with open(os.path.join(tmp_dir, f"r{i}.json"), "w") as f:
            json.dump(rows, f)
    with pytest.raises(Exception, match="different headers"):
        read_json_rows(spark, tmp_dir).collect()


def test_envelopes(spark, tmp_dir):
    p = os.path.join(tmp_dir, "env.json")
    with open(p, "w") as f:
        f.write(json.dumps({"status": "SUCCESS", "object": "https://h/n1/tbl/csv/17100009-eng.zip"}) + "\n")
        f.write(json.dumps({"status": "FAILED", "object": "https://h/n1/tbl/csv/17100010-eng.zip"}) + "\n")
    got = {r.product_id: (r.ok, r.file_name) for r in read_envelopes(spark, p).collect()}
    assert got == {17100009: (True, "17100009-eng.zip"), 17100010: (False, "17100010-eng.zip")}


def test_delta_file_name():
    import datetime as dt

    from cubelake.functions.columns import delta_file_name

    assert delta_file_name(dt.date(2023, 8, 3)) == "20230803.zip"
    assert delta_file_name("20230803") == "20230803.zip"
    for bad in ("2023-08-03", "2023083", "abcdefgh"):
        with pytest.raises(ValueError):
            delta_file_name(bad)


def test_type_mask_matches_guards(spark):
    from cubelake.functions.typing import CANDIDATES, type_mask

    samples = ["12", "-3", "+7", "0", "1", "1.5", ".5", "1e3", "1d", "1999-04", "1999-04-01", "1999-02-30",
               "1999-04-01T10:00", "1999-04-01 10:00:05", "TRUE", "false", "y", "abc", "", "NA", "1.2.3",
               "99999999999999999999", "-", "+.", "2001/2002", " 5"]
    df = spark.createDataFrame([(s,) for s in samples], "c string")
    exprs = [type_mask(F.col("c")).alias("m")] + [guard(F.col("c"), t).alias(t) for t in CANDIDATES]
    for r in df.select("c", *exprs).collect():
        if r.m is None:
            continue
        expected = sum(1 << i for i, t in enumerate(CANDIDATES) if r[t])
        assert r.m == expected, r.c
