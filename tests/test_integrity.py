"""Damaged, odd and late input: what must fail alone, and what must come out the same."""

import datetime as dt
import importlib
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from cubelake import schemas as S
from cubelake.functions.columns import power_of_ten, scaled_value
from cubelake.operators.stats import multiset_difference
from cubelake.plans.cube_etl import prepare_cubes
from cubelake.plans.refresh import plan_changed, refresh
from cubelake.sources.archives import unzip_to_landing
from cubelake.sources.delta_csv import read_delta
from cubelake.sources.registry import read_registry

CUBE = "REF_DATE,GEO,VALUE,DECIMALS\n"


def write_zip(path, member, text, damage=False):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as z:
        z.writestr(member, text)
    if damage:
        with open(path, "r+b") as f:
            f.seek(len(text) - 200)
            f.write(b"#")


def test_damaged_archives_publish_nothing(spark, tmp_dir):
    landing, lake, registry = (os.path.join(tmp_dir, x) for x in ("landing", "lake", "registry"))
    os.makedirs(landing)
    body = CUBE + "".join(f"2001,place {k},{k},0\n" for k in range(100_000))  # beyond one read of the copier
    write_zip(f"{landing}/61-eng.zip", "61.csv", body, damage=True)
    write_zip(f"{landing}/62-eng.zip", "62.csv", body)
    with open(f"{landing}/63-eng.zip", "w") as f:
        f.write("no archive")
    write_zip(f"{landing}/64-eng.zip", "other.csv", body)
    with open(f"{landing}/65.csv", "w") as f:
        f.write("x" * 200_000)  # no line feed at all
    with open(f"{landing}/66.csv", "w") as f:
        f.write(CUBE + "2001,A,5,0\n")
    plan = spark.createDataFrame([(k, dt.datetime(2024, 1, 1)) for k in range(61, 68)], "product_id bigint, release_time timestamp")
    status = {r.product_id: r for r in refresh(spark, plan, landing, lake, registry).collect()}
    assert {k: r.ok for k, r in status.items()} == {61: False, 62: True, 63: False, 64: False, 65: False, 66: True, 67: False}
    assert status[61].reason == "bad zip" and status[64].reason == "member missing" and status[67].reason == "not landed"
    assert status[62].rows == 100_000
    assert sorted(os.listdir(lake)) == ["62.parquet", "66.parquet"]
    assert sorted(r.number for r in read_registry(spark, registry).collect()) == [62, 66]


def test_failed_members_leave_nothing_behind(spark, tmp_dir):
    source, landing = os.path.join(tmp_dir, "zips"), os.path.join(tmp_dir, "landing")
    os.makedirs(source)
    write_zip(f"{source}/71.zip", "71.csv", CUBE * 1000, damage=True)
    assert [r.ok for r in unzip_to_landing(spark, source, landing).collect()] == [False]
    assert not os.path.exists(landing) or os.listdir(landing) == []


def test_changed_plan_through_refresh(spark, tmp_dir):
    landing, changes = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "changes")
    os.makedirs(landing)
    os.makedirs(f"{changes}/change_date=2024-03-01")
    with open(f"{changes}/change_date=2024-03-01/list.json", "w") as f:
        f.write('[{"productId": 81, "releaseTime": "2024-03-01T08:30"}, {"productId": 82, "releaseTime": "2024-03-01T08:30"}]')
    for k in (81, 82):
        with open(f"{landing}/{k}.csv", "w") as f:
            f.write(CUBE + "2001,A,5,0\n")
    plan = plan_changed(spark, changes, "2024-03-01", "2024-03-01", skip=[82])
    got = refresh(spark, plan, landing, os.path.join(tmp_dir, "lake"), os.path.join(tmp_dir, "registry")).collect()
    assert [(r.product_id, r.ok, r.rows) for r in got] == [(81, True, 1)]


def test_refresh_plan_never_reaches_the_driver(spark, tmp_dir, monkeypatch):
    from pyspark.sql import functions as F

    landing = os.path.join(tmp_dir, "landing")
    os.makedirs(landing)
    write_zip(f"{landing}/85-eng.zip", "85.csv", CUBE + "2001,A,5,0\n")
    write_zip(f"{landing}/86-eng.zip", "86.csv", CUBE * 1000, damage=True)
    write_zip(f"{landing}/500001-eng.zip", "500001.csv", CUBE)  # not planned
    with open(f"{landing}/87.csv", "w") as f:
        f.write(CUBE + "2001,A,5,0\n2002,A,5,0\n")
    day = F.timestamp_seconds(F.lit(1704067200) + F.col("id"))
    plan = spark.range(300_000).select(F.col("id").alias("product_id"), day.alias("release_time"))
    plan = plan.unionByName(plan.where("product_id = 85").withColumn("release_time", F.lit(dt.datetime(2023, 1, 1))))
    most, frame = [], type(plan)
    collect = frame.collect

    def counted(df):
        rows = collect(df)
        most.append(len(rows))
        return rows

    monkeypatch.setattr(frame, "collect", counted)
    status = refresh(spark, plan, landing, os.path.join(tmp_dir, "lake"), os.path.join(tmp_dir, "registry"))
    assert max(most) < 10
    monkeypatch.undo()
    assert status.count() == 300_000 and status.where("reason = 'not landed' AND NOT ok").count() == 299_997
    got = {r.product_id: (r.ok, r.reason, r.rows, r.release_time) for r in status.where("product_id IN (85, 86, 87)").collect()}
    assert {k: v[:3] for k, v in got.items()} == {85: (True, None, 1), 86: (False, "bad zip", None), 87: (True, None, 2)}
    assert got[85][3] > dt.datetime(2024, 1, 1)  # planned twice: the latest release


def test_odd_files_are_read(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "land ing+%20")
    os.makedirs(landing)
    files = {
        "91 a.CSV": CUBE + "2001,A, 12,0\n2002,B,7 ,0\n",  # blanks around numbers
        "93.csv": "REF_DATE," + "x" * 1_100_000 + "\n2001,1\n",  # a header over a megabyte, a field over the csv limit
    }
    for name, text in files.items():
        with open(os.path.join(landing, name), "w") as f:
            f.write(text)
    lake = os.path.join(tmp_dir, "lake")
    status = {r.product_id: (r.ok, r.rows) for r in prepare_cubes(spark, landing, lake).collect()}
    assert status[91] == (True, 2) and status[93] == (True, 1)
    assert sorted(r.VALUE for r in spark.read.parquet(f"{lake}/91.parquet").collect()) == [7, 12]


def delta_line(value="1.5", vector="5", coordinate="1", released="2024-01-02T08:30", code="0", product="1"):
    return f"{product},{coordinate},{vector},2024-01,,0,0,0,{value},{released},{code},0,6"


def write_delta(path, *lines):
    with open(path, "w") as f:
        f.write("\n".join([",".join(S.DELTA_NAMES), *lines]) + "\n")


def test_delta_nulls_and_strict_numbers(spark, tmp_dir):
    path = os.path.join(tmp_dir, "20240102.csv")
    write_delta(path, *(delta_line(v) for v in ("NaN", "NA", "null", "", "#N/A", " 2.5", "1e3")))
    assert sorted(str(r.value) for r in read_delta(spark, path).collect()) == ["1000.0", "2.5"] + ["None"] * 5
    assert [f.dataType for f in read_delta(spark, path).schema] == [f.dataType for f in S.DELTA_SCHEMA]
    for bad in (delta_line("1d"), delta_line("x"), delta_line(code="256"), delta_line(code="-1"), delta_line(vector="5.5")):
        write_delta(path, bad)
        with pytest.raises(Exception, match="not a valid value|out of uint8 range"):
            read_delta(spark, path).collect()


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 1, 0), (1, 2, 0)])
def test_stream_merge_does_not_depend_on_arrival(spark, tmp_dir, order):
    from cubelake.streaming.delta_stream import ingest_and_merge

    store, landing, state = (os.path.join(tmp_dir, x) for x in ("store", "landing", "state"))
    spark.createDataFrame([(1, 5, 0.0), (2, 5, 0.0)], "productId bigint, vectorId bigint, value double").write.partitionBy(
        "productId"
    ).parquet(store)
    os.makedirs(landing)
    days = [("2024-01-02T08:30", "10"), ("2024-02-02T08:30", "20"), ("2024-01-20T08:30", "15")]
    for k in order:
        name, line = f"2024010{k}", delta_line(days[k][1], released=days[k][0])
        write_delta(f"{landing}/{name}.CSV" if k else f"{tmp_dir}/{name}.csv", line)
        if not k:  # one comes zipped
            write_zip(f"{landing}/{name}.zip", f"{name}.csv", open(f"{tmp_dir}/{name}.csv").read())
        ingest_and_merge(spark, landing, store, state)
    assert sorted((r.productId, r.value) for r in spark.read.parquet(store).collect()) == [(1, 20.0), (2, 0.0)]
    assert not os.path.exists(f"{state}/merge-work/0")


@pytest.mark.parametrize("merge", [False, True])
def test_damaged_archives_end_an_ingest_with_an_error(spark, tmp_dir, merge):
    from cubelake.streaming.delta_stream import DamagedArchives, ingest_and_merge, ingest_deltas

    store, landing, state = (os.path.join(tmp_dir, x) for x in ("store", "landing", "state"))
    if merge:
        one = spark.createDataFrame([(1, 5, 0.0)], "productId bigint, vectorId bigint, value double")
        one.write.partitionBy("productId").parquet(store)
    os.makedirs(landing)
    write_delta(f"{landing}/20240101.csv", delta_line("10"))
    with open(f"{landing}/20240102.zip", "wb") as f:
        f.write(b"no archive")
    with pytest.raises(DamagedArchives, match="20240102.zip") as error:
        (ingest_and_merge if merge else ingest_deltas)(spark, landing, store, state)
    assert [x.reason for x in error.value.archives] == ["bad zip"]
    assert [r.value for r in spark.read.parquet(store).collect()] == [10.0]


def test_negative_power_in_an_integral_cube(spark):
    rows = spark.createDataFrame([(7000, -3)], "v bigint, s bigint")
    assert rows.select(scaled_value("v", "s", False)).first()[0] == 7.0
    assert spark.range(3).select(power_of_ten(F.col("id"), True).alias("p")).agg(F.sum("p")).first()[0] == 111
    with pytest.raises(Exception, match="negative power of ten"):
        rows.select(scaled_value("v", "s", True)).collect()


def test_multiset_difference_of_one_frame(spark):
    rows = spark.createDataFrame([(1, None), (1, None), (2, "b")], "a int, b string")
    assert multiset_difference(rows, rows.where("true")).count() == 0
    got = multiset_difference(rows, rows.distinct()).collect()
    assert [tuple(r) for r in got] == [(1, None, 2, 1)]


def test_stream_keeps_winners_in_few_tables(spark, tmp_dir, monkeypatch):
    """Many batches, an older stream's folders of winners, and a batch that is repeated leave the newest values."""
    from cubelake.plans.delta_jobs import replace_folders

    ds = importlib.import_module("cubelake.streaming.delta_stream")
    store, landing, state = (os.path.join(tmp_dir, x) for x in ("store", "landing", "state"))
    stored = [(k, 5, 0.0) for k in range(1, 5)]
    spark.createDataFrame(stored, "productId bigint, vectorId bigint, value double").write.partitionBy("productId").parquet(store)
    # product 3 has a winner that is newer than all that lands
    old = "productId bigint, coordinate string, vectorId bigint, refPer string, value double, releaseTime string"
    replace_folders(spark.createDataFrame([(3, "c", 5, "2024-01", 33.0, "2025-01-01T08:30")], old), f"{state}/winners")
    monkeypatch.setattr(ds, "WINNER_TABLES", 2)
    os.makedirs(landing)
    for k, (product, day) in enumerate([(1, 5), (2, 3), (1, 4), (3, 9), (1, 6), (2, 2)]):
        line = delta_line(f"{10 * k + 10}", released=f"2024-01-0{day}T08:30").split(",")
        write_delta(f"{landing}/2024010{k}.csv", ",".join([str(product), *line[1:]]))
        ds.ingest_and_merge(spark, landing, store, state)
        names = os.listdir(f"{state}/winner-tables")
        assert len(names) <= 3 and not any("productId=" in n for n in names) and not os.path.exists(f"{state}/winners")
    want = [(1, 50.0), (2, 20.0), (3, 33.0), (4, 0.0)]
    got = lambda: sorted((r.productId, r.value) for r in spark.read.parquet(store).collect())
    assert got() == want
    commits = sorted(os.listdir(f"{state}/commits"))
    for name in commits:  # the last batch was not noted as done
        if name.strip(".").split(".")[0] == "5":
            os.rename(f"{state}/commits/{name}", f"{tmp_dir}/{name}")
    ds.ingest_and_merge(spark, landing, store, state)
    assert got() == want
