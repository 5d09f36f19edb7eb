"""Catalog, changed lists, registry, freshness and refresh planning."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from cubelake.operators.freshness import freshness_diff, latest_release, refresh_plan
from cubelake.sources.catalog import read_catalog, read_changed, read_changed_on
from cubelake.sources.registry import append_registry, ensure_registry, latest_registry, read_registry

CATALOG = [
    {"productId": 501, "cubeTitleEn": "a", "releaseTime": "2019-02-03T04:05", "subjectCode": ["10"], "corrections": []},
    {"productId": 502, "cubeTitleEn": "b", "releaseTime": "2021-11-12T06:07", "subjectCode": ["10"], "corrections": []},
    {"productId": "503", "cubeTitleEn": "c", "releaseTime": "2020-10-09T08:10", "subjectCode": [], "corrections": []},
    {"productId": 504, "cubeTitleEn": "d", "releaseTime": "2018-01-30T11:45", "subjectCode": ["10"], "corrections": []},
    {"productId": 505, "cubeTitleEn": "é", "releaseTime": "2024-05-06T23:59", "subjectCode": ["10"], "corrections": []},
]
EXPECTED = [
    (501, dt.datetime(2019, 2, 3, 4, 5)),
    (502, dt.datetime(2021, 11, 12, 6, 7)),
    (503, dt.datetime(2020, 10, 9, 8, 10)),
    (504, dt.datetime(2018, 1, 30, 11, 45)),
    (505, dt.datetime(2024, 5, 6, 23, 59)),
]


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_catalog_compact_array(spark, tmp_dir):
    path = os.path.join(tmp_dir, "catalog.json")
    with open(path, "w") as f:
        json.dump(CATALOG, f)
    got = [(r.product_id, r.release_time) for r in read_catalog(spark, path).collect()]
    assert got == EXPECTED  # order of the response kept, no dedup


def test_catalog_pretty_printed(spark, tmp_dir):
    path = os.path.join(tmp_dir, "catalog.json")
    with open(path, "w") as f:
        json.dump(CATALOG, f, indent=2)
    got = [(r.product_id, r.release_time) for r in read_catalog(spark, path, multi_line=True).collect()]
    assert got == EXPECTED


def _write_changes(root, days):
    for day, records in days.items():
        d = os.path.join(root, f"change_date={day}")
        os.makedirs(d)
        with open(os.path.join(d, "list.json"), "w") as f:
            json.dump(records, f)


def test_changed_range_inclusive_and_latest(spark, tmp_dir):
    root = os.path.join(tmp_dir, "changed")
    _write_changes(root, {
        "2023-08-01": [{"productId": 1, "releaseTime": "2023-08-01T08:30"}, {"productId": 2, "releaseTime": "2023-08-01T08:30"}],
        "2023-08-02": [],
        "2023-08-03": [{"productId": 1, "releaseTime": "2023-08-03T08:30"}, {"productId": 1, "releaseTime": "2023-08-03T08:30"}],
        "2023-08-04": [{"productId": 3, "releaseTime": "2023-08-04T08:30"}],
    })
    got = read_changed(spark, root, "2023-08-01", "2023-08-03")
    assert got.count() == 4  # both ends inclusive, duplicates kept
    latest = [(r.product_id, r.release_time) for r in latest_release(got).collect()]
    assert latest == [(1, dt.datetime(2023, 8, 3, 8, 30)), (2, dt.datetime(2023, 8, 1, 8, 30))]
    assert read_changed(spark, root, "2023-08-04", "2023-08-01").count() == 0  # start after end
    assert read_changed_on(spark, root, dt.date(2023, 8, 4)).count() == 1
    plan = got.where(F.col("change_date") == "2023-08-02")
    assert plan.count() == 0  # an empty day


def test_changed_range_prunes_partitions(spark, tmp_dir):
    root = os.path.join(tmp_dir, "changed")
    _write_changes(root, {"2023-08-01": [{"productId": 1, "releaseTime": "2023-08-01T08:30"}]})
    plan = read_changed(spark, root, "2023-08-01", "2023-08-01")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(change_date" in plan


def test_registry_latest_and_freshness(spark, tmp_dir):
    reg_path = os.path.join(tmp_dir, "registry")
    ensure_registry(spark, reg_path)
    assert read_registry(spark, reg_path).count() == 0
    t = lambda s: dt.datetime.fromisoformat(s)
    b1 = spark.createDataFrame([(1, t("2023-01-01 00:00")), (2, t("2023-01-01 00:00")), (3, t("2023-03-01 00:00"))],
                               "product_id bigint, release_time timestamp")
    append_registry(spark, reg_path, b1, created_at=F.lit("2023-05-01 00:00:00").cast("timestamp"))
    b2 = spark.createDataFrame([(1, t("2023-02-01 00:00"))], "product_id bigint, release_time timestamp")
    append_registry(spark, reg_path, b2, created_at=F.lit("2023-06-01 00:00:00").cast("timestamp"))
    latest = {r.number: r.release_time for r in latest_registry(read_registry(spark, reg_path)).collect()}
    assert latest == {1: t("2023-02-01 00:00"), 2: t("2023-01-01 00:00"), 3: t("2023-03-01 00:00")}

    catalog = spark.createDataFrame(
        [(1, t("2023-02-01 00:00")), (2, t("2023-04-01 00:00")), (3, t("2023-02-01 00:00")), (4, t("2023-01-01 00:00"))],
        "product_id bigint, release_time timestamp",
    )
    diff = sorted(r.product_id for r in freshness_diff(catalog, read_registry(spark, reg_path)).collect())
    assert diff == [2, 4]  # 1 equal (fresh), 3 older (fresh), 2 newer, 4 missing


def test_refresh_plan_limit_then_skip(spark):
    t = dt.datetime(2023, 1, 1)
    catalog = spark.createDataFrame([(i, t) for i in range(10, 0, -1)], "product_id bigint, release_time timestamp")
    registry = spark.createDataFrame([], "number bigint, release_time timestamp, is_uploaded boolean, created_at timestamp, updated_at timestamp")
    plan = refresh_plan(catalog, registry, start_from=3, max_products=4, skip=[4, 9])
    assert [r.product_id for r in plan.collect()] == [3, 5, 6]  # 3,4,5,6 planned; 4 skipped after the limit
    unlimited = refresh_plan(catalog, registry, start_from=0, max_products=0)
    assert unlimited.count() == 10
