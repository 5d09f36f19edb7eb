"""The commit log, versioned publishing, and the indexed store."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from cubelake import fs
from cubelake import schemas as S
from cubelake.operators.freshness import freshness_diff
from cubelake.operators.merge import merge_values
from cubelake.operators.stats import multiset_difference
from cubelake.plans import indexed_store as store_
from cubelake.plans import versions
from cubelake.sources.commit_log import commit, last_entry, read_entries
from cubelake.sources.registry import latest_registry
from cubelake.streaming.delta_stream import current_compacted, delta_rows, ingest_compacted

ROWS = "productId long, vectorId long, refPer string, releaseTime string, value double"


# ------------------------------------------------------------------ log


def test_put_if_absent_has_one_winner(spark, tmp_dir):
    wins = []

    def put(k):
        if fs.put_if_absent(spark, f"{tmp_dir}/log/1.json", f"{k}"):
            wins.append(k)

    threads = [threading.Thread(target=put, args=(k,)) for k in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(wins) == 1 and open(f"{tmp_dir}/log/1.json").read() == str(wins[0])
    assert os.listdir(f"{tmp_dir}/log") == ["1.json"] or not [n for n in os.listdir(f"{tmp_dir}/log") if n.endswith(".part")]


def test_entries_take_the_next_number(spark, tmp_dir):
    log = f"{tmp_dir}/log"
    assert last_entry(spark, log) == 0 and read_entries(spark, log, "a long").count() == 0
    assert commit(spark, log, [{"a": 1}], 0) == 1
    met = []
    assert commit(spark, log, [{"a": 2}, {"a": 3}], 0, met.append) == 2 and met == [1]

    def refuse(number):
        raise RuntimeError(number)

    with pytest.raises(RuntimeError):
        commit(spark, log, [{"a": 4}], 1, refuse)
    assert sorted(map(tuple, read_entries(spark, log, "a long").collect())) == [(1, 1), (2, 2), (3, 2)]


# ------------------------------------------------------------- versions


def _cubes(spark, n, scale):
    return spark.range(n * 3).select((F.col("id") % n).alias("product_id"), (F.col("id") * scale).alias("v"))


def _publish(spark, lake, rows, release):
    written = [r.asDict() for r in versions.write_release(spark, lake, rows).collect()]
    return versions.publish_versions(spark, lake, [{**w, "release_time": release} for w in written])


def test_a_publish_is_seen_whole_or_not_at_all(spark, tmp_dir):
    lake = f"{tmp_dir}/la ke"
    assert versions.current_versions(spark, lake).count() == 0
    _publish(spark, lake, _cubes(spark, 4, 1), "2024-01-01 08:30:00")

    def seen():
        rows = versions.read_versions(spark, lake, "v long")
        sums = {r[0]: r[1] for r in rows.groupBy("product_id").agg(F.sum("v")).collect()}
        registry = latest_registry(versions.version_registry(spark, lake)).collect()
        return sums, {r["number"]: str(r["release_time"]) for r in registry}

    before = seen()
    # a crash after the data is written, at any point before the entry
    written = versions.write_release(spark, lake, _cubes(spark, 4, 10).where("product_id < 2")).collect()
    assert seen() == before
    versions.publish_versions(spark, lake, [{**r.asDict(), "release_time": "2024-02-01 08:30:00"} for r in written])
    sums, releases = seen()
    assert sums == {0: 120, 1: 150, 2: 18, 3: 21}
    assert releases[0] == releases[1] == "2024-02-01 08:30:00" and releases[2] == "2024-01-01 08:30:00"
    assert versions.read_version(spark, lake, 0, entry=1).agg(F.sum("v")).first()[0] == 12


def test_a_late_old_release_hides_nothing(spark, tmp_dir):
    lake = f"{tmp_dir}/lake"
    _publish(spark, lake, _cubes(spark, 2, 5), "2024-03-01 00:00:00")
    _publish(spark, lake, _cubes(spark, 2, 1), "2024-01-01 00:00:00")
    assert versions.read_version(spark, lake, 0).agg(F.sum("v")).first()[0] == 30
    catalog = spark.createDataFrame([(0, "2024-03-01 00:00:00"), (1, "2024-04-01 00:00:00")], "product_id long, t string")
    due = freshness_diff(
        catalog.select("product_id", F.col("t").cast("timestamp").alias("release_time")),
        latest_registry(versions.version_registry(spark, lake).drop("created_at").withColumn("created_at", F.col("release_time"))),
    )
    assert [r.product_id for r in due.collect()] == [1]


def test_staged_folder_and_vacuum(spark, tmp_dir):
    lake, staged = f"{tmp_dir}/lake", f"{tmp_dir}/staged"
    spark.range(5).select(F.col("id").alias("v"), (F.col("id") + 2000).cast("string").alias("year")).write.partitionBy("year").parquet(staged)
    for release in ("2024-01-01 00:00:00", "2024-02-01 00:00:00"):
        folder = versions.stage_copy(spark, staged, lake, 7)
        versions.publish_versions(spark, lake, [{"product_id": 7, "folder": folder, "release_time": release, "rows": 5}])
    versions.stage_copy(spark, staged, lake, 7)  # crashed
    assert versions.read_version(spark, lake, 7).where("year > 2002").count() == 2
    assert versions.read_versions(spark, lake, "v long").count() == 5
    assert versions.vacuum(spark, lake) == 2 and versions.vacuum(spark, lake) == 0
    assert versions.read_version(spark, lake, 7).count() == 5
    with pytest.raises(LookupError):
        versions.read_version(spark, lake, 8)


# -------------------------------------------------------- indexed store


@pytest.fixture()
def small_files(monkeypatch):
    monkeypatch.setattr(store_, "FILE_ROWS", 200)


def _hot(spark):
    """3,000 series of a hot product and 40 small products."""
    hot = spark.range(3000).select(F.lit(1).cast("long").alias("productId"), F.col("id").alias("vectorId"))
    small = spark.range(400).select((F.col("id") % 40 + 100).alias("productId"), (F.col("id") + 50_000).alias("vectorId"))
    rows = hot.unionByName(small)
    return rows.select("*", F.lit("2024-01").alias("refPer"), F.lit("2024-01-01T08:30").alias("releaseTime"), F.col("vectorId").cast("double").alias("value"))


def _delta(spark, rows):
    return spark.createDataFrame([(p, v, "2024-01", t, x) for p, v, t, x in rows], ROWS)


def test_a_merge_rewrites_only_files_with_touched_keys(spark, tmp_dir, small_files):
    store = f"{tmp_dir}/store"
    rows = _hot(spark)
    store_.create_store(spark, store, rows)
    before = {r.file for r in store_.live_files(spark, store).collect()}
    assert len(before) >= 17
    delta = _delta(spark, [(1, 5, "a", 1.5), (1, 5, "b", 2.5), (1, 2900, "a", None), (100, 50_000, "a", 3.0), (1, 99_999, "a", 4.0), (2, 5, "a", 9.0)])
    store_.merge_rows(spark, store, delta, rows.schema)
    after = {r.file for r in store_.live_files(spark, store).collect()}
    assert len(before - after) <= 3
    wanted = merge_values(rows, delta, ("productId", "vectorId"))
    assert [r[0] for r in multiset_difference(store_.read_store(spark, store, rows.schema), wanted).limit(1).collect()] == []
    one = store_.read_store(spark, store, rows.schema, product=100)
    assert one.count() == 10 and len(one.inputFiles()) < len(after)


def test_a_merge_inserts_what_no_file_holds(spark, tmp_dir, small_files):
    store = f"{tmp_dir}/store"
    rows = _hot(spark)
    store_.create_store(spark, store, rows)
    delta = _delta(spark, [(1, 5, "a", 1.5), (1, 99_999, "a", 4.0), (900, 7, "a", 9.0), (None, 7, "a", 1.0)])
    store_.merge_rows(spark, store, delta, rows.schema, insert_new=True)
    wanted = merge_values(rows, delta, ("productId", "vectorId"), insert_new=True)
    assert multiset_difference(store_.read_store(spark, store, rows.schema), wanted).isEmpty()
    store_.merge_rows(spark, store, _delta(spark, [(3, 3, "a", 1.0)]), rows.schema)  # matches nothing
    assert multiset_difference(store_.read_store(spark, store, rows.schema), wanted).isEmpty()


def test_filters_have_no_false_negatives(spark, tmp_dir, small_files):
    store = f"{tmp_dir}/store"
    rows = _hot(spark)
    store_.create_store(spark, store, rows)
    name = F.regexp_extract("_metadata.file_path", r"([0-9a-f]{32}/[^/]+)$", 1)
    held = store_.read_store(spark, store, rows.schema).select("productId", "vectorId", name.alias("file")).collect()
    for r in held[::701]:
        found = store_.touched_files(spark, store, spark.createDataFrame([(r.productId, r.vectorId)], "productId long, vectorId long"), 1)
        assert r.file in {f.file for f in found.collect()}
    absent = spark.createDataFrame([(1, v) for v in range(3000, 3400)], "productId long, vectorId long")
    assert store_.touched_files(spark, store, absent, 1).count() <= 5  # by ranges and filters, nearly none


def test_compaction_keeps_the_rows(spark, tmp_dir, small_files):
    store = f"{tmp_dir}/store"
    rows = _hot(spark)
    for k in range(6):
        store_.append_rows(spark, store, rows.where(F.col("vectorId") % 6 == k), batch=f"b{k}")
    store_.append_rows(spark, store, rows, batch="b3")  # a replay
    before = store_.live_files(spark, store).count()
    entry = store_.compact(spark, store, rows.schema, small_rows=10_000)
    assert store_.live_files(spark, store).count() < before
    assert multiset_difference(store_.read_store(spark, store, rows.schema), rows).isEmpty()
    assert store_.live_files(spark, store, entry - 1).count() == before  # as it was
    store_.snapshot(spark, store)
    assert multiset_difference(store_.read_store(spark, store, rows.schema), rows).isEmpty()
    store_.append_rows(spark, store, rows, batch="b3")
    assert store_.read_store(spark, store, rows.schema).count() == rows.count()


def test_writers_that_meet(spark, tmp_dir, small_files, monkeypatch):
    store = f"{tmp_dir}/store"
    rows = _hot(spark)
    store_.create_store(spark, store, rows)
    seen = last_entry(spark, store_.log_path(store))
    store_.append_rows(spark, store, rows.limit(1))  # someone appends meanwhile
    monkeypatch.setattr(store_, "last_entry", lambda *_: seen)
    assert store_.compact(spark, store, rows.schema, small_rows=10_000) == 3  # in the way of nobody
    with pytest.raises(store_.ConcurrentChange):
        store_.compact(spark, store, rows.schema, small_rows=10_000)  # would take away the same files
    with pytest.raises(store_.ConcurrentChange):
        store_.merge_rows(spark, store, _delta(spark, [(1, 5, "a", 1.0)]), rows.schema)
    assert store_.read_store(spark, store, rows.schema, product=1).count() >= 3000


def test_stream_into_a_compacted_store(spark, tmp_dir):
    landing, store, state = (os.path.join(tmp_dir, n) for n in ("landing", "store", "state"))
    os.makedirs(landing)
    header = ",".join(S.DELTA_NAMES)

    def land(day, rows):
        lines = [f"{p},1.1,{v},2023-06-01,,0,0,0,{x},2023-07-{day}T08:30,0,1,6" for p, v, x in rows]
        with open(os.path.join(landing, f"202307{day}.csv"), "w") as f:
            f.write("\n".join([header, *lines]) + "\n")

    for day in range(10, 18):
        land(day, [(p, p * 10 + k, day + k) for p in (1, 2, 3) for k in range(5)])
    ingest_compacted(spark, landing, store, state, max_files_per_trigger=1, compact_files=4)
    assert delta_rows(spark, store).count() == 120 and store_.live_files(spark, store).count() < 8
    ingest_compacted(spark, landing, store, state)  # nothing new
    land(18, [(1, 10, 99)])
    ingest_compacted(spark, landing, store, state)
    assert delta_rows(spark, store).count() == 121
    stored = spark.createDataFrame([(1, 10, "x", 0.0), (9, 9, "x", 1.0)], "productId long, vectorId long, coordinate string, value double")
    assert {r.vectorId: r.value for r in current_compacted(spark, stored, store).collect()} == {10: 99.0, 9: 1.0}
