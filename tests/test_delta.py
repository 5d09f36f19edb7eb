"""Delta files: read, split, merge (parity and keyed), streaming ingest."""

import os
import zipfile

import pytest
from pyspark.sql import functions as F

from cubelake import schemas as S
from cubelake.operators.merge import merge_values
from cubelake.operators.stats import multiset_difference
from cubelake.plans.delta_jobs import merge_delta, split_delta
from cubelake.sources.delta_csv import read_delta
from cubelake.streaming.delta_stream import current_table, ingest_deltas

HEADER = ",".join(S.DELTA_NAMES)
ROWS = [
    "880001,1.1.1,111,2023-06-01,,0,0,0,12.5,2023-07-15T08:30,0,1,6",
    "880001,1.1.2,112,2023-06-01,,0,0,0,,2023-07-15T08:30,3,1,6",
    '880001,"1.2,1",113,2023-06-01,,1,0,0,7,2023-07-15T08:30,0,0,6',
    "880002,1.1,200,2023-04-01,,0,0,0,39000000,2023-07-15T08:30,6,0,9",
]


def _write(path, lines):
    with open(path, "w", newline="") as f:
        f.write("\n".join([HEADER] + lines) + "\n")


def test_read_delta_schema_and_blanks(spark, tmp_dir):
    p = os.path.join(tmp_dir, "20230715.csv")
    _write(p, ROWS)
    df = read_delta(spark, p)
    assert [f.name for f in df.schema.fields] == S.DELTA_NAMES
    rows = df.collect()
    assert rows[0].refPer2 == ""  # empty text stays text
    assert rows[1].value is None  # empty number is null
    assert rows[2].coordinate == "1.2,1"


def test_read_delta_uint8_range_checked(spark, tmp_dir):
    p = os.path.join(tmp_dir, "bad.csv")
    _write(p, ["1,1,1,2023-01-01,,300,0,0,1.0,2023-07-15T08:30,0,0,6"])
    with pytest.raises(Exception, match="uint8"):
        read_delta(spark, p).collect()


def test_split_single_product(spark, tmp_dir):
    p = os.path.join(tmp_dir, "20240102.csv")
    rows = [f"77,9.{k},{900 + k % 2},2024-01-01,,0,0,0,{v},2024-01-02T08:30,0,0,6" for k, v in enumerate(("", "3", "NA"))]
    _write(p, rows + rows[:1])
    out = os.path.join(tmp_dir, "split")
    split_delta(spark, p, out)
    assert [d for d in os.listdir(out) if "=" in d] == ["productId=77"]
    assert multiset_difference(read_delta(spark, p), spark.read.schema(S.DELTA_SCHEMA).parquet(out)).count() == 0


@pytest.mark.parametrize("zipped", [True, False])
def test_split_many_products_same_set_and_count(spark, tmp_dir, zipped):
    csv_path = os.path.join(tmp_dir, "20230803.csv")
    _write(csv_path, ROWS)
    src = csv_path
    if zipped:
        src = os.path.join(tmp_dir, "20230803.zip")
        with zipfile.ZipFile(src, "w") as zf:
            zf.write(csv_path, "20230803.csv")
    out = os.path.join(tmp_dir, "split")
    os.makedirs(out)  # an existing empty target is accepted
    split_delta(spark, src, out, work=os.path.join(tmp_dir, "work"))
    back = spark.read.parquet(out)
    assert {r.productId for r in back.select("productId").distinct().collect()} == {880001, 880002}
    assert back.count() == len(ROWS)


def test_split_refuses_non_empty_target(spark, tmp_dir):
    p = os.path.join(tmp_dir, "d.csv")
    _write(p, ROWS)
    out = os.path.join(tmp_dir, "split")
    os.makedirs(out)
    open(os.path.join(out, "x"), "w").close()
    with pytest.raises(FileExistsError):
        split_delta(spark, p, out)


def _stored(spark):
    return spark.createDataFrame(
        [(1, 10, "2023-01", 1.0), (1, 10, "2023-02", 2.0), (1, 11, "2023-01", 3.0), (2, 20, "2023-01", 4.0)],
        "productId bigint, vectorId bigint, refPer string, value double",
    )


def _delta(spark):
    return spark.createDataFrame(
        [
            (10, "2023-02", "c", 20.0, "2023-07-01T08:30"),
            (10, "2023-02", "c", 21.0, "2023-07-02T08:30"),  # later release wins
            (11, "2023-01", "c", None, "2023-07-01T08:30"),  # null overwrites
            (99, "2023-01", "c", 9.0, "2023-07-01T08:30"),  # not stored
            (10, "2023-03", "c", 30.0, "2023-07-01T08:30"),
        ],
        "vectorId bigint, refPer string, coordinate string, value double, releaseTime string",
    )


def test_merge_parity_vector_only(spark):
    got = sorted(tuple(r) for r in merge_values(_stored(spark), _delta(spark)).collect())
    # every period of vector 10 takes the winner (2023-07-02 release, 21.0)
    assert got == [(1, 10, "2023-01", 21.0), (1, 10, "2023-02", 21.0), (1, 11, "2023-01", None), (2, 20, "2023-01", 4.0)]


def test_merge_keyed_with_and_without_insert(spark):
    keyed = merge_values(_stored(spark), _delta(spark), keys=("vectorId", "refPer"))
    assert sorted(tuple(r) for r in keyed.collect()) == [
        (1, 10, "2023-01", 1.0), (1, 10, "2023-02", 21.0), (1, 11, "2023-01", None), (2, 20, "2023-01", 4.0)
    ]
    ins = merge_values(_stored(spark), _delta(spark), keys=("vectorId", "refPer"), insert_new=True)
    got = [tuple(r) for r in ins.collect()]
    assert (None, 99, "2023-01", 9.0) in got and (None, 10, "2023-03", 30.0) in got
    assert len(got) == 6


def test_merge_is_idempotent_and_keeps_count(spark):
    once = merge_values(_stored(spark), _delta(spark))
    twice = merge_values(once, _delta(spark))
    assert once.count() == _stored(spark).count()
    assert multiset_difference(once, twice).count() == 0


def test_merge_delta_files(spark, tmp_dir):
    orig = os.path.join(tmp_dir, "orig.parquet")
    delta = os.path.join(tmp_dir, "delta.parquet")
    new = os.path.join(tmp_dir, "new.parquet")
    _stored(spark).write.parquet(orig)
    _delta(spark).write.parquet(delta)
    merge_delta(spark, orig, delta, new)
    assert spark.read.parquet(new).where("vectorId = 11").first().value is None


def test_stream_ingest_exactly_once(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    os.makedirs(landing)
    _write(os.path.join(landing, "20230715.csv"), ROWS[:2])
    store, ckpt = os.path.join(tmp_dir, "store"), os.path.join(tmp_dir, "ckpt")
    ingest_deltas(spark, landing, store, ckpt)
    assert spark.read.parquet(store).count() == 2
    ingest_deltas(spark, landing, store, ckpt)  # nothing new
    assert spark.read.parquet(store).count() == 2
    _write(os.path.join(landing, "20230716.csv"), ROWS[2:])
    ingest_deltas(spark, landing, store, ckpt)
    assert spark.read.parquet(store).count() == 4
    stored = spark.createDataFrame([(880001, 111, "x", 0.0)], "productId bigint, vectorId bigint, coordinate string, value double")
    assert current_table(spark, stored, store).first().value == 12.5


def test_merge_into_store_touches_only_delta_products(spark, tmp_dir):
    from cubelake.plans.delta_jobs import merge_into_store

    store = os.path.join(tmp_dir, "store")
    _stored(spark).write.partitionBy("productId").parquet(store)
    untouched = sorted(os.listdir(os.path.join(store, "productId=2")))
    delta = _delta(spark).where("vectorId IN (10, 11)").withColumn("productId", F.lit(1).cast("bigint"))
    merge_into_store(spark, store, delta, work=os.path.join(tmp_dir, "w"))
    assert sorted(os.listdir(os.path.join(store, "productId=2"))) == untouched
    got = sorted((r.productId, r.vectorId, r.refPer, r.value) for r in spark.read.parquet(store).collect()
                 if r.value is not None)
    assert got == [(1, 10, "2023-01", 21.0), (1, 10, "2023-02", 21.0), (2, 20, "2023-01", 4.0)]
    assert spark.read.parquet(store).count() == 4


def test_stream_merge_on_write(spark, tmp_dir):
    from cubelake.streaming.delta_stream import ingest_and_merge

    store = os.path.join(tmp_dir, "store")
    spark.createDataFrame(
        [(880001, 111, "2023-06-01", 0.0), (880001, 112, "2023-06-01", 0.0), (880002, 200, "2023-04-01", 0.0),
         (5, 5, "2023-01-01", 5.0)],
        "productId bigint, vectorId bigint, refPer string, value double",
    ).write.partitionBy("productId").parquet(store)
    landing = os.path.join(tmp_dir, "landing")
    os.makedirs(landing)
    _write(os.path.join(landing, "20230715.csv"), ROWS[:2])
    ckpt = os.path.join(tmp_dir, "ckpt")
    ingest_and_merge(spark, landing, store, ckpt, keys=("vectorId", "refPer"))
    _write(os.path.join(landing, "20230716.csv"), ROWS[3:])
    ingest_and_merge(spark, landing, store, ckpt, keys=("vectorId", "refPer"))
    ingest_and_merge(spark, landing, store, ckpt, keys=("vectorId", "refPer"))  # nothing new
    got = {r.vectorId: r.value for r in spark.read.parquet(store).collect()}
    assert got == {111: 12.5, 112: None, 200: 39000000.0, 5: 5.0}


def test_merge_insert_skips_null_keys(spark):
    delta = _delta(spark).unionByName(
        spark.createDataFrame([(None, "2023-01", "c", 1.0, "2023-07-01T08:30")],
                              "vectorId bigint, refPer string, coordinate string, value double, releaseTime string")
    )
    got = merge_values(_stored(spark), delta, keys=("vectorId", "refPer"), insert_new=True).collect()
    assert len(got) == 6 and all(r.vectorId is not None for r in got)


def test_merge_keeps_non_value_columns(spark):
    stored = _stored(spark)
    merged = merge_values(stored, _delta(spark))
    cols = [c for c in stored.columns if c != "value"]
    assert multiset_difference(stored.select(*cols), merged.select(*cols)).count() == 0
