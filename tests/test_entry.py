"""Driver contract: entry() smoke, query/oracle registry shape, a few oracle checks."""

import duckdb
import pytest

import __spark_entry__ as E
from cubelake.registered import QUERIES

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"l_orderkey", "l_linenumber", "REF_DATE", "GEO", "Sex", "VALUE", "year"}


def test_every_query_has_an_oracle():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert set(QUERIES) <= set(o)


def test_flagship_plan_prunes_and_pushes(spark):
    plan = E.entry(spark)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert "In(GEO, [A,R])" in plan and "Not(EqualTo(Sex,F))" in plan


def _duck():
    con = duckdb.connect()
    for t in ["customer", "part", "orders", "lineitem", "events"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", ["merge_vector_period_insert", "refresh_plan", "typed_cube", "json_rows"])
def test_against_oracle(spark, name):
    df = E.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(str(r[c]) for c in cols) for r in df.collect())
    res = _duck().execute(E.oracle_sql()[name])
    names = [d[0] for d in res.description]
    want = sorted(tuple(str(r[names.index(c)]) for c in cols) for r in res.fetchall())
    assert sorted(names) == cols
    assert got == want
