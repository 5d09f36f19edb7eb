"""

``entry(spark)`` runs the flagship query (an analytic read of a published,
year-partitioned cube) on sf0.001. ``queries()`` maps every registered
operator query to a callable ``(spark, sf_dir) -> DataFrame``;
``oracle_sql()`` gives the equivalent DuckDB SQL over the driver's tables.
Queries that SQL cannot express have no oracle; their tests hold them against
brute force.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from cubelake.registered import QUERIES, cube_filter  # noqa: E402

try:  # the subpackage may be absent; whatever else goes wrong in it is an error
    import cubelake.llm  # noqa: F401
except ImportError:
    _LLM_QUERIES, _LLM_ORACLE = {}, {}
else:
    from corpus_pipeline import ORACLE_SQL as _PIPELINE_SQL  # noqa: E402
    from corpus_pipeline import run as _pipeline  # noqa: E402
    from cubelake.llm.queries import ORACLE as _LLM_ORACLE  # noqa: E402
    from cubelake.llm.queries import QUERIES as _LLM_QUERIES  # noqa: E402

    _LLM_QUERIES = {**_LLM_QUERIES, "pipeline": _pipeline}
    _LLM_ORACLE = {**_LLM_ORACLE, **({"pipeline": _PIPELINE_SQL} if _PIPELINE_SQL else {})}

SMOKE_DIR = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    return cube_filter(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**QUERIES, **_LLM_QUERIES}


# Shared SQL pieces -----------------------------------------------------------

_BRAND = "CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS BIGINT)"

# Latest delta row per vectorId: releaseTime, refPer, coordinate, then value.
_EVENT_WINNERS = """
    SELECT user_id AS vectorId, value,
           row_number() OVER (
               PARTITION BY user_id
               ORDER BY strftime(ts, '%Y-%m-%dT%H:%M') DESC, strftime(ts, '%Y-%m-%d') DESC,
                        event_type DESC, value DESC NULLS LAST) AS rn
    FROM events
"""

_MERGE_VECTOR = f"""
    WITH w AS (SELECT * FROM ({_EVENT_WINNERS}) WHERE rn = 1)
    SELECT CAST(c.c_nationkey AS BIGINT) AS productId, c.c_custkey AS vectorId,
           c.c_name AS coordinate, c.c_mktsegment AS refPer,
           CASE WHEN w.vectorId IS NOT NULL THEN w.value ELSE c.c_acctbal END AS value
    FROM customer c LEFT JOIN w ON w.vectorId = c.c_custkey
"""

_PERIOD_ORIGINAL = """
    SELECT user_id AS productId, user_id AS vectorId, strftime(ts, '%Y-%m-%d') AS refPer,
           arg_max(event_type, ts) AS coordinate, arg_max(value, ts) AS value
    FROM events WHERE event_type <> 'purchase'
    GROUP BY user_id, strftime(ts, '%Y-%m-%d')
"""

_PERIOD_WINNERS = """
    SELECT * FROM (
        SELECT user_id AS productId, user_id AS vectorId, strftime(ts, '%Y-%m-%d') AS refPer,
               event_type AS coordinate, value,
               row_number() OVER (
                   PARTITION BY user_id, strftime(ts, '%Y-%m-%d')
                   ORDER BY strftime(ts, '%Y-%m-%dT%H:%M') DESC, event_type DESC,
                            value DESC NULLS LAST) AS rn
        FROM events WHERE event_type = 'purchase')
    WHERE rn = 1
"""

_PERIOD_MERGED = f"""
    SELECT o.productId, o.vectorId, o.refPer, o.coordinate,
           CASE WHEN w.vectorId IS NOT NULL THEN w.value ELSE o.value END AS value
    FROM ({_PERIOD_ORIGINAL}) o
    LEFT JOIN ({_PERIOD_WINNERS}) w ON w.vectorId = o.vectorId AND w.refPer = o.refPer
"""

_ORDERS_DIFF = """
    WITH cat AS (SELECT o_custkey AS product_id, max(o_orderdate) AS release_time
                 FROM orders GROUP BY o_custkey),
         reg AS (SELECT o_custkey AS number, max(o_orderdate) AS release_time
                 FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey)
    SELECT cat.product_id, cat.release_time
    FROM cat LEFT JOIN reg ON reg.number = cat.product_id
    WHERE reg.number IS NULL OR cat.release_time > reg.release_time
"""

_LINEITEM_CUBE = """
    SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%d') AS REF_DATE,
           l_returnflag AS GEO, l_linestatus AS Sex, l_extendedprice AS VALUE,
           CAST(year(l_shipdate) AS INTEGER) AS year
    FROM lineitem
"""

_ORACLE = {
    "cube_filter": f"""
        SELECT * FROM ({_LINEITEM_CUBE})
        WHERE GEO IN ('A', 'R') AND Sex <> 'F' AND year > 1996
    """,
    "year_equals": f"SELECT * FROM ({_LINEITEM_CUBE}) WHERE year = 1998",
    "cube_sql": f"""
        SELECT GEO, Sex, year, COUNT(*) AS n_rows, MIN(VALUE) AS min_value, MAX(VALUE) AS max_value
        FROM ({_LINEITEM_CUBE})
        WHERE year >= 1996 AND Sex <> 'O'
        GROUP BY GEO, Sex, year
    """,
    "split_counts": """
        SELECT CAST(user_id AS BIGINT) AS productId, COUNT(*) AS n_rows,
               COUNT(DISTINCT strftime(ts, '%Y-%m-%d')) AS n_periods,
               MIN(strftime(ts, '%Y-%m-%d')) AS first_period,
               MAX(strftime(ts, '%Y-%m-%d')) AS last_period,
               COUNT(*) FILTER (WHERE value IS NULL) AS n_null_values
        FROM events GROUP BY user_id
    """,
    "delta_zip_split": """
        SELECT CAST(user_id AS BIGINT) AS productId, COUNT(*) AS n_rows,
               COUNT(DISTINCT strftime(ts, '%Y-%m-%d')) AS n_periods,
               MIN(strftime(ts, '%Y-%m-%d')) AS first_period,
               MAX(strftime(ts, '%Y-%m-%d')) AS last_period,
               COUNT(*) FILTER (WHERE value IS NULL) AS n_null_values
        FROM events GROUP BY user_id
    """,
    "split_multiset": """
        SELECT 'input_rows' AS measure, COUNT(*) AS n FROM events
        UNION ALL SELECT 'split_rows' AS measure, COUNT(*) AS n FROM events
        UNION ALL SELECT 'unmatched_rows' AS measure, CAST(0 AS BIGINT) AS n
    """,
    "merge_vector": _MERGE_VECTOR,
    "merge_vector_period": _PERIOD_MERGED,
    "merge_store": _PERIOD_MERGED,
    "merge_vector_period_insert": f"""
        {_PERIOD_MERGED}
        UNION ALL
        SELECT w.productId, w.vectorId, w.refPer, w.coordinate, w.value
        FROM ({_PERIOD_WINNERS}) w
        WHERE NOT EXISTS (SELECT 1 FROM ({_PERIOD_ORIGINAL}) o
                          WHERE o.vectorId = w.vectorId AND o.refPer = w.refPer)
    """,
    "scale_delta": """
        SELECT CAST(user_id AS BIGINT) AS vectorId, strftime(ts, '%Y-%m-%dT%H:%M') AS releaseTime,
               CAST(event_id % 4 AS SMALLINT) AS scalarFactorCode,
               COALESCE(value, 0.0) * power(10.0, CAST(event_id % 4 AS DOUBLE)) AS scaled_value
        FROM events
    """,
    "stream_merge": _MERGE_VECTOR,
    "stream_merge_store": _PERIOD_MERGED,
    "freshness_diff": f"""
        SELECT product_id, strftime(release_time, '%Y-%m-%d %H:%M:%S') AS release_time
        FROM ({_ORDERS_DIFF})
    """,
    "refresh_plan": f"""
        SELECT product_id, strftime(release_time, '%Y-%m-%d %H:%M:%S') AS release_time
        FROM (SELECT * FROM ({_ORDERS_DIFF}) WHERE product_id >= 100
              ORDER BY product_id, release_time LIMIT 50)
        WHERE product_id NOT IN (105, 110, 120)
    """,
    "changed_latest": """
        SELECT o_custkey AS product_id,
               strftime(max(o_orderdate), '%Y-%m-%d') || ' 08:30:00' AS release_time
        FROM orders
        WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-03-01' AND DATE '1999-06-30'
        GROUP BY o_custkey
    """,
    "changed_on_day": """
        SELECT o_custkey AS product_id,
               strftime(o_orderdate, '%Y-%m-%d') || ' 08:30:00' AS release_time
        FROM orders
        WHERE CAST(o_orderdate AS DATE) = DATE '1998-08-02'
    """,
    "catalog_json": """
        SELECT o_orderkey AS product_id, strftime(o_orderdate, '%Y-%m-%d') || ' 12:30:00' AS release_time
        FROM orders
    """,
    "registry_latest": """
        WITH r AS (
            SELECT o_custkey AS number, o_orderdate AS release_time,
                   TIMESTAMP '2024-01-01 00:00:00' AS created_at
            FROM orders WHERE o_orderstatus = 'F'
            UNION ALL
            SELECT o_custkey, o_orderdate, TIMESTAMP '2024-02-01 00:00:00'
            FROM orders WHERE o_orderstatus = 'O'
            UNION ALL
            SELECT o_custkey, o_orderdate, TIMESTAMP '2024-03-01 00:00:00'
            FROM orders WHERE o_orderstatus = 'P'),
        w AS (SELECT *, row_number() OVER (PARTITION BY number
                                           ORDER BY created_at DESC, release_time DESC) AS rn
              FROM r)
        SELECT number, strftime(release_time, '%Y-%m-%d %H:%M:%S') AS release_time,
               strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at
        FROM w WHERE rn = 1
    """,
    "value_kind": f"""
        SELECT {_BRAND} AS product_id, MAX({_BRAND} % 2) AS max_decimals,
               CASE WHEN MAX({_BRAND} % 2) > 0 THEN 'double' ELSE 'bigint' END AS value_type,
               COUNT(*) AS n_rows
        FROM part GROUP BY {_BRAND}
    """,
    "scale_value": """
        SELECT p_partkey, CAST(p_partkey % 4 AS BIGINT) AS SCALAR_ID,
               CAST(p_size AS BIGINT) * CAST(power(10, p_partkey % 4) AS BIGINT) AS VALUE
        FROM part
    """,
    "csv_folder_scaled": """
        SELECT p_partkey, p_name AS GEO, CAST(p_partkey % 4 AS BIGINT) AS SCALAR_ID,
               CAST(p_size AS BIGINT) * CAST(power(10, p_partkey % 4) AS BIGINT) AS VALUE
        FROM part
    """,
    "typed_cube": f"""
        SELECT {_BRAND} AS product_id,
               CAST(1980 + p_size AS VARCHAR) || '-' || lpad(CAST(p_partkey % 12 + 1 AS VARCHAR), 2, '0') AS REF_DATE,
               p_name || ', "' || p_type || '"' AS GEO,
               '' AS DGUID, '' AS Symbol,
               CASE WHEN p_size > 40 THEN p_type ELSE '' END AS "Symbol.1",
               CASE WHEN p_size < 5 THEN '..' ELSE '' END AS STATUS,
               CAST(p_size % 3 AS BIGINT) AS UOM_ID, CAST(0 AS BIGINT) AS SCALAR_ID,
               CASE WHEN {_BRAND} % 2 = 1 THEN p_retailprice ELSE CAST(p_size AS DOUBLE) END AS VALUE,
               {_BRAND} % 2 AS DECIMALS,
               CASE WHEN p_size % 10 = 0 THEN NULL ELSE CAST(p_size AS BIGINT) END AS NOTE,
               p_size % 2 = 0 AS FLAG,
               CAST(DATE '2000-01-01' + CAST(p_partkey AS INTEGER) AS DATE) AS DAY,
               CAST(1980 + p_size AS INTEGER) AS year,
               CASE WHEN {_BRAND} % 2 = 1 THEN 'double' ELSE 'bigint' END AS value_type
        FROM part
    """,
    "large_cube": """
        SELECT CAST(year(l_shipdate) AS INTEGER) AS year, l_returnflag AS GEO, l_linestatus AS Sex,
               COUNT(*) AS n_rows, MIN(l_extendedprice) AS min_value, MAX(l_extendedprice) AS max_value,
               COUNT(DISTINCT l_orderkey) AS n_orders
        FROM lineitem GROUP BY ALL
    """,
    "refresh_status": f"""
        SELECT {_BRAND} AS product_id, {_BRAND} <> 13 AS ok,
               CASE WHEN {_BRAND} = 13 THEN 'malformed' END AS reason_kind,
               COUNT(*) AS rows
        FROM part GROUP BY {_BRAND}
    """,
    "json_rows": """
        SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
               CAST(c_nationkey AS VARCHAR) AS c_nationkey,
               CAST(CAST(c_acctbal AS DECIMAL(15, 2)) AS VARCHAR) AS c_acctbal, c_mktsegment
        FROM customer
    """,
    "zip_ingest": """
        SELECT CAST(1000 + c_custkey // 500 AS BIGINT) AS product_id, c_custkey, c_name,
               c_nationkey, c_acctbal, c_mktsegment
        FROM customer
    """,
}


_ORACLE["typed_cube_partitioned"] = _ORACLE["typed_cube"]

_ORACLE["layout_choice"] = f"""
    SELECT {_BRAND} AS product_id, TRUE AS ok, COUNT(*) AS rows, TRUE AS layout_agrees FROM part GROUP BY {_BRAND}
"""

# Part cubes landed as zips: 13 has a wrong checksum, 21 is no archive, 22 a file without a line feed.
_ZIP_STATUS = f"""
    SELECT {_BRAND} AS product_id, {_BRAND} NOT IN (13, 21, 22) AS ok,
           CASE WHEN {_BRAND} IN (13, 21) THEN 'bad zip' WHEN {_BRAND} = 22 THEN 'no REF_DATE column' END AS reason,
           CASE WHEN {_BRAND} NOT IN (13, 21, 22) THEN COUNT(*) END AS rows
    FROM part GROUP BY {_BRAND}
"""
_ORACLE["refresh_zip_status"] = f"SELECT *, ok AS registered FROM ({_ZIP_STATUS})"
_ORACLE["refresh_counts"] = f"""
    SELECT COUNT(*) FILTER (WHERE ok) AS succeeded, COUNT(*) AS planned FROM ({_ZIP_STATUS})
"""
_ORACLE["changed_refresh"] = f"""
    SELECT c.product_id, COALESCE(z.ok, FALSE) AS ok,
           CASE WHEN z.product_id IS NULL THEN 'not landed' ELSE z.reason END AS reason, z.rows, c.release_time
    FROM ({_ORACLE["changed_latest"]}) c LEFT JOIN ({_ZIP_STATUS}) z ON z.product_id = c.product_id
    WHERE c.product_id <> 11
"""
_ORACLE["delta_nulls"] = """
    SELECT CAST(user_id AS BIGINT) AS vectorId, event_type AS coordinate,
           strftime(ts, '%Y-%m-%dT%H:%M') AS releaseTime, CAST(event_id % 4 AS SMALLINT) AS scalarFactorCode,
           CASE WHEN event_id % 7 > 3 THEN value END AS value
    FROM events
"""
_ORACLE["split_formats"] = """
    SELECT format, CAST(user_id AS BIGINT) AS productId, COUNT(*) AS n_rows, COUNT(value) AS n_values,
           MAX(strftime(ts, '%Y-%m-%dT%H:%M')) AS latest
    FROM events, (VALUES ('csv'), ('json'), ('orc')) f(format) GROUP BY format, user_id
"""
_ORACLE["stream_merge_late"] = f"""
    SELECT o.productId, o.vectorId, o.refPer, o.coordinate,
           CASE WHEN w.vectorId IS NOT NULL THEN w.value ELSE o.value END AS value
    FROM ({_PERIOD_ORIGINAL}) o
    LEFT JOIN (SELECT user_id AS vectorId, value, row_number() OVER (
                   PARTITION BY user_id
                   ORDER BY strftime(ts, '%Y-%m-%dT%H:%M') DESC, strftime(ts, '%Y-%m-%d') DESC,
                            event_type DESC, value DESC NULLS LAST) AS rn
               FROM events WHERE event_type = 'purchase') w
           ON w.vectorId = o.vectorId AND w.rn = 1
"""
_ORACLE["stream_compaction"] = """
    SELECT CAST(user_id AS BIGINT) AS productId, COUNT(*) AS rows_before, COUNT(*) AS rows_after,
           TRUE AS same_sum, TRUE AS fewer_files
    FROM events GROUP BY user_id
"""
_ORACLE["merge_indexed"] = f"""
    SELECT CAST(CASE WHEN o.vectorId % 4 = 0 THEN o.vectorId ELSE 0 END AS BIGINT) AS productId,
           o.vectorId, o.refPer, o.coordinate,
           CASE WHEN w.vectorId IS NOT NULL THEN w.value ELSE o.value END AS value
    FROM ({_PERIOD_ORIGINAL}) o
    LEFT JOIN ({_PERIOD_WINNERS}) w ON w.vectorId = o.vectorId AND w.refPer = o.refPer AND w.vectorId % 25 = 1
"""
_ORACLE["publish_versions"] = f"""
    WITH p AS (SELECT {_BRAND} AS product_id, p_size FROM part),
         r AS (SELECT product_id, p_size, '2024-01-01 08:30:00' AS release_time FROM p WHERE p_size <= 25
               UNION ALL
               SELECT product_id, p_size, '2024-03-01 08:30:00' FROM p WHERE product_id % 2 = 0
               UNION ALL
               SELECT product_id, p_size, '2024-02-01 08:30:00' FROM p WHERE product_id % 5 = 0 AND p_size > 10),
         b AS (SELECT *, max(release_time) OVER (PARTITION BY product_id) AS newest FROM r)
    SELECT product_id, release_time, COUNT(*) AS n_rows, CAST(SUM(p_size) AS BIGINT) AS sum_size
    FROM b WHERE release_time = newest GROUP BY product_id, release_time
"""


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in _ORACLE.items() if k in QUERIES} | _LLM_ORACLE
