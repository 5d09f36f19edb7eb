"""A log of numbered entries beside the data they are about.

An entry is a small file of JSON lines, named by its number. It is written
with put-if-absent, so two writers never share a number, and nothing is ever
renamed or changed. What readers see is decided by the entries alone: data
that no entry names does not exist for them, so a writer can crash at any
point before its entry is there without anyone noticing.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cubelake import fs


def entry_path(log: str, number: int) -> str:
    return f"{log.rstrip('/')}/{number:020d}.json"


def last_entry(spark: SparkSession, log: str) -> int:
    """The greatest number so far, 0 for a log without entries (one listing)."""
    names = fs.list_names(spark, log)
    return max((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()), default=0)


def commit(
    spark: SparkSession, log: str, rows: Iterable[dict], after: int, passed: Callable[[int], None] | None = None
) -> int:
    """Append an entry of ``rows`` with the first free number above ``after``; returns the number.

    ``after`` is the last entry the writer has seen. ``passed`` is called
    with each number that someone else has taken meanwhile and raises if that
    entry forbids this one. An entry without rows is a line ``{}``.
    """
    text = "".join(json.dumps(r, default=str) + "\n" for r in rows) or "{}\n"
    number = after + 1
    while not fs.put_if_absent(spark, entry_path(log, number), text):
        if passed:
            passed(number)
        number += 1
    return number


def read_entries(spark: SparkSession, log: str, schema: str) -> DataFrame:
    """The rows of all entries, with the number of each (``entry``)."""
    if not last_entry(spark, log):
        return spark.createDataFrame([], f"{schema}, entry long")
    number = F.regexp_extract("_metadata.file_name", r"^([0-9]+)", 1).cast("long")
    return spark.read.schema(schema).json(log).withColumn("entry", number)
