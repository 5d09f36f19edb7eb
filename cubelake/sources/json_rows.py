"""Array-of-arrays JSON responses: row 0 holds column names, the rest records.

Each file is one response (``[["NAME","state"],["Maine","23"], ...]``) and
is parsed by one task; responses are bounded by the service's page size.
All values stay text, as given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _docs(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.option("wholetext", True).text(path).select(
        F.from_json("value", "array<array<string>>").alias("doc")
    )


def read_json_rows(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All records of all responses under ``path`` as a text table.

    Column names come from the header row of the first response; every other
    response must carry the same header, otherwise the read fails.
    """
    docs = _docs(spark, path)
    first = docs.select(F.col("doc")[0].alias("h")).where(F.col("h").isNotNull()).first()
    if first is None:
        return spark.createDataFrame([], "value string")
    names = list(first["h"])
    header = F.array(*[F.lit(n) for n in names])
    checked = docs.select(
        F.when(F.col("doc")[0] == header, F.col("doc")).otherwise(
            F.raise_error(F.lit("json rows: responses have different headers"))
        ).alias("doc")
    )
    rows = checked.select(F.posexplode("doc").alias("pos", "row")).where(F.col("pos") > 0)
    return rows.select(*[F.col("row")[i].alias(n) for i, n in enumerate(names)])
