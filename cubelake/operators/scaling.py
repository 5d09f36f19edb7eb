"""Value scaling of full cubes and delta rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cubelake import schemas as S
from cubelake.functions.columns import scaled_delta_value, scaled_value


def drop_existing(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drop columns that must exist (Spark's ``drop`` ignores unknown names)."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    return df.drop(*columns)


def scale_cube_value(df: DataFrame) -> DataFrame:
    """``VALUE := VALUE * 10 ** SCALAR_ID``, dropping DECIMALS, UOM_ID,
    SCALAR_FACTOR and the old VALUE; the new VALUE is the last column.

    Integral VALUE columns stay BIGINT; fractional ones DOUBLE.
    """
    missing = [c for c in [S.SCALAR_ID_COLUMN, *S.SCALE_DROP_COLUMNS] if c not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    integral = isinstance(df.schema[S.VALUE_COLUMN].dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType))
    new_value = scaled_value(F.col(S.VALUE_COLUMN), F.col(S.SCALAR_ID_COLUMN), integral)
    out = df.withColumn("_scaled_value", new_value)
    out = drop_existing(out, S.SCALE_DROP_COLUMNS)
    return out.withColumnRenamed("_scaled_value", S.VALUE_COLUMN)


def scale_delta_value(df: DataFrame, into: str = "scaled_value") -> DataFrame:
    """Optional delta helper: empty value as 0.0, times ``10 ** scalarFactorCode``."""
    return df.withColumn(into, scaled_delta_value(F.col("value"), F.col("scalarFactorCode")))
