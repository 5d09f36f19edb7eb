"""Daily delta files: one CSV covering many cubes, 13 fixed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cubelake import schemas as S
from cubelake.functions.columns import blank_if_null, in_uint8_range, is_null_spelling
from cubelake.functions.typing import guard, plain_int


#: The file as it is read: every column as text.
DELTA_TEXT_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in S.DELTA_NAMES])

#: Reader options shared by the batch and the stream.
DELTA_OPTIONS = {
    "header": "true",
    "enforceSchema": "true",
    "escape": '"',
    "encoding": "UTF-8",
    "mode": "FAILFAST",
    "maxCharsPerColumn": "-1",
}


def type_delta(text: DataFrame, check_uint8: bool = True, blank_strings: bool = True) -> DataFrame:
    """Delta columns from their text, strictly.

    A null spelling is null in a number column and text in a text column.
    Text that is no literal of the column's type, or an unsigned 8-bit value
    out of range, raises when the data is read; no extra pass is made.
    """
    cols = []
    for field in S.DELTA_SCHEMA.fields:
        c = F.col(field.name)
        if isinstance(field.dataType, T.StringType):
            cols.append((blank_if_null(c) if blank_strings else c).alias(field.name))
            continue
        kind = "double" if isinstance(field.dataType, T.DoubleType) else "bigint"
        value = c.try_cast(kind)
        valid = F.coalesce(guard(c, kind), F.lit(False))
        if kind == "bigint":  # nearly every value; a pattern costs several times as much
            valid = plain_int(c) | valid
        wrong = F.raise_error(F.concat(F.lit(f"{field.name} not a valid value: "), c)).cast(kind)
        typed = value
        if check_uint8 and field.name in S.UINT8_COLUMNS:
            beyond = F.raise_error(F.concat(F.lit(f"{field.name} out of uint8 range: "), c)).cast(kind)
            typed = F.when(in_uint8_range(value), value).otherwise(beyond)
        typed = F.when(is_null_spelling(c), F.lit(None).cast(kind)).when(valid, typed).otherwise(wrong)
        cols.append(typed.cast(field.dataType).alias(field.name))
    return text.select(*cols)


def read_delta(
    spark: SparkSession,
    path: str | list[str],
    check_uint8: bool = True,
    blank_strings: bool = True,
) -> DataFrame:
    """Read delta CSVs; the header line is skipped and names go by position.

    Malformed rows fail the read (as in the source); values are typed by
    ``type_delta``. ``blank_strings`` keeps empty text as ``''``.
    """
    text = spark.read.schema(DELTA_TEXT_SCHEMA).options(**DELTA_OPTIONS).csv(path)
    return type_delta(text, check_uint8, blank_strings)
