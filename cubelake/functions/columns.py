"""Scalar column functions (all JVM-side, codegen friendly)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cubelake import schemas as S


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ref_year(ref_date: Column | str) -> Column:
    """First four characters of the reference date, as text (``year``)."""
    return F.substring(_c(ref_date).cast("string"), 1, 4)


def power_of_ten(exponent: Column | str, integral: bool) -> Column:
    """``10 ** exponent``; exact BIGINT for integral cubes, where a negative exponent is an error."""
    e = _c(exponent)
    p = F.pow(F.lit(10.0), e.cast("double"))
    if not integral:
        return p
    wrong = F.raise_error(F.concat(F.lit("negative power of ten in an integral cube: "), e.cast("string")))
    return F.when(e < 0, wrong.cast("bigint")).otherwise(p.cast("bigint"))


def scaled_value(value: Column | str, scalar_id: Column | str, integral: bool) -> Column:
    """``VALUE * 10 ** SCALAR_ID``; null in gives null out.

    Integral cubes stay BIGINT (no trip through DOUBLE, which would lose
    digits past 2**53).
    """
    v = _c(value)
    if integral:
        return (v.cast("bigint") * power_of_ten(scalar_id, True)).cast("bigint")
    return v.cast("double") * power_of_ten(scalar_id, False)


def scaled_delta_value(value: Column | str, scalar_factor_code: Column | str) -> Column:
    """Delta scaling idea: empty value counts as 0.0, else value * 10**code."""
    return F.coalesce(_c(value), F.lit(0.0)) * power_of_ten(scalar_factor_code, False)


def digits_only(text: Column | str) -> Column:
    """All digits of a name, in order (a file name -> product id text)."""
    return F.regexp_replace(_c(text), r"[^0-9]", "")


def file_name(path: Column | str) -> Column:
    """Last path component of a path or URL path."""
    return F.regexp_extract(_c(path), r"[^/]*$", 0)


def url_basename(url: Column | str) -> Column:
    """Base file name of a URL's path (query and fragment ignored)."""
    return file_name(F.parse_url(_c(url), F.lit("PATH")))


def product_id_from_name(name: Column | str) -> Column:
    """Digits of a file name as BIGINT (null if the name has none)."""
    d = digits_only(name)
    return F.when(F.length(d) > 0, d.cast("bigint"))


def in_uint8_range(c: Column | str) -> Column:
    col = _c(c)
    return col.isNull() | col.between(S.UINT8_MIN, S.UINT8_MAX)


def is_null_spelling(c: Column | str) -> Column:
    """True where CSV text means null for a non-text column."""
    col = _c(c)
    return col.isNull() | col.isin(S.CSV_NULL_SPELLINGS)


def parse_release_time(text: Column | str, lenient: bool = False) -> Column:
    """``YYYY-MM-DDTHH:MM`` text to TIMESTAMP (strict unless ``lenient``)."""
    fmt = F.lit(S.RELEASE_TIME_FORMAT)
    if lenient:
        return F.try_to_timestamp(_c(text), fmt)
    return F.to_timestamp(_c(text), S.RELEASE_TIME_FORMAT)


def format_release_time(ts: Column | str) -> Column:
    return F.date_format(_c(ts), S.RELEASE_TIME_FORMAT)


def blank_if_null(c: Column | str) -> Column:
    """Empty text instead of null (text columns keep ``''`` as in the source)."""
    return F.coalesce(_c(c), F.lit(""))


def delta_file_name(day) -> str:
    """Landing name of a daily delta file: ``YYYYMMDD.zip``.

    Accepts a date/datetime or its ``YYYYMMDD`` text; any other text is
    rejected (eight digits exactly).
    """
    import re

    if isinstance(day, str):
        if not re.fullmatch(r"[0-9]{8}", day):
            raise ValueError(f"delta date must be YYYYMMDD: {day!r}")
        text = day
    else:
        text = day.strftime("%Y%m%d")
    return f"{text}.zip"


def only_products(files: DataFrame, only: Iterable[int] | DataFrame) -> DataFrame:
    """The listed files whose ``product_id`` is one of ``only`` (ids, or a table of any size that has them).

    A table is first cut down to the ids that are listed; what is broadcast are
    ids of files, and the files stay in the tasks that the listing made.
    """
    if isinstance(only, DataFrame):
        listed = files.select("product_id").distinct()
        wanted = only.select("product_id").join(F.broadcast(listed), "product_id", "left_semi").distinct()
        return files.join(F.broadcast(wanted), "product_id", "left_semi")
    return files.where(F.col("product_id").isin(sorted({int(p) for p in only})))
