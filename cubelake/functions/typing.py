"""Type guards and rules for full-cube columns.

The source lets its CSV reader infer a type per column, then overrides a few
columns by name. Here a column is inferred from all of its values at once: a
type is chosen when every non-null value passes that type's guard. Guards are
regular expressions plus a strict parse, so that text Spark would happily
cast (``1d``, ``1999-04``, ``y``) does not pass.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from cubelake import schemas as S
from cubelake.functions.columns import is_null_spelling

# Blanks may surround a number; Spark's casts trim them too.
_INT_RE = r"^[ \t]*[+-]?[0-9]+[ \t]*$"
_FLOAT_RE = r"^[ \t]*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?[ \t]*$"
_DATE_RE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_TS_RE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,9})?)?(Z)?$"

# Candidate types, most specific first (the order the source reader tries).
CANDIDATES = ["bigint", "boolean", "date", "timestamp", "double"]


def guard(c: Column, type_name: str) -> Column:
    """True where text ``c`` is a valid literal of ``type_name``."""
    if type_name == "bigint":
        return c.rlike(_INT_RE) & c.try_cast("bigint").isNotNull()
    if type_name == "boolean":
        return c.isin(S.CSV_TRUE_SPELLINGS + S.CSV_FALSE_SPELLINGS)
    if type_name == "date":
        return c.rlike(_DATE_RE) & F.try_to_date(c, "yyyy-MM-dd").isNotNull()
    if type_name == "timestamp":
        return c.rlike(_TS_RE) & F.regexp_replace(c, "Z$", "").try_cast("timestamp").isNotNull()
    if type_name == "double":
        return c.rlike(_FLOAT_RE) & c.try_cast("double").isNotNull()
    raise ValueError(type_name)


def cast_text(c: Column, type_name: str) -> Column:
    """Strict conversion of CSV text to ``type_name`` (null spellings -> null).

    Values that fail the guard become null; callers count those failures
    first and reject the cube, so nothing is silently lost.
    """
    if type_name == "string":
        return c
    value = F.when(~is_null_spelling(c), c)
    if type_name == "boolean":
        return (
            F.when(value.isin(S.CSV_TRUE_SPELLINGS), F.lit(True))
            .when(value.isin(S.CSV_FALSE_SPELLINGS), F.lit(False))
        )
    if type_name == "date":
        return F.try_to_date(value, "yyyy-MM-dd")
    if type_name == "timestamp":
        return F.regexp_replace(value, "Z$", "").try_cast("timestamp")
    return value.try_cast(type_name)


def is_string_override(name: str) -> bool:
    """Columns that are always text, whatever their values look like."""
    return name in S.STRING_OVERRIDE_NAMES or re.match(S.STRING_OVERRIDE_PATTERN, name) is not None


def value_type(max_decimals: int | None) -> str:
    """VALUE is DOUBLE when any row has decimals, else BIGINT (null -> 0)."""
    return "double" if (max_decimals or 0) > 0 else "bigint"


_NUMERIC_START = list("0123456789+-.")
_BIT = {t: 1 << i for i, t in enumerate(CANDIDATES)}


def plain_int(c: Column) -> Column:
    """Text that is a BIGINT written the usual way (no sign +, blanks or leading zeros); false for null.

    A cast there and back is several times cheaper than a pattern, which takes
    the text out of Spark's own string type. A cast that fails is dearer than
    both: ask only about text that looks like a whole number.
    """
    return F.coalesce(c.try_cast("bigint").cast("string") == c, F.lit(False))


def type_mask(c: Column) -> Column:
    """Bit ``CANDIDATES.index(t)`` set when ``c`` passes ``guard(c, t)``.

    The same answer as testing every guard, evaluated as a decision chain so
    that most values need no pattern test or one: text not starting like a
    number can only be a boolean; only text with a dash in fifth place can be
    a date or a timestamp; text with a point can be a double alone; what is
    left is mostly a plain integer, which a cast tells. An integer literal is
    also a double (and a boolean when it is 0 or 1). Null for null text (null
    spellings), so ``bit_and`` skips it.
    """
    b = lambda t: F.lit(_BIT[t])
    none = F.lit(0)
    is_bool = c.isin(S.CSV_TRUE_SPELLINGS + S.CSV_FALSE_SPELLINGS)
    starts_numeric = F.substring(F.ltrim(c, F.lit(" \t")), 1, 1).isin(_NUMERIC_START)
    dash = F.substring(c, 5, 1) == "-"
    maybe_bool = F.when(is_bool, b("boolean")).otherwise(none)
    plain = F.lit(_BIT["bigint"] | _BIT["double"]).bitwiseOR(maybe_bool)
    int_mask = (
        F.when(c.try_cast("bigint").isNotNull(), b("bigint")).otherwise(none)
        .bitwiseOR(b("double"))
        .bitwiseOR(maybe_bool)
    )
    mask = (
        F.when(~starts_numeric, maybe_bool)
        .when(dash & c.rlike(_DATE_RE), F.when(F.try_to_date(c, "yyyy-MM-dd").isNotNull(), b("date")).otherwise(none))
        .when(dash & c.rlike(_TS_RE), F.when(guard(c, "timestamp"), b("timestamp")).otherwise(none))
        .when(c.contains("."), F.when(c.rlike(_FLOAT_RE), b("double")).otherwise(none))
        .when(plain_int(c), plain)
        .when(c.rlike(_FLOAT_RE), F.when(c.rlike(_INT_RE), int_mask).otherwise(b("double")))
        .otherwise(none)
    )
    return F.when(~is_null_spelling(c), mask)


def int_or_null(c: Column) -> Column:
    """BIGINT value of integer text, else null, without trying to cast other text.

    A failed cast is expensive per value; the pattern test rules out text
    that cannot be an integer first.
    """
    return F.when(c.rlike(_INT_RE), c.try_cast("bigint"))
