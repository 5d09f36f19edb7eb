"""Schemas and fixed values.

Everything in the block marked FIXED VALUES must stay equal to the values the
source pipeline uses (its delta layout, its type override names, the null
spellings of its CSV parser, its layout threshold). They are data, not logic.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the source pipeline; keep in natural order)
# ---------------------------------------------------------------------------

# Delta file columns, in file order (names are applied by position).
DELTA_COLUMNS = [
    ("productId", T.LongType()),
    ("coordinate", T.StringType()),
    ("vectorId", T.LongType()),
    ("refPer", T.StringType()),
    ("refPer2", T.StringType()),
    ("symbolCode", T.ShortType()),  # uint8 in the source
    ("statusCode", T.ShortType()),  # uint8
    ("securityLevelCode", T.ShortType()),  # uint8
    ("value", T.DoubleType()),
    ("releaseTime", T.StringType()),  # text, YYYY-MM-DDTHH:MM
    ("scalarFactorCode", T.ShortType()),  # uint8
    ("decimals", T.ShortType()),  # uint8
    ("frequencyCode", T.ShortType()),  # uint8
]

# Columns that are unsigned 8-bit in the source; we keep them as SMALLINT and
# check the range ourselves.
UINT8_COLUMNS = [
    "symbolCode",
    "statusCode",
    "securityLevelCode",
    "scalarFactorCode",
    "decimals",
    "frequencyCode",
]
UINT8_MIN, UINT8_MAX = 0, 255

# Full-cube columns that are always loaded as text ("mostly null" columns).
STRING_OVERRIDE_NAMES = ["STATUS", "SYMBOL", "TERMINATED", "DGUID"]
# ...plus "Symbol" and its renamed repeats "Symbol.1", "Symbol.2", ...
STRING_OVERRIDE_PATTERN = r"^Symbol(\.[0-9]+)?$"

# Columns of the value-scaling step.
VALUE_COLUMN = "VALUE"
DECIMALS_COLUMN = "DECIMALS"
SCALAR_ID_COLUMN = "SCALAR_ID"
SCALE_DROP_COLUMNS = ["DECIMALS", "UOM_ID", "SCALAR_FACTOR", "VALUE"]

# First column of every full cube; the derived partition column.
REF_DATE_COLUMN = "REF_DATE"
YEAR_COLUMN = "year"

# A cube whose parquet output is strictly smaller than this stays flat.
FLAT_LAYOUT_THRESHOLD_BYTES = 10 * 1024 * 1024

# Text that the CSV reader of the source turns into null in non-text columns.
CSV_NULL_SPELLINGS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "n/a",
    "nan",
    "null",
]
# Text the same reader accepts as booleans.
CSV_TRUE_SPELLINGS = ["1", "True", "TRUE", "true"]
CSV_FALSE_SPELLINGS = ["0", "False", "FALSE", "false"]

# Timestamp text formats of the catalog and the changed-cube lists.
RELEASE_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm"
CHANGE_DATE_FORMAT = "yyyy-MM-dd"
DELTA_FILE_DATE_FORMAT = "yyyyMMdd"

# ---------------------------------------------------------------------------
# Spark schemas built from the values above
# ---------------------------------------------------------------------------

DELTA_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in DELTA_COLUMNS])
DELTA_NAMES = [n for n, _ in DELTA_COLUMNS]

CATALOG_SCHEMA = T.StructType(
    [
        T.StructField("product_id", T.LongType(), False),
        T.StructField("release_time", T.TimestampType(), True),
    ]
)

REGISTRY_SCHEMA = T.StructType(
    [
        T.StructField("number", T.LongType(), False),
        T.StructField("release_time", T.TimestampType(), True),
        T.StructField("is_uploaded", T.BooleanType(), True),
        T.StructField("created_at", T.TimestampType(), True),
        T.StructField("updated_at", T.TimestampType(), True),
    ]
)

ENVELOPE_SCHEMA = T.StructType(
    [
        T.StructField("status", T.StringType()),
        T.StructField("object", T.StringType()),
    ]
)
