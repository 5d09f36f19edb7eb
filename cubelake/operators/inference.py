"""Per-cube column types from the data itself (one aggregate pass).

For every cube (``product_id``) and every column the pass keeps the set of
type guards that all non-null values pass (a ``bit_and`` of per-value
masks); the same pass takes ``max(DECIMALS)`` and counts malformed rows. A column gets the first
candidate type that every non-null value passes; a column with no non-null
value is all-null text. Name rules then override: ``REF_DATE`` and the
"mostly null" columns are text, ``VALUE`` follows ``max(DECIMALS)``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubelake import schemas as S
from cubelake.functions.typing import CANDIDATES, int_or_null, is_string_override, type_mask, value_type
from cubelake.sources.cube_csv import CORRUPT


def _q(name: str):
    return F.col(f"`{name}`")


def fixed_type(name: str) -> str | None:
    if name == S.REF_DATE_COLUMN or is_string_override(name):
        return "string"
    return None


def _evidence(text: DataFrame, columns: dict[int, str], key: str, integers: list[int]) -> DataFrame:
    """One row per ``key``: rows, malformed rows, and ``mask_i`` (and ``max_i``) of the columns numbered so.

    The cells of a row are taken one below the other, so that there is one
    mask expression however many columns there are: written out per column,
    it grows past what the JVM compiles, and every value then costs several
    times as much. Cells meet in partial aggregates per cube and column.
    """
    numbers = list(columns)
    cell = F.posexplode(F.array(*[_q(c) for c in columns.values()])).alias("_at", "_cell")
    cells = text.select(F.col(key), F.col(CORRUPT).isNotNull().alias("_broken"), cell)
    wanted = [i for i, n in enumerate(numbers) if n in integers]
    largest = F.when(F.col("_at").isin(wanted), int_or_null(F.col("_cell"))) if wanted else F.lit(None).cast("bigint")
    per_column = cells.groupBy(key, "_at").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count_if("_broken").alias("_bad"),
        F.bit_and(type_mask(F.col("_cell"))).alias("mask"),
        F.max(largest).alias("max"),
    )
    found = F.map_from_entries(F.collect_list(F.struct("_at", F.struct("mask", "max")))).alias("found")
    per_cube = per_column.groupBy(key).agg(F.max("_rows").alias("_rows"), F.max("_bad").alias("_bad"), found)
    return per_cube.select(
        key,
        "_rows",
        "_bad",
        *[F.col("found")[i]["mask"].alias(f"mask_{n}") for i, n in enumerate(numbers)],
        *[F.col("found")[i]["max"].alias(f"max_{n}") for i, n in enumerate(numbers) if n in integers],
    )


def inference_aggregates(
    text: DataFrame, names: list[str], key: str = "product_id", overrides: bool = True
) -> DataFrame:
    """One row per cube with the evidence the type decision needs.

    Per column one ``bit_and`` of the per-value type masks: the bits left
    are the types every non-null value passes (null when there is none).
    Every column is referenced, so the CSV parser checks whole rows and
    ragged rows show up in the corrupt-record count.
    """
    decimals = [i for i, n in enumerate(names) if n == S.DECIMALS_COLUMN]
    found = _evidence(text, dict(enumerate(names)), key, decimals)
    return found.withColumnRenamed(f"max_{decimals[0]}", "_max_dec") if decimals else found


def _passes(mask: int | None, type_name: str) -> bool:
    return mask is not None and bool(mask & (1 << CANDIDATES.index(type_name)))


@dataclass
class CubeTypes:
    product_id: int
    rows: int
    ok: bool = True
    reason: str | None = None
    types: tuple[str, ...] = field(default_factory=tuple)  # "null" = all-null text


def decide_types(stats_row, names: list[str], key: str = "product_id", overrides: bool = True) -> CubeTypes:
    """Column types of one cube from its aggregate row (driver side, tiny).

    ``overrides=False`` is plain inference: no text override by name and
    VALUE keeps its inferred type.
    """
    r = stats_row.asDict()
    out = CubeTypes(product_id=r[key], rows=int(r["_rows"]))
    if r["_bad"]:
        out.ok, out.reason = False, f"malformed rows: {r['_bad']}"
        return out
    max_dec = r.get("_max_dec")
    types = []
    for i, name in enumerate(names):
        ft = fixed_type(name) if overrides else None
        if ft is not None:
            types.append(ft)
            continue
        mask = r[f"mask_{i}"]
        if overrides and name == S.VALUE_COLUMN and S.DECIMALS_COLUMN in names:
            target = value_type(max_dec)
            if mask is not None and not _passes(mask, target):
                out.ok, out.reason = False, f"VALUE does not convert to {target}"
                return out
            types.append(target)
            continue
        if mask is None:
            types.append("null")
            continue
        types.append(next((t for t in CANDIDATES if _passes(mask, t)), "string"))
    out.types = tuple(types)
    return out


def value_kinds(text: DataFrame, key: str = "product_id") -> DataFrame:
    """Per cube: ``max(DECIMALS)`` (null counts as 0) and the VALUE type it implies."""
    max_dec = F.max(int_or_null(_q(S.DECIMALS_COLUMN)))
    out = text.groupBy(key).agg(max_dec.alias("max_decimals"), F.count(F.lit(1)).alias("n_rows"))
    kind = F.when(F.coalesce(F.col("max_decimals"), F.lit(0)) > 0, F.lit("double")).otherwise(F.lit("bigint"))
    return out.withColumn("value_type", kind)


def empty_cube_types(product_id: int, names: list[str]) -> CubeTypes:
    """Types of a cube without data rows: all-null text, VALUE by the DECIMALS rule."""
    types = []
    for name in names:
        if fixed_type(name) is not None:
            types.append(fixed_type(name))
        elif name == S.VALUE_COLUMN and S.DECIMALS_COLUMN in names:
            types.append(value_type(None))
        else:
            types.append("null")
    return CubeTypes(product_id=product_id, rows=0, types=tuple(types))


# ------------------------------------------------------- all headers at once


def positional_names(width: int) -> list[str]:
    return [f"c{i}" for i in range(width)]


def positional_aggregates(text: DataFrame, headers: list[list[str]], key: str = "product_id") -> DataFrame:
    """Per-cube evidence for cubes whose headers differ but are equally long.

    ``text`` is a scan of those cubes with positional text columns; a row
    with another number of fields keeps its raw line in the corrupt-record
    column and counts as malformed. A position gets a type mask unless it is
    text by name in every header, and its largest integer only if it is
    DECIMALS in one of them. The scan must have parsed whole rows already.
    """
    names = positional_names(len(headers[0]))
    open_ = [i for i in range(len(names)) if any(fixed_type(h[i]) is None for h in headers)]
    decimals = [i for i in open_ if any(h[i] == S.DECIMALS_COLUMN for h in headers)]
    return _evidence(text, {i: names[i] for i in open_ or [0]}, key, decimals)


def decide_positional(stats_row, names: list[str]) -> CubeTypes:
    """``decide_types`` for a row of ``positional_aggregates`` and a cube's header."""
    from pyspark.sql import Row

    r = stats_row.asDict()
    d = {"product_id": r["product_id"], "_rows": r["_rows"], "_bad": r["_bad"]}
    if S.DECIMALS_COLUMN in names:
        d["_max_dec"] = r[f"max_{names.index(S.DECIMALS_COLUMN)}"]
    for i in range(len(names)):
        d[f"mask_{i}"] = r.get(f"mask_{i}")
    return decide_types(Row(**d), names)
