"""URL filter lists with dates, joined to captures as of their fetch time.

A list is a log of dated entries that add or remove a pattern. The log
becomes validity intervals: an added pattern holds from its entry to the next
entry of the same list and pattern. A capture is looked up under all keys that
a pattern can have for its URL (its host, the domains above it, the prefixes
of its path). An as-of join finds, for each key and time, the last interval
that began by then, and the pattern counts if that interval still holds. The
longest matching pattern decides; of equally long ones, allow before deny.

The as-of join sorts intervals and times together within a pattern and a span
of time, and hands the last interval on from span to span through one row per
span. So nothing is joined with all intervals of a pattern, and no task has to
take a whole pattern, however many entries or captures it has.

Kinds of patterns: ``host`` (exactly that host), ``domain`` (that domain and
all below it) and ``prefix`` (host and leading path segments).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cubelake.llm.common import cut, numbered
from cubelake.llm.html_text import host_of, path_of

#: Seconds of one span of time: a pattern's entries and captures of a span are one sorted group.
SPAN = 3600
_PATTERN = ["list", "kind", "pattern"]
#: Columns that ``evaluate`` adds.
ADDED = ["verdict", "list", "kind", "pattern", "valid_from"]


def _span(at: Column) -> Column:
    return F.floor(F.unix_seconds(at) / F.lit(SPAN))


def intervals(entries: DataFrame) -> DataFrame:
    """(list, kind, pattern, valid_from, valid_to) from (list, kind, pattern, action, at).

    ``action`` is add or remove. Patterns are compared in lower case without
    a slash or dot at either end. Repeated entries count once; of entries at
    one instant a removal counts last. ``valid_to`` is exclusive, null while
    the pattern still holds. Rows with a null or with another action are left
    out. The next entry is looked for inside the span, then in the first
    entries of the spans after it (one row per pattern and span).
    """
    log = (
        entries.select("list", "kind", F.lower(F.expr("trim(BOTH './' FROM pattern)")).alias("pattern"), "action", "at")
        .filter(F.col("action").isin("add", "remove"))
        .dropna()
        .distinct()
        .withColumn("__span", _span(F.col("at")))
    )
    inside = Window.partitionBy(*_PATTERN, "__span").orderBy("at", "action")
    spans = log.groupBy(*_PATTERN, "__span").agg(F.min("at").alias("__first"))
    after = F.lead("__first").over(Window.partitionBy(*_PATTERN).orderBy("__span")).alias("__after")
    return (
        log.withColumn("__next", F.lead("at").over(inside))
        .join(spans.select(*_PATTERN, "__span", after), [*_PATTERN, "__span"])
        .withColumn("valid_to", F.coalesce("__next", "__after"))
        .filter((F.col("action") == "add") & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col("at"))))
        .select(*_PATTERN, F.col("at").alias("valid_from"), "valid_to")
    )


def as_of(times: DataFrame, valid: DataFrame) -> DataFrame:
    """(list, kind, pattern, at, valid_from): the intervals of ``valid`` that hold at ``times`` (kind, pattern, at).

    Equal times count once; nulls, and patterns without interval, give no row.
    """
    known = valid.select(*_PATTERN).distinct()
    asked = times.dropna().distinct().join(known, ["kind", "pattern"])
    interval = F.struct("valid_from", "valid_to").alias("__holds")
    none = F.lit(None).cast("struct<valid_from:timestamp,valid_to:timestamp>").alias("__holds")
    starts = valid.select(*_PATTERN, F.col("valid_from").alias("at"), interval, F.lit(False).alias("__asked"))
    both = starts.unionByName(asked.select(*_PATTERN, "at", none, F.lit(True).alias("__asked")))
    both = both.withColumn("__span", _span(F.col("at")))
    # What each span leaves to the later ones: its last interval, if it has any.
    spans = both.groupBy(*_PATTERN, "__span").agg(F.max("__holds").alias("__last"))
    before = Window.partitionBy(*_PATTERN).orderBy("__span").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(*_PATTERN, "__span", F.last("__last", ignorenulls=True).over(before).alias("__before"))
    # At one instant the interval comes first: it holds from its start on.
    here = Window.partitionBy(*_PATTERN, "__span").orderBy("at", "__asked")
    here = here.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        both.withColumn("__here", F.last("__holds", ignorenulls=True).over(here))
        .filter("__asked")
        .join(spans, [*_PATTERN, "__span"])
        .withColumn("__found", F.coalesce("__here", "__before"))
        .filter(F.col("__found").isNotNull())
        .filter(F.col("__found.valid_to").isNull() | (F.col("at") < F.col("__found.valid_to")))
        .select(*_PATTERN, "at", F.col("__found.valid_from").alias("valid_from"))
    )


def keys_of(url: Column) -> Column:
    """array<struct(kind, pattern)>: all patterns that match a URL; empty without host."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), "^[^@]*@", ""), r":[0-9]*$", "")
    labels = F.split(host, r"\.")
    parts = F.filter(F.split(F.lower(path_of(url)), "/"), lambda s: s != "")

    def key(kind: str, pattern: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), pattern.alias("pattern"))

    def places(array: Column) -> Column:
        return F.when(F.size(array) > 0, F.sequence(F.lit(1), F.size(array))).otherwise(F.array().cast("array<int>"))

    domains = F.transform(
        places(labels), lambda k: key("domain", F.array_join(F.slice(labels, k, F.size(labels)), "."))
    )
    prefixes = F.transform(
        places(parts), lambda k: key("prefix", F.concat_ws("/", host, F.array_join(F.slice(parts, 1, k), "/")))
    )
    found = F.concat(F.array(key("host", host)), domains, prefixes)
    return F.when(F.coalesce(host, F.lit("")) != "", found).otherwise(F.filter(found, lambda x: F.lit(False)))


def evaluate(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """Add verdict, list, kind, pattern and valid_from to captures (id, url, fetched_at).

    ``verdict`` is blocked (a deny pattern decides), allowed (an allow
    pattern) or unlisted (none holds at that time, or url or fetched_at is
    null or has no host). Every row of ``captures`` comes back once, repeated
    rows too; a column that has one of the names added here gives way. Lists
    are named allow or deny; other names never block. Without captures there
    are no rows, without entries all are unlisted. However long a URL, it has
    a key for each of its labels and segments.

    What is shuffled are (pattern, time) pairs, each once, of patterns that
    are on a list at all; Spark may broadcast the listed patterns and what
    holds if it finds them small, else the skew join splits a common host.
    """
    kept = [c for c in captures.columns if c not in ADDED]
    whole = F.struct(*[F.col(f"`{c}`") for c in kept]).alias("__capture")
    rows = numbered(captures, [whole], "url-captures")
    asked = rows.select(
        "__row",
        F.col("__capture.fetched_at").alias("at"),
        F.explode(keys_of(F.col("__capture.url"))).alias("__key"),
    ).select("__row", "at", "__key.kind", "__key.pattern")
    holding = cut(as_of(asked.select("kind", "pattern", "at"), cut(intervals(entries), "url-intervals")), "url-holding")
    rank = F.struct(
        F.char_length("pattern").alias("length"),
        (F.col("list") == "allow").alias("allow"),
        "kind",
        "pattern",
        "valid_from",
        "list",
    )
    best = asked.join(holding, ["kind", "pattern", "at"]).groupBy("__row").agg(F.max(rank).alias("__best"))
    verdict = (
        F.when(F.col("__best").isNull() | ~F.col("__best.list").isin("allow", "deny"), "unlisted")
        .when(F.col("__best.allow"), "allowed")
        .otherwise("blocked")
    )
    return rows.join(best, "__row", "left").select(
        "__capture.*", verdict.alias("verdict"), *[F.col(f"__best.{c}").alias(c) for c in ADDED[1:]]
    )
