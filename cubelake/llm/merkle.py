"""Merkle tree fingerprints of documents.

A text is cut into paragraphs (after each line feed), a paragraph into
clauses (after punctuation, and where none comes for ``CLAUSE`` characters);
``FAN`` consecutive paragraphs form a section.
Clauses are the leaves. A paragraph's digest covers its clauses' digests, a
section's those of its paragraphs, and the root those of the sections, all by
SHA-256, so equal roots mean equal texts. The fingerprint is text:

    root ':' section ',' section ... ':' leaf '.' leaf ... ',' leaf '.' leaf ...

with sections cut to 16 and leaves to 6 hex digits; commas in the last part
separate paragraphs. Everything is built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cubelake.llm.common import following, numbered, ordered

FAN = 8
_PARAGRAPH = r"(?<=\n)"
CLAUSE = 32
_CLAUSE = rf"(?<=[.,;:!?])|(?<=\G.{{{CLAUSE}}})"
SECTION_HEX, LEAF_HEX = 16, 6


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text; null counts as empty."""
    whole = F.coalesce(text.cast("string"), F.lit(""))
    leaves = F.transform(
        F.split(whole, _PARAGRAPH), lambda p: F.transform(F.split(p, _CLAUSE), lambda c: F.sha2(c.cast("binary"), 256))
    )
    return _compose(leaves)


def _compose(leaves: Column) -> Column:
    def tree(parts: Column) -> Column:
        digests = F.transform(parts, lambda p: F.sha2(F.concat(F.lit("p"), F.array_join(p, "")).cast("binary"), 256))
        count = F.size(parts)
        starts = F.sequence(F.lit(1), count, F.lit(FAN))
        sections = F.transform(
            starts, lambda s: F.sha2(F.concat(F.lit("s"), F.array_join(F.slice(digests, s, FAN), "")).cast("binary"), 256)
        )
        return F.concat(
            F.sha2(F.concat(F.lit("r"), F.array_join(sections, "")).cast("binary"), 256),
            F.lit(":"),
            F.array_join(F.transform(sections, lambda s: F.substring(s, 1, SECTION_HEX)), ","),
            F.lit(":"),
            F.array_join(
                F.transform(parts, lambda p: F.array_join(F.transform(p, lambda c: F.substring(c, 1, LEAF_HEX)), ".")), ","
            ),
        )

    # Through a one-element array the tree is computed once and used by name.
    return F.transform(F.array(leaves), tree)[0]


def root(fp: Column) -> Column:
    return F.substring_index(fp, ":", 1)


def likeness(a: Column, b: Column) -> Column:
    """1 for equal roots, else the Dice coefficient of the two sets of leaves."""

    def leaf_set(fp: Column) -> Column:
        return F.array_distinct(F.split(F.substring_index(fp, ":", -1), "[.,]"))

    def dice(pair: Column) -> Column:
        one, two = pair["a"], pair["b"]
        return 2.0 * F.size(F.array_intersect(one, two)) / (F.size(one) + F.size(two))

    sets = F.array(F.struct(leaf_set(a).alias("a"), leaf_set(b).alias("b")))
    return F.when(root(a) == root(b), F.lit(1.0)).otherwise(F.transform(sets, dice)[0])


def differing_paragraphs(a: Column, b: Column) -> Column:
    """Places (from 0) of the paragraphs that differ, found under differing sections only."""

    def part(fp: Column, k: int) -> Column:
        return F.split(F.split(fp, ":")[k], ",")

    def places(pair: Column) -> Column:
        top = F.greatest(F.size(pair["sa"]), F.size(pair["sb"]))
        sections = F.filter(
            F.sequence(F.lit(0), top - 1),
            lambda s: ~F.get(pair["sa"], s).eqNullSafe(F.get(pair["sb"], s)),
        )
        most = F.greatest(F.size(pair["pa"]), F.size(pair["pb"]))
        return F.flatten(
            F.transform(
                sections,
                lambda s: F.filter(
                    F.sequence(s * FAN, F.least(s * FAN + FAN, most) - 1),
                    lambda p: ~F.get(pair["pa"], p).eqNullSafe(F.get(pair["pb"], p)),
                ),
            )
        )

    parts = F.struct(part(a, 1).alias("sa"), part(b, 1).alias("sb"), part(a, 2).alias("pa"), part(b, 2).alias("pb"))
    return F.when(root(a) == root(b), F.array().cast("array<int>")).otherwise(F.transform(F.array(parts), places)[0])


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likeness.

    The edit replaces the last floor(n / 4) code points by the first as many
    (or all) of the next document in the order of doc_id (repeated ids: of
    the table); after the last comes the first, and a single document follows
    itself. Null text counts as empty; a null doc_id comes first. Returns
    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, changed_paragraphs (places of the paragraphs in
    which the two trees differ). Other columns of ``docs`` are not read.

    Neighbours are found over (row, length) only; then every text is shuffled
    once, to its own row number, and a quarter of its predecessor's length to
    that predecessor.
    """
    columns = [
        F.col("doc_id").cast("long").alias("__id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("__text"),
    ]
    texts = numbered(docs, columns, "merkle-rows")
    slim = texts.select("__row", F.col("__id").alias("doc_id"), F.char_length("__text").cast("long").alias("n_chars"))
    order = ordered(slim, ["doc_id", "__row"], "merkle")
    order = order.withColumn("__me", F.struct(F.col("__row"), F.expr("n_chars div 4").alias("k")))
    links = following(order, "__me", "__before", circular=True, back=True).select(
        "__row", "doc_id", "n_chars", F.col("__before.__row").alias("__to"), F.col("__before.k").cast("int").alias("__k")
    )
    # Both uses of ``here`` read the same columns of ``texts``, so its shuffle is done once and reused.
    here = texts.select("__row", "__text").join(links, "__row").withColumn("fingerprint", fingerprint(F.col("__text")))
    sent = here.select(
        F.col("__to").alias("__row"),
        F.expr("substring(__text, 1, __k)").alias("__head"),
        F.col("fingerprint").alias("__next_fp"),
    )
    edited = F.expr("concat(substring(__text, 1, cast(n_chars - n_chars div 4 as int)), __head)")
    return (
        here.join(sent, "__row")
        .withColumn("__edited", edited)
        .select(
            "doc_id",
            "n_chars",
            F.sha2(F.col("__edited").cast("binary"), 256).alias("edited_sha256"),
            "fingerprint",
            fingerprint(F.col("__edited")).alias("edited_fingerprint"),
            "__next_fp",
        )
        .withColumn("near_edited", likeness(F.col("fingerprint"), F.col("edited_fingerprint")))
        .withColumn("near_next", likeness(F.col("fingerprint"), F.col("__next_fp")))
        .withColumn("changed_paragraphs", differing_paragraphs(F.col("fingerprint"), F.col("edited_fingerprint")))
        .drop("__next_fp")
    )
