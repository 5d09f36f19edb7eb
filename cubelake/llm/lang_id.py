"""Language identification with language-bitmask n-gram filters.

Training counts letter n-grams per language over all labelled texts and keeps,
for each language, the n-grams that are frequent in it. Each language's set is
a Bloom filter; the filters are stored bit-sliced: one mask per filter
position, whose bit l tells whether language l has that position set. The AND
of the masks at an n-gram's positions is the set of all languages that contain
it. A text is decided by the popcount of each language's bit over its n-grams,
corrected for that language's rate of false positives.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cubelake.llm.common import ship

UNDETERMINED = "und"

#: An n-gram is three code points with a letter in the middle; others count as a border.
_BORDER = 32
#: Kept for a language: n-grams with at least this share of its n-grams (so at most 1 / MIN_SHARE of them) ...
MIN_SHARE = 2e-5
#: ... and at least this part of the largest share the n-gram has in any language.
MIN_PART = 0.1
FILTER_BITS = 20
HASHES = 3
#: Characters worked on at once; longer texts go in overlapping slices.
SLICE = 1 << 17
_MASK_WORD = 63  # languages per mask word


@functools.cache
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _grams(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """n-grams of a run of code points, and the place of each one's middle."""
    folded = np.where(_letters()[codes], codes, _BORDER).astype(np.uint64)
    at = np.flatnonzero(folded[1:-1] != _BORDER) + 1
    return folded[at - 1] << np.uint64(42) | folded[at] << np.uint64(21) | folded[at + 1], at


def _slices(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(n-grams, row of each n-gram) for a batch of texts, in bounded slices."""
    parts: list[str] = []
    rows: list[int] = []
    held = 0

    def flush():
        codes = np.frombuffer(" ".join(["", *parts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
        ends = np.cumsum([len(p) + 1 for p in parts])
        grams, at = _grams(codes)
        return grams, np.asarray(rows)[np.searchsorted(ends, at - 1, side="right")]

    for row, text in enumerate(texts):
        low = (text or "").lower()
        if len(low) > SLICE:
            # Each slice sees one more character on either side of its n-grams' middles.
            low = f" {low} "
            for start in range(0, len(low) - 2, SLICE):
                part = low[start : start + SLICE + 2].encode("utf-32-le", "surrogatepass")
                grams, _ = _grams(np.frombuffer(part, np.uint32))
                yield grams, np.full(len(grams), row)
        elif low:
            parts.append(low)
            rows.append(row)
            held += len(low)
            if held >= SLICE:
                yield flush()
                parts, rows, held = [], [], 0
    if parts:
        yield flush()


def _positions(grams: np.ndarray) -> Iterator[np.ndarray]:
    """The filter positions of each n-gram, one array per hash function (double hashing)."""
    with np.errstate(over="ignore"):
        mixed = (grams ^ grams >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ mixed >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(32)
        step = mixed >> np.uint64(32) | np.uint64(1)
        low = np.uint64((1 << FILTER_BITS) - 1)
        for _ in range(HASHES):
            yield (mixed & low).astype(np.int64)
            mixed = mixed + step


@dataclass
class LanguageFilters:
    """``masks[w, p]`` holds languages 63 w ... 63 w + 62 as bits; ``false_rate[l]`` is exact from the fill."""

    languages: list[str]
    masks: np.ndarray
    false_rate: np.ndarray

    @classmethod
    def build(cls, members: dict[str, np.ndarray]) -> LanguageFilters:
        languages = sorted(members)
        words = max(1, -(-len(languages) // _MASK_WORD))
        masks = np.zeros((words, 1 << FILTER_BITS), np.int64)
        false_rate = np.zeros(len(languages))
        for k, language in enumerate(languages):
            word, bit = divmod(k, _MASK_WORD)
            for at in _positions(members[language]):
                masks[word, at] |= 1 << bit
            false_rate[k] = np.mean(masks[word] >> bit & 1) ** HASHES
        return cls(languages, masks, false_rate)

    def containing(self, grams: np.ndarray) -> np.ndarray:
        """Per mask word and n-gram, the mask of all languages that contain it."""
        found = None
        for at in _positions(grams):
            found = self.masks[:, at] if found is None else found & self.masks[:, at]
        return found

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        n, known = len(texts), len(self.languages)
        counts, totals = np.zeros((n, max(known, 1))), np.zeros(n)
        for grams, rows in _slices(texts):
            if not len(grams):
                continue
            totals += np.bincount(rows, minlength=n)
            found = self.containing(grams)
            for k in range(known):
                word, bit = divmod(k, _MASK_WORD)
                counts[:, k] += np.bincount(rows, found[word] >> bit & 1, n)
        if not known:
            return [UNDETERMINED] * n, np.zeros(n)
        false = totals[:, None] * self.false_rate
        corrected = np.clip((counts - false) / (1 - self.false_rate), 0, totals[:, None])
        best = corrected.argmax(axis=1)  # ties: the first language in alphabetical order
        score = corrected[np.arange(n), best] / np.maximum(totals, 1)
        return [self.languages[b] if t else UNDETERMINED for b, t in zip(best, totals, strict=True)], score


def gram_counts(labelled: DataFrame) -> DataFrame:
    """(lang, gram, n) over all rows of ``labelled`` (text, lang); each task adds up its own rows first."""
    ship(labelled.sparkSession)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def add(language: str, grams: np.ndarray, counts: np.ndarray) -> None:
            if language in sums:
                grams, counts = np.concatenate([sums[language][0], grams]), np.concatenate([sums[language][1], counts])
                grams, back = np.unique(grams, return_inverse=True)
                counts = np.bincount(back, counts)
            sums[language] = grams, counts

        for batch in batches:
            by_lang: dict[str, list[str]] = {}
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                for grams, _ in _slices(texts):
                    add(lang, *np.unique(grams, return_counts=True))
        for lang, (grams, counts) in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(grams)), pa.array(grams.astype(np.int64)), pa.array(counts.astype(np.int64))],
                names=["lang", "gram", "n"],
            )

    part = labelled.select(F.col("text").cast("string"), F.col("lang").cast("string")).dropna()
    return (
        part.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    )


def train(labelled: DataFrame) -> LanguageFilters:
    """Filters from all rows of ``labelled`` (text, lang); rows with a null in either are left out.

    What reaches the driver is the kept n-grams: at most 1 / MIN_SHARE per language.
    """
    counts = gram_counts(labelled)
    sizes = counts.groupBy("lang").agg(F.sum("n").alias("total"))  # one row per language
    shares = counts.join(F.broadcast(sizes), "lang").withColumn("share", F.col("n") / F.col("total"))
    tops = shares.filter(F.col("share") >= MIN_SHARE)
    best = tops.groupBy("gram").agg(F.collect_list(F.struct("lang", "share")).alias("of"), F.max("share").alias("top"))
    kept = best.select("gram", F.explode(F.filter("of", lambda x: x["share"] >= MIN_PART * F.col("top"))).alias("x"))
    rows = kept.select("gram", "x.lang").toPandas()
    return LanguageFilters.build({k: g.gram.to_numpy().astype(np.uint64) for k, g in rows.groupby("lang")})


def identify(docs: DataFrame, filters: LanguageFilters, text_col: str = "text") -> Column:
    """Column struct(lang_pred, score) for ``docs``.

    ``lang_pred`` is ``und`` with score 0 for null, empty or letterless texts
    and when no language was learned. Equal texts get equal results. The
    score is the corrected share of the text's n-grams that the language
    contains, 0 to 1.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(filters)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts):
        import pandas as pd

        langs, score = shared.value.predict(texts.tolist())
        return pd.DataFrame({"lang_pred": langs, "score": score})

    return predict(F.col(text_col).cast("string"))


def held_out_fold(doc_id: Column) -> Column:
    from cubelake.llm.common import text_remainder

    return F.coalesce(text_remainder(doc_id, 4) == 2, F.lit(False))


def identify_documents(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score; learned from the rows not held out.

    A null doc_id is not held out. Other columns of ``docs`` are not read.
    """
    filters = train(docs.filter(~held_out_fold(F.col("doc_id"))))
    found = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out_fold(F.col("doc_id")).alias("held_out"),
        identify(docs, filters).alias("__found"),
    )
    return found.select("doc_id", "held_out", "__found.lang_pred", "__found.score")
