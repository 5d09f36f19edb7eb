"""Toxicity from a bidirectional gated recurrent network with attention pooling.

A text is lower-cased and cut into words; each word enters as a learned
vector of the word and the sum of learned vectors of its character n-grams.
Windows of ``WINDOW`` words, each overlapping the next by half, run through a
bidirectional GRU; attention pools the states, and a linear layer gives the
window's logit. A text's logit is that of its worst window, over all windows.

The network is trained in numpy on a bounded sample of labelled rows. A label
says that some window of the text is toxic, not which, so training alternates
between fitting the windows and choosing them anew: of a toxic text those
that the network so far finds worst, of a clean text those that come nearest.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cubelake.llm.common import cut, held, ship, text_remainder

WINDOW, STRIDE = 32, 16
HIDDEN, WORD_DIM, CHAR_DIM = 8, 8, 8
BUCKET_BITS = 15
NGRAMS = (3, 4)

#: Bounds of the training sample: rows of each class, and characters of a text.
MAX_ROWS = 2000
MAX_CHARS = 20_000

#: Words worked on at once when scoring.
CHUNK_WORDS = 1 << 15
_BATCH = 2048

_KEEP = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Lower-case words, all of them."""
    return (text or "").lower().encode("utf-8", "replace").translate(_KEEP).split()


def _bucket(codes: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        mixed = (codes + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ mixed >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return (mixed >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)


@dataclass
class Lexicon:
    """Distinct words with their buckets: one of the word, several of its character n-grams."""

    word: np.ndarray  # [words]
    grams: np.ndarray  # [n-grams], those of a word in a row
    starts: np.ndarray  # [words]: first n-gram of each

    @classmethod
    def of(cls, words: list[bytes]) -> Lexicon:
        data = np.frombuffer(b"".join(b"^" + w + b"$" for w in words), np.uint8).astype(np.uint64)
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
        owner = np.repeat(np.arange(len(words)), sizes)
        found, owners = [], []
        for n in NGRAMS:
            if len(data) < n:
                continue
            code = data[: len(data) - n + 1].copy()
            for k in range(1, n):
                code = code << np.uint64(8) | data[k : len(data) - n + 1 + k]
            whole = owner[: len(code)] == owner[n - 1 :]
            found.append(_bucket(code[whole] + np.uint64(n << 40)))
            owners.append(owner[: len(code)][whole])
        grams, owners = np.concatenate(found), np.concatenate(owners)
        order = np.argsort(owners, kind="stable")
        # A word has at least one n-gram of the shortest length: borders count as characters.
        starts = np.searchsorted(owners[order], np.arange(len(words)))
        with np.errstate(over="ignore"):
            powers = np.uint64(1099511628211) ** np.arange(int(sizes.max(initial=1)), dtype=np.uint64)
            place = np.arange(len(data)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            ends = np.cumsum(sizes) - sizes
            word = np.add.reduceat((data + np.uint64(7)) * powers[place], ends) if len(words) else data
        return cls(_bucket(word), grams[order], starts)


def _windows(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Over texts of so many words laid end to end: (text, first word) of every window."""
    per = np.where(lengths > 0, np.maximum(1, -(-(lengths - WINDOW) // STRIDE) + 1), 0)
    text = np.repeat(np.arange(len(lengths)), per)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per)
    return text, (np.cumsum(lengths) - lengths)[text] + nth * STRIDE


def _index(texts: Iterable[list[bytes]]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words, the index of every word, and each text's number of words."""
    known: dict[bytes, int] = defaultdict(lambda: len(known))
    parts = [np.fromiter(map(known.__getitem__, words), np.int32, len(words)) for words in texts]
    lengths = np.array([len(part) for part in parts], np.int64)
    return list(known), np.concatenate([*parts, np.zeros(0, np.int32)]), lengths


def _rows(index: np.ndarray, lengths: np.ndarray, text: np.ndarray, start: np.ndarray, pad: int) -> np.ndarray:
    """Word indices of each window, [windows, WINDOW]; beyond the text's end ``pad``."""
    at = start[:, None] + np.arange(WINDOW)
    inside = at < np.cumsum(lengths)[text][:, None]
    return np.where(inside, index[np.minimum(at, max(len(index) - 1, 0))], np.int32(pad))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


class Network:
    """The network's parameters, its forward pass and its gradients."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        n, d, h = 1 << BUCKET_BITS, WORD_DIM + CHAR_DIM, HIDDEN

        def normal(scale, *shape):
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        self.p = {
            "word": normal(0.1, n, WORD_DIM),
            "char": normal(0.1, n, CHAR_DIM),
            "x": normal(d**-0.5, 2, d, 3 * h),
            "b": np.zeros((2, 1, 3 * h), np.float32),
            "h": normal(h**-0.5, 2, h, 3 * h),
            "att": normal((2 * h) ** -0.5, 2 * h),
            "out": normal((2 * h) ** -0.5, 2 * h),
            "bias": np.zeros(1, np.float32),
        }
        self.scale, self.cut = 1.0, 0.0

    def vectors(self, lex: Lexicon, word_kept: np.ndarray | None = None) -> np.ndarray:
        word = self.p["word"][lex.word]
        if word_kept is not None:
            word = word * word_kept[:, None]
        return np.concatenate([word, np.add.reduceat(self.p["char"][lex.grams], lex.starts, axis=0) * 0.3], axis=1)

    def inputs(self, vectors: np.ndarray) -> np.ndarray:
        """Per direction and word what the gates add for it; the last row is the padding's."""
        added = vectors @ self.p["x"] + self.p["b"]
        return np.concatenate([added, np.zeros((2, 1, 3 * HIDDEN), np.float32)], axis=1)

    def forward(self, added: np.ndarray, rows: np.ndarray, keep: bool = False):
        """Logit of each window; with ``keep`` also what the gradients need."""
        n, h = len(rows), HIDDEN
        mask = (rows != added.shape[1] - 1).astype(np.float32)
        state = np.zeros((2, n, h), np.float32)
        states = np.empty((2, WINDOW, n, h), np.float32)
        kept = []
        for t in range(WINDOW):
            back = WINDOW - 1 - t
            given = np.stack([added[0][rows[:, t]], added[1][rows[:, back]]])
            there = np.stack([mask[:, t], mask[:, back]])[:, :, None]
            own = state @ self.p["h"]
            gates = _sigmoid(given[..., : 2 * h] + own[..., : 2 * h])
            z, r = gates[..., :h], gates[..., h:]
            new = np.tanh(given[..., 2 * h :] + r * own[..., 2 * h :])
            if keep:
                kept.append((state, z, r, new, own[..., 2 * h :], there))
            state = (new + z * (state - new)) * there
            states[0, t], states[1, back] = state[0], state[1]
        both = np.concatenate([states[0], states[1]], axis=-1)  # [time, window, 2h]
        weight = both @ self.p["att"] + (mask.T - 1) * 1e9
        weight = np.exp(weight - weight.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = (weight[..., None] * both).sum(axis=0)
        logit = pooled @ self.p["out"] + self.p["bias"][0]
        return (logit, (kept, both, weight, pooled)) if keep else logit

    def gradients(self, lex: Lexicon, rows: np.ndarray, label: np.ndarray, word_kept: np.ndarray) -> dict:
        h, p = HIDDEN, self.p
        vectors = self.vectors(lex, word_kept)
        logit, (kept, both, weight, pooled) = self.forward(self.inputs(vectors), rows, keep=True)
        g = {k: np.zeros_like(v) for k, v in p.items()}
        d_logit = ((_sigmoid(logit) - label) / len(rows)).astype(np.float32)
        g["out"], g["bias"] = pooled.T @ d_logit, np.array([d_logit.sum()], np.float32)
        d_pooled = d_logit[:, None] * p["out"]
        d_weight = (both * d_pooled).sum(-1)
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
        g["att"] = np.einsum("tn,tnd->d", d_score, both)
        d_both = weight[..., None] * d_pooled + d_score[..., None] * p["att"]
        d_states = np.stack([d_both[..., :h], d_both[..., h:]])
        d_given = np.empty((2, WINDOW, len(rows), 3 * h), np.float32)
        d_state = np.zeros((2, len(rows), h), np.float32)
        for t in reversed(range(WINDOW)):
            back = WINDOW - 1 - t
            state, z, r, new, own, there = kept[t]
            d = (d_state + np.stack([d_states[0, t], d_states[1, back]])) * there
            d_new = d * (1 - z) * (1 - new * new)
            d_z = d * (state - new) * z * (1 - z)
            d_r = d_new * own * r * (1 - r)
            d_own = np.concatenate([d_z, d_r, d_new * r], axis=-1)
            d_state = d * z + d_own @ p["h"].transpose(0, 2, 1)
            g["h"] += state.transpose(0, 2, 1) @ d_own
            step = np.concatenate([d_z, d_r, d_new], axis=-1)
            d_given[0, t], d_given[1, back] = step[0], step[1]
        flat = rows.T.ravel()
        order = np.argsort(flat, kind="stable")
        used, first = np.unique(flat[order], return_index=True)
        d_added = np.zeros((2, len(vectors) + 1, 3 * h), np.float32)
        d_added[:, used] = np.add.reduceat(d_given.reshape(2, -1, 3 * h)[:, order], first, axis=1)
        d_added = d_added[:, :-1]
        g["x"], g["b"] = vectors.T @ d_added, d_added.sum(axis=1, keepdims=True)
        d_vectors = (d_added @ p["x"].transpose(0, 2, 1)).sum(axis=0)
        np.add.at(g["word"], lex.word, d_vectors[:, :WORD_DIM] * word_kept[:, None])
        sizes = np.diff(np.append(lex.starts, len(lex.grams)))
        np.add.at(g["char"], lex.grams, np.repeat(d_vectors[:, WORD_DIM:] * 0.3, sizes, axis=0))
        return g

    def logits(self, words: list[bytes], rows: np.ndarray) -> np.ndarray:
        """Logits of windows over ``words`` (``rows`` index them; len(words) is the padding)."""
        added = self.inputs(self.vectors(Lexicon.of(words)))
        return np.concatenate(
            [self.forward(added, rows[k : k + _BATCH]) for k in range(0, len(rows), _BATCH)] or [np.zeros(0)]
        )

    def worst(self, texts: list[list[bytes]]) -> np.ndarray:
        """The largest window logit of each text; -inf without words."""
        out = np.full(len(texts), -np.inf)
        words, index, lengths = _index(texts)
        text, start = _windows(lengths)
        if len(text):
            np.maximum.at(out, text, self.logits(words, _rows(index, lengths, text, start, len(words))))
        return out

    def scores(self, texts: Iterable[str | None]) -> np.ndarray:
        """Scores of whole texts, worked on in chunks; longer texts go in overlapping parts."""
        out: list[float] = []
        held: list[list[bytes]] = []
        owner: list[int] = []

        def flush():
            for k, logit in zip(owner, self.worst(held), strict=True):
                out[k] = max(out[k], logit)
            held.clear()
            owner.clear()

        size = 0
        for k, text in enumerate(texts):
            out.append(-np.inf)
            words = words_of(text)
            for start in range(0, max(len(words) - WINDOW + STRIDE, 1), CHUNK_WORDS):
                part = words[start : start + CHUNK_WORDS + WINDOW - STRIDE]
                held.append(part)
                owner.append(k)
                size += len(part)
                if size >= CHUNK_WORDS:
                    flush()
                    size = 0
        flush()
        return _sigmoid(np.clip((np.array(out) - self.cut) * self.scale, -60, 60))


class Constant:
    """Stands in for the network where the labels have one class only: always its share of toxic rows."""

    def __init__(self, share: float):
        self.share = share

    def scores(self, texts: Iterable[str | None]) -> np.ndarray:
        return np.array([self.share for _ in texts])


def fit(texts: list[str | None], toxic: list[int], seed: int = 7):
    """Train on the rows given; see the module's text."""
    label = np.array(toxic, np.float32)
    if not len(label) or label.min() == label.max():
        return Constant(float(label.mean()) if len(label) else 0.0)
    rng = np.random.default_rng(seed)
    net = Network(seed)
    words, index, lengths = _index(map(words_of, texts))
    text, start = _windows(lengths)
    rows = _rows(index, lengths, text, start, len(words))
    if not len(rows):
        return Constant(float(label.mean()))
    lex = Lexicon.of(words)
    grams_of = np.append(lex.starts, len(lex.grams))
    # Every fifth row sets the cut and is not learned from, where there are rows enough for that.
    aside = (np.arange(len(label)) % 5 == 0) & (min(label.sum(), len(label) - label.sum()) >= 100)
    of_toxic = np.flatnonzero((label[text] == 1) & ~aside[text])
    of_clean = np.flatnonzero((label[text] == 0) & ~aside[text])

    moment = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in net.p.items()}
    step = 0

    def train(pos: np.ndarray, neg: np.ndarray, rate: float) -> None:
        nonlocal step
        chosen = np.concatenate([pos, neg])
        target = np.repeat([1.0, 0.0], [len(pos), len(neg)])
        order = rng.permutation(len(chosen))
        for k in range(0, len(order), 256):
            take = chosen[order[k : k + 256]]
            used, local = np.unique(rows[take], return_inverse=True)
            local = local.reshape(len(take), WINDOW)
            used = used[used < len(words)]  # what is left of ``local`` is the padding
            counts = grams_of[used + 1] - grams_of[used]
            first = np.cumsum(counts) - counts
            at = np.repeat(grams_of[used] - first, counts) + np.arange(counts.sum())
            part = Lexicon(lex.word[used], lex.grams[at], first)
            word_kept = (rng.random(len(used)) < 0.5).astype(np.float32)  # else words would be learned by heart
            grads = net.gradients(part, local, target[order[k : k + 256]], word_kept)
            step += 1
            for name, grad in grads.items():
                m, v = moment[name]
                m += 0.1 * (grad - m)
                v += 0.01 * (grad * grad - v)
                net.p[name] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)

    def pick(pool: np.ndarray, n: int) -> np.ndarray:
        return rng.choice(pool, min(n, len(pool)), replace=False)

    def all_logits() -> np.ndarray:
        added = net.inputs(net.vectors(lex))
        return np.concatenate([net.forward(added, rows[k : k + _BATCH]) for k in range(0, len(rows), _BATCH)])

    if not len(of_toxic) or not len(of_clean):
        return Constant(float(label.mean()))
    n = 8000
    repeats = max(1, 4000 // min(len(of_toxic), n))  # small samples are gone over more often
    for _ in range(min(repeats, 8)):
        train(pick(of_toxic, n), pick(of_clean, n), 0.01)
    for _ in range(3):
        logit = all_logits()
        # Texts whose worst window doesn't look toxic to a network that has seen all windows are mislabelled:
        # learning them would only be learning them by heart.
        best = of_toxic[logit[of_toxic] > min(0.0, np.sort(logit[of_toxic])[-max(1, int(label.sum()))])]
        hard = of_clean[np.argsort(-logit[of_clean])[:n]]
        for _ in range(min(max(1, 2000 // len(best)), 4)):
            train(pick(best, n), np.concatenate([pick(hard, n // 2), pick(of_clean, n // 2)]), 0.005)

    # Buckets that training never met say nothing.
    seen = np.zeros(1 << BUCKET_BITS, bool)
    seen[lex.word] = True
    net.p["word"][~seen] = 0
    seen[:] = False
    seen[lex.grams] = True
    net.p["char"][~seen] = 0

    top = np.full(len(label), -30.0)
    np.maximum.at(top, text, all_logits())
    judged = aside if aside.any() else ~aside
    net.cut = _best_cut(top[judged], label[judged])
    return net


def _best_cut(logit: np.ndarray, label: np.ndarray) -> float:
    """The cut with the fewest wrong rows; the middle of the widest gap among equals."""
    order = np.argsort(logit, kind="stable")
    value, positive = logit[order], label[order]
    wrong = np.concatenate([[0], np.cumsum(positive)]) + np.concatenate([np.cumsum((1 - positive)[::-1])[::-1], [0]])
    edges = np.concatenate([[value[0] - 2], value, [value[-1] + 2]])
    low, high = edges[:-1], edges[1:]
    best = np.flatnonzero(wrong == wrong.min())
    k = best[np.argmax((high - low)[best])]
    return float((low[k] + high[k]) / 2)


def training_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Up to MAX_ROWS (text, toxic) rows of each class, chosen by a hash of the id.

    Learns from rows of the training folds only. Rows without text or label,
    and texts over MAX_CHARS, are left out of the sample; labels of other
    documents change nothing. A document with labels of both kinds counts for
    both classes, one with the same label twice once.
    """
    marked = labels.select(F.col("doc_id").alias("__id"), F.col("toxic").cast("int").alias("__toxic")).filter(
        F.col("__toxic").isin(0, 1) & F.col("__id").isNotNull() & ~held_out_fold(F.col("__id"))
    )
    rows = docs.select(F.col("doc_id").alias("__id"), F.col("text").cast("string").alias("__text")).filter(
        F.char_length("__text").between(1, MAX_CHARS)
    )
    # Drawn from the labelled ids that have such a text; ids alone are joined, and texts read for the drawn ones only.
    there = cut(marked.distinct().join(rows.select("__id"), "__id", "left_semi"), "labelled")
    drawn = None
    for value in (0, 1):
        part = there.filter(F.col("__toxic") == value).orderBy(F.xxhash64("__id"), "__id").limit(MAX_ROWS)
        drawn = part if drawn is None else drawn.unionByName(part)
    joined = rows.join(F.broadcast(drawn), "__id")  # at most 2 MAX_ROWS ids
    out = None
    for value in (0, 1):
        part = joined.filter(F.col("__toxic") == value).orderBy(F.xxhash64("__id"), "__id", "__text").limit(MAX_ROWS)
        out = part if out is None else out.unionByName(part)
    return out.select(F.col("__text").alias("text"), F.col("__toxic").alias("toxic"))


def held_out_fold(doc_id: Column) -> Column:
    return F.coalesce(text_remainder(doc_id, 5) == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame):
    rows = training_sample(docs, labels).collect()  # bounded: 2 MAX_ROWS texts of MAX_CHARS
    return fit([r.text for r in rows], [r.toxic for r in rows])


def score(docs: DataFrame, model, text_col: str = "text") -> Column:
    """Score of each text of ``docs``; null and wordless texts get 0 from a network."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def of_text(texts):
        import pandas as pd

        held("toxicity", None, None)
        return pd.Series(shared.value.scores(texts.tolist()))

    return of_text(F.col(text_col).cast("string"))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted.

    Texts of any length are scored whole, in windows of ``WINDOW`` words.
    Null doc_ids are not held out. Equal texts get equal scores. With no
    labelled rows every score is 0; with one class, that class. Other columns
    are not read.
    """
    found = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out_fold(F.col("doc_id")).alias("held_out"),
        score(docs, train(docs, labels)).alias("score"),
    )
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
