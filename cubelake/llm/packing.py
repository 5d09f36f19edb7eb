"""Order-preserving packing of tokenized documents into fixed-length sequences.

The documents of a partition are one long run of tokens. Dynamic programming
over its possible cuts (document ends, sentence ends, and a thin grid for
texts without sentences) chooses the windows: a window may hold up to
``limit`` tokens, its cost is its padding (none if its length is a power of
two) plus ``WINDOW_COST``, and a cut inside a document costs a truncation
penalty, less at a sentence end. The best predecessor of a cut is the least
of cost plus position among the cuts at most ``limit`` before it, kept in a
monotone queue, or one that stands a power of two before it.
"""

from __future__ import annotations

import gc
import json
import re
import zlib
from array import array
from collections import deque
from collections.abc import Iterable, Iterator
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubelake.llm.bpe import byte_alphabet
from cubelake.llm.common import ROW_BITS, held, ship

#: Penalties, in tokens of padding.
SENTENCE_CUT, FREE_CUT, WINDOW_COST = 8.0, 64.0, 128.0
#: Distance of the cuts that are possible anywhere.
GRID = 256
#: Tokens planned at once; the last, unfinished window goes on into the next plan.
PLAN_TOKENS = 1 << 20
#: Words whose ids a worker keeps (about 200 bytes each); at that number the older half is let go.
CACHE_WORDS = 1_000_000

# Characters that end a sentence.
_SENTENCE_END = set(".!?…。！？")

#: A mark after a letter or digit at a word's end: a piece of its own.
_MARK = re.compile(rb"[.,](?<=[0-9A-Za-z].)(?![^ \t\n\r\x0b\x0c])")
#: Letters and the marks after them are pieces of their own (an apostrophe may go with letters).
_LETTERS_MARKS = re.compile(rb"([a-z]+)([!-&(-/:-@\[-`{-~]+)")


def plan(total: int, ends: np.ndarray, sentences: np.ndarray, limit: int) -> list[int]:
    """Window ends, ascending, the last being ``total``.

    ``ends`` are positions after a document's last token, ``sentences`` those
    after a sentence; positions are 1 to ``total``.
    """
    if not total:
        return []
    powers = [1 << k for k in range(limit.bit_length()) if 1 << k <= limit]
    tail = total - np.cumsum([0, *(p for p in powers if total & p)])  # leaves whole powers of two behind
    grid = np.arange(0, total, min(GRID, limit))
    kinds = ((grid, FREE_CUT), (tail, FREE_CUT), (sentences, SENTENCE_CUT), (ends, 0.0), (np.array([0, total]), 0.0))
    at = np.concatenate([k for k, _ in kinds]).astype(np.int64)
    cost = np.concatenate([np.full(len(k), c) for k, c in kinds])
    inside = (at >= 0) & (at <= total)
    at, cost = at[inside], cost[inside]
    order = np.lexsort((cost, at))
    at, cost = at[order], cost[order]
    first = np.append(True, at[1:] != at[:-1])
    at, cost = at[first], cost[first]

    # Exact steps: for each cut, the cuts a power of two before it.
    steps: list[list[int]] = [[] for _ in range(len(at))]
    for power in powers:
        place = np.searchsorted(at, at - power)
        hit = at[place] == at - power
        for j, i in zip(np.flatnonzero(hit).tolist(), place[hit].tolist(), strict=True):
            steps[j].append(i)

    where, penalty = at.tolist(), cost.tolist()
    best, back = [0.0] * len(where), [0] * len(where)
    queue: deque[tuple[float, int, int]] = deque([(0.0, 0, 0)])  # (cost + position, position, index), ascending
    for j in range(1, len(where)):
        here = where[j]
        low = here - limit
        while queue[0][1] < low:
            queue.popleft()
        value, _, i = queue[0]
        value += limit - here
        for k in steps[j]:
            if best[k] < value:
                value, i = best[k], k
        value += WINDOW_COST + penalty[j]
        best[j], back[j] = value, i
        key = value + here
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, here, j))
    cuts, j = [], len(where) - 1
    while j:
        cuts.append(where[j])
        j = back[j]
    return cuts[::-1]


class Run:
    """The tokens of documents in order, cut into windows as they come."""

    def __init__(self, limit: int, sentence_end: np.ndarray):
        self.limit, self.sentence_end = limit, sentence_end
        self.sequence = 0
        self._docs: list[tuple[object, np.ndarray, int]] = []  # (doc_id, ids, ids already placed)
        self._held = 0

    def add(self, doc_id, ids: np.ndarray) -> Iterator[tuple]:
        self._docs.append((doc_id, ids, 0))
        self._held += len(ids)
        if self._held >= PLAN_TOKENS:
            yield from self._place(False)

    def finish(self) -> Iterator[tuple]:
        yield from self._place(True)

    def _place(self, last: bool) -> Iterator[tuple]:
        if not self._docs:
            return
        parts = [ids[done:] for _, ids, done in self._docs]
        ids = np.concatenate(parts)
        ends = np.cumsum([len(p) for p in parts])
        sentences = np.flatnonzero(self.sentence_end[ids]) + 1
        cuts = plan(len(ids), ends, sentences, self.limit)
        if not last:
            cuts = cuts[:-1]
        placed = cuts[-1] if cuts else 0
        starts = ends - [len(p) for p in parts]
        bounds = np.unique(np.concatenate([starts, cuts, [0]]))
        bounds = bounds[bounds < placed]
        stops = np.append(bounds[1:], placed)
        window = np.searchsorted(cuts, bounds, side="right")
        window_start = np.concatenate([[0], cuts])[window]
        owner = np.searchsorted(ends, bounds, side="right")
        data = memoryview(ids.astype("<u4", copy=False)).cast("B")
        for a, b, w, ws, k in zip(
            bounds.tolist(), stops.tolist(), window.tolist(), window_start.tolist(), owner.tolist(), strict=True
        ):
            doc_id, whole, done = self._docs[k]
            yield (
                doc_id, done + a - int(starts[k]), b - a, zlib.crc32(data[4 * a : 4 * b]), len(whole),
                self.sequence + w, a - int(ws),
            )
        self.sequence += len(cuts)
        first = int(np.searchsorted(ends, placed, side="right"))
        kept = self._docs[first:]
        if kept:
            doc_id, whole, done = kept[0]
            kept[0] = (doc_id, whole, done + max(0, placed - int(starts[first])))
        self._docs, self._held = kept, len(ids) - placed


class WordIds(dict):
    """Ids of a white-space-delimited word, as little-endian bytes; looked up in the tokenizer when new.

    The tokenizer drops white space and splits at it, so a text's ids are
    those of its words.
    """

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        super().__init__()
        tokenizer = Tokenizer.from_str(spec)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        self._encode, self._merge, self._older = tokenizer.encode, tokenizer.model.tokenize, {}
        self._alphabet = byte_alphabet()
        spec = json.loads(spec)
        vocab = spec["model"]["vocab"]
        self._added = [t["content"].lower().encode() for t in spec["added_tokens"]]
        self.sentence_end = np.zeros(tokenizer.get_vocab_size(with_added_tokens=True) + 1, bool)
        for token, i in vocab.items():
            word = token.removesuffix("</w>")
            self.sentence_end[i] = token != word and bool(word) and set(word) <= _SENTENCE_END

    def __missing__(self, word: bytes) -> bytes:
        ids = self._older.get(word)
        if ids is None:
            ids = self._new(word)
        if 2 * len(self) >= CACHE_WORDS:
            self._older = dict(self)
            self.clear()
        self[word] = ids
        return ids

    def _new(self, word: bytes) -> bytes:
        if word.isalpha() and word.islower():  # ASCII letters, the most frequent kind
            return array("I", [t.id for t in self._merge(word.decode())]).tobytes()
        low = word.lower()
        # The tokenizer takes lower case, but looks for its added tokens before that.
        if low != word and not any(t in low for t in self._added):
            return self[low]
        if word[-1:] in (b".", b",") and word[-2:-1].isalnum():
            return self[word[:-1]] + self[word[-1:]]  # letters or digits and a mark are pieces of their own
        if parts := _LETTERS_MARKS.fullmatch(word):
            return self[parts[1]] + self[parts[2]]
        text = word.decode("utf-8", "replace")
        if text.isalpha() and max(text) < "\u0250" and text == text.lower() and is_normalized("NFC", text):
            # One piece of normalized Latin letters: its bytes, spelled in the vocabulary's alphabet.
            found = [t.id for t in self._merge("".join(map(self._alphabet.__getitem__, word)))]
        else:
            found = self._encode(text, add_special_tokens=False).ids
        return array("I", found).tobytes()

    def encode(self, text: bytes, end: bytes) -> np.ndarray:
        low = text.lower()
        # What makes few words into many is taken off the whole text at once, if no added token stands in it.
        words = text.split() if any(t in low for t in self._added) else _MARK.sub(rb" \g<0>", low).split()
        return np.frombuffer(b"".join(map(self.__getitem__, words)) + end, "<u4")


def _loaded(spec: str) -> WordIds:
    return held("packing", hash(spec), lambda: WordIds(spec))


PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


def pack(docs: DataFrame, vocabulary: str, limit: int = 4096, end_id: int = 2) -> DataFrame:
    """Pieces of all documents; see ``PIECES``.

    A document's tokens are those of the tokenizer in the file
    ``vocabulary`` (one bounded file, read by the driver and broadcast) and
    ``end_id``. Null and empty texts are that one token; null doc_ids stay
    null. Each partition of ``docs`` is packed in its own order; sequence ids
    of partitions never meet. Repeated rows are packed each; an empty table
    gives no pieces. Windows are planned over ``PLAN_TOKENS`` and the rest of
    the last document at a time, so a very long text is in memory as its ids,
    4 bytes each. Only doc_id and text are read, whatever else there is.
    """
    spark = docs.sparkSession
    ship(spark)
    with open(vocabulary, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())

    def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _loaded(spec.value)
        end = np.array([end_id], "<u4").tobytes()
        run, base = Run(limit, words.sentence_end), None
        names = [x.split()[0] for x in PIECES.split(", ")]

        def out(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            columns[5] = [base + s for s in columns[5]]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

        # Nothing here is cyclic, and looking for cycles among that many small objects takes a tenth of the time.
        often = gc.get_threshold()
        gc.set_threshold(100_000, *often[1:])
        try:
            for batch in batches:
                for row, doc_id, text in zip(*batch.columns, strict=True):
                    if base is None:
                        base = row.as_py() >> ROW_BITS << ROW_BITS
                    raw = text.as_buffer()
                    ids = words.encode(b"" if raw is None else raw.to_pybytes(), end)
                    if rows := list(run.add(doc_id.as_py(), ids)):
                        yield out(rows)
            if rows := list(run.finish()):
                yield out(rows)
        finally:
            gc.set_threshold(*often)

    return docs.select(
        F.monotonically_increasing_id(), F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary")
    ).mapInArrow(pieces, PIECES)
