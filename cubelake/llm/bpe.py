"""Byte-level BPE encoding and decoding.

The text is split into units (an optional leading space and a run of other
characters, or white space), every unit into the pieces of the byte-level
rule, and every piece is merged: a heap holds the merge ranks of all adjacent
pairs, the symbols form a doubly linked list, and an entry whose pair no
longer stands there is skipped when it is popped. Decoding concatenates the
vocabulary's byte strings.

Units repeat a lot, so a worker keeps the ids of up to ``CACHE_UNITS`` units it
has met lately and lets the others go. That changes no result.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterable, Iterator
from heapq import heapify, heappop, heappush
from itertools import chain, pairwise

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubelake.llm.common import ship

CACHE_UNITS = 800_000

# The byte-level splitting rule and Unicode's White_Space set.
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_PIECE = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+"
    rf"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
_UNIT = rf" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in the vocabulary file."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    shifted = iter(range(0x100, 0x200))
    kept = set(own)
    return [chr(b) if b in kept else chr(next(shifted)) for b in range(256)]


class _Recent(dict):
    """Ids of the units met lately; at ``CACHE_UNITS`` the older half is let go."""

    def __init__(self, make: Callable[[str], tuple[int, ...]]):
        super().__init__()
        self._make, self._older = make, {}

    def __missing__(self, unit: str) -> tuple[int, ...]:
        ids = self._older.get(unit)
        if ids is None:
            ids = self._make(unit)
        if 2 * len(self) >= CACHE_UNITS:
            self._older = dict(self)
            self.clear()
        self[unit] = ids
        return ids


class ByteBPE:
    """Encoder and decoder for one byte-level vocabulary (the JSON text of its file)."""

    def __init__(self, spec: str):
        spec = json.loads(spec)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        alphabet = byte_alphabet()
        byte_of = {c: b for b, c in enumerate(alphabet)}
        self._byte_id = [vocab.get(c) for c in alphabet]
        # _rank[left id][right id]: rank of the merge; _made[rank]: id of what it makes.
        self._rank: list[dict[int, int]] = [{} for _ in range(max(vocab.values()) + 1)]
        self._made: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            one, two = pair.split(" ") if isinstance(pair, str) else pair
            self._rank[vocab[one]][vocab[two]] = rank
            self._made.append(vocab[one + two])
        self._added = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        self._bytes = {i: bytes(byte_of[c] for c in s) for s, i in vocab.items()}
        self._bytes |= {i: s.encode() for s, i in self._added.items()}
        by_length = sorted(self._added, key=len, reverse=True)
        self._special = re.compile("(" + "|".join(map(re.escape, by_length)) + ")") if by_length else None
        self._decimal = {i: str(i) for i in self._bytes}
        self._pieces = regex.compile(_PIECE).findall
        self._units = re.compile(_UNIT).findall
        self._cache = _Recent(self._unit)

    def merge(self, piece: str) -> list[int]:
        """Ids of one piece. A heap entry is ``rank << bits | position``."""
        data = piece.encode()
        ids = [self._byte_id[b] for b in data]
        n, ranks, made = len(ids), self._rank, self._made
        bits = n.bit_length()
        low = (1 << bits) - 1
        heap = [
            rank << bits | i
            for i, (one, two) in enumerate(pairwise(ids))
            if (rank := ranks[one].get(two)) is not None
        ]
        heapify(heap)
        left, right = list(range(-1, n)), list(range(1, n + 2))
        while heap:
            entry = heappop(heap)
            i = entry & low
            j = right[i]
            if j >= n or (rank := ranks[ids[i]].get(ids[j])) is None or rank << bits | i != entry:
                continue  # stale: what was queued no longer stands here
            ids[i] = one = made[rank]
            ids[j] = -1
            right[i] = k = right[j]
            right[j] = n
            if k < n:
                left[k] = i
                if (rank := ranks[one].get(ids[k])) is not None:
                    heappush(heap, rank << bits | i)
            if i and (rank := ranks[ids[h := left[i]]].get(one)) is not None:
                heappush(heap, rank << bits | h)
        return [x for x in ids if x >= 0]

    def _unit(self, unit: str) -> tuple[int, ...]:
        pieces = self._pieces(unit)
        if len(pieces) == 1:
            return tuple(self.merge(unit))
        return tuple(chain.from_iterable(map(self._cache.__getitem__, pieces)))

    def _plain(self, text: str) -> Iterable[int]:
        return chain.from_iterable(map(self._cache.__getitem__, self._units(text)))

    def encode(self, text: str) -> list[int]:
        if self._special is None or not self._special.search(text):
            return list(self._plain(text))
        ids: list[int] = []
        for k, part in enumerate(self._special.split(text)):
            if k % 2:
                ids.append(self._added[part])
            elif part:
                ids.extend(self._plain(part))
        return ids

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self._bytes.__getitem__, ids)).decode("utf-8", "replace")

    def decimal(self, ids: Iterable[int]) -> str:
        return ",".join(map(self._decimal.__getitem__, ids))


_LOADED: dict[int, ByteBPE] = {}


def loaded(spec: str) -> ByteBPE:
    """One encoder per vocabulary and worker, kept between tasks."""
    key = hash(spec)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = ByteBPE(spec)
    return _LOADED[key]


def read_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode_documents(docs: DataFrame, vocabulary: str, text_col: str = "text") -> DataFrame:
    """Add ``ids`` (array of int) to every row; null text counts as empty.

    ``vocabulary`` is the path of the vocabulary file on the driver; its
    content (one bounded file) is broadcast. An empty text has no ids.
    """
    spark = docs.sparkSession
    ship(spark)
    spec = spark.sparkContext.broadcast(read_vocabulary(vocabulary))

    @F.udf("array<int>", useArrow=True)
    def encode(text):
        return loaded(spec.value).encode(text or "")

    return docs.withColumn("ids", encode(F.col(text_col)))


def decode_documents(docs: DataFrame, vocabulary: str, ids_col: str = "ids") -> DataFrame:
    """Add ``decoded``: the vocabulary strings of the ids, concatenated; null ids count as none."""
    spark = docs.sparkSession
    ship(spark)
    spec = spark.sparkContext.broadcast(read_vocabulary(vocabulary))

    @F.udf("string", useArrow=True)
    def decode(ids):
        return loaded(spec.value).decode([] if ids is None else [int(i) for i in ids])

    return docs.withColumn("decoded", decode(F.col(ids_col)))


def round_trip_digest(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256.

    Ids and decoded texts are digested where they are made, so nothing but
    the digests leaves the task. Repeated rows give repeated results; other
    columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    spec = spark.sparkContext.broadcast(read_vocabulary(vocabulary))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, sha = loaded(spec.value), hashlib.sha256
        for batch in batches:
            counts, coded, decoded = [], [], []
            for text in batch.column(1):
                ids = bpe.encode(text.as_py() or "")
                counts.append(len(ids))
                coded.append(sha(bpe.decimal(ids).encode()).hexdigest())
                decoded.append(sha(bpe.decode(ids).encode("utf-8")).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
