"""Web archives with a Zstandard dictionary: one record per page, repeats as revisits.

Every task collects records up to ``ARCHIVE_BYTES``, builds a dictionary from
all records of that archive, and writes the archive: a skippable frame that
holds the dictionary, then each record as a frame of its own, compressed with
it. So any record can be read alone, with the dictionary at the front.

Archives get names that no other attempt of a task uses, and the manifest (the
rows that the tasks return, committed by Spark with the attempt that counts)
says which ones are good: files of lost or repeated attempts are not in it.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from cubelake import fs
from cubelake.llm.common import cut, ship
from cubelake.sources.cube_csv import _filesystem, _open_random_access

#: Records of an archive before compression (one record may be larger); also what a task holds at once.
ARCHIVE_BYTES = 16 << 20
#: Size of a dictionary at most, and how much of one record it is built from. Both only change the size of archives.
DICTIONARY_BYTES, SAMPLE_BYTES = 112_640, 64 << 10
LEVEL = 3
#: Payloads shorter than this are stored in full, however often they occur.
REVISIT_BYTES = 100

# Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE_FIELD, REFERS_FIELD = "X-Page-ID", "X-Refers-To-Page-ID"

MANIFEST = "archive string, records long, raw_bytes long, archive_bytes long"
RECORD = (
    "page_id long, target_uri string, record_id string, record_type string, payload_bytes long, "
    "payload_digest string, refers_to long, refers_to_record string"
)


def _record_id(page_id: int | None, digest: str) -> str:
    """Rows of one page_id and payload describe one record, so they share its id."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def _field_value(value: str) -> str:
    """A header value on one line: control characters and spaces are percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record_bytes(page_id, url, payload: bytes, digest: str, first, revisit: bool, date: str) -> bytes:
    """One WARC record: a response with its payload, or a revisit of page ``first`` without."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() if revisit else http.encode() + payload
    fields = {"WARC-Type": "revisit" if revisit else "response", "WARC-Record-ID": _record_id(page_id, digest)}
    if url is not None:
        fields["WARC-Target-URI"] = _field_value(url)
    fields |= {"WARC-Date": date, "WARC-Payload-Digest": f"sha256:{digest}"}
    if revisit:
        fields |= {"WARC-Profile": PROFILE, "WARC-Refers-To": _record_id(first, digest), REFERS_FIELD: str(first)}
    if page_id is not None:
        fields[PAGE_FIELD] = str(page_id)
    fields |= {"Content-Type": "application/http; msgtype=response", "Content-Length": str(len(block))}
    head = b"".join(f"{k}: {v}\r\n".encode() for k, v in fields.items())
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def build_dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """A dictionary from the records of one archive; from pieces of them if they are few; none if that is too little."""
    samples = [r[:SAMPLE_BYTES] for r in records]
    pieces = [s[i : i + 64] for s in samples[:64] for i in range(0, len(s), 64)]
    for tried in (samples, pieces):
        size = min(DICTIONARY_BYTES, max(256, sum(map(len, tried)) // 8))
        try:
            return zstandard.train_dictionary(size, tried, k=256 if tried is samples else 32, d=8)
        except zstandard.ZstdError:
            continue
    return None


def _open_output(path: str):
    """A new file, written as given (by its name it would be compressed once more)."""
    filesystem, inner = _filesystem(path)
    filesystem.create_dir(inner.rpartition("/")[0], recursive=True)
    return filesystem.open_output_stream(inner, compression=None)


def write_archive(path: str, records: list[bytes]) -> int:
    """Write one archive; returns its size."""
    dictionary = build_dictionary(records)
    compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_checksum=True)
    size = 0
    with _open_output(path) as out:
        if dictionary is not None:
            dictionary.precompute_compress(level=LEVEL)
            body = dictionary.as_bytes()
            out.write(struct.pack("<II", DICTIONARY_MAGIC, len(body)) + body)
            size = 8 + len(body)
        for record in records:
            frame = compressor.compress(record)
            out.write(frame)
            size += len(frame)
    return size


def _writer(folder: str, date: str, archive_bytes: int):
    """For ``mapInArrow``: writes the pages of a task to archives, returns their manifest rows."""

    def write(records: list[bytes], held: int) -> pa.RecordBatch:
        path = f"{folder}/{uuid.uuid4().hex}.warc.zst"
        row = {"archive": [path], "records": [len(records)], "raw_bytes": [held], "archive_bytes": [write_archive(path, records)]}
        return pa.RecordBatch.from_pydict(row)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records, held = [], 0
        for batch in batches:
            for row in zip(*batch.columns):
                record = record_bytes(*(v.as_py() for v in row), date)
                if records and held + len(record) > archive_bytes:
                    yield write(records, held)
                    records, held = [], 0
                records.append(record)
                held += len(record)
        if records:
            yield write(records, held)

    return run


def _repeats(payload: Column, pages: DataFrame) -> DataFrame:
    """Digests of payloads that several pages have, with the smallest of their ids."""
    slim = pages.select(F.sha2(payload, 256).alias("digest"), F.octet_length(payload).alias("size"), "page_id")
    found = slim.filter(F.col("size") >= REVISIT_BYTES).groupBy("digest")
    return found.agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")


def write_archives(
    pages: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES
) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html) into archives under ``folder``; returns the manifest.

    The payload is the html in UTF-8, none for null. Of rows with equal
    payloads of ``REVISIT_BYTES`` or more, those with the smallest page_id are
    responses (also where several rows share that id) and the others revisit
    it; a row with a null page_id revisits if any of the rows has an id, and
    otherwise all are responses. A null url gives a record without
    WARC-Target-URI. ``date`` is the WARC-Date of all records, as pages carry
    none. An empty table writes nothing and gives an empty manifest. Columns
    besides the three are not looked at, whatever their names.

    Payloads are compared by SHA-256: the digests alone are grouped, and only
    those that occur again are joined back to the pages (a hot payload is one
    row a task in the grouping and split by AQE in the join).
    """
    spark = pages.sparkSession
    ship(spark)
    pages = pages.select("page_id", "url", "html")
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    repeats = cut(_repeats(payload, pages), "repeats")
    rows = pages.select("page_id", "url", payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    decided = rows.join(repeats, "digest", "left").select(
        "page_id", "url", "payload", "digest", "first", revisit.alias("revisit")
    )
    target = fs.qualify(spark, folder).rstrip("/")
    return cut(decided.mapInArrow(_writer(target, date, archive_bytes), MANIFEST), "warc-manifest")


def records_of(source) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record of an open archive."""
    magic, size = struct.unpack("<II", source.read(8).ljust(8, b"\0"))
    dictionary = None
    if magic == DICTIONARY_MAGIC:
        dictionary = zstandard.ZstdCompressionDict(source.read(size))
    else:
        source.seek(0)
    with zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(source, read_across_frames=True) as plain:
        lines = io.BufferedReader(plain, 1 << 16)
        while version := lines.readline():
            if version.rstrip() != VERSION:
                raise ValueError(f"not a record: {version[:40]!r}")
            fields = {}
            while line := lines.readline().rstrip(b"\r\n"):
                name, _, value = line.decode().partition(":")
                fields[name.strip()] = value.strip()
            block = lines.read(length := int(fields["Content-Length"]))
            if len(block) != length or lines.read(4) != b"\r\n\r\n":
                raise ValueError(f"record {fields.get('WARC-Record-ID')} is cut off")
            yield fields, block


def _as_row(fields: dict[str, str], block: bytes, with_payload: bool) -> tuple:
    head, _, payload = block.partition(b"\r\n\r\n")
    revisit = fields["WARC-Type"] == "revisit"
    size = int(re.search(rb"(?im)^content-length:\s*(\d+)", head)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if not revisit and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"record {fields['WARC-Record-ID']} does not have its digest")
    ids = [int(fields[k]) if k in fields else None for k in (PAGE_FIELD, REFERS_FIELD)]
    row = (
        ids[0], fields.get("WARC-Target-URI"), fields["WARC-Record-ID"], fields["WARC-Type"], size, digest,
        ids[1], fields.get("WARC-Refers-To"),
    )
    return row + ((None if revisit else payload,) if with_payload else ())


def _reader(schema: pa.Schema, with_payload: bool, rows_at_once: int = 256):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)]
            return pa.RecordBatch.from_arrays(columns, schema=schema)

        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows = []
                with _open_random_access(path) as source:
                    for fields, block in records_of(source):
                        rows.append(_as_row(fields, block, with_payload))
                        if len(rows) == rows_at_once:
                            yield batch_of(rows)
                            rows = []
                if rows:
                    yield batch_of(rows)

    return run


def read_archives(manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """The records of the archives that a manifest (column ``archive``) names, one row each.

    ``payload_bytes`` and ``payload_digest`` are those of the full payload,
    also for revisits, whose stored header tells them; ``with_payload`` adds
    ``payload`` (null for revisits). Responses whose payload does not have
    the digest of their header, and cut off records, raise.
    """
    spark = manifest.sparkSession
    ship(spark)
    form = RECORD + (", payload binary" if with_payload else "")
    schema = to_arrow_schema(spark.createDataFrame([], form).schema)
    # the manifest itself is small: spread its archives over tasks, not its bytes
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    paths = manifest.select("archive")
    return paths.repartition(max(1, min(paths.count(), tasks))).mapInArrow(_reader(schema, with_payload), form)
