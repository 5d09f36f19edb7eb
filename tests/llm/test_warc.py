"""Dictionary-compressed archives: exact round trips, revisits, damage."""

import glob
import hashlib
import struct

import pytest
import zstandard
from pyspark.sql import functions as F

from cubelake.llm import warc

PAGES = "page_id long, url string, html string"


def expected(pages):
    firsts = {}
    for i, _, h in pages:
        if i is not None and len((h or "").encode()) >= 100:
            firsts[h] = min(i, firsts.get(h, i))
    rows = []
    for i, _, h in pages:
        payload = (h or "").encode()
        first = firsts.get(h)
        revisit = first is not None and i != first
        kind = "revisit" if revisit else "response"
        rows.append((i, len(payload), hashlib.sha256(payload).hexdigest(), kind, first if revisit else None))
    return sorted(rows, key=str)


def case():
    long = "<p>" + "häuser \U0001f600 " * 30
    rows = [(k, f"http://h{k % 3}.org/{k}", f"<html><body>page {k % 40} " + "text " * (k % 40) * 3) for k in range(300)]
    rows += [
        (900, None, None), (901, "http://a.org/\r\nX-Page-ID: 5", ""), (902, "", long), (903, "u", long), (903, "u", long),
        (None, "n", long), (None, None, "only null ids " * 20), (None, None, "only null ids " * 20), (5000, "x", "short"),
        (5001, "x", "short"), (1, "again", "WARC/1.1\r\nContent-Length: 3\r\n\r\n" * 9), (6000, "z", "v" * 3_000_000),
        (-7, "z", "v" * 3_000_000),
    ]
    return rows


COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def test_round_trip(spark, tmp_dir):
    rows = case()
    pages = spark.createDataFrame(rows, PAGES).repartition(4)
    for name in ("digest", "first", "payload", "revisit", "n", "size"):
        pages = pages.withColumn(name, F.lit("theirs"))
    manifest = warc.write_archives(pages, f"{tmp_dir}/out")
    records = warc.read_archives(manifest, with_payload=True).collect()
    assert sorted((tuple(r[c] for c in COLUMNS) for r in records), key=str) == expected(rows)
    payloads = {r.page_id: r.payload for r in records if r.record_type == "response" and r.page_id is not None}
    texts = {i: (h or "").encode() for i, _, h in rows if i != 1}
    assert all(bytes(p) == texts[i] for i, p in payloads.items() if i != 1)
    ids = {r.record_id for r in records if r.record_type == "response"}
    assert all(r.refers_to_record in ids for r in records if r.record_type == "revisit")
    uris = {r.page_id: r.target_uri for r in records}
    assert uris[900] is None and uris[901] == "http://a.org/%0D%0AX-Page-ID:%205"
    assert manifest.agg(F.sum("records")).first()[0] == len(rows)


def test_layout_of_an_archive(spark, tmp_dir):
    pages = spark.createDataFrame([(k, "u", f"<html>{k} " + "shared words of all pages " * 9) for k in range(500)], PAGES)
    warc.write_archives(pages.coalesce(1), f"{tmp_dir}/out")
    (path,) = glob.glob(f"{tmp_dir}/out/*.warc.zst")
    data = open(path, "rb").read()
    magic, size = struct.unpack("<II", data[:8])
    assert magic == 0x184D2A5D and data[8:12] == struct.pack("<I", 0xEC30A437)  # a dictionary in zstd's own format
    dictionary = zstandard.ZstdCompressionDict(data[8 : 8 + size])
    rest, n = data[8 + size :], 0
    while rest:  # every record is a frame of its own
        frame = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
        record = frame.decompress(rest)
        assert record.startswith(b"WARC/1.1\r\nWARC-Type: response") and record.endswith(b"\r\n\r\n")
        assert zstandard.get_frame_parameters(rest).dict_id == dictionary.dict_id()
        rest, n = frame.unused_data, n + 1
    assert n == 500


def test_archives_are_rolled_and_orphans_ignored(spark, tmp_dir):
    pages = spark.createDataFrame([(k, "u", f"{k} " * 300) for k in range(200)], PAGES).coalesce(1)
    manifest = warc.write_archives(pages, f"{tmp_dir}/out", archive_bytes=20_000)
    assert manifest.count() > 5 and manifest.agg(F.max("raw_bytes")).first()[0] <= 20_000
    open(f"{tmp_dir}/out/lost-attempt.warc.zst", "wb").write(b"half a file")
    assert warc.read_archives(manifest).count() == 200


def test_one_short_record_and_none(spark, tmp_dir):
    one = spark.createDataFrame([(None, None, None)], PAGES)
    (row,) = warc.read_archives(warc.write_archives(one, f"{tmp_dir}/one")).collect()
    assert (row.page_id, row.payload_bytes, row.record_type) == (None, 0, "response")
    none = warc.write_archives(spark.createDataFrame([], PAGES), f"{tmp_dir}/none")
    assert none.count() == 0 and warc.read_archives(none).collect() == []


def test_damage_raises(spark, tmp_dir):
    pages = spark.createDataFrame([(k, "u", f"page {k} " * 50) for k in range(50)], PAGES).coalesce(1)
    manifest = warc.write_archives(pages, f"{tmp_dir}/out")
    (path,) = glob.glob(f"{tmp_dir}/out/*.warc.zst")
    data = bytearray(open(path, "rb").read())
    data[-9] ^= 255
    open(path, "wb").write(data)
    with pytest.raises(Exception, match="ZstdError|digest|cut off|not a record"):
        warc.read_archives(manifest).collect()
