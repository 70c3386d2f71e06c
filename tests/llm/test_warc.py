import base64
import hashlib
import io
import struct

import pytest
import zstandard
from pyspark.sql import functions as F

from tidewater.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, payload string"


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def brute(pages, min_bytes=0):
    holder = {}
    for i, html in pages:
        if i is not None:
            h = digest(html)
            holder[h] = min(holder.get(h, i), i)
    out = []
    for i, html in pages:
        size = len((html or "").encode())
        first = holder.get(digest(html)) if size >= min_bytes else None
        revisit = first is not None and first != i
        out.append((i, size, digest(html), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


def table(spark, pages):
    return spark.createDataFrame([(i, f"http://x/{i}\r\nInjected: y", html, "d", "p") for i, html in pages], SCHEMA)


PAGES = [(i, f"<html><head><title>Page {i % 50}</title></head><body>{'lorem ipsum ' * (i % 9)}é{i % 50}\r\n\r\n</body></html>") for i in range(300)]
ODD = [(400, None), (401, ""), (402, "x" * 3_000_000), (403, "\r\n\r\nWARC/1.1\r\n"), (403, "\r\n\r\nWARC/1.1\r\n"), (None, "no id"), (404, "no id"),
       (None, "nobody"), (-1, "")]


@pytest.mark.parametrize("min_bytes", [0, 60])
def test_round_trip(spark, min_bytes):
    got = warc.round_trip(table(spark, PAGES + ODD), min_bytes=min_bytes).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(PAGES + ODD, min_bytes)


def test_archives_are_rolled_and_hold_one_frame_a_record(spark):
    folder, manifest = warc.archive(table(spark, PAGES).repartition(2), max_file_bytes=4096)
    rows = manifest.collect()
    assert sum(r.records for r in rows) == len(PAGES) and len(rows) > 2
    for r in rows[:3]:
        data = open(f"{folder.removeprefix('file://')}/{r.file}", "rb").read()
        magic, size = struct.unpack("<II", data[:8])
        assert magic == warc.DICTIONARY_MAGIC and len(data) == r.bytes
        coder, at, n = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8:8 + size])), 8 + size, 0
        while at < len(data):
            one = coder.decompressobj()
            assert one.decompress(data[at:]).startswith(b"WARC/1.1\r\n")
            at, n = len(data) - len(one.unused_data), n + 1
        assert n == r.records


def test_without_a_dictionary_and_empty(spark):
    few = [(1, "a"), (2, "a"), (3, "b")]
    folder, manifest = warc.archive(table(spark, few))
    data = open(f"{folder.removeprefix('file://')}/{manifest.first().file}", "rb").read()
    assert struct.unpack("<I", data[:4])[0] != warc.DICTIONARY_MAGIC
    assert sorted((tuple(r) for r in warc.round_trip(table(spark, few)).collect()), key=str) == brute(few)
    assert warc.round_trip(table(spark, [])).count() == 0


def test_the_dictionary_saves_space():
    records = [warc.record(i, f"http://host/{i}", html.encode(), None) for i, html in PAGES]
    trained = zstandard.ZstdCompressionDict(warc.train_dictionary(records))
    plain = sum(len(zstandard.ZstdCompressor().compress(r)) for r in records)
    assert sum(len(zstandard.ZstdCompressor(dict_data=trained).compress(r)) for r in records) < 0.6 * plain


def test_a_stream_without_records():
    assert list(warc.records_of(io.BytesIO(b""))) == []


def test_digests_are_of_the_whole_payload(spark):
    got = warc.round_trip(table(spark, [(1, "é" * 10)])).select(F.col("payload_bytes"), F.col("payload_digest")).first()
    assert tuple(got) == (20, digest("é" * 10))
