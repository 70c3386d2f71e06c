"""WARC archives of pages, one Zstandard frame a record, with the dictionary in a leading skippable frame.

The dictionary is trained on a bounded sample of the records.  Each task
writes its own archives (rolled at ``max_file_bytes``), and only files of
tasks that succeeded are listed in the manifest; reading follows the manifest.
Payloads that occur more than once are stored once, by the smallest page id;
the other pages are revisit records of it.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import small_batches, written
from tidewater.session import scratch_dir

#: Magic number of the skippable frame that holds a WARC dictionary.
DICTIONARY_MAGIC = 0x184D2A5D
SAMPLE_RECORDS = 2000
SAMPLE_BYTES = 8 << 20
RECORD_SAMPLE_BYTES = 64 << 10
DICTIONARY_BYTES = 64 << 10
WARC_DATE = "2000-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ID = re.compile(rb"<urn:page:([^>]*)>")


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response record of the payload, or the revisit record that refers to another page's response."""
    name = lambda i: f"<urn:page:{'' if i is None else i}>"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {name(page_id)}",
            f"WARC-Date: {WARC_DATE}", "WARC-Target-URI: " + re.sub(r"[\r\n]+", "%0A", url or ""),
            f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: {name(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(head: bytes, block: bytes) -> tuple:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of a record.

    A response's digest and size are taken from its payload, a revisit's from its headers.
    """
    fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:] if b": " in line)

    def page(field: bytes) -> int | None:
        found = _ID.search(fields.get(field, b""))
        return int(found[1]) if found and found[1] else None

    http, _, payload = block.partition(b"\r\n\r\n")
    kind = fields[b"WARC-Type"].decode()
    if kind == "response":
        return page(b"WARC-Record-ID"), len(payload), base32_sha1(payload), kind, None
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    return page(b"WARC-Record-ID"), size, fields[b"WARC-Payload-Digest"].decode().removeprefix("sha1:"), kind, page(b"WARC-Refers-To")


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A Zstandard dictionary of the samples; empty where there are too few to train on."""
    if len(samples) < 16 or sum(map(len, samples)) < 16 * 1024:
        return b""
    try:
        return zstandard.train_dictionary(min(size, sum(map(len, samples)) // 10), samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _open(uri: str) -> tuple[FileSystem, str]:
    return FileSystem.from_uri(uri)


def _write(pages: DataFrame, folder: str, dictionary: bytes, level: int, max_file_bytes: int) -> DataFrame:
    shared = pages.sparkSession.sparkContext.broadcast(dictionary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        fs, root = _open(folder)
        trained = zstandard.ZstdCompressionDict(shared.value) if shared.value else None
        pack = zstandard.ZstdCompressor(level=level, dict_data=trained, write_content_size=True)
        lead = struct.pack("<II", DICTIONARY_MAGIC, len(shared.value)) + shared.value if shared.value else b""
        out, made, n, size = None, [], 0, 0

        def closed() -> None:
            nonlocal out
            if out is not None:
                out.close()
                made[-1] += (n, size)
                out = None

        for batch in batches:
            for page_id, url, payload, refers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    name = f"{root}/{task.partitionId():06d}-{task.taskAttemptId()}-{len(made):04d}.warc.zst"
                    out, n, size = fs.open_output_stream(name, compression=None), 0, len(lead)
                    out.write(lead)
                    made.append((name.rsplit("/", 1)[1],))
                frame = pack.compress(record(page_id, url, payload, refers))
                out.write(frame)
                n, size = n + 1, size + len(frame)
                if size >= max_file_bytes:
                    closed()
        closed()
        if made:
            names, counts, sizes = zip(*made, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())],
                                             names=["file", "records", "bytes"])

    return pages.mapInArrow(run, "file string, records long, bytes long")


def records_of(stream) -> Iterator[tuple[bytes, bytes]]:
    """(head, block) of every record of an archive, read as a stream."""
    lead = stream.read(8)
    trained = None
    if len(lead) == 8 and struct.unpack("<II", lead)[0] == DICTIONARY_MAGIC:
        trained, lead = zstandard.ZstdCompressionDict(stream.read(struct.unpack("<II", lead)[1])), b""

    class Rest(io.RawIOBase):
        """What follows the dictionary; without one, the bytes read while looking for it come first."""

        head = lead

        def readable(self) -> bool:
            return True

        def readinto(self, buffer) -> int:
            data = self.head or stream.read(len(buffer))
            self.head = data[len(buffer):]
            buffer[: len(data[: len(buffer)])] = data[: len(buffer)]
            return len(data[: len(buffer)])

    plain = io.BufferedReader(zstandard.ZstdDecompressor(dict_data=trained).stream_reader(Rest(), read_across_frames=True), 1 << 20)
    while True:
        head = []
        while line := plain.readline():
            if line == b"\r\n":
                break
            head.append(line)
        if not head:
            return
        text = b"".join(head).rstrip(b"\r\n")
        size = int(re.search(rb"\r\nContent-Length: (\d+)", text)[1])
        block = plain.read(size)
        plain.read(4)
        yield text, block


def _read(manifest: DataFrame, folder: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows: list[tuple] = []
                with fs.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for head, block in records_of(stream):
                        rows.append(parse(head, block))
                        if len(rows) >= 20_000:
                            yield _rows(rows)
                            rows = []
                if rows:
                    yield _rows(rows)

    def _rows(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                          names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    files = manifest.select("file").repartition(max(1, manifest.count()))
    return files.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def _sample(rows: DataFrame) -> list[bytes]:
    """Records to train on: SAMPLE_RECORDS pages by hash, at most SAMPLE_BYTES of them.

    Only ids and hashes are ordered; payloads are looked up afterwards.  Of a
    longer payload a stretch of RECORD_SAMPLE_BYTES is taken at a place that its
    hash gives; a page that is repeated counts once.
    """
    mixed = F.xxhash64("page_id", "url")
    chosen = rows.select("page_id", "url", mixed.alias("order")).distinct().orderBy("order").limit(SAMPLE_RECORDS)
    chosen = F.broadcast(chosen.select(F.col("page_id").alias("i"), F.col("url").alias("u")))  # SAMPLE_RECORDS rows at most
    begin = F.pmod(F.xxhash64("digest"), F.greatest(F.length("payload") - RECORD_SAMPLE_BYTES, F.lit(0)) + 1).cast("int") + 1
    stretch = F.substring("payload", begin, F.lit(RECORD_SAMPLE_BYTES))
    found = (rows.join(chosen, rows["page_id"].eqNullSafe(F.col("i")) & rows["url"].eqNullSafe(F.col("u")), "left_semi")
             .groupBy("page_id", "url").agg(F.min(stretch).alias("payload")))
    sample, used = [], 0
    for r in found.orderBy(mixed).toLocalIterator():
        if used < SAMPLE_BYTES:
            sample.append(record(r.page_id, r.url, bytes(r.payload), None))
            used += len(sample[-1])
    return sample


def archive(pages: DataFrame, min_bytes: int = 0, level: int = 3, max_file_bytes: int = 64 << 20,
            folder: str | None = None) -> tuple[str, DataFrame]:
    """Writes the pages; (folder, manifest of file, records, bytes).

    Of pages with equal payloads of at least ``min_bytes`` bytes the smallest
    ``page_id`` is stored as a response and the others as revisits of it.  A
    null ``html`` is an empty payload.  Repeated rows of the smallest id are
    all responses.  A page without id never stands for others; where no page of
    a payload has an id, all are responses.  An empty table writes no file.
    """
    spark = pages.sparkSession
    folder = folder or f"{scratch_dir(spark, 'warc')}/archives"
    if "://" not in folder and folder.startswith("file:"):
        folder = "file://" + folder.removeprefix("file:")
    fs, root = _open(folder)
    fs.create_dir(root, recursive=True)
    rows = small_batches(pages).select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    dictionary = train_dictionary(_sample(rows))
    repeats = written(rows.filter(F.length("payload") >= min_bytes).groupBy("digest")
                      .agg(F.min("page_id").alias("holder"), F.count("*").alias("n"))
                      .filter("n > 1 and holder is not null").select("digest", "holder"), "warc-repeats")
    marked = rows.join(repeats, "digest", "left").select(
        "page_id", "url", "payload", F.expr("case when holder <> page_id or (holder is not null and page_id is null) then holder end")
        .alias("refers_to"))
    return folder, written(_write(marked, folder, dictionary, level, max_file_bytes), "warc-manifest")


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Archives the pages and reads the archives back: one row per record."""
    folder, manifest = archive(pages, **options)
    return _read(manifest, folder)
