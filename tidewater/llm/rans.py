"""Token ids in files coded by a static range asymmetric numeral system (rANS).

One table of frequencies, counted over all ids, is shared by all files.  The
ids of the documents, in ascending order of their ids, are cut into blocks; a
block is coded on its own by interleaved states (lane k takes every
``LANES``-th id from k), so each step is one array operation.  A file is

    header   magic, CRC-32 of the table
    blocks   lengths and ids of the documents that begin in it, lane states,
             checkpoints (place in the words, lane states), words, CRC-32s
    footer   byte offset, first id, number of ids of every block; CRC-32, size, magic

A block needs nothing of another, so readers take ranges of blocks; inside a
block decoding can begin at a checkpoint.  A document belongs to the range that
holds its first id; its reader follows it into the next blocks.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import map_arrow, small_batches, written
from tidewater.llm.tokens import ByteLevelChunks
from tidewater.session import scratch_dir

MAGIC = b"TWRANS1\n"
PRECISION = 20
LANES = 1024
BLOCK_IDS = 1 << 20
CHECKPOINT_IDS = 1 << 18
RANGE_BLOCKS = 2
_LOW = np.uint64(1 << 31)
_MASK = np.uint64((1 << PRECISION) - 1)
_SHIFT, _WORD = np.uint64(PRECISION), np.uint64(32)
_BLOCK = struct.Struct("<IIIIIII")
_FOOTER = struct.Struct("<III8s")


class Table:
    """Frequencies that sum to 2**PRECISION, one for every id that occurs."""

    def __init__(self, ids: np.ndarray, frequencies: np.ndarray):
        self.ids, self.frequencies = ids.astype(np.uint32), frequencies.astype(np.uint32)
        size = int(ids.max()) + 1 if len(ids) else 0
        self.f = np.zeros(size, dtype=np.uint64)
        self.f[self.ids] = self.frequencies
        begin = np.cumsum(self.frequencies, dtype=np.uint64) - self.frequencies
        self.begin = np.zeros(size, dtype=np.uint64)
        self.begin[self.ids] = begin
        self.slots = np.repeat(self.ids, self.frequencies)

    @classmethod
    def of_counts(cls, ids: np.ndarray, counts: np.ndarray) -> Table:
        """Shares of the counts rounded down, one at least; what is left over goes to the commonest ids."""
        order = np.argsort(ids)
        ids, counts = ids[order], counts[order].astype(np.float64)
        if len(ids) > (1 << PRECISION) // 2:
            raise ValueError(f"{len(ids)} ids are too many for frequencies of {PRECISION} bits")
        f = np.maximum(1, np.floor(counts / max(counts.sum(), 1) * (1 << PRECISION))).astype(np.int64)
        left = (1 << PRECISION) - int(f.sum()) if len(f) else 0
        for i in np.argsort(-counts, kind="stable"):
            if left == 0:
                break
            step = left if left > 0 else -min(-left, int(f[i]) // 2)
            f[i] += step
            left -= step
        return cls(ids, f)

    def dump(self) -> bytes:
        body = struct.pack("<I", len(self.ids)) + self.ids.astype("<u4").tobytes() + self.frequencies.astype("<u4").tobytes()
        return MAGIC + body + struct.pack("<I", zlib.crc32(body))

    @classmethod
    def load(cls, data: bytes) -> Table:
        body = data[len(MAGIC):-4]
        if data[:len(MAGIC)] != MAGIC or zlib.crc32(body) != struct.unpack("<I", data[-4:])[0]:
            raise ValueError("damaged table of frequencies")
        n = struct.unpack("<I", body[:4])[0]
        return cls(np.frombuffer(body, "<u4", n, 4), np.frombuffer(body, "<u4", n, 4 + 4 * n))


def encode(ids: np.ndarray, table: Table, checkpoint_ids: int = CHECKPOINT_IDS) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, np.ndarray]]]:
    """(states a reader begins with, words, checkpoints of (id, place in the words, states))."""
    if len(ids) and (ids.max() >= len(table.f) or not table.f[ids].all()):
        raise ValueError("an id is not in the table")
    f, begin = table.f[ids], table.begin[ids]
    state = np.full(min(LANES, len(ids)), _LOW, dtype=np.uint64)
    limit = f << np.uint64(63 - PRECISION)
    steps = -(-len(ids) // LANES)
    emitted: list[np.ndarray] = []
    marks: list[tuple[int, int, np.ndarray]] = []
    total = 0
    for s in range(steps - 1, -1, -1):
        row = slice(s * LANES, min((s + 1) * LANES, len(ids)))
        fs = f[row]
        x = state[:len(fs)]
        full = x >= limit[row]
        if full.any():
            emitted.append((x[full] & np.uint64(0xFFFFFFFF)).astype("<u4"))
            total += len(emitted[-1])
            x = np.where(full, x >> _WORD, x)
        high, low = np.divmod(x, fs)
        state[:len(fs)] = (high << _SHIFT) + low + begin[row]
        if s and s * LANES % checkpoint_ids == 0:
            marks.append((s * LANES, total, state.copy()))
    words = np.concatenate(emitted[::-1]) if emitted else np.zeros(0, dtype="<u4")
    return state, words, [(i, total - t, x) for i, t, x in marks[::-1]]


def decode(states: np.ndarray, words: np.ndarray, first: int, n: int, table: Table, place: int = 0) -> np.ndarray:
    """Ids ``first`` (a multiple of LANES) to ``n`` of a block, from the states and the place in the words there."""
    out = np.empty(n - first, dtype=np.uint32)
    state = states.astype(np.uint64)
    for at in range(first, n, LANES):
        size = min(LANES, n - at)
        x = state[:size]
        slot = x & _MASK
        ids = table.slots[slot.astype(np.int64)]
        out[at - first:at - first + size] = ids
        x = table.f[ids] * (x >> _SHIFT) + slot - table.begin[ids]
        short = x < _LOW
        k = int(np.count_nonzero(short))
        if k:
            x[short] = (x[short] << _WORD) | words[place:place + k].astype(np.uint64)
            place += k
        state[:size] = x
    return out


class Document(NamedTuple):
    doc_id: int | None
    length: int


def pack_block(ids: np.ndarray, skip: int, docs: list[Document], table: Table, checkpoint_ids: int = CHECKPOINT_IDS) -> bytes:
    """A block; ``skip`` of its ids belong to a document that began before it."""
    states, words, marks = encode(ids, table, checkpoint_ids)
    named = np.array([d.doc_id is not None for d in docs], dtype=np.uint8)
    body = b"".join([
        np.array([d.doc_id or 0 for d in docs], dtype="<i8").tobytes(), np.array([d.length for d in docs], dtype="<i8").tobytes(), named.tobytes(),
        states.astype("<u8").tobytes(), *[struct.pack("<II", i, place) + x.astype("<u8").tobytes() for i, place, x in marks], words.tobytes()])
    return _BLOCK.pack(len(ids), skip, len(docs), len(marks), len(words), zlib.crc32(ids.astype("<u4").tobytes()), zlib.crc32(body)) + body


class Block:
    """A block read back; ids are decoded from the start or from the last checkpoint before a place."""

    def __init__(self, data: bytes, table: Table):
        self.n, self.skip, n_docs, n_marks, n_words, self.crc, crc = _BLOCK.unpack_from(data)
        body = memoryview(data)[_BLOCK.size:]
        if zlib.crc32(body) != crc:
            raise ValueError("damaged block")
        self.table, lanes = table, min(LANES, self.n)
        at = 0

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(body, kind, count, at)
            at += out.nbytes
            return out

        ids, lengths, named = take("<i8", n_docs), take("<i8", n_docs), take("u1", n_docs)
        self.docs = [Document(int(i) if k else None, int(n)) for i, n, k in zip(ids, lengths, named, strict=True)]
        self.marks = [(0, 0, take("<u8", lanes))]
        for _ in range(n_marks):
            first, place = take("<u4", 2).tolist()
            self.marks.append((first, place, take("<u8", lanes)))
        self.words = take("<u4", n_words)

    def ids(self, first: int = 0, end: int | None = None) -> np.ndarray:
        """Ids ``first`` to ``end``; a whole block is held against its checksum."""
        end = self.n if end is None else min(end, self.n)
        begin, place, states = max((m for m in self.marks if m[0] <= first), key=lambda m: m[0])
        out = decode(states, self.words, begin, end, self.table, place)
        if begin == 0 and end == self.n and zlib.crc32(out.astype("<u4").tobytes()) != self.crc:
            raise ValueError("ids differ from their checksum")
        return out[first - begin:]


def _fs(folder: str) -> tuple[FileSystem, str]:
    return FileSystem.from_uri(folder)


def _id_type(size: int) -> str:
    return "<u2" if size <= 1 << 16 else "<u4"


def _tokenized(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """(doc_id, ids, seq): each document's ids with the end id as binary, in the width that the vocabulary needs."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        chunks = _chunks(tokenizer)
        kind, end = _id_type(chunks.tokenizer.get_vocab_size(with_added_tokens=True)), np.array([end_id], dtype="<u4").tobytes()
        return pa.RecordBatch.from_arrays([batch.column(0), chunks.ids(batch.column(1), kind, end)], names=["doc_id", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_arrow(rows, run, "doc_id long, ids binary").withColumn("seq", F.monotonically_increasing_id())


_TOKENIZERS: dict[str, ByteLevelChunks] = {}


def _chunks(path: str) -> ByteLevelChunks:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = ByteLevelChunks(path)
    return _TOKENIZERS[path]


def _all_ids(column: pa.Array, kind: str) -> np.ndarray:
    """The ids of a batch of binary values one after the other, without copies."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    return np.frombuffer(data.tobytes(), kind)


def _counts(ids: DataFrame, kind: str) -> Table:
    """The shared table: every id of every document counted; a task sends one row per id of the vocabulary it met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(0, dtype=np.int64)
        for batch in batches:
            more = np.bincount(_all_ids(batch.column(0), kind))
            if len(more) > len(seen):
                seen, more = more, seen
            seen[:len(more)] += more
        found = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(seen[found], pa.int64())], names=["id", "n"])

    rows = small_batches(ids).select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    return Table.of_counts(rows["id"].to_numpy(dtype=np.int64), rows["n"].to_numpy(dtype=np.int64))


class _Writer:
    """One file: documents go in, blocks go out as soon as they are full."""

    def __init__(self, out, table: Table, crc: int, block_ids: int, checkpoint_ids: int):
        self.out, self.table, self.block_ids, self.checkpoint_ids = out, table, block_ids, checkpoint_ids
        self.held: list[np.ndarray] = []
        self.size = self.skip = self.at = self.first = self.n_docs = 0
        self.docs: list[Document] = []
        self.index: list[tuple[int, int, int]] = []
        self._put(MAGIC + struct.pack("<I", crc))

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(Document(doc_id, len(ids)))
        self.n_docs += 1
        while len(ids):
            part, ids = ids[:self.block_ids - self.size], ids[self.block_ids - self.size:]
            self.held.append(part)
            self.size += len(part)
            if self.size == self.block_ids:
                self._block()
                self.skip = min(len(ids), self.block_ids)

    def _block(self) -> None:
        ids = np.concatenate(self.held)
        self.index.append((self.at, self.first, len(ids)))
        self._put(pack_block(ids, self.skip, self.docs, self.table, self.checkpoint_ids))
        self.first += len(ids)
        self.held, self.size, self.skip, self.docs = [], 0, 0, []

    def close(self) -> None:
        if self.size:
            self._block()
        body = np.array(self.index, dtype="<i8").tobytes()
        self._put(body + _FOOTER.pack(len(self.index), zlib.crc32(body), len(body), MAGIC))
        self.out.close()


def _write(ordered: DataFrame, folder: str, table: Table, kind: str, block_ids: int, checkpoint_ids: int) -> DataFrame:
    data = table.dump()
    crc, shared = zlib.crc32(data), ordered.sparkSession.sparkContext.broadcast(data)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, writer, name = TaskContext.get(), None, ""
        fs, root = _fs(folder)
        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if writer is None:
                    name = f"{task.partitionId():08d}-{task.taskAttemptId()}.rans"
                    writer = _Writer(fs.open_output_stream(f"{root}/{name}", compression=None), Table.load(shared.value), crc,
                                     block_ids, checkpoint_ids)
                writer.add(doc_id, np.frombuffer(ids.as_buffer(), kind))
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pylist([{"file": name, "part": task.partitionId(), "docs": writer.n_docs, "ids": writer.first,
                                               "blocks": len(writer.index), "bytes": writer.at}])

    return ordered.select("doc_id", "ids").mapInArrow(run, "file string, part long, docs long, ids long, blocks long, bytes long")


def write(docs: DataFrame, tokenizer: str, end_id: int = 0, folder: str | None = None, block_ids: int = BLOCK_IDS,
          checkpoint_ids: int = CHECKPOINT_IDS) -> tuple[str, DataFrame]:
    """Encodes whole texts and writes them in ascending ``doc_id`` order; (folder, manifest of finished files in that order).

    A document's ids are those of its text without special tokens, then
    ``end_id``.  A null or empty text has ``end_id`` alone.  A null ``doc_id``
    comes first; rows that share an id lie next to each other, each with its own
    ids; other columns are ignored.  An empty table writes the table of
    frequencies and no file.  Files are named by task attempt and listed only
    once their task has ended, so lost or repeated tasks leave nothing behind
    in the manifest.  ``checkpoint_ids`` is a multiple of LANES.
    """
    spark = docs.sparkSession
    folder = folder or f"{scratch_dir(spark, 'rans')}/files"
    if "://" not in folder and folder.startswith("file:"):
        folder = "file://" + folder.removeprefix("file:")
    fs, root = _fs(folder)
    fs.create_dir(root, recursive=True)
    kind = _id_type(_chunks(tokenizer).tokenizer.get_vocab_size(with_added_tokens=True))
    ids = written(_tokenized(docs, tokenizer, end_id), "rans-ids", compression="zstd")
    table = _counts(ids, kind)
    with fs.open_output_stream(f"{root}/table", compression=None) as out:
        out.write(table.dump())
    ordered = ids.repartitionByRange("doc_id", "seq").sortWithinPartitions("doc_id", "seq")
    return folder, written(_write(small_batches(ordered), folder, table, kind, block_ids, checkpoint_ids), "rans-manifest")


class Reader:
    """Ranges of a file's blocks, by the footer's index."""

    def __init__(self, fs: FileSystem, path: str, table: Table, crc: int):
        self.file, self.table = fs.open_input_file(path), table
        size = self.file.size()
        n, check, length, magic = _FOOTER.unpack(self.file.read_at(_FOOTER.size, size - _FOOTER.size))
        body = self.file.read_at(length, size - _FOOTER.size - length)
        head = self.file.read_at(len(MAGIC) + 4, 0)
        if magic != MAGIC or zlib.crc32(body) != check or head != MAGIC + struct.pack("<I", crc):
            raise ValueError(f"{path} is damaged or belongs to another table")
        self.index = np.frombuffer(body, "<i8").reshape(n, 3)
        self.end = size - _FOOTER.size - length

    def block(self, k: int) -> Block:
        begin = int(self.index[k, 0])
        end = int(self.index[k + 1, 0]) if k + 1 < len(self.index) else self.end
        return Block(self.file.read_at(end - begin, begin), self.table)

    def documents(self, first: int, end: int) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, ids before it in the file, ids) of the documents that begin in blocks ``first`` to ``end``."""
        for k in range(first, min(end, len(self.index))):
            block = self.block(k)
            if not block.docs:
                continue
            start, ids = int(self.index[k, 1]) + block.skip, block.ids(block.skip)
            for doc in block.docs:
                own, ids = ids[:doc.length], ids[doc.length:]
                parts, more, size = [own], k + 1, len(own)
                while size < doc.length:
                    parts.append(self.block(more).ids(0, doc.length - size))
                    size += len(parts[-1])
                    more += 1
                yield doc.doc_id, start, np.concatenate(parts) if len(parts) > 1 else own
                start += doc.length


def read(folder: str, manifest: DataFrame, with_ids: bool = False, range_blocks: int = RANGE_BLOCKS) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every document, from the files alone.

    Ranges of ``range_blocks`` blocks are decoded each on their own.  ``start`` counts the
    ids of all documents before it, those of earlier files by the manifest's
    counts (one row a file, summed on the driver).  ``ids`` are little-endian unsigned 32-bit.
    """
    spark = manifest.sparkSession
    ranges, before = [], 0
    for r in manifest.orderBy("part").toLocalIterator():
        ranges.append((r.file, before, r.blocks))
        before += r.ids
    files = spark.createDataFrame(ranges, "file string, before long, blocks long")
    jobs = files.select("file", "before", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1, F.lit(range_blocks).cast("long"))).alias("first"))
    n_jobs = sum(-(-n // range_blocks) for _, _, n in ranges)
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _fs(folder)
        with fs.open_input_stream(f"{root}/table", compression=None) as f:
            data = f.read()
        table, crc = Table.load(data), zlib.crc32(data)
        for batch in batches:
            for name, past, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                reader, rows, size = Reader(fs, f"{root}/{name}", table, crc), [], 0
                for doc_id, start, ids in reader.documents(first, first + range_blocks):
                    plain = ids.astype("<u4").tobytes()
                    rows.append((doc_id, past + start, len(ids), zlib.crc32(plain), *([plain] if with_ids else [])))
                    size += len(plain) if with_ids else 40
                    if size >= 4 << 20:
                        yield _rows(rows)
                        rows, size = [], 0
                if rows:
                    yield _rows(rows)

    def _rows(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64()] * 4 + [pa.binary()] * with_ids
        names = ["doc_id", "start", "n_tokens", "ids_crc32", "ids"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names[:len(kinds)])

    return small_batches(jobs).repartition(max(1, n_jobs)).mapInArrow(run, schema)
