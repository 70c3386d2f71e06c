"""Best-fit packing of tokenized documents into sequences, in a hierarchy.

Every input partition tokenizes its documents, cuts the ones over the capacity
and packs its pieces best-fit, longest first.  Bins that are nearly full are
emitted there; the pieces of the others go up: neighbouring partitions' underfull
bins meet in one task, where whole bins are the items of the next best-fit
round.  Rounds go on until one task holds all that is left, or until a round
closes hardly any bin more (then larger groups would not either).  No task
ever holds more than the leftovers of its own branch.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import give_back, small_batches, written
from tidewater.llm.tokens import ChunkedTokenizer

GROUP_PIECES = 200_000
FAN_IN = 8
_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, leaf long, bin long, offset long, open boolean"


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset, fill of each bin) of items packed best-fit, longest first; ties by position."""
    bins, offsets = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    fills: list[int] = []
    room: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by what still fits
    some = 0  # bit r: a bin with room r
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fitting = some >> n
        if fitting:
            r = n + (fitting & -fitting).bit_length() - 1
            b = room[r].pop()
            if not room[r]:
                some &= ~(1 << r)
        else:
            b, r = len(fills), capacity
            fills.append(0)
        bins[i], offsets[i] = b, fills[b]
        fills[b] += n
        if r > n:
            room[r - n].append(b)
            some |= 1 << (r - n)
    return bins, offsets, np.array(fills, dtype=np.int64)


_TOKENIZERS: dict[str, ChunkedTokenizer] = {}


def _tokenizer(path: str) -> ChunkedTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = ChunkedTokenizer(path)
    return _TOKENIZERS[path]


def _bin_id(level: int, leaf: int, local: np.ndarray) -> np.ndarray:
    return (np.int64(level) << 56) + (np.int64(leaf) << 28) + local


def _runs(column: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, list[str]]]:
    """(index of the first, texts) of runs of about ``limit`` characters; a null text is empty."""
    begin, size, run = 0, 0, []
    for i, text in enumerate(column):
        run.append(text.as_py() or "")
        size += len(run[-1])
        if size >= limit:
            yield begin, run
            begin, size, run = i + 1, 0, []
    if run:
        yield begin, run


def _leaves(docs: DataFrame, tokenizer: str, capacity: int, slack: int, end_id: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, leaf = _tokenizer(tokenizer), TaskContext.get().partitionId()
        end = end_id.to_bytes(4, "little")
        held: list[tuple] = []
        used = 0

        def packed() -> pa.RecordBatch:
            nonlocal used
            ids, piece, start, length, crc = zip(*held, strict=True)
            length = np.array(length, dtype=np.int64)
            bins, offsets, fills = best_fit(length, capacity)
            opened = fills[bins] < capacity - slack
            out = pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length),
                 pa.array(crc, pa.int64()), pa.array(np.full(len(length), leaf, dtype=np.int64)),
                 pa.array(_bin_id(0, leaf, bins + used)), pa.array(offsets), pa.array(opened)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "leaf", "bin", "offset", "open"])
            used += len(fills)
            held.clear()
            return out

        for batch in batches:
            docs = batch.column(0).to_pylist()
            for begin, texts in _runs(batch.column(1)):
                for doc, tokens in zip(docs[begin:], encode.block(texts), strict=False):
                    tokens += end
                    total = len(tokens) // 4
                    for k in range(0, total, capacity):
                        n = min(capacity, total - k)
                        held.append((doc, k // capacity, k, n, zlib.crc32(tokens[4 * k: 4 * (k + n)])))
                if len(held) >= GROUP_PIECES:
                    yield packed()
        encode.forget()  # the worker stays, idle or for other stages
        if held:
            yield packed()
        give_back()

    return small_batches(docs, "2m").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, _PIECE)


def _merge(pieces: DataFrame, level: int, capacity: int, slack: int) -> DataFrame:
    """One best-fit round whose items are the bins that came up to each group (column ``leaf``)."""

    def repack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["bin", "offset"], ignore_index=True)
        _, first, which = np.unique(rows["bin"].to_numpy(), return_index=True, return_inverse=True)
        length = rows["length"].to_numpy()
        bins, offsets, fills = best_fit(np.add.reduceat(length, first), capacity)
        leaf = int(rows["leaf"].iat[0])
        return rows.assign(bin=_bin_id(level, leaf, bins)[which], offset=rows["offset"].to_numpy() + offsets[which],
                           open=fills[bins][which] < capacity - slack)

    return pieces.groupBy("leaf").applyInPandas(repack, _PIECE)


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, slack: int = 8, end_id: int = 0) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), one row per piece.

    A document's ids are those of its whole text without special tokens, then
    ``end_id``; a null or empty text has ``end_id`` alone.  Only a document of
    more than ``capacity`` ids is cut, every ``capacity`` ids.  Pieces of a
    sequence lie without gaps from offset 0.  A bin counts as nearly full when
    at most ``slack`` ids are free.  Repeated rows are packed each; a row
    without id keeps the null; an empty table gives no rows; other columns are
    ignored.
    """
    state = written(_leaves(docs, tokenizer, capacity, slack, end_id), "packing")
    done, left, level = [state.filter("not open")], state.filter("open"), 0
    while True:
        pieces, bins, top = left.agg(F.count("*"), F.countDistinct("bin"), F.max("leaf")).first()
        if not pieces:
            break
        fan_in = FAN_IN if pieces > GROUP_PIECES else top + 1  # what is left fits one task: all branches meet
        level += 1
        up = left.withColumn("leaf", F.expr(f"leaf div {fan_in}"))
        state = written(_merge(up, level, capacity, slack), "packing")
        done.append(state.filter("not open"))
        left = state.filter("open")
        still = left.agg(F.countDistinct("bin")).first()[0]
        if top < fan_in or still > 0.99 * bins:
            done.append(left)
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", F.col("bin").alias("sequence_id"), "offset")
