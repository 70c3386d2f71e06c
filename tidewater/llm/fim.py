"""Fill-in-middle transformation with a piece table.

A document is an immutable buffer of UTF-8 bytes, the sentinels are another.
What is written of it is a list of descriptors (buffer, begin, end): cutting
splits a descriptor in two, an arrangement permutes the parts and puts sentinel
descriptors between them, the inverse permutation puts them back.  No step
copies text; hashes run over the descriptors, and only ``output`` and
``restored`` are joined up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import map_arrow
from tidewater.llm.wordhash import SPACE

TEXT, SENTINEL = 0, 1
#: Sentinels of prefix, suffix and middle.
MARKS = (b"<P>", b"<S>", b"<M>")
SENTINELS = b"".join(MARKS)
#: Order of the parts (0 prefix, 1 middle, 2 suffix) and the sentinel before each.
ARRANGED = {"psm": ((0, 0), (2, 1), (1, 2)), "spm": ((2, 1), (0, 0), (1, 2))}
_RUN_BYTES = 1 << 20


class Piece(NamedTuple):
    buffer: int
    begin: int
    end: int


def cut(pieces: list[Piece], at: int) -> tuple[list[Piece], list[Piece]]:
    """The pieces before and after byte ``at`` of what they spell; a piece across it is split."""
    left: list[Piece] = []
    for i, p in enumerate(pieces):
        size = p.end - p.begin
        if at < size:
            middle = p.begin + at
            return left + ([Piece(p.buffer, p.begin, middle)] if at else []), [Piece(p.buffer, middle, p.end), *pieces[i + 1:]]
        left.append(p)
        at -= size
    return left, []


def arrange(parts: list[list[Piece]], form: str) -> list[Piece]:
    """Prefix, middle and suffix in the order of ``form``, each behind its sentinel."""
    out: list[Piece] = []
    for part, mark in ARRANGED[form]:
        begin = sum(map(len, MARKS[:mark]))
        out.append(Piece(SENTINEL, begin, begin + len(MARKS[mark])))
        out += parts[part]
    return out


def find_parts(output: bytes, form: str) -> list[Piece]:
    """Descriptors over an arranged output in the order of the text: the inverse of ``arrange``.

    The text holds no sentinel, so each is found at its first place.
    """
    parts: dict[int, Piece] = {}
    order = ARRANGED[form]
    begin = 0
    for k, (part, mark) in enumerate(order):
        if not output.startswith(MARKS[mark], begin):
            raise ValueError(f"an output of form {form} has {MARKS[mark].decode()} at byte {begin}")
        begin += len(MARKS[mark])
        end = output.index(MARKS[order[k + 1][1]], begin) if k + 1 < len(order) else len(output)
        parts[part] = Piece(TEXT, begin, end)
        begin = end
    return [parts[i] for i in range(3)]


def spelled(pieces: list[Piece], text: bytes) -> Iterator[memoryview]:
    buffers = (memoryview(text), memoryview(SENTINELS))
    for p in pieces:
        yield buffers[p.buffer][p.begin:p.end]


def digest(pieces: list[Piece], text: bytes) -> str:
    """Hexadecimal SHA-256 of what the pieces spell, streamed."""
    h = hashlib.sha256()
    for part in spelled(pieces, text):
        h.update(part)
    return h.hexdigest()


def unit_ends(data: np.ndarray) -> np.ndarray:
    """Byte ends of the units: white space with the word behind it; white space at the end is one of its own."""
    if not len(data):
        return np.zeros(0, dtype=np.int64)
    space = SPACE[data]
    ends = np.flatnonzero(~space & np.append(space[1:], True)) + 1
    return np.append(ends, len(data)) if space[-1] else ends


def code_points(data: np.ndarray) -> int:
    return len(data) - int(np.count_nonzero((data & 0xC0) == 0x80))


def plan(doc_id: int | None, text: bytes, seed: int, rate: int, spm_rate: int) -> tuple[int, str, list[list[Piece]]]:
    """(number of units, form, the three parts); a plain document is one part."""
    data = np.frombuffer(text, dtype=np.uint8)
    ends = unit_ends(data)
    n = len(ends)
    drawn = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(drawn[8 * i:8 * i + 8], 16) for i in range(4))
    whole = [Piece(TEXT, 0, len(text))] if text else []
    if not text or h3 % 100 >= rate or any(mark in text for mark in MARKS):
        return n, "plain", [whole]
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    byte = lambda k: int(ends[k - 1]) if k else 0
    rest, suffix = cut(whole, byte(high))
    prefix, middle = cut(rest, byte(low))
    return n, "spm" if h4 % 100 < spm_rate else "psm", [prefix, middle, suffix]


def _chunks(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first, texts) of runs of about a megabyte."""
    begin, size, run = 0, 0, []
    for i, text in enumerate(column):
        run.append(text.as_py() or b"")
        size += len(run[-1])
        if size >= _RUN_BYTES:
            yield begin, run
            begin, size, run = i + 1, 0, []
    if run:
        yield begin, run


def _nested(df: DataFrame, text: str) -> DataFrame:
    return df.select(F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("row"), F.col(text).cast("binary").alias("text"))


def transform(docs: DataFrame, seed: int = 42, rate: int = 50, spm_rate: int = 80) -> DataFrame:
    """One row per row of ``docs``: its columns as the struct ``row``, then what the transformation made of ``text``.

    (row, n, form, prefix_chars, middle_chars, pieces, output, output_sha256).
    ``n`` counts the units: white space (space, tab to carriage return) with
    the word behind it, and white space at the end.  Two of the four numbers in
    SHA-256 of "seed:doc_id" cut the text between units; the third sends
    ``rate`` percent of the documents into the forms, the fourth ``spm_rate``
    percent of those into ``spm``, the others into ``psm``.  ``pieces`` are the
    descriptors of ``output`` over the text (buffer 0) and the sentinels
    (buffer 1).

    A null text is empty.  Empty texts and texts with a sentinel in them stay
    ``plain`` (``output`` is the text, the character counts are null).  A null
    id hashes as "seed:".  Rows of one id are cut by the same numbers; repeated
    rows give repeated rows; an empty table gives none.
    """
    rows = _nested(docs, "text")
    piece = T.StructType([T.StructField("buffer", T.IntegerType()), T.StructField("begin", T.LongType()), T.StructField("end", T.LongType())])
    schema = T.StructType([rows.schema["row"], T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
                           T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()),
                           T.StructField("pieces", T.ArrayType(piece)), T.StructField("output", T.StringType()),
                           T.StructField("output_sha256", T.StringType())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = [None if i is None else int(i) for i in batch.column(0).field("doc_id").to_pylist()]
        made: list[tuple] = []
        for begin, texts in _chunks(batch.column(1)):
            for doc_id, text in zip(ids[begin:], texts, strict=False):
                n, form, parts = plan(doc_id, text, seed, rate, spm_rate)
                pieces = parts[0] if form == "plain" else arrange(parts, form)
                chars = (None, None)
                if form != "plain":
                    chars = tuple(sum(code_points(np.frombuffer(s, dtype=np.uint8)) for s in spelled(p, text)) for p in parts[:2])
                made.append((n, form, *chars, [p._asdict() for p in pieces], b"".join(spelled(pieces, text)), digest(pieces, text)))
        columns = list(zip(*made, strict=True)) if made else [()] * 7
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(),
                 pa.list_(pa.struct([("buffer", pa.int32()), ("begin", pa.int64()), ("end", pa.int64())])), pa.binary(), pa.string()]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        arrays[5] = arrays[5].cast(pa.string())
        return pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=[f.name for f in schema])

    return map_arrow(rows, run, schema)


def restore(made: DataFrame) -> DataFrame:
    """``restored`` and ``restored_sha256`` from ``output`` and ``form`` alone, as two more columns.

    The output is cut at its sentinels, their descriptors dropped and the
    others put back in order.  A null output is empty; an output that lacks the
    sentinels of its form is an error.
    """
    rows = made.select(F.struct(*[made[f"`{c}`"] for c in made.columns]).alias("row"), F.col("output").cast("binary").alias("text"))
    schema = T.StructType([rows.schema["row"], T.StructField("restored", T.StringType()), T.StructField("restored_sha256", T.StringType())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        forms = batch.column(0).field("form").to_pylist()
        texts, hashes = [], []
        for begin, outputs in _chunks(batch.column(1)):
            for form, output in zip(forms[begin:], outputs, strict=False):
                pieces = [Piece(TEXT, 0, len(output))] if form == "plain" else find_parts(output, form)
                texts.append(b"".join(spelled(pieces, output)))
                hashes.append(digest(pieces, output))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(hashes, pa.string())],
                                          names=["row", "restored", "restored_sha256"])

    return map_arrow(rows, run, schema).select("row.*", "restored", "restored_sha256")
