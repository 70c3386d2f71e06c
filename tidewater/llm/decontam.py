"""Benchmark decontamination with a generalised suffix automaton of the test items.

Items are normalised to hashed words and go into one automaton per block of
items (a block has a fixed bound of words, so what is broadcast has one too).
Training texts stream through it: a transition per word, following suffix
links on a mismatch, which keeps the longest item substring that ends at the
word.  Where that length reaches the window the last ``window`` words are hit.
Words are only fed where every neighbouring pair is a pair of some item; any
other word would reset the automaton to a match of one word at most.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import give_back, small_batches, written
from tidewater.llm.wordhash import NON_WORD, U64, Words, blocks, mix

BLOCK_WORDS = 400_000


def _pairs(h: np.ndarray) -> np.ndarray:
    return mix(h[:-1] * U64(0x9E6C63D0876A9A47) + h[1:])


class _Members:
    """Membership in a set of 64-bit hashes: a small table first, then a binary search."""

    def __init__(self, values: np.ndarray):
        self.values = np.unique(values)
        self.table = np.zeros(1 << 18, dtype=bool)
        self.table[(self.values & U64((1 << 18) - 1)).astype(np.int64)] = True

    def has(self, h: np.ndarray) -> np.ndarray:
        out = self.table[(h & U64((1 << 18) - 1)).astype(np.int64)]
        at = np.flatnonzero(out)
        if len(at):
            place = np.minimum(np.searchsorted(self.values, h[at]), len(self.values) - 1)
            out[at] = self.values[place] == h[at]
        return out


class Automaton:
    """Generalised suffix automaton over word hashes of (item, words) pairs."""

    def __init__(self, items: list[tuple[str, np.ndarray]], window: int):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        held: dict[int, set[str]] = {}
        self.short: dict[int, list[tuple[int, str]]] = {}
        for item, words in items:
            state = 0
            for k, w in enumerate(words.tolist(), 1):
                state = self._extend(state, w)
                if k >= window:
                    held.setdefault(state, set()).add(item)
            if 0 < len(words) < window:
                self.short.setdefault(state, []).append((len(words), item))
        hashes = [w for _, w in items if len(w)]
        self.least = min((min(window, len(w)) for w in hashes), default=0)
        self.words = _Members(np.concatenate(hashes)) if hashes else None
        self.pairs = _Members(np.concatenate([_pairs(w) for w in hashes])) if hashes else None
        self._finish(held)

    def _extend(self, last: int, w: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if w in nxt[last]:
            q = nxt[last][w]
            return q if length[q] == length[last] + 1 else self._clone(last, w, q)
        new = self._state(length[last] + 1, {})
        p = last
        while p >= 0 and w not in nxt[p]:
            nxt[p][w] = new
            p = link[p]
        if p < 0:
            link[new] = 0
        else:
            q = nxt[p][w]
            link[new] = q if length[q] == length[p] + 1 else self._clone(p, w, q)
        return new

    def _state(self, length: int, moves: dict[int, int]) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(0)
        return len(self.next) - 1

    def _clone(self, p: int, w: int, q: int) -> int:
        copy = self._state(self.length[p] + 1, dict(self.next[q]))
        self.link[copy], self.link[q] = self.link[q], copy
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def _finish(self, held: dict[int, set[str]]) -> None:
        """Per state: where its ``window``-word suffix lives with the items there, and the next shorter whole item."""
        order = sorted(range(len(self.next)), key=self.length.__getitem__)
        for v in reversed(order):  # items seen at a state are seen at its suffixes
            up = self.link[v]
            if v in held and up > 0 and self.length[up] >= self.window:
                held.setdefault(up, set()).update(held[v])
        self.at_window, self.shorter = [-1] * len(order), [-1] * len(order)
        for v in order[1:]:
            up = self.link[v]
            if self.length[v] >= self.window:
                self.at_window[v] = v if self.length[up] < self.window else self.at_window[up]
            self.shorter[v] = up if up in self.short else self.shorter[up]
        self.items = held

    def run(self, words: list[int]) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit (begin, end) word ranges of one stretch of words, and the items whose windows occur."""
        nxt, link, length, window = self.next, self.link, self.length, self.window
        state = size = 0
        found: list[tuple[int, int]] = []
        items: set[str] = set()
        for i, w in enumerate(words):
            while state and w not in nxt[state]:
                state = link[state]
                size = length[state]
            if w in nxt[state]:
                state = nxt[state][w]
                size += 1
            widest = 0
            if size >= window:
                widest = window
                items |= self.items[self.at_window[state]]
            u = state
            while u > 0:
                for n, item in self.short.get(u, ()):
                    if n <= size:
                        widest = max(widest, n)
                        items.add(item)
                u = self.shorter[u]
            if widest:
                begin = i + 1 - widest
                while found and found[-1][1] >= begin:
                    begin = min(begin, found.pop()[0])
                found.append((begin, i + 1))
        return found, items


def stretches(words: Words, automaton: Automaton) -> Iterator[tuple[int, int]]:
    """(begin, end) runs of a block's words that could hold a window; none crosses documents."""
    h = words.hash
    if automaton.words is None or not len(h):
        return
    known = automaton.words.has(h)
    tied = np.zeros(len(h) + 1, dtype=bool)  # tied[i]: words i - 1 and i follow each other in some item
    both = np.flatnonzero(known[:-1] & known[1:]) + 1
    tied[both] = automaton.pairs.has(mix(h[both - 1] * U64(0x9E6C63D0876A9A47) + h[both]))
    tied[words.first[words.first < len(h)]] = False
    begins = np.flatnonzero(known & ~tied[:-1])
    ends = np.flatnonzero(known & ~tied[1:]) + 1
    long = (ends - begins) >= automaton.least
    yield from zip(begins[long].tolist(), ends[long].tolist(), strict=True)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 13, max_percent: float = 5.0,
                  max_span: int | None = None, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its columns as the struct ``row``, and what the items hit in ``text``.

    (row, n_words, n_hit, items, contaminated, cleaned).  Words are runs of
    letters, digits and non-ASCII characters, A-Z in lower case.  A window is
    ``window`` consecutive words of an item, or all of a shorter item that has
    words; each word inside an occurrence is hit.  ``items`` are the ids (as
    strings, sorted, distinct) of the items with occurring windows.  A row is
    contaminated when its hit words are at least ``max_percent`` of its words
    and not none.  ``cleaned`` is the text without hit spans of more than
    ``max_span`` words, and of all hit spans if the row is contaminated;
    without ``max_span`` only the latter.

    A null or wordless text has no words and stays as it is.  Items without id
    or text are left out, repeated items count once, and without items nothing
    is hit.  Repeated documents each get their row; an empty table gives none.
    """
    spark = docs.sparkSession
    state = small_batches(docs, "2m").select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), docs["text"].cast("string").alias("text"),
        F.lit(0).cast("long").alias("n_words"), F.array().cast("array<struct<b:int,e:int,x:int,y:int>>").alias("spans"),
        F.array().cast("array<string>").alias("items"))
    schema = state.schema
    result = T.StructType([schema["row"], schema["n_words"], T.StructField("n_hit", T.LongType()), schema["items"],
                           T.StructField("contaminated", T.BooleanType()), T.StructField("cleaned", T.StringType())])
    items = (benchmark.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
             .filter("id is not null and text is not null"))
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n_blocks = max(1, -(-size // (4 * BLOCK_WORDS)))
    for k in range(n_blocks):
        if k:
            state = written(state, "decontamination")
        part = items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(n_blocks)) == k).orderBy("id", "text")
        sent = spark.sparkContext.broadcast([(r.id, r.text) for r in part.toLocalIterator()])
        state = state.mapInArrow(_pass(sent, window, k == n_blocks - 1, max_percent, max_span), result if k == n_blocks - 1 else schema)
    return state


def _pass(sent: Broadcast, window: int, last: bool, max_percent: float, max_span: int | None) -> Callable:
    """One block of items over all documents; the last block's pass also sums up."""
    tag = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tag not in _BUILT:
            _BUILT.clear()
            _BUILT[tag] = Automaton([(item, Words([text.encode()], NON_WORD).hash) for item, text in sent.value], window)
        for batch in batches:
            found = _scan(batch, _BUILT[tag])
            yield _digest(found, max_percent, max_span) if last else found
        give_back()

    return run


_BUILT: dict[str, Automaton] = {}


def _scan(batch: pa.RecordBatch, automaton: Automaton) -> pa.RecordBatch:
    """Adds the spans (words b to e, bytes x to y) and items that one block's automaton finds."""
    n_words: list[int] = []
    new: dict[int, tuple[list, set]] = {}
    for begin, run in blocks(batch.column(1).to_pylist()):
        words = Words(run, NON_WORD)
        n_words += words.count.tolist()
        origin = np.concatenate(([0], np.cumsum([len(t) + 1 for t in run])))
        for b, e in stretches(words, automaton):
            ranges, items = automaton.run(words.hash[b:e].tolist())
            if ranges:
                doc = int(np.searchsorted(words.first, b, side="right")) - 1
                at = new.setdefault(begin + doc, ([], set()))
                at[0].extend({"b": int(b + x - words.first[doc]), "e": int(b + y - words.first[doc]),
                              "x": int(words.start[b + x] - origin[doc]), "y": int(words.end[b + y - 1] - origin[doc])}
                             for x, y in ranges)
                at[1].update(items)
    spans, items = batch.column(3), batch.column(4)
    if new:
        spans, items = spans.to_pylist(), items.to_pylist()
        for i, (more, ids) in new.items():
            spans[i] = spans[i] + more
            items[i] = items[i] + sorted(ids)
        spans, items = pa.array(spans, batch.column(3).type), pa.array(items, batch.column(4).type)
    return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n_words, pa.int64()), spans, items],
                                      names=batch.schema.names)


def _digest(batch: pa.RecordBatch, max_percent: float, max_span: int | None) -> pa.RecordBatch:
    n_hit, items, bad, cleaned = [], [], [], []
    n_words = batch.column(2).to_pylist()
    texts, spans = batch.column(1), batch.column(3).to_pylist()
    for i, found in enumerate(spans):
        merged: list[dict] = []
        for s in sorted(found, key=lambda s: s["b"]):
            if merged and s["b"] <= merged[-1]["e"]:
                if s["e"] > merged[-1]["e"]:
                    merged[-1] |= {"e": s["e"], "y": s["y"]}
            else:
                merged.append(dict(s))
        hit = sum(s["e"] - s["b"] for s in merged)
        over = hit > 0 and 100 * hit >= max_percent * n_words[i]
        n_hit.append(hit)
        bad.append(over)
        text = texts[i].as_py()
        cut = [s for s in merged if over or (max_span is not None and s["e"] - s["b"] > max_span)]
        if cut:
            data, parts, at = text.encode(), [], 0
            for s in cut:
                parts.append(data[at:s["x"]])
                at = s["y"]
            text = b"".join([*parts, data[at:]]).decode()
        cleaned.append(text)
    for ids in batch.column(4).to_pylist():
        items.append(sorted(set(ids)))
    return pa.RecordBatch.from_arrays(
        [batch.column(0), batch.column(2), pa.array(n_hit, pa.int64()), pa.array(items, pa.list_(pa.string())),
         pa.array(bad, pa.bool_()), pa.array(cleaned, pa.string())],
        names=["row", "n_words", "n_hit", "items", "contaminated", "cleaned"])
