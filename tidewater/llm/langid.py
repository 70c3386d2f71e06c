"""Language identification with a byte convolutional network trained in numpy.

Texts are bytes, folded to a small alphabet and cut into windows of 256.  In
each window filters of several widths run over the bytes; a filter's largest
response (max pooling, after ReLU) feeds a softmax layer.  A document's
prediction is the mean of its windows' log-probabilities, weighted by the bytes
they hold, over all windows of the whole text.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import small_batches
from tidewater.llm.wordhash import blocks

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16  # of each width
SAMPLE_DOCS = 3000
SAMPLE_WINDOWS = 5  # of a sampled document
UNDETERMINED = "und"
LETTERS = 160


def _alphabet() -> np.ndarray:
    """Byte -> symbol: 0 for padding, 1 anything between words, 2 digits, letters without case, each byte from 0x80."""
    table = np.ones(256, dtype=np.uint8)
    table[48:58] = 2
    for i in range(26):
        table[[65 + i, 97 + i]] = 3 + i
    table[128:] = np.arange(29, 157)
    return table


ALPHABET = _alphabet()


@dataclass
class Network:
    """Filters by width, (width, symbol, filter), their biases, and the softmax layer over the pooled responses."""

    langs: list[str]
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    dense: np.ndarray
    offset: np.ndarray

    def pairs(self) -> list[list[np.ndarray]]:
        """For each width the tables of symbol pairs (and a last single symbol) whose sum is a filter's response."""
        out = []
        for f in self.filters:
            tables = [(f[k][:, None, :] + f[k + 1][None, :, :]).reshape(LETTERS * LETTERS, -1) for k in range(0, len(f) - 1, 2)]
            out.append(tables + ([f[-1]] if len(f) % 2 else []))
        return out

    def pooled(self, x: np.ndarray, tables: list[list[np.ndarray]]) -> np.ndarray:
        """Largest responses (windows, all filters) in windows of symbols ``x``."""
        pair = x[:, :-1].astype(np.int32) * LETTERS + x[:, 1:]
        out = []
        for width, parts, bias in zip(WIDTHS, tables, self.biases, strict=True):
            n = x.shape[1] - width + 1
            total = None
            for k, table in enumerate(parts):
                at = pair[:, 2 * k: 2 * k + n] if len(table) > LETTERS else x[:, 2 * k: 2 * k + n]
                rows = np.take(table, at, axis=0)
                total = rows if total is None else np.add(total, rows, out=total)
            out.append(np.maximum(total.max(axis=1) + bias, 0))
        return np.concatenate(out, axis=1)

    def log_probabilities(self, x: np.ndarray, tables: list[list[np.ndarray]], batch: int = 64) -> np.ndarray:
        parts = [self.pooled(x[i: i + batch], tables) for i in range(0, len(x), batch)]
        z = np.concatenate(parts) @ self.dense + self.offset
        z -= z.max(axis=1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def train(x: np.ndarray, y: np.ndarray, langs: list[str], epochs: int = 6, batch: int = 128, rate: float = 0.01,
          seed: int = 7) -> Network:
    """Adam on the cross-entropy of labelled windows ``x`` (n, WINDOW); gradients reach a filter at its pooled place."""
    rng = np.random.default_rng(seed)
    net = Network(langs, [rng.normal(0, 0.1, (w, LETTERS, FILTERS)).astype(np.float32) for w in WIDTHS],
                  [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
                  rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(langs))).astype(np.float32), np.zeros(len(langs), np.float32))
    values = [*net.filters, *net.biases, net.dense, net.offset]
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for i in range(0, len(x), batch):
            xb, yb = x[order[i: i + batch]].astype(np.int64), y[order[i: i + batch]]
            m, responses, places = len(xb), [], []
            for f, bias in zip(net.filters, net.biases, strict=True):
                n = xb.shape[1] - len(f) + 1
                r = f[0][xb[:, :n]]
                for k in range(1, len(f)):
                    r = r + f[k][xb[:, k: k + n]]
                places.append(r.argmax(axis=1))
                responses.append(r.max(axis=1) + bias)
            h = np.maximum(np.concatenate(responses, axis=1), 0)
            z = h @ net.dense + net.offset
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(m), yb] -= 1
            p /= m
            back = (p @ net.dense.T) * (h > 0)
            grads: list[np.ndarray] = []
            for j, (f, at) in enumerate(zip(net.filters, places, strict=True)):
                g = np.zeros_like(f)
                part = back[:, j * FILTERS: (j + 1) * FILTERS]
                for k in range(len(f)):
                    np.add.at(g[k], (xb[np.arange(m)[:, None], at + k], np.arange(FILTERS)[None, :]), part)
                grads.append(g)
            grads += [back[:, j * FILTERS: (j + 1) * FILTERS].sum(axis=0) for j in range(len(WIDTHS))]
            grads += [h.T @ p + 1e-4 * net.dense, p.sum(axis=0)]
            step += 1
            for v, g, a, b in zip(values, grads, first, second, strict=True):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                v -= (rate / (1 - 0.9**step)) * a / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
    return net


def windows(text: bytes) -> np.ndarray:
    """A text's symbols in rows of WINDOW, the last one padded; one row for an empty text."""
    n = max(1, -(-len(text) // WINDOW))
    out = np.zeros(n * WINDOW, dtype=np.uint8)
    out[: len(text)] = ALPHABET[np.frombuffer(text, dtype=np.uint8)]
    return out.reshape(n, WINDOW)


def bucket(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text modulo ``modulus``; null without an id."""
    return F.pmod(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")), F.lit(modulus))


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        sample_docs: int = SAMPLE_DOCS) -> Network | None:
    """Trains on a bounded sample of the labelled rows; None where no row has a language and text.

    About ``sample_docs`` documents, as many of each language as there are
    (chosen by a hash of their id), and SAMPLE_WINDOWS windows of each, spread
    over the whole text.  The languages themselves are those of all rows.
    """
    rows = small_batches(labelled).select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"),
                           F.col(lang_col).cast("string").alias("lang")).filter("lang is not null and text is not null")
    counts = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}
    langs = sorted(counts)
    if not langs:
        return None
    share = F.create_map(*[c for k in langs for c in (F.lit(k), F.lit(sample_docs / len(langs) / counts[k]))])
    chosen = rows.filter(F.pmod(F.xxhash64("id", F.lit(11)), F.lit(1_000_000)) < F.element_at(share, F.col("lang")) * 1_000_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, kept = [], []
            for text, name in zip(batch.column(0), batch.column(1), strict=True):
                w = windows(text.as_py().encode("utf-8", "surrogatepass"))
                for i in sorted({k * len(w) // SAMPLE_WINDOWS for k in range(SAMPLE_WINDOWS)}):
                    kept.append(w[i].tobytes())
                    lang.append(name.as_py())
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(kept, pa.binary())], names=["lang", "symbols"])

    cut = chosen.select("text", "lang").mapInArrow(run, "lang string, symbols binary").limit(2 * sample_docs * SAMPLE_WINDOWS)
    got = sorted((r.lang, bytes(r.symbols)) for r in cut.collect())
    if not got:
        return None
    x = np.frombuffer(b"".join(s for _, s in got), dtype=np.uint8).reshape(-1, WINDOW)
    y = np.array([langs.index(name) for name, _ in got])
    return train(x, y, langs, epochs=max(6, min(60, 40_000 // len(x))))


_TABLES: dict[str, list[list[np.ndarray]]] = {}


def identify(docs: DataFrame, network: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score), one row per row of ``docs``, from the text alone.

    ``score`` is the predicted language's probability.  A text that is null or
    has no letter is ``und`` with score 0, and so is every text if there was
    nothing to learn from.  Repeated rows each get their row; other columns are
    ignored; an empty table gives no rows.
    """
    sent, tag = docs.sparkSession.sparkContext.broadcast(network), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = sent.value
        if net is not None and tag not in _TABLES:
            _TABLES.clear()
            _TABLES[tag] = net.pairs()
        for batch in batches:
            texts = batch.column(1).to_pylist()
            lang, score = [UNDETERMINED] * len(texts), [0.0] * len(texts)
            for begin, run in blocks(texts) if net is not None else ():
                parts = [windows(t) for t in run]
                logs = net.log_probabilities(np.concatenate(parts), _TABLES[tag])
                filled = np.concatenate([(p > 0).sum(axis=1) for p in parts])
                at = np.cumsum([0] + [len(p) for p in parts])
                sums = np.add.reduceat(logs * filled[:, None], at[:-1])
                for i, total in enumerate(sums):
                    text = texts[begin + i]
                    if text and any(map(str.isalpha, text)):
                        p = np.exp(total / max(1, filled[at[i]: at[i + 1]].sum()))
                        lang[begin + i] = net.langs[int(p.argmax())]
                        score[begin + i] = float(p.max() / p.sum())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang), pa.array(score, pa.float64())],
                                             names=["doc_id", "lang_pred", "score"])

    return small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, "doc_id long, lang_pred string, score double")
