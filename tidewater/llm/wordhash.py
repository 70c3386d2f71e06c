"""Word and shingle hashing of whole texts in numpy, a block of documents at a time.

A block is one flat byte array; every step is an array operation over it, so a
million words cost a few dozen numpy calls.  Word identities are 64-bit
polynomial hashes of the word's bytes, mixed once more with its length.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
BLOCK_BYTES = 1 << 20
SPAN_BYTES = 1 << 18

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Separators of words ``[^\x20\x09-\x0D]+``.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: Separators of words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` once A-Z is lower case.
NON_WORD = np.ones(256, dtype=bool)
NON_WORD[0x30:0x3A] = False
NON_WORD[0x61:0x7B] = False
NON_WORD[0x80:] = False


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self) -> None:
        self.up = np.ones(1, dtype=U64)
        self.down = np.ones(1, dtype=U64)

    def upto(self, n: int) -> None:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            for name, base in (("up", _BASE), ("down", _BASE_INV)):
                table = np.full(size, base, dtype=U64)
                table[0] = 1
                setattr(self, name, np.multiply.accumulate(table))


_POWERS = _Powers()


class Words:
    """The words of one block: hash, place in its bytes, and each document's slice.

    Hashes are taken over stretches of SPAN_BYTES, so a long text needs a few
    bytes of memory for each of its own, not a table of 64-bit sums.
    """

    def __init__(self, texts: Sequence[bytes], separators: np.ndarray):
        data = LOWER[np.frombuffer(b"\x20".join(texts) + b"\x20", dtype=np.uint8)]
        sizes = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
        edge = np.flatnonzero(np.diff(separators[data].view(np.int8), prepend=np.int8(1)))
        self.start, self.end = edge[0::2], edge[1::2]
        self.hash = np.empty(len(self.start), dtype=U64)
        self._data = data
        i = 0
        while i < len(self.start):
            begin = self.start[i]
            j = max(i + 1, int(np.searchsorted(self.end, begin + SPAN_BYTES, side="right")))
            self.hash[i:j] = self._hashes(begin, self.start[i:j], self.end[i:j])
            i = j
        ends_of_docs = np.cumsum(sizes)
        self.first = np.searchsorted(self.start, np.concatenate(([0], ends_of_docs[:-1])))
        self.last = np.append(self.first[1:], len(self.start))
        self.count = self.last - self.first

    def _hashes(self, begin: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        data = self._data[begin: end[-1]]
        _POWERS.upto(len(data) + 1)
        total = np.zeros(len(data) + 1, dtype=U64)
        np.cumsum((data.astype(U64) + U64(1)) * _POWERS.up[: len(data)], out=total[1:])
        h = (total[end - begin] - total[start - begin]) * _POWERS.down[start - begin]
        return mix(h + (end - start).astype(U64) * U64(0xD6E8FEB86659FD93))

    def prefix(self, n: int) -> np.ndarray:
        """Hashes of the words' first ``n`` bytes, apart from those of words; of the whole word if it is shorter."""
        h = np.full(len(self.start), (n * 0xE7037ED1A0B428DB) & 0xFFFFFFFFFFFFFFFF, dtype=U64)
        for k in range(n):
            at = self.start + k
            byte = np.where(at < self.end, self._data[np.minimum(at, len(self._data) - 1)], 0)
            h = h * U64(_BASE) + byte.astype(U64) + U64(1)
        return mix(h)

    def documents(self, at: np.ndarray) -> np.ndarray:
        """The document of each word position."""
        return np.searchsorted(self.last, at, side="right")

    def of(self, doc: int) -> np.ndarray:
        return self.hash[self.first[doc] : self.last[doc]]


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of the n-word windows; the whole sequence if shorter; none without words."""
    if not len(words):
        return words
    size = min(n, len(words))
    h = np.full(len(words) - size + 1, U64(size), dtype=U64)
    for i in range(size):
        h = mix(h * U64(0xA24BAED4963EE407) + words[i : len(words) - size + 1 + i])
    return np.unique(h)


def blocks(texts: Sequence[str | None], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first, UTF-8 texts) of runs of about ``limit`` bytes; null is empty; a longer text is a block alone."""
    begin, size, run = 0, 0, []
    for i, text in enumerate(texts):
        data = b"" if text is None else text.encode("utf-8", "surrogatepass")
        if run and size + len(data) > limit:
            yield begin, run
            begin, size, run = i, 0, []
        run.append(data)
        size += len(data) + 1
    if run:
        yield begin, run
