"""Token ids of whole texts by a public tokenizer, with a cache per chunk."""

from __future__ import annotations

import json
import os
import string
import unicodedata
from array import array
from functools import cache
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_CACHED_LENGTH = 48
_STRETCH = 1 << 22
#: Punctuation after letters; an apostrophe may begin a contraction instead.
_TAIL = string.punctuation.replace("'", "")
_PARTS = {"normalizer": ["NFC", "Replace", "Lowercase"], "pre_tokenizer": ["Split", "ByteLevel"]}


def _byte_letters() -> list[str]:
    """Byte-level BPE's letter for each byte: itself where it prints, else one from U+0100 on in order."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in prints else chr(next(others)) for b in range(256)]


_LETTERS = _byte_letters()
_SPELLED = dict(enumerate(_LETTERS))
_ID = attrgetter("id")


def _plain(chunk: str) -> bool:
    """Letters that lower case and normalisation keep letters, one for one."""
    return chunk.isalpha() and (chunk.isascii() or max(chunk) < "\u0130")


def _kinds(part: dict | None, parts: str) -> list[str]:
    return [p["type"] for p in (part or {}).get(parts, [])]


class _Both(dict):
    """A block's new chunks in front of the known ones."""

    def __init__(self, known: dict[str, bytes], new: dict[str, bytes]):
        super().__init__(new)
        self.known = known

    def __missing__(self, chunk: str) -> bytes:
        return self.known[chunk]


class ChunkedTokenizer:
    """Ids of a word tokenizer that drops white space and never joins what it separates.

    Its ids for a text are those of the text's chunks one after the other, so
    each distinct chunk is encoded once while it stays in the cache.  A chunk
    of letters is one word and goes to the model in lower case directly;
    punctuation after it is a token run of its own; any other chunk goes through
    the whole tokenizer.  The cache has two generations of ``limit`` chunks:
    what is not used again drops out.
    """

    def __init__(self, path: str, limit: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if (_kinds(spec["normalizer"], "normalizers"), _kinds(spec["pre_tokenizer"], "pretokenizers")) != tuple(_PARTS.values()):
            raise ValueError(f"{path} is not a lower-casing tokenizer of separate words")
        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        self.young: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}

    def _encode(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _word(self, word: str) -> bytes:
        low = word.lower()
        if not low.isascii():
            low = "".join([_LETTERS[b] for b in low.encode()])
        return array("I", [t.id for t in self.tokenizer.model.tokenize(low)]).tobytes()

    def _fill(self, missing: list[str]) -> dict[str, bytes]:
        known, new = self.young, {}
        for chunk in missing:
            word = chunk.rstrip(_TAIL)
            if not word or not _plain(word):
                new[chunk] = self._encode(chunk)
                continue
            ids = new.get(word) or known.get(word)
            if ids is None:
                ids = new[word] = self._word(word)
            tail = chunk[len(word):]
            if tail:
                if tail not in known:
                    known[tail] = self._encode(tail)
                new[chunk] = ids + known[tail]
        return new

    def block(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        split = [t.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") for t in texts]
        known, missing = self.young, []
        for chunk in set().union(*split):
            if chunk not in known:
                if chunk in self.old:
                    known[chunk] = self.old[chunk]
                else:
                    missing.append(chunk)
        look = known
        if missing:
            new = self._fill(missing)
            if any(len(c) > _CACHED_LENGTH for c in new):  # long chunks are not kept
                look = _Both(known, new)
                known.update((c, ids) for c, ids in new.items() if len(c) <= _CACHED_LENGTH)
            else:
                known.update(new)
        out = [b"".join(map(look.__getitem__, chunks)) for chunks in split]
        if len(known) > self.limit:
            self.old, self.young = known, {"": b""}
        return out

    def forget(self) -> None:
        """Empties the cache."""
        self.young, self.old = {"": b""}, {}


# Kinds of characters; white space has the largest numbers.
_OTHER, _LETTER, _NUMBER, _MARK, _QUOTE, _SPACE, _LINE, _WHITE = range(8)


@cache
def _kind_tables() -> tuple[np.ndarray, np.ndarray]:
    """(kind of each code point below U+10000, whether a byte-level word ends between two kinds).

    A character is a letter, number or mark only if it was one in Unicode 3.2
    and is one now, so that any tokenizer's tables agree; what was ever a
    separator counts as white space.
    """
    kinds = np.zeros(1 << 16, dtype=np.uint8)
    of = {"L": _LETTER, "N": _NUMBER, "P": _MARK, "S": _MARK}
    for point in range(1 << 16):
        c = chr(point)
        then, now = unicodedata.ucd_3_2_0.category(c)[0], unicodedata.category(c)[0]
        if c.isspace() or "Z" in (then, now):
            kinds[point] = _WHITE
        elif then == now:
            kinds[point] = of.get(now, _OTHER)
    kinds[[ord("'"), ord(" "), ord("\n")]] = _QUOTE, _SPACE, _LINE
    ends = np.zeros((8, 8), dtype=bool)
    ends[:_SPACE, [_SPACE, _LINE]] = ends[_LINE, :_SPACE] = True
    for k in (_LETTER, _NUMBER, _MARK):
        ends[k, [x for x in (_LETTER, _NUMBER, _MARK) if x != k]] = True
    ends[[_LETTER, _NUMBER], _QUOTE] = True
    return kinds, ends.ravel()


def _kinds_of(data: np.ndarray) -> np.ndarray:
    """The kind of the character that each byte of UTF-8 belongs to."""
    table, _ = _kind_tables()
    kinds = table[data]
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        head, last = data[lead].astype(np.int32), len(data) - 1
        second, third = (data[np.minimum(lead + k, last)].astype(np.int32) & 0x3F for k in (1, 2))
        point = np.where(head < 0xE0, (head & 0x1F) << 6 | second, (head & 0x0F) << 12 | second << 6 | third)
        own = np.where(head < 0xF0, table[point & 0xFFFF], np.uint8(_OTHER))
        for k, wide in enumerate((0, 0, 0xE0, 0xF0)):
            kinds[lead[head >= wide] + k] = own[head >= wide]
    return kinds


class ByteLevelChunks:
    """Ids of a byte-level BPE tokenizer, with a cache of the chunks between certain word ends.

    Its pattern ends a word before every single space between two other
    characters than white space, on both sides of such a line end, and between
    letters, numbers and marks; the ids of a text are those of its chunks cut
    there, one after the other.  Chunks are cut and told apart a stretch of texts
    at a time; each distinct one is looked up or encoded once.  A chunk of one kind
    is one word and goes to the model directly; any other (apostrophes, runs of white
    space, unknown characters, added tokens) goes through the whole tokenizer.
    The cache has two generations of ``limit`` chunks, as above.
    """

    def __init__(self, path: str, limit: int = 600_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split = spec["pre_tokenizer"] or {}
        added = any(t["lstrip"] or t["rstrip"] or t["single_word"] or any(map(str.isspace, t["content"])) for t in spec["added_tokens"])
        if spec["normalizer"] or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex") or added:
            raise ValueError(f"{path} is not a byte-level tokenizer without normalisation")
        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        self.added = [t["content"].encode() for t in spec["added_tokens"]]
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self._fast = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)  # without offsets

    @staticmethod
    def pieces(text: str) -> list[str]:
        """The coarser cut that tests hold ids against: before every single space between two other characters than white space."""
        parts = text.split(" ")
        out = [parts[0]]
        for i in range(1, len(parts)):
            left, right = parts[i - 1], parts[i]
            if left and right and not left[-1].isspace() and not right[0].isspace():
                out.append(" " + right)
            else:
                out[-1] += " " + right
        return out

    def _encode(self, chunks: list[str]) -> dict[str, bytes]:
        out = {}
        for at in range(0, len(chunks), 10_000):
            some = chunks[at:at + 10_000]
            out.update((c, array("I", e.ids).tobytes()) for c, e in zip(some, self._fast(some, add_special_tokens=False), strict=True))
        return out

    def _cut(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first bytes of the chunks, bytes that keep their chunk from being one word); no chunk crosses a bound of texts."""
        kinds, firsts = _kinds_of(data), bounds[:-1][bounds[:-1] < bounds[1:]]
        white = kinds >= _SPACE
        beside = np.zeros(len(data) + 2, dtype=bool)
        beside[1:-1] = white
        before, after = beside[:-2].copy(), beside[2:].copy()
        before[firsts] = after[firsts[1:] - 1] = False
        kinds[white & (before | after)] = _WHITE
        cut = np.zeros(len(data), dtype=bool)
        cut[1:] = _kind_tables()[1][kinds[:-1] << 3 | kinds[1:]]
        odd = (kinds == _OTHER) | (kinds == _QUOTE) | (kinds == _WHITE)
        plain = data.tobytes() if self.added else b""
        for token in self.added:
            at = plain.find(token)
            while at >= 0:
                cut[at + 1:at + len(token)], odd[at:at + len(token)] = False, True
                at = plain.find(token, at + 1)
        cut[firsts] = True
        return np.flatnonzero(cut), np.flatnonzero(odd)

    def _look(self, chunks: list[bytes], whole: np.ndarray) -> list[bytes]:
        """Ids of distinct chunks; ``whole`` marks those for the whole tokenizer."""
        known, old, tokenize = self.young, self.old, self.tokenizer.model.tokenize
        got = list(map(known.get, chunks))
        missing = [k for k, ids in enumerate(got) if ids is None]
        rest = []
        for k in missing:
            chunk = chunks[k]
            ids = old.get(chunk)
            if ids is None:
                if whole[k]:
                    rest.append(k)
                    continue
                spelled = chunk.decode().translate(_SPELLED) if chunk.isascii() else "".join([_LETTERS[b] for b in chunk])
                ids = array("I", map(_ID, tokenize(spelled))).tobytes()
            got[k] = ids
        texts = [chunks[k].decode() for k in rest]
        made = self._encode(texts)
        for k, text in zip(rest, texts, strict=True):
            got[k] = made[text]
        known.update((chunks[k], got[k]) for k in missing if len(chunks[k]) <= _CACHED_LENGTH)  # long chunks are not kept
        if len(known) > self.limit:
            self.old, self.young = known, {}
        return got

    def _stretch(self, data: np.ndarray, bounds: np.ndarray, kind: str, end: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the texts between the bounds one after the other, bytes of each text's)."""
        starts, odd = self._cut(data, bounds)
        sides = pa.py_buffer(np.append(starts, len(data)).astype(np.int32))
        told = pa.Array.from_buffers(pa.binary(), len(starts), [None, sides, pa.py_buffer(data)]).dictionary_encode()
        chunks, codes = told.dictionary.to_numpy(zero_copy_only=False).tolist(), told.indices.to_numpy()
        whole = np.zeros(len(chunks), dtype=bool)
        whole[codes[np.searchsorted(starts, odd, "right") - 1]] = True
        got = [*self._look(chunks, whole), end]
        pool = np.frombuffer(b"".join(got), "<u4").astype(kind)
        sides = np.cumsum([0, *map(len, got)]) // 4 * pool.itemsize
        entries = pa.Array.from_buffers(pa.binary(), len(got), [None, pa.py_buffer(sides.astype(np.int32)), pa.py_buffer(pool)])
        first = np.searchsorted(starts, bounds)
        _, sides, ids = entries.take(pa.array(np.insert(codes, first[1:], len(chunks)))).buffers()  # the end behind each text's chunks
        sides = np.frombuffer(sides, np.int32)[first + np.arange(len(first))]
        return np.frombuffer(ids or b"", kind, int(sides[-1]) // pool.itemsize), np.diff(sides).astype(np.int64)

    def ids(self, texts: pa.Array, kind: str = "<u4", end: bytes = b"") -> pa.Array:
        """Ids of each text, a null one empty, and ``end`` (ids of 32 bits) behind them, as binary values of ids of ``kind``."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        texts.validate(full=True)  # refuses what is not UTF-8
        _, offsets, data = texts.buffers()
        bounds = np.frombuffer(offsets or bytes(4), np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
        data = np.frombuffer(data or b"", np.uint8)
        values, sizes, at = [np.zeros(0, kind)], [np.zeros(1, np.int64)], 0
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + _STRETCH, "right")) - 1)
            some, n = self._stretch(data[bounds[at]:bounds[to]], bounds[at:to + 1] - bounds[at], kind, end)
            values.append(some)
            sizes.append(n)
            at = to
        out = np.concatenate(values)
        sides = np.cumsum(np.concatenate(sizes)).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(sides), pa.py_buffer(out)])

    def block(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        return self.ids(pa.array(texts, pa.string())).to_pylist()
