import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm import odd
from tidewater.llm import rans, tokens
from tidewater.llm.tokens import ByteLevelChunks

PATH = public_tokenizers.path("byte_bpe_50k.json")


def brute(rows):
    """{doc_id: [(start, ids)]} in ascending order, null ids first, each text by the plain library."""
    plain, out, start = Tokenizer.from_file(PATH), [], 0
    for doc_id, text in sorted(((d, t) for d, t, *_ in rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = plain.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def rows_of(frame):
    return sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in frame.collect()), key=lambda r: (r[1], r[0] or 0))


@pytest.mark.parametrize("block, every, reach", [(rans.BLOCK_IDS, rans.CHECKPOINT_IDS, rans.RANGE_BLOCKS), (4096, 2048, 2)])
def test_files_hold_what_the_tokenizer_gives(spark, block, every, reach):
    more = [(100 + i, " ".join(f"w{j * i}," for j in range(i * 9)), "en", "a") for i in range(60)]
    rows = odd.DOCS + more
    folder, manifest = rans.write(odd.documents(spark, rows).repartition(5), PATH, block_ids=block, checkpoint_ids=every)
    if block == 4096:  # files of more blocks than a range has, and documents over several blocks
        assert max(r.blocks for r in manifest.collect()) > reach
    want = brute(rows)
    assert rows_of(rans.read(folder, manifest, range_blocks=reach)) == want
    for r in rans.read(folder, manifest, with_ids=True, range_blocks=reach).collect():
        assert len(r.ids) == 4 * r.n_tokens and zlib.crc32(r.ids) == r.ids_crc32


def test_empty_table(spark):
    folder, manifest = rans.write(odd.documents(spark, []), PATH)
    assert manifest.count() == 0 and rans.read(folder, manifest).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aZé日1 \n\t.,'’  \x1c\x85<|", max_size=25) | st.text(max_size=12) | st.just("a <|endoftext|> b's"), max_size=5))
def test_chunks_give_the_ids_of_whole_texts(texts):
    chunks = _CHUNKS
    plain = [np.array(e.ids, "<u4").tobytes() for e in chunks.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert chunks.block(texts) == plain
    assert [b"".join(chunks._encode(chunks.pieces(t))[p] for p in chunks.pieces(t)) for t in texts] == plain


_CHUNKS = ByteLevelChunks(PATH, limit=40)
_ANY = "aZé日Ω1٣²_.,'’…—\u0301\u180e\u200b\ufeff😀 \n\t\r\x1c\x85\xa0\u2028\u3000"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.none() | st.lists(st.text(alphabet=_ANY, max_size=9) | st.text(max_size=5) | st.sampled_from(["<|endoftext|>", "<|endof", "'s", "\n\n", "  "])).map("".join), max_size=6),
       st.sampled_from(["<u2", "<u4"]), st.integers(1, 40), st.integers(0, 3))
def test_ids_of_any_characters(texts, kind, stretch, skip):
    want = [np.array([*e.ids, 7], kind).tobytes() for e in _CHUNKS.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    with pytest.MonkeyPatch.context() as m:
        m.setattr(tokens, "_STRETCH", stretch)
        got = _CHUNKS.ids(pa.array(texts, pa.string())[skip:], kind, np.array([7], "<u4").tobytes())
    assert got.to_pylist() == want[skip:]


def test_words_are_encoded_once_whatever_stands_beside_them():
    chunks = ByteLevelChunks(PATH)
    words = [f"{a}{b}" for a in ("on", "thé", "ing", "Er") for b in ("a", "ou", "st", "ß", "ly")]
    texts = [" ".join(f"{v}{mark}\n{w}" for mark in (".", ",", "!?", "&&&")) for v in words for w in words]
    assert chunks.block(texts) == [np.array(e.ids, "<u4").tobytes() for e in chunks.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert len(chunks.young) <= 2 * len(words) + 5  # at the start of a line and behind a space; marks and line ends


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 30) | st.integers(0, 3), max_size=4000), st.data())
def test_blocks_round_trip_from_every_checkpoint(values, data):
    ids = np.array(values, dtype=np.uint32)
    found, counts = np.unique(ids, return_counts=True)
    table = rans.Table.load(rans.Table.of_counts(found, counts).dump())
    assert not len(ids) or int(table.frequencies.sum()) == 1 << rans.PRECISION
    block = rans.Block(rans.pack_block(ids, 0, [rans.Document(None, len(ids))], table), table)
    assert block.ids().tolist() == values and block.docs == [rans.Document(None, len(ids))]
    begin = data.draw(st.integers(0, len(ids)))
    end = data.draw(st.integers(begin, len(ids)))
    assert block.ids(begin, end).tolist() == values[begin:end]


def test_checkpoints_size_and_damage():
    rng = np.random.default_rng(3)
    ids = np.minimum(rng.zipf(1.3, 600_000), 40_000).astype(np.uint32)
    found, counts = np.unique(ids, return_counts=True)
    table = rans.Table.of_counts(found, counts)
    data = rans.pack_block(ids, 0, [], table)
    block = rans.Block(data, table)
    assert [m[0] for m in block.marks] == [0, 262144, 524288]
    assert (block.ids(300_000, 350_000) == ids[300_000:350_000]).all()
    share = counts / counts.sum()
    assert len(data) * 8 < 1.05 * len(ids) * -(share * np.log2(share)).sum()
    with pytest.raises(ValueError):
        rans.Block(data[:5000] + b"\0\1" + data[5002:], table)
    with pytest.raises(ValueError):
        rans.encode(np.array([45_000], np.uint32), rans.Table.of_counts(found, counts))
