import json
import random
import time
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm import odd
from tidewater.llm import packing
from tidewater.llm.tokens import ChunkedTokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")
CODER = Tokenizer.from_file(PATH)


def ids(text):
    return [*CODER.encode(text or "", add_special_tokens=False).ids, 0]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aBé'st.,!? \n\t ́日1%&<|>İß-"), max_size=30), max_size=5))
def test_chunked_ids_are_the_tokenizers(texts):
    got = ChunkedTokenizer(PATH, limit=5)
    for _ in range(2):
        for text, data in zip(texts, got.block(texts), strict=True):
            assert np.frombuffer(data, "<u4").tolist() == CODER.encode(text, add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=60))
def test_best_fit_is_gapless_within_capacity(lengths):
    bins, offsets, fills = packing.best_fit(np.array(lengths, dtype=np.int64), 20)
    for b in range(len(fills)):
        at = 0
        for i in sorted(np.flatnonzero(bins == b), key=lambda i: offsets[i]):
            assert offsets[i] == at
            at += lengths[i]
        assert at == fills[b] <= 20
    assert len(fills) <= 2 * sum(lengths) // 20 + 1


def check(rows, texts, capacity):
    pieces = {}
    for d, t in texts:
        x = np.array(ids(t), dtype="<u4")
        for k in range(0, len(x), capacity):
            p = x[k:k + capacity]
            pieces.setdefault((d, k // capacity), []).append((k, len(p), zlib.crc32(p.tobytes())))
    got = {}
    for r in rows:
        got.setdefault((r.doc_id, r.piece), []).append((r.start, r.length, r.ids_crc32))
    assert got == pieces
    fill = {}
    for r in sorted(rows, key=lambda r: r.offset):
        assert fill.get(r.sequence_id, 0) == r.offset
        fill[r.sequence_id] = r.offset + r.length
    assert max(fill.values(), default=0) <= capacity
    return len(fill), sum(len(ids(t)) for _, t in texts)


def test_pieces_and_sequences(spark):
    rng = random.Random(3)
    texts = [(i, " ".join(rng.choices(["alpha", "beta", "gamma,", "Δelta."], k=rng.choice([0, 3, 40, 90, 300])))) for i in range(400)]
    docs = odd.documents(spark, [(d, t, "en", "s") for d, t in texts]).repartition(5)
    n, total = check(packing.pack(docs, PATH, capacity=64, slack=2).collect(), texts, 64)
    assert n <= 1.05 * total / 64 + 2


def test_bins_climb_through_several_rounds(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_PIECES", 20)
    monkeypatch.setattr(packing, "FAN_IN", 2)
    texts = [(i, "word " * (i % 37)) for i in range(300)]
    docs = odd.documents(spark, [(d, t, "en", "s") for d, t in texts]).repartition(8)
    n, total = check(packing.pack(docs, PATH, capacity=64).collect(), texts, 64)
    assert n <= 1.1 * total / 64 + 2


def test_odd_rows(spark):
    check(packing.pack(odd.documents(spark), PATH).collect(), [(d, t) for d, t, _, _ in odd.DOCS], 2048)
    assert packing.pack(odd.documents(spark, []), PATH).count() == 0
    same = packing.pack(odd.documents(spark, [(1, "word " * 40, "en", "s")] * 50), PATH, capacity=41).collect()
    assert len(same) == 50 and len({r.sequence_id for r in same}) == 50


def test_idle_workers_keep_no_chunks(spark):
    docs = odd.documents(spark, [(i, f"word{i} other{i}", "en", "s") for i in range(800)]).repartition(4)
    assert packing.pack(docs, PATH).count() == 800

    def held(batches):
        for batch in batches:
            time.sleep(1)  # all workers take part
            coders = packing._TOKENIZERS.values()
            yield pa.RecordBatch.from_pydict({"loaded": [len(coders)], "chunks": [sum(len(c.young) + len(c.old) for c in coders)]})

    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(0, cores, 1, cores).mapInArrow(held, "loaded long, chunks long").collect()
    assert sum(r.loaded for r in rows) > 0 and all(r.chunks == r.loaded for r in rows)  # the empty chunk alone


def test_other_tokenizers_are_refused(tmp_path):
    with open(PATH, encoding="utf-8") as f:
        spec = json.load(f)
    spec["normalizer"] = None
    path = tmp_path / "t.json"
    path.write_text(json.dumps(spec))
    try:
        ChunkedTokenizer(str(path))
    except ValueError:
        return
    raise AssertionError("a tokenizer that keeps case was taken")
