import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm import odd
from tests.llm.test_decontam import brute as contaminated
from tests.llm.test_neardup import brute as components
from tests.llm.test_quality import base
from tidewater.llm import secrets

PROSE = [f"w{(i * 7919) % 4001} and" for i in range(4000)]


def prose(k, n=60):
    return " ".join(PROSE[(k * 61) % 3000: (k * 61) % 3000 + n])


PASSAGE = " ".join(f"exam{i}" for i in range(30))
ROWS = [(i, prose(i), "en", f"s{i % 9}") for i in range(40)] + [
    (100, prose(3), "en", "s"), (101, prose(3).replace("w", "W") + " tail", "en", "s"), (102, prose(5) + " " + PASSAGE, "en", "s"),
    (103, prose(7, 150) + ' token = "a1b2c3d4e5f6a7b8" end', "en", "s"), (103, prose(7, 150) + ' token = "a1b2c3d4e5f6a7b8" end', "en", "s"),
    (104, "short text", "en", "s"), (105, "again and again " * 40, "en", "s"), *odd.DOCS]
ITEMS = [(1, PASSAGE), (2, "of no document"), (3, None)]


@pytest.fixture
def sf(spark, tmp_path):
    odd.documents(spark, ROWS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(i, 1, 0) for i in (*range(40), 100, 101, 102, 103)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_each_stage_equals_its_definition(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    before = [tuple(r) for r in docs.collect()]
    for (name, stage), check in zip(corpus_pipeline.STAGES, (quality, dedup, decontaminated, redacted, packed), strict=True):
        out = stage(spark, docs, sf)
        rows = out.collect()
        if name != "best_fit_packing":
            assert out.columns == columns and out.dtypes == docs.dtypes
        check(before, rows)
        before = [tuple(r) for r in rows]
        docs = corpus_pipeline.written(out, "test-stage")
    assert corpus_pipeline.run(spark, sf).count() == len(before)


def quality(before, after):
    assert {r.doc_id for r in after} >= {*range(40), 100, 101, 102, 103} and not {104, 105} & {r.doc_id for r in after}
    assert {tuple(r) for r in after} <= set(before) and not any(base(r.text)[5] for r in after)


def dedup(before, after):
    texts = [(b[0], b[1]) for b in before]
    assert sorted(r.doc_id for r in after) == sorted({c for _, _, c in components(texts, 5, 80)})


def decontaminated(before, after):
    items = [i for i in ITEMS if i[1]]
    bad = {b[0] for b in before if (n := contaminated(b[1], items, 13))[1] and 20 * n[1] >= n[0]}
    assert bad == {102} and sorted(tuple(r) for r in after) == sorted(b for b in before if b[0] not in bad)


def redacted(before, after):
    want = {b[0]: b[1].replace('token = "a1b2c3d4e5f6a7b8', "[SECRET]") for b in before}
    assert {r.doc_id: r.text for r in after} == want and all(r.n_chars == len(r.text) for r in after)
    assert not any(secrets.find(r.text) for r in after if r.doc_id == 103)


def packed(before, after):
    coder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    length = {b[0]: len(coder.encode(b[1], add_special_tokens=False).ids) + 1 for b in before}
    total = {}
    for r in after:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
    assert total == length


def test_short_benchmark_spans_are_cut_from_long_documents(spark, tmp_path):
    item = " ".join(f"exam{i}" for i in range(20))
    odd.documents(spark, [(1, f"{prose(1, 400)} {item}. {prose(2, 400)}", "en", "s"), (2, prose(3, 400), "en", "s"), (3, f"a {item} b", "en", "s")],
                  clashing=False).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r.doc_id: r for r in corpus_pipeline.decontaminate(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path)).collect()}
    assert set(got) == {1, 2} and got[2].text == prose(3, 400)
    assert got[1].text == f"{prose(1, 400)} . {prose(2, 400)}" and got[1].n_chars == len(got[1].text)
