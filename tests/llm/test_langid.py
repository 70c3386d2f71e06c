import zlib

import numpy as np
from pyspark.sql import functions as F

from tests.conftest import SF_ORACLE
from tests.llm import odd
from tidewater.llm import langid, queries


def test_held_out_accuracy(spark):
    """Queries over the given documents: the held-out fold is right nearly everywhere."""
    got = queries.QUERIES["op2_language_id"](spark, SF_ORACLE).collect()
    truth = {r.doc_id: (r.lang, r.text) for r in spark.read.parquet(f"{SF_ORACLE}/documents.parquet").collect()}
    assert len(got) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    held = [r.lang_pred == truth[r.doc_id][0] for r in got if r.held_out]
    assert len(held) > 100 and sum(held) / len(held) > 0.97


def test_pooling_equals_a_plain_convolution():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 157, (5, langid.WINDOW)).astype(np.uint8)
    filters = [rng.normal(size=(w, langid.LETTERS, langid.FILTERS)) for w in langid.WIDTHS]
    biases = [rng.normal(size=langid.FILTERS) for _ in langid.WIDTHS]
    net = langid.Network(["a", "b"], filters, biases, rng.normal(size=(48, 2)), np.zeros(2))
    want = [np.maximum(0, np.max([sum(f[k][row[i + k]] for k in range(len(f))) for i in range(langid.WINDOW - len(f) + 1)], axis=0) + b)
            for row in x for f, b in zip(filters, biases, strict=True)]
    np.testing.assert_allclose(net.pooled(x, net.pairs()).reshape(-1), np.concatenate(want), rtol=1e-9)
    np.testing.assert_allclose(np.exp(net.log_probabilities(x, net.pairs(), batch=2)).sum(axis=1), 1)


def test_training_learns_a_byte_pattern():
    rng = np.random.default_rng(3)
    x = rng.integers(3, 20, (400, langid.WINDOW)).astype(np.uint8)
    y = np.arange(400) % 2
    x[y == 1, 100:103] = [25, 26, 27]
    net = langid.train(x[:300], y[:300], ["no", "yes"], epochs=15)
    assert (net.log_probabilities(x[300:], net.pairs()).argmax(axis=1) == y[300:]).mean() > 0.95


def test_every_window_of_a_long_text_counts():
    text = b"a" * 1000
    w = langid.windows(text)
    assert w.shape == (4, 256) and (w > 0).sum() == 1000 and langid.windows(b"").shape == (1, 256)


def test_odd_rows(spark):
    docs = odd.documents(spark, odd.DOCS + [(100 + i, t, lang, "s") for i in range(40) for t, lang in
                                            ((f"the thing and that number {i} with these words", "en"),
                                             (f"der die das und nicht zahl {i} mit wörtern über", "de"))])
    network = langid.fit(docs.filter("doc_id is not null"))
    assert network.langs == ["de", "en", "fr"]
    got = langid.identify(docs, network).collect()
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (4, 5, 6, 16)] == ["und"] * 4 and all(0 <= r.score <= 1 for r in got)
    assert by[14].lang_pred in network.langs and len(got) == docs.count()
    assert {r.lang_pred for r in langid.identify(docs, None).collect()} == {"und"}
    assert langid.identify(odd.documents(spark, []), network).count() == 0
    assert langid.fit(docs.withColumn("lang", F.lit(None).cast("string"))) is None
