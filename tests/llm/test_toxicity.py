import zlib

import numpy as np
from pyspark.sql import functions as F

from tests.llm import odd
from tidewater.llm import queries, toxicity
from tidewater.llm.wordhash import NON_WORD, Words

def trained():
    return F.pmod(F.col("doc_id"), F.lit(5)) != 0


def corpus(n=600):
    """Texts of which each seventh holds a made-up toxic stem or an insult."""
    rows, labels = [], []
    for i in range(n):
        words = [f"w{(i * j) % 211}" for j in range(1, 40)]
        toxic = i % 7 == 0
        if toxic:
            words[i % 30] = f"zorgl{'abcdefgh'[i % 8]}x" if i % 2 else "pathetic"
        rows.append((i, " ".join(words), "en", "s"))
        labels.append((i, 1 if toxic else 0))
    return rows, labels


def test_learned_stems_reach_the_held_out_fold(spark):
    rows, labels = corpus()
    known = spark.createDataFrame([*labels, (None, 1), (10_000, 1), (3, None)], "doc_id long, toxic int")
    got = toxicity.score(odd.documents(spark, rows), known, trained()).collect()
    truth = dict(labels)
    held = [(r.predicted, truth[r.doc_id]) for r in got if r.doc_id % 5 == 0]
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert sum(p == t for p, t in held) / len(held) > 0.97


def test_query_on_the_given_documents(spark, tmp_path):
    got = queries.QUERIES["op3_toxicity_weak_supervision"](spark, "/root/testdata/sf0.01").collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    clean = [r.predicted for r in got if r.held_out and labels.get(r.doc_id) == 0]
    toxic = [r.predicted for r in got if r.held_out and labels.get(r.doc_id) == 1]
    assert np.mean(clean) < 0.05 and np.mean(toxic) > 0.5


def test_label_model_recovers_the_rates():
    rng = np.random.default_rng(4)
    m = len(toxicity.VOTERS)
    y = rng.random(60_000) < 0.1
    a, b = rng.uniform(0.3, 0.9, m), np.full(m, 0.01)
    fired = rng.random((len(y), m)) < np.where(y[:, None], a, b)
    codes, counts = np.unique(fired @ (1 << np.arange(m)), return_counts=True)
    model = toxicity.fit_label_model(codes, counts, 0.1)
    assert np.abs(model.toxic - a).max() < 0.05 and np.abs(model.clean - b).max() < 0.01
    assert ((model.posterior(fired.astype(float)) > 0.5) == y).mean() > 0.99


def test_correlated_voters_share_their_evidence():
    rng = np.random.default_rng(5)
    m = len(toxicity.VOTERS)
    y = rng.random(60_000) < 0.2
    fired = rng.random((len(y), m)) < np.where(y[:, None], 0.5, 0.02)
    fired[:, 1] = fired[:, 0]
    codes, counts = np.unique(fired @ (1 << np.arange(m)), return_counts=True)
    share = toxicity.fit_label_model(codes, counts, 0.2).share
    assert share[:2].max() < 0.7 and share[2:].min() > 0.8


def test_beginnings_of_words_are_found():
    one, two = Words([b"Zorgla zorglb zor"], NON_WORD), Words([b"x ZORGLC"], NON_WORD)
    assert one.prefix(5)[0] == one.prefix(5)[1] == two.prefix(5)[1]
    assert len({*one.prefix(4).tolist(), *one.prefix(5).tolist(), *one.hash.tolist()}) == 7


def test_odd_rows(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    docs = odd.documents(spark, [*odd.DOCS, (21, odd.DOCS[15][1], "en", "a")])
    for labels in (none, spark.createDataFrame([(15, 1), (1, 0), (1, 0), (4, 1)], "doc_id long, toxic int")):
        got = toxicity.score(docs, labels, trained()).collect()
        by = {r.doc_id: r.score for r in got}
        assert len(got) == len(odd.DOCS) + 1 and by[4] == by[5] == by[6] and all(0 <= r.score <= 1 for r in got)
        assert by[15] > by[5]
    assert toxicity.score(odd.documents(spark, []), none, trained()).count() == 0


def learned(spark, rows):
    return toxicity.learn_terms(spark.createDataFrame(rows, "text string, toxic boolean"))[0]


def test_a_toxic_term_is_learned_among_many_commoner_neutral_ones(spark):
    neutral = " ".join(f"{i * 7919 % 100_003:05d}{i * 104_729 % 1_000_003:06d}" for i in range(20_000))
    rows = [(neutral + (" zorglax" if i < 20 else ""), True) for i in range(30)] + [(neutral, False)] * 100
    assert set(_word_hashes("zorglax")) <= set(learned(spark, rows).hashes.tolist())


def test_no_learned_term_is_cut(spark):
    bad = " ".join(f"{i * 7919 % 100_003:05d}{i * 104_729 % 1_000_003:06d}" for i in range(5_000))
    terms = learned(spark, [(bad, True)] * 40 + [("only clean words", False)] * 400)
    assert set(_word_hashes(bad)) <= set(terms.hashes.tolist())
    assert (np.diff(terms.hashes.astype(object)) > 0).all() and (terms.odds >= min(toxicity.GRADES.values())).all()


def _word_hashes(text):
    return Words([text.encode()], NON_WORD).hash.tolist()
