import math
import struct
from collections import Counter

import pytest
import xxhash

from tests.llm import odd
from tidewater.llm import quality, queries


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def grams(text):
    """Buckets of a text's unigrams and bigrams."""
    h = [xxhash.xxh64_intdigest(w.encode(), seed=42) for w in odd.SPACE_WORD.findall(text or "")]
    two = [xxhash.xxh64_intdigest(struct.pack("<Q", b), seed=xxhash.xxh64_intdigest(struct.pack("<Q", a), seed=42))
           for a, b in zip(h, h[1:], strict=False)]
    n = quality.BUCKETS
    return [signed(x) % n for x in h] + [n + signed(x) % n for x in two]


def base(text):
    text = text or ""
    words = odd.SPACE_WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    covered = {k for i, w in enumerate(windows) if times[w] > 1 for k in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if odd.SPACE_WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
            len(words) < 50 or 100 * len(covered) > 50 * len(words))


def brute(rows, trusted):
    raw, good = Counter(), Counter()
    for d, t in rows:
        raw.update(grams(t))
        if d in trusted:
            good.update(grams(t))
    share = sum(good.values()) / max(1, sum(raw.values()))
    s = quality.SHRINKAGE
    weight = {b: math.log((good[b] + s) / (raw[b] * share + s)) if share else 0.0 for b in raw}
    return [(d, base(t), sum(weight[b] for b in grams(t)) / max(1, len(grams(t)))) for d, t in rows]


ROWS = odd.DOCS + [(200 + i, " ".join(f"t{(i * j) % 37} plain{j % 11}" for j in range(60)), "en", "a") for i in range(20)] + [
    (300 + i, " ".join(f"junk{(i * j) % 29}%%%" for j in range(70)), "en", "a") for i in range(20)]


@pytest.mark.parametrize("trusted", [list(range(200, 215)) + [1, None, 999], []])
def test_judge_equals_brute_force(spark, trusted):
    ids = spark.createDataFrame([(i,) for i in trusted], "doc_id long")
    got = quality.judge(odd.documents(spark, ROWS), ids).collect()
    want = brute([(d, t) for d, t, _, _ in ROWS], {i for i in trusted if i is not None})
    key = lambda r: (r[0] is None, r[0] or 0)
    have = sorted(((r.row.doc_id, (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed), r.score, r.kept)
                   for r in got), key=key)
    for (d, stats, score, kept), (e, b, s) in zip(have, sorted(want, key=key), strict=True):
        assert d == e and stats == b and score == pytest.approx(s, abs=1e-9)
        assert kept == (not b[5] and s >= quality.THRESHOLD)


def test_a_filter_on_the_verdict_keeps_the_rows(spark):
    ids = spark.createDataFrame([(200,), (201,)], "doc_id long")
    judged = quality.judge(odd.documents(spark, ROWS), ids)
    kept = judged.filter("kept").select("row.*").collect()
    assert sorted(r.doc_id for r in kept) == sorted(r.row.doc_id for r in judged.collect() if r.kept)
    assert kept[0].kept == "kept"


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long")
    assert quality.judge(odd.documents(spark, []), none).count() == 0


def test_no_python_in_the_plan(spark):
    ids = spark.createDataFrame([(200,)], "doc_id long")
    plan = quality.judge(odd.documents(spark, ROWS), ids)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


GOOD = [(1000 + i, " ".join(f"g{(i * j * j + j) % 61} plain{(i + j) % 13}" for j in range(60)), "en", "a") for i in range(60)]
OTHER = [(2000 + i, " ".join(f"junk{(i * j) % 29}%%%" for j in range(70)), "en", "a") for i in range(20)]
HOT = " ".join(f"hot{j}" for j in range(400))
COPIES = [(3000 + i, HOT, "en", "a") for i in range(40)]


@pytest.mark.parametrize("labelled", ["all", "one", "none"])
def test_copies_count_as_one_document(spark, labelled):
    trusted = {d for d, _, _, _ in GOOD} | {"all": {d for d, _, _, _ in COPIES}, "one": {3007}, "none": set()}[labelled]
    ids = spark.createDataFrame([(i,) for i in sorted(trusted)], "doc_id long")
    got = quality.judge(odd.documents(spark, GOOD + OTHER + COPIES), ids, distinct_texts=True).collect()
    want = brute([(d, t) for d, t, _, _ in GOOD + OTHER + COPIES[7:8]], trusted)
    score = {d: s for d, _, s in want}
    assert len(got) == len(GOOD + OTHER + COPIES)
    for r in got:
        d = r.row.doc_id
        assert r.score == pytest.approx(score[d if d < 3000 else 3007], abs=1e-9)
        if 1000 <= d < 2000:
            assert r.kept == (not r.base_failed)
    if labelled != "none":
        assert all(r.kept for r in got if r.row.doc_id >= 3000)


def test_query_gives_copies_the_weight_of_one(spark, tmp_path):
    odd.documents(spark, GOOD + OTHER + COPIES, clashing=False).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(d, 1) for d, _, _, _ in GOOD + COPIES], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    got = queries.QUERIES["op6_quality_rules"](spark, str(tmp_path)).collect()
    want = {d: s for d, _, s in brute([(d, t) for d, t, _, _ in GOOD + OTHER + COPIES[:1]], {d for d, _, _, _ in GOOD + COPIES})}
    assert len(got) == len(GOOD + OTHER + COPIES)
    assert all(r.score == pytest.approx(want[min(r.doc_id, 3000)], abs=1e-9) for r in got)
