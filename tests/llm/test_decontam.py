import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm import odd
from tidewater.llm import decontam


def brute(text, items, window):
    """(n_words, n_hit, item ids) by trying every window at every place."""
    words, hit, found = odd.PLAIN_WORD.findall(odd.lower(text)), set(), set()
    for item, t in items:
        w = odd.PLAIN_WORD.findall(odd.lower(t))
        k = min(window, len(w))
        windows = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else ()
        for i in range(len(words) - k + 1):
            if tuple(words[i:i + k]) in windows:
                hit.update(range(i, i + k))
                found.add(str(item))
    return len(words), len(hit), sorted(found)


def table(spark, items):
    return spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, row string")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=9), max_size=5), st.lists(st.integers(0, 4), max_size=30), st.integers(1, 5))
def test_automaton_equals_brute_force(items, text, window):
    a = decontam.Automaton([(str(i), np.array(w, dtype=np.uint64)) for i, w in enumerate(items)], window)
    spans, found = a.run(text)
    n = brute(" ".join(f"w{w}" for w in text), [(i, " ".join(f"w{x}" for x in w)) for i, w in enumerate(items)], window)
    assert (len(text), sum(e - b for b, e in spans), sorted(found)) == n


@pytest.mark.parametrize("block_words", [400_000, 20])
def test_query_equals_brute_force(spark, monkeypatch, block_words):
    monkeypatch.setattr(decontam, "BLOCK_WORDS", block_words)
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "日本", "x-y"]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 2, 5, 13, 14, 30])))) for i in range(25)]
    docs = []
    for d in range(80):
        words = rng.choices(vocabulary, k=rng.randrange(0, 120))
        for _ in range(rng.randrange(3)):
            words[rng.randrange(len(words) + 1):0] = rng.choice(items)[1].upper().split(" ")
        docs.append((1000 + d, " ".join(words), "en", "s"))
    got = decontam.contamination(odd.documents(spark, docs + odd.DOCS[3:6]), table(spark, items)).collect()
    want = {d: brute(t, items, 13) for d, t, _, _ in docs + odd.DOCS[3:6]}
    for r in got:
        assert (r.n_words, r.n_hit, r["items"]) == want[r.row.doc_id], r.row.doc_id
        assert r.contaminated == (r.n_hit > 0 and 20 * r.n_hit >= r.n_words)
    assert len(got) == len(want)


def test_spans_are_cut_by_coverage_or_length(spark):
    passage = " ".join(f"Q{i}" for i in range(20))
    filler = " ".join(f"f{i}" for i in range(1000))
    docs = [(1, f"{filler} {passage}. {filler}", "en", "s"), (2, f"Intro, {passage}! end", "en", "s"), (3, filler, "en", "s")]
    items = table(spark, [(7, passage.lower())])
    got = {r.row.doc_id: r for r in decontam.contamination(odd.documents(spark, docs), items).collect()}
    assert got[1].cleaned == docs[0][1] and not got[1].contaminated and got[1].n_hit == 20
    assert got[2].cleaned == "Intro, ! end" and got[2].contaminated
    assert got[3].cleaned == filler and got[3].row.cleaned == "cleaned"
    cut = {r.row.doc_id: r for r in decontam.contamination(odd.documents(spark, docs), items, max_span=15).collect()}
    assert cut[1].cleaned == f"{filler} . {filler}"


def test_odd_rows_and_empty_tables(spark):
    items = [(1, "one"), (2, None), (None, "two"), (3, ""), (1, "one"), (4, "brown fox")]
    got = decontam.contamination(odd.documents(spark), table(spark, items)).collect()
    want = odd.by_id([{"d": d, "w": brute(t, [(1, "one"), (4, "brown fox")], 13)} for d, t, _, _ in odd.DOCS], "d", "w")
    assert odd.by_id([{"d": r.row.doc_id, "w": (r.n_words, r.n_hit, r["items"])} for r in got], "d", "w") == want
    assert all(r.cleaned == r.row.text for r in got if not r.contaminated)
    none = decontam.contamination(odd.documents(spark), table(spark, [])).collect()
    assert len(none) == len(odd.DOCS) and not any(r.n_hit or r.contaminated for r in none)
    assert decontam.contamination(odd.documents(spark, []), table(spark, items)).count() == 0
