import random
import tracemalloc

import numpy as np
import pytest

from tests.llm import odd
from tidewater.llm import neardup, wordhash


def shingle_set(text, n):
    words = odd.SPACE_WORD.findall(odd.lower(text))
    if not words:
        return frozenset()
    size = min(n, len(words))
    return frozenset((size, *words[i:i + size]) for i in range(len(words) - size + 1))


def brute(rows, n, percent):
    """(doc_id, n_shingles, component) by all pairs."""
    sets = [shingle_set(t, n) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            ids[find(i)] = min(ids.get(find(i), d), d)
    return sorted(((d, len(sets[i]), ids.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)),
                  key=lambda r: (r[0] is None, r[0] or 0))


def groups(seed, n_groups=40, size=12):
    """Families of texts that differ in a few words, many of them near the threshold."""
    rng = random.Random(seed)
    rows, doc = [], 0
    for _ in range(n_groups):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(5, 90))]
        for _ in range(rng.randrange(1, size)):
            text = list(base)
            for _ in range(rng.randrange(0, 4)):
                text[rng.randrange(len(text))] = f"x{rng.randrange(10_000)}"
            rows.append((doc, " ".join(text)))
            doc += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("n", "percent"), [(3, 85), (5, 80)])
def test_components_equal_all_pairs(spark, n, percent):
    rows = groups(n)
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), n, percent).collect()
    assert odd.by_id(got, "doc_id", "n_shingles", "component_id") == brute(rows, n, percent)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_a_large_region_is_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK_NODES", 8)
    monkeypatch.setattr(neardup, "NEIGHBOURS", 1)
    rows = groups(9, n_groups=3, size=60)
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()
    assert odd.by_id(got, "doc_id", "n_shingles", "component_id") == brute(rows, 3, 85)


def test_odd_rows(spark):
    rows = [(d, t) for d, t, _, _ in odd.DOCS]
    got = neardup.near_duplicates(odd.documents(spark), 3, 85).collect()
    assert odd.by_id(got, "doc_id", "n_shingles", "component_id") == brute(rows, 3, 85)
    kept = {r.doc_id: r.kept for r in got}
    assert kept[1] and not kept[2] and not kept[3] and kept[4] and kept[5] and not kept[8]
    assert [r.kept for r in got if r.doc_id is None] == [True]


def test_empty_table(spark):
    got = neardup.near_duplicates(odd.documents(spark, []))
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"] and got.count() == 0


def test_signature_estimates_the_similarity():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, 1000).astype(np.uint64)
    b = np.concatenate((a[:900], rng.integers(0, 1 << 63, 100).astype(np.uint64)))
    assert abs((neardup.signature(a) == neardup.signature(b)).mean() - 900 / 1100) < 0.1


def test_forest_shape_covers_the_threshold():
    for percent in (70, 80, 85, 90, 95):
        depth, trees, width = neardup.forest_shape(percent)
        assert trees * width <= neardup.PERMUTATIONS and depth <= width
        assert (1 - (percent / 100) ** depth) ** trees <= 1e-6


def test_one_id_with_several_texts(spark):
    rng = random.Random(11)

    def family(k):
        base = [f"f{k}w{j}" for j in range(120)]
        return [" ".join(base[:i] + [f"x{rng.randrange(10_000)}"] + base[i + 1:]) for i in (3, 117)]

    rows = []
    for k in range(30):  # the id 10 * k + 5 stands for one text of each of two families, and for a text alone
        (a, b), (c, d) = family(2 * k), family(2 * k + 1)
        rows += [(10 * k + 5, a), (10 * k + 5, c), (10 * k + 7, b), (10 * k + 3 if k % 2 else 10 * k + 9, d),
                 (10 * k + 5, f"alone {k} " + " ".join(f"a{k}b{j}" for j in range(30)))]
    rng.shuffle(rows)
    want = brute(rows, 3, 85)
    assert len({(d, c) for d, _, c in want if d % 10 == 5 and c != d}) == 15  # a family of each second id has a smaller one
    for order in (rows, rows[::-1]):
        got = neardup.near_duplicates(spark.createDataFrame(order, "doc_id long, text string"), 3, 85).collect()
        assert odd.by_id(got, "doc_id", "n_shingles", "component_id") == odd.by_id(
            [{"d": d, "n": n, "c": c} for d, n, c in want], "d", "n", "c")


@pytest.mark.parametrize("small", [1_000_000, 10])
def test_components_settle_alike_in_one_task_and_in_rounds(spark, monkeypatch, small):
    monkeypatch.setattr(neardup, "SMALL_EDGES", small)
    rng = random.Random(9)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1200)] + [(5, 5)]
    rng.shuffle(edges)
    root = {n: n for e in edges if e[0] != e[1] for n in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    got = neardup.components(spark.createDataFrame(edges, "a long, b long").repartition(6)).collect()
    assert {r.node: r.component for r in got} == {n: find(n) for n in root} and len(got) == len(root)


def test_a_block_of_words_takes_little_memory(monkeypatch):
    monkeypatch.setattr(wordhash, "_POWERS", wordhash._Powers())
    text = " ".join(f"w{i % 9973}" for i in range(22_000)).encode()
    block = [text] * (wordhash.BLOCK_BYTES // len(text))
    tracemalloc.start()
    try:
        words = wordhash.Words(block, wordhash.SPACE)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < 30 << 20
    alone = wordhash.Words([text], wordhash.SPACE).of(0)
    assert all((words.of(i) == alone).all() for i in range(len(block)))
