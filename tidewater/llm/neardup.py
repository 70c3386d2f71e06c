"""Near-duplicate detection with an LSH forest over MinHash signatures.

1. Every whole text becomes its set of distinct word shingles; equal sets
   collapse to one node, the smallest ``doc_id`` that has the set.
2. A node has 256 MinHash values.  Tree *t* of the forest is the sorted order
   of its own run of those values (a signature order); the trees' runs are
   disjoint.  All trees are sorted at once by a range shuffle, so a dense
   stretch of an order is spread over as many tasks as it needs.
3. Neighbours in an order with a common prefix of at least ``depth`` values
   are candidates.  Round one confirms, for each node, its neighbours of the
   longest common prefixes on the full shingle sets, and joins what links.
   The prefix that counts is as deep as the region is dense.
4. Round two takes every region (equal ``depth``-value prefix of one tree)
   that still holds two components and compares all its nodes across
   components on the full sets, in blocks.  Nothing is capped: a large region
   is only cut into more block pairs, and only links that join components
   come out, fewer than a region has nodes.
5. Components of the confirmed links come from alternating star rounds on
   written tables.

``depth`` and the number of trees follow from the threshold: a pair exactly
on it shares a prefix in some tree with probability above 1 - 1e-6.
"""

from __future__ import annotations

import math
from collections import OrderedDict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import give_back, map_arrow, written
from tidewater.llm.wordhash import SPACE, U64, Words, blocks, mix, shingles

PERMUTATIONS = 256
NEIGHBOURS = 3
BLOCK_NODES = 1024
SMALL_EDGES = 1_000_000
_RNG = np.random.default_rng(20240229)
_MUL_HIGH = _RNG.integers(0, 1 << 32, PERMUTATIONS, dtype=np.uint32) | np.uint32(1)
_MUL_LOW = _RNG.integers(0, 1 << 32, PERMUTATIONS, dtype=np.uint32) | np.uint32(1)


def forest_shape(percent: int, miss: float = 1e-6) -> tuple[int, int, int]:
    """(least common depth, trees, values a tree orders by) for a threshold in percent."""
    s = percent / 100
    depth = max(2, round(math.log(0.43) / math.log(s)))
    trees = math.ceil(math.log(miss) / math.log(1 - s**depth))
    while trees * depth > PERMUTATIONS:
        depth -= 1
        trees = math.ceil(math.log(miss) / math.log(1 - s**depth))
    return depth, trees, PERMUTATIONS // trees


def signature(s: np.ndarray) -> np.ndarray:
    """Low halves of the minima of 256 hash functions over a shingle set."""
    low_bits = np.full(PERMUTATIONS, 0xFFFFFFFF, dtype=np.uint32)
    for i in range(0, len(s), 2048):
        part = s[i : i + 2048]
        high, low = (part >> U64(32)).astype(np.uint32), part.astype(np.uint32)
        h = (high[:, None] * _MUL_HIGH) ^ (low[:, None] * _MUL_LOW)
        np.minimum(low_bits, h.min(axis=0), out=low_bits)
    return low_bits.astype(np.uint16)


def set_key(s: np.ndarray) -> bytes:
    """128 bits that stand for the whole set."""
    a, b = mix(s + U64(0x51ED270B)).sum(dtype=U64), mix(s ^ U64(0x2545F4914F6CDD1D)).sum(dtype=U64)
    return np.array([a, b], dtype=U64).tobytes()


def _shingle_sets(texts: list[str | None], n: int) -> Iterator[np.ndarray]:
    for _, run in blocks(texts):
        words = Words(run, SPACE)
        for i in range(len(run)):
            yield shingles(words.of(i), n)


def signatures(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, n, key, sig) of every row; key and sig are null for a text without words."""

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        n, keys, sigs = [], [], []
        for s in _shingle_sets(batch.column(2).to_pylist(), shingle):
            n.append(len(s))
            keys.append(set_key(s) if len(s) else None)
            sigs.append(signature(s).tobytes() if len(s) else None)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(sigs, pa.binary())],
            names=["doc_id", "text_key", "n", "key", "sig"])

    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    return map_arrow(rows, fn, "doc_id long, text_key long, n long, key binary, sig binary", most="2m")


def _fixed(column: pa.Array, width: int) -> np.ndarray:
    """A binary column of equal widths as a byte matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, width)


def forest_neighbours(nodes: DataFrame, percent: int) -> DataFrame:
    """Rows of the sorted orders that share a region with a neighbour.

    (region, node, prev, lcp): ``prev`` is the node before it in the order and
    ``lcp`` their common prefix; null and 0 at the start of a region.
    """
    depth, trees, width = forest_shape(percent)
    row = 1 + 2 * width
    orders = (nodes.select("node", "sig", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
              .select("node", F.expr(f"concat(unhex(lpad(hex(tree), 2, '0')), substring(sig, tree * {2 * width} + 1, {2 * width}))")
                      .alias("order_key"))
              .repartitionByRange("order_key", "node").sortWithinPartitions("order_key", "node"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # last row so far: key bytes, node, node before it, their lcp
        first = True
        for batch in chain(batches_of(batches), [None]):
            if batch is None:
                if held is None:
                    return
                keys, ids, more = held[0], held[1], 0
            else:
                keys, ids = batch
                if held is not None:
                    keys, ids = np.concatenate((held[0], keys)), np.concatenate((held[1], ids))
                more = 1
            same = (keys[1:] == keys[:-1])
            equal = np.concatenate((same[:, :1], same[:, 1::2] & same[:, 2::2]), axis=1)
            lcp_prev = np.zeros(len(ids), dtype=np.int32)
            lcp_prev[1:] = np.where(equal[:, 0], np.minimum.accumulate(equal, axis=1).sum(axis=1) - 1, 0)
            prev = np.concatenate(([0], ids[:-1]))
            if held is not None:
                prev[0], lcp_prev[0] = held[2], held[3]
            out = len(ids) - more  # the last row waits for its successor
            lcp_next = np.append(lcp_prev[1:], 0)
            edge = np.zeros(len(ids), dtype=np.int32)
            if first and out:
                edge[0] |= 1
            if not more:
                edge[-1] |= 2
            keep = np.flatnonzero(((lcp_prev >= depth) | (lcp_next >= depth) | (edge > 0))[:out])
            if len(keep):
                first = False
                linked = lcp_prev[keep] >= depth
                yield pa.RecordBatch.from_arrays([
                    pa.array([keys[i, : 1 + 2 * depth].tobytes() for i in keep], pa.binary()),
                    pa.array(ids[keep]),
                    pa.array(prev[keep], mask=~linked),
                    pa.array(np.where(linked, lcp_prev[keep], 0).astype(np.int32)),
                    pa.array(edge[keep]),
                    pa.array([keys[i].tobytes() if edge[i] else None for i in keep], pa.binary()),
                ], names=["region", "node", "prev", "lcp", "edge", "order_key"])
            elif out:
                first = False
            if more:
                held = (keys[-1:], ids[-1:], prev[-1], lcp_prev[-1])

    def batches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for batch in batches:
            if batch.num_rows:
                yield _fixed(batch.column(1), row), batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)

    found = written(orders.mapInArrow(run, "region binary, node long, prev long, lcp int, edge int, order_key binary"),
                    "forest")
    # two rows a partition at most: a region that runs over a partition's end joins up here
    w = Window.partitionBy("region").orderBy("order_key", "node")
    borders = (found.filter("edge > 0")
               .withColumn("before", F.lag("node").over(w))
               .filter("(edge & 1) = 1 and before is not null and prev is null")
               .select("region", "node", F.col("before").alias("prev"), F.lit(depth).alias("lcp")))
    return found.select("region", "node", "prev", "lcp").unionByName(borders)


def confirm(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(a, b, linked) for each pair, on the full shingle sets of both texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recent: OrderedDict[bytes, np.ndarray] = OrderedDict()

        def full(key: bytes, text: str) -> np.ndarray | None:
            if key not in recent:
                s = next(_shingle_sets([text], shingle))
                if not len(s) or set_key(s) != key:
                    return s[:0]
                recent[key] = s
                if len(recent) > 256:
                    recent.popitem(last=False)
            return recent[key]

        for batch in batches:
            a, b, out = batch.column(0), batch.column(1), []
            for ka, ta, kb, tb in zip(*(c.to_pylist() for c in batch.columns[2:6]), strict=True):
                x, y = full(ka, ta), full(kb, tb)
                both = len(np.intersect1d(x, y, assume_unique=True))
                out.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([a, b, pa.array(out, pa.bool_())], names=["a", "b", "linked"])
        recent.clear()
        give_back()

    left = texts.select(F.col("node").alias("a"), F.col("key").alias("ka"), F.col("text").alias("ta"))
    right = texts.select(F.col("node").alias("b"), F.col("key").alias("kb"), F.col("text").alias("tb"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "ka", "ta", "kb", "tb")
    return both.mapInArrow(run, "a long, b long, linked boolean")


def _stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) of the edges' nodes that are not the smallest themselves."""
    names, at = np.unique(np.concatenate((u, v)), return_inverse=True)
    a, b = at[:len(u)], at[len(u):]
    root = np.arange(len(names))
    while True:  # names are in order, so the smallest place is the smallest node
        least = root.copy()
        np.minimum.at(least, root[a], root[b])
        np.minimum.at(least, root[b], root[a])
        while (least[least] != least).any():
            least = least[least]
        if (least[root] == root).all():
            break
        root = least[root]
    far = np.flatnonzero(root != np.arange(len(names)))
    return names[far], names[root[far]]


def _contracted(edges: DataFrame) -> DataFrame:
    """(u, v), u > v, with the same components: each task gives the stars of its own edges, bounded stretches at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        us, vs, held = [], [], 0
        for batch in chain(batches, [None]):
            if batch is not None:
                us.append(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64))
                vs.append(batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64))
                held += batch.num_rows
            if held and (batch is None or held >= 2 * SMALL_EDGES):
                u, v = _stars(np.concatenate(us), np.concatenate(vs))
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])
                us, vs, held = [], [], 0

    return edges.mapInArrow(run, "u long, v long")


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) of every node of an undirected edge table (a, b); the component is its smallest node.

    Each task first contracts its own edges to stars.  At most SMALL_EDGES of
    them are then settled in one task, which that number bounds; more go through
    alternating star rounds, each of which hooks neighbours to the smallest one in reach,
    until nothing changes.  Both give the same components.
    """
    state = written(_contracted(edges.filter("a <> b").select(F.col("a").alias("u"), F.col("b").alias("v"))).distinct(), name)
    if state.count() <= SMALL_EDGES:
        state = written(_contracted(state.coalesce(1)), name)
        return (state.select(F.col("u").alias("node"), F.col("v").alias("component"))
                .union(state.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
    seen = None
    while True:
        both = state.union(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), name)
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large, name)
        least = written(large.groupBy("u").agg(F.min("v").alias("m")), name)
        joined = large.join(least, "u")
        small = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v")))
        state = written(small.filter("u <> v").distinct(), name)
        now = state.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == seen:
            break
        seen = now
    return (state.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(state.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))


def _overlaps(sets: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
    """(k, sizes of the intersections of set k with each later set), by bit counts over the shared shingles."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, place, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    column = np.cumsum(times > 1) - 1
    shared = times[place] > 1
    owner, place = owner[shared], column[place[shared]]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    total = np.zeros((len(sets), len(sets)), dtype=np.int32)
    for begin in range(0, int(place[-1]) + 1 if len(place) else 0, 8192):
        lo, hi = np.searchsorted(place, (begin, begin + 8192))
        dense = np.zeros((len(sets), 8192), dtype=bool)
        dense[owner[lo:hi], place[lo:hi] - begin] = True
        bits = np.packbits(dense, axis=1).view(np.uint64)
        for k in range(len(sets) - 1):
            total[k, k + 1:] += np.bitwise_count(bits[k] & bits[k + 1:]).sum(axis=1, dtype=np.int32)
    for k in range(len(sets) - 1):
        yield k, total[k, k + 1:]


def _links_across(node: list[int], label: list[int], block: list[int], sets: list[np.ndarray], two: bool,
                  percent: int) -> list[tuple[int, int]]:
    """Links that join different components of one block pair; none that only repeats a connection."""
    root, part = np.unique(np.array(label), return_inverse=True)[1], np.array(block)
    size = np.array([len(s) for s in sets], dtype=np.int64)
    out = []
    for k, both in _overlaps(sets):
        union = size[k] + size[k + 1:] - both
        fits = (100 * both.astype(np.int64) >= percent * union) & (both > 0)
        if two:
            fits &= part[k + 1:] != part[k]
        for m in (np.flatnonzero(fits) + k + 1).tolist():
            if root[m] != root[k]:
                root[root == root[m]] = root[k]
                out.append((min(node[k], node[m]), max(node[k], node[m])))
    return out


def _regions(members: DataFrame, texts: DataFrame, labels: DataFrame, done: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links (a, b) between components within a region, on the full sets of all its nodes.

    A region of more than BLOCK_NODES nodes is cut into blocks, and every pair
    of blocks is compared; what comes out joins components, so a group of n
    nodes yields fewer than n links, not all of its pairs.
    """
    placed = written(members.select("region", "node").distinct().join(labels, "node", "left")
                     .withColumn("component", F.coalesce("component", "node")), "regions")
    several = (placed.groupBy("region").agg(F.count("*").alias("size"), F.min("component").alias("lo"), F.max("component").alias("hi"),
                                            F.min("node").alias("a"), F.max("node").alias("b")).filter("lo <> hi"))
    # a region of two nodes that round one compared is settled
    settled = done.select("a", "b", F.lit(2).cast("long").alias("size"))
    several = written(several.join(settled, ["a", "b", "size"], "left_anti").select("region", "size"), "open-regions")
    blocked = (placed.join(several, "region")
               .withColumn("n_blocks", F.expr(f"cast((size + {BLOCK_NODES - 1}) div {BLOCK_NODES} as int)"))
               .withColumn("block", F.expr("cast(pmod(xxhash64(node), n_blocks) as int)"))
               .withColumn("other", F.explode(F.expr("sequence(0, n_blocks - 1)")))
               .select("node", "region", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                       "block", "component"))
    rows = (blocked.join(texts, "node").select("region", "i", "j", "block", "node", "component", "key", "text")
            .repartition("region", "i", "j").sortWithinPartitions("region", "i", "j"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, []
        recent: OrderedDict[bytes, np.ndarray] = OrderedDict()

        def full(key: bytes, text: str) -> np.ndarray:
            if key not in recent:
                s = next(_shingle_sets([text], shingle))
                if not len(s) or set_key(s) != key:
                    return s[:0]
                recent[key] = s
                if len(recent) > 64:
                    recent.popitem(last=False)
            return recent[key]

        def closed() -> pa.RecordBatch:
            links = []
            if len(held) > 1:
                block, node, label, sets = (list(c) for c in zip(*held, strict=True))
                links = _links_across(node, label, block, sets, group[1] != group[2], percent)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([a for a, _ in links], pa.int64()), pa.array([b for _, b in links], pa.int64())],
                                              names=["a", "b"])

        for batch in batches:
            for region, i, j, block, node, label, key, text in zip(*batch.columns, strict=True):
                at = (region.as_py(), i.as_py(), j.as_py())
                if at != group:
                    if held:
                        yield closed()
                    group = at
                held.append((block.as_py(), node.as_py(), label.as_py(), full(key.as_py(), text.as_py())))
        if held:
            yield closed()
        recent.clear()
        give_back()

    return rows.mapInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80,
                    id_col: str = "doc_id", text_col: str = "text", with_text_key: bool = False) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per input row; also xxhash64 of the text as ``text_key`` if asked for.

    Documents are linked when 100 * intersection >= ``percent`` * union of
    their sets of distinct ``shingle``-word windows (A-Z in lower case, words
    between ASCII white space); ``component_id`` is the smallest id reachable.

    Rows of one id with different texts are told apart.
    Null or wordless texts have the empty set, 0 shingles and link with
    nothing.  A text shorter than a shingle is one shingle.  Repeated rows
    each get their row.  A row without an id takes part in its class and gets
    the component of it, or null (and is kept) where no row of it has an id.
    Other columns of ``docs`` are ignored, whatever their names; an empty table
    gives no rows.
    """
    sigs = written(signatures(docs, shingle, id_col, text_col), "signatures")
    # a node is a class of equal sets, not an id: rows of one id may have several texts
    classes = written(sigs.filter("key is not null").groupBy("key").agg(F.min("doc_id").alias("doc_id"))
                      .withColumn("node", F.xxhash64("key")), "classes")
    nodes = written(sigs.select("doc_id", "key", "text_key", "sig").join(classes, ["doc_id", "key"])
                    .dropDuplicates(["node", "key"]), "nodes")
    signed = nodes.select("node", "sig")
    members = written(forest_neighbours(signed, percent), "members")
    candidates = (members.filter("prev is not null").groupBy(F.least("node", "prev").alias("a"), F.greatest("node", "prev").alias("b"))
                  .agg(F.max("lcp").alias("lcp")).filter("a <> b"))
    best = Window.partitionBy("n").orderBy(F.desc("lcp"), F.xxhash64("a", "b"))
    nearest = (candidates.select("a", "b", "lcp", F.explode(F.array("a", "b")).alias("n"))
               .withColumn("rank", F.row_number().over(best)).filter(f"rank <= {NEIGHBOURS}")
               .select("a", "b").distinct())
    wanted = members.select("node").distinct().join(nodes.select("node", "key", "doc_id", "text_key"), "node")
    texts = written(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
                    .withColumn("text_key", F.xxhash64("text")).join(wanted, ["doc_id", "text_key"])
                    .select("node", "text", "key"), "candidate-texts")
    first = written(confirm(nearest, texts, shingle, percent), "confirmed")
    links = first.filter("linked").select("a", "b")
    labels = components(links)
    merged = written(_regions(members, texts, labels, first, shingle, percent), "confirmed")
    if not merged.isEmpty():
        # the first round's components are stars already; only the new links are added to them
        stars = labels.select(F.col("node").alias("a"), F.col("component").alias("b"))
        labels = components(stars.union(merged))
    labelled = written(classes.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node")), "labelled")
    smallest = labelled.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    placed = labelled.join(smallest, "component").select("key", "component_id")
    out = sigs.select("doc_id", "text_key", F.col("n").alias("n_shingles"), "key").join(written(placed, "placed"), "key", "left")
    own = F.coalesce("component_id", F.when(F.col("key").isNull(), F.col("doc_id")))
    kept = F.coalesce(F.col("doc_id") == own, own.isNull()).alias("kept")
    return out.select("doc_id", "n_shingles", own.alias("component_id"), kept, *(["text_key"] if with_text_key else []))
