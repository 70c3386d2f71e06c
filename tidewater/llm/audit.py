"""Audit of how ordered filters interact, counted by an incremental stream with retractions.

The files of the documents pass as available-now micro-batches.  A document's
own filters give a mask; whether it repeats a smaller id's text is known only
once all files are seen.  So each distinct text has keyed state: the smallest
id so far and what its rows count.  (The state store's rows are groups of some
256 texts by hash, as a call of the state function for each text costs a
hundred times what it does.)  When a smaller id arrives, the counts of
the former holder are retracted from the part counters and counted again with
the repeat filter's bit.  A micro-batch's changes are one folder, overwritten
when the batch is replayed; the counters are their sum.

Texts never leave the task that reads them: state and shuffle hold a hash, and
each task sends a text once per kind of row, however often it occurs there.
"""

from __future__ import annotations

import hashlib
import itertools
import pickle
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidewater.llm.common import broadcast_up_to, map_arrow, small_batches
from tidewater.session import read_note, scratch_dir, write_note

FILTERS = "ABCDE"
MIN_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 50, 65, 5
REPEATED = 1 << FILTERS.index("E")
MICRO_BATCHES = 4
HELD_TEXTS = 200_000
TEXTS_PER_STATE = 256
BROADCAST_LABELS = 2_000_000
_CAPITALS = re.compile(rb"[A-Z]+")
_SYMBOL = re.compile(rb"[#$%&*|]")
_CONTINUATION = bytes(range(0x80, 0xC0))
_MASKED = "text_key binary, mask int, doc_id long, part string"
_CANDIDATE = "texts long, text_key binary, mask int, has_id boolean, least_id long, part string, good boolean, toxic boolean, at_least long, above long"
_CHANGE = "part string, mask int, good boolean, toxic boolean, n long"
_STATE = "held binary"


def own_mask(text: bytes) -> int:
    """Bits 0 to 3: filters A to D of a text."""
    words = text.split()
    capitals = sum(map(len, _CAPITALS.findall(text)))
    points = len(text.translate(None, _CONTINUATION))
    failed = (len(words) < MIN_WORDS, 100 * len(set(words)) < DISTINCT_PERCENT * len(words), 100 * capitals > CAPITAL_PERCENT * points,
              _SYMBOL.search(text) is not None)
    return sum(bad << i for i, bad in enumerate(failed))


def _masked(docs: DataFrame) -> DataFrame:
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys, masks = [], []
        for text in batch.column(1):
            text = text.as_py() or b""
            keys.append(hashlib.sha256(text).digest())
            masks.append(own_mask(text))
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(masks, pa.int32()), batch.column(0), batch.column(2)],
                                          names=["text_key", "mask", "doc_id", "part"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"),
                       F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"))
    return map_arrow(rows, run, _MASKED)


def _combined(rows: DataFrame, groups: int) -> DataFrame:
    """A task's rows, once per text, part and labels: the rows of its smallest id there, and those above it.

    ``texts`` is the group of the text's hash, one of ``groups``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}

        def flush() -> pa.RecordBatch:
            out = []
            for (key, named), (mask, least, at, above) in held.items():
                out += [(int.from_bytes(key[:7], "big") % groups, key, mask, named, least, *kind, at[kind], above[kind]) for kind in at.keys() | above.keys()]
            held.clear()
            kinds = [pa.int64(), pa.binary(), pa.int32(), pa.bool_(), pa.int64(), pa.string(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64()]
            names = [c.strip().split(" ")[0] for c in _CANDIDATE.split(",")]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

        for batch in batches:
            for key, mask, doc_id, part, good, toxic in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                named, kind = doc_id is not None, (part, good, toxic)
                now = held.get((key, named))
                if now is None:
                    held[key, named] = [mask, doc_id or 0, Counter({kind: 1}), Counter()]
                elif not named or doc_id == now[1]:
                    now[2][kind] += 1
                elif doc_id > now[1]:
                    now[3][kind] += 1
                else:
                    now[3].update(now[2])
                    now[1], now[2] = doc_id, Counter({kind: 1})
            if len(held) >= HELD_TEXTS:
                yield flush()
        if held:
            yield flush()

    return small_batches(rows).select("text_key", "mask", "doc_id", "part", "good", "toxic").mapInArrow(run, _CANDIDATE)


def fold(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """A micro-batch's candidates of one group of texts: changes of the part counters, and the texts' state after them."""
    texts: dict[bytes, list[tuple]] = defaultdict(list)
    for frame in frames:
        for text, *row in zip(*(frame[c].tolist() for c in frame.columns[1:]), strict=True):
            texts[text].append(row)
    held: dict[bytes, tuple[int, dict]] = pickle.loads(state.get[0]) if state.exists else {}
    change: Counter = Counter()
    for text, rows in texts.items():
        now = fold_text(rows, held.get(text), change)
        if now is not None:
            held[text] = now
    state.update((pickle.dumps(held, protocol=5),))
    out = [(*kind, m, n) for (kind, m), n in change.items() if n]
    if out:
        part, good, toxic, masks, n = zip(*out, strict=True)
        yield pd.DataFrame({"part": part, "mask": masks, "good": good, "toxic": toxic, "n": n})


def fold_text(rows: list, before: tuple[int, dict] | None, change: Counter) -> tuple[int, dict] | None:
    """One text's candidates on its (smallest id, rows of it by kind); adds to ``change``, returns the new state."""
    mask = rows[0][0]
    ids = [r[2] for r in rows if r[1]]
    if before is not None:
        ids.append(before[0])
    least = min(ids, default=None)
    counts: Counter = Counter()
    if before is not None and before[0] == least:
        counts.update(before[1])
    elif before is not None:
        for kind, n in before[1].items():  # no longer the smallest: retracted, and counted as a repeat
            change[kind, mask] -= n
            change[kind, mask | REPEATED] += n
    for _, named, own, part, good, toxic, at_least, above in rows:
        kind = (part, good, toxic)
        first = not named or own == least
        change[kind, mask if first else mask | REPEATED] += at_least
        change[kind, mask | REPEATED] += above
        if named and first:
            counts[kind] += at_least
    return None if least is None else (least, dict(counts))


def counters(spark: SparkSession, path: str, labels: DataFrame, micro_batches: int = MICRO_BATCHES, folder: str | None = None) -> DataFrame:
    """(part, mask, good, toxic, n): rows of the documents under ``path`` by the filters they fail, filter i as bit i.

    ``path`` is a Parquet table with doc_id, text and source; its files pass in
    about ``micro_batches`` micro-batches of equal numbers of files.  With the
    same ``folder`` a stopped run goes on where it was, and files that came
    since are counted on top.  ``labels`` (doc_id, quality, toxic) mark good and
    toxic documents; of repeated labels any counts.

    A null text is empty.  Texts are the same when their bytes are (by
    SHA-256).  Rows of the smallest id of a text never repeat it, however many
    they are; a row without id is never smaller or larger than another.  A null
    source is the part ''.  The state is kept by the session's state store;
    for large tables that should be the one on disk.  An empty table gives no rows; other columns are not read.
    """
    path = path.rstrip("/")
    table = spark.read.parquet(path)
    folder = folder or scratch_dir(spark, "audit")
    changes = f"{folder}/changes"
    groups = read_note(spark, f"{folder}/groups")
    if groups is None:  # of a hash's bits, so the same for as long as the state lives
        groups = max(1, table.count() // TEXTS_PER_STATE)
        write_note(spark, f"{folder}/groups", groups)
    per_batch = max(1, -(-len(table.inputFiles()) // micro_batches))
    marks = (labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic")))
    docs = (spark.readStream.schema(table.select("doc_id", "text", "source").schema)
            .option("maxFilesPerTrigger", per_batch).parquet(f"{path[:-1]}[{path[-1]}]"))  # a pattern, so that one file will do
    marked = _masked(docs).join(broadcast_up_to(marks, BROADCAST_LABELS), "doc_id", "left").select(
        "text_key", "mask", "doc_id", "part", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))
    folded = _combined(marked, groups).groupBy("texts").applyInPandasWithState(fold, _CHANGE, _STATE, "update", GroupStateTimeout.NoTimeout)

    def store(batch: DataFrame, number: int) -> None:
        total = batch.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))
        total.write.mode("overwrite").parquet(f"{changes}/batch={number}")

    query = (folded.writeStream.outputMode("update").option("checkpointLocation", f"{folder}/checkpoint")
             .trigger(availableNow=True).foreachBatch(store).start())
    query.awaitTermination()
    root = spark._jvm.org.apache.hadoop.fs.Path(changes)
    root.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(root)
    read = spark.read.schema(_CHANGE).parquet(changes)
    return read.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n")).filter("n <> 0")


def steps(filters: str = FILTERS) -> list[tuple]:
    """(mask, filter_order, step, filter's bit, kept, removed, redundant, only, shapley) of every mask in every order of the filters."""
    orders = list(itertools.permutations(range(len(filters))))
    out = []
    for mask in range(1 << len(filters)):
        first = [next((f for f in order if mask >> f & 1), None) for order in orders]
        removals = Counter(first)
        for order, gone in zip(orders, first, strict=True):
            at = order.index(gone) if gone is not None else len(filters)
            for k, f in enumerate(order):
                fails = bool(mask >> f & 1)
                out.append((mask, "".join(filters[i] for i in order), k + 1, at > k, at == k, fails and at < k, mask == 1 << f, removals[f]))
    return out


def interactions(counts: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from the counters of the masks.

    kept after the step, removed by it, redundant (fails its filter, removed
    before), unique_fails (fails no other filter), good_lost and toxic_lost
    (removed here), shapley (removals by its filter summed over all orders).
    Zeros are included: every part has a mask, and every mask meets every step.
    """
    spark = counts.sparkSession
    table = spark.createDataFrame(steps(), "mask int, filter_order string, step int, is_kept boolean, is_removed boolean, is_redundant boolean, "
                                           "is_only boolean, orders int")
    parts = counts.groupBy("part", "mask").agg(F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("good"), F.col("n"))), F.lit(0)).alias("n_good"),
                                               F.coalesce(F.sum(F.when(F.col("toxic"), F.col("n"))), F.lit(0)).alias("n_toxic"))

    def count(flag: str, n: str = "n"):
        return F.sum(F.when(F.col(flag), F.col(n)).otherwise(0)).cast("long")

    return (parts.join(F.broadcast(table), "mask").groupBy("part", "filter_order", "step")
            .agg(count("is_kept").alias("kept"), count("is_removed").alias("removed"), count("is_redundant").alias("redundant"),
                 count("is_only").alias("unique_fails"), count("is_removed", "n_good").alias("good_lost"),
                 count("is_removed", "n_toxic").alias("toxic_lost"), F.sum(F.col("n") * F.col("orders")).cast("long").alias("shapley")))
