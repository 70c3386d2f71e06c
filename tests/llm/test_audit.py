import itertools
import random
import re
from collections import Counter

from tests.llm import odd
from tidewater.llm import audit

RNG = random.Random(11)
TEXTS = ["", None, "short # text", "Plain words only " * 30, " ".join(f"w{i}" for i in range(80)), " ".join(f"W{i}" for i in range(80)),
         " ".join(f"é{i}\x1c&" for i in range(60)), "UPPER CASE " * 40 + "$", "a\x0bb\x0cc " * 30, "x　y z " * 30]
ROWS = [(i, RNG.choice(TEXTS), "en", RNG.choice(["a", "b", None, ""])) for i in range(400, 0, -1)]
ROWS += [(7, TEXTS[3], "en", "a"), (7, TEXTS[3], "en", "b"), (1, TEXTS[4], "en", "a"), (None, TEXTS[4], "en", "a"), (None, "alone", "en", "c"), (500, "alone", "en", "c")]
LABELS = [(i, RNG.randrange(2), RNG.randrange(2)) for i in range(0, 400, 3)] + [(7, 0, 0), (7, 1, 1), (None, 1, 1), (9, None, 1)]


def fails(rows):
    """(part, doc_id, failing filters) of every row, by the definitions."""
    least = {}
    for d, t, *_ in rows:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    for d, t, _, source in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        bad = [len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
               bool(re.search(r"[#$%&*|]", t)), d is not None and d > least[t]]
        yield source or "", d, {f for f, b in zip("ABCDE", bad, strict=True) if b}


def brute(rows, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, x in labels if x == 1 and d is not None}
    out, shares = {}, Counter()
    for part, d, bad in fails(rows):
        for order in map("".join, itertools.permutations("ABCDE")):
            gone = next((f for f in order if f in bad), None)
            shares[part, gone] += 1
            for k, f in enumerate(order, 1):
                row = out.setdefault((part, order, k), [0] * 6)
                past = gone is not None and order.index(gone) + 1 < k
                row[0] += not past and gone != f
                row[1] += gone == f
                row[2] += past and f in bad
                row[3] += bad == {f}
                row[4] += gone == f and d in good
                row[5] += gone == f and d in toxic
    return {(p, o, k): (*v, shares[p, o[k - 1]]) for (p, o, k), v in out.items()}


def got(frame):
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in frame.collect()}


def save(spark, rows, path, files, mode="errorifexists"):
    """Files in the order of the rows, so that smaller ids come in later micro-batches."""
    step = -(-len(rows) // files)
    for k in range(files):
        odd.documents(spark, rows[k * step:(k + 1) * step]).coalesce(1).write.mode("append" if k else mode).parquet(path)
    return path


def labels(spark):
    return spark.createDataFrame([(*r, "x") for r in LABELS], "doc_id long, quality int, toxic int, part string")


def test_stream_equals_brute_force_and_retracts(spark, tmp_path):
    path = save(spark, ROWS, str(tmp_path / "documents.parquet"), 6)
    counts = audit.counters(spark, path, labels(spark), micro_batches=3, folder=str(tmp_path / "run"))
    assert got(audit.interactions(counts)) == brute(ROWS, LABELS)
    changes = spark.read.parquet(str(tmp_path / "run/changes")).collect()
    assert len({r.batch for r in changes}) == 3 and any(r.n < 0 for r in changes)


def test_stream_goes_on_with_files_that_come_later(spark, tmp_path):
    path, folder = str(tmp_path / "documents.parquet"), str(tmp_path / "run")
    save(spark, ROWS[:250], path, 2)
    first = audit.counters(spark, path, labels(spark), folder=folder)
    assert got(audit.interactions(first)) == brute(ROWS[:250], LABELS)
    save(spark, ROWS[250:], path, 2, mode="append")
    again = audit.counters(spark, path, labels(spark), folder=folder)
    assert got(audit.interactions(again)) == brute(ROWS, LABELS)
    assert got(audit.interactions(audit.counters(spark, path, labels(spark), folder=folder))) == brute(ROWS, LABELS)


def test_odd_rows_and_empty_tables(spark, tmp_path):
    path = save(spark, odd.DOCS, str(tmp_path / "odd.parquet"), 1)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert got(audit.interactions(audit.counters(spark, path, none))) == brute(odd.DOCS, [])
    empty = save(spark, [], str(tmp_path / "empty.parquet"), 1)
    assert audit.interactions(audit.counters(spark, empty, labels(spark))).count() == 0
