"""Laws of the persisted tables: moved keys, missing dates, emptied partitions, lost and repeated batches, feeds, signed sums."""

import datetime as dt

import pytest

from tidewater.operators import tables as T
from tidewater.operators.changes import apply_changes, changes_between, signed
from tidewater.plans.gold import GoldTables
from tidewater.session import scratch_dir
from tidewater.sources.landing import quarantine, read_landing_json
from tidewater.sources.schemas import TRANSACTION_EVENT, USER_EVENT

SCHEMA = "k string, v int, day date"
D1, D2, D3 = (dt.date(2024, 1, d) for d in (1, 2, 3))


def put(spark, path, n, *rows, **options):
    T.upsert_partitions(spark.createDataFrame(rows, SCHEMA), path, "k", "day", n, **options)


def state(spark, path):
    table = T.read_table(spark, path)
    return sorted(((r.k, r.v, r.day) for r in table.collect()), key=str) if table is not None else []


def folders(spark, path):
    return sorted(c for c in T._children(spark, path) if c.startswith("day="))


def test_a_moved_key_leaves_its_old_partition(spark):
    t = scratch_dir(spark, "t_table") + "/t"
    put(spark, t, 0, ("a", 1, D1), ("b", 1, D1), ("c", 1, D2))
    put(spark, t, 1, ("a", 2, D3), ("c", 2, D2))
    assert state(spark, t) == [("a", 2, D3), ("b", 1, D1), ("c", 2, D2)]
    put(spark, t, 2, ("b", 3, D2))
    assert state(spark, t) == [("a", 2, D3), ("b", 3, D2), ("c", 2, D2)]
    assert folders(spark, t) == ["day=2024-01-02", "day=2024-01-03"]  # the first was emptied


def test_rows_without_a_date_stay(spark):
    t = scratch_dir(spark, "t_table") + "/t"
    put(spark, t, 0, ("a", 1, None))
    put(spark, t, 1, ("c", 1, None), ("b", 1, D1))
    put(spark, t, 2, ("a", 5, D1))
    assert state(spark, t) == [("a", 5, D1), ("b", 1, D1), ("c", 1, None)]
    put(spark, t, 3, ("c", 6, D1))
    assert folders(spark, t) == ["day=2024-01-01"]


def test_only_touched_partitions_are_rewritten(spark):
    t = scratch_dir(spark, "t_table") + "/t"
    put(spark, t, 0, ("a", 1, D1), ("b", 1, D2))
    files = T._children(spark, f"{t}/day=2024-01-01")
    put(spark, t, 1, ("b", 2, D2), ("c", 2, D3))
    put(spark, t, 1, ("b", 2, D2), ("c", 2, D3))
    assert state(spark, t) == [("a", 1, D1), ("b", 2, D2), ("c", 2, D3)]
    assert T._children(spark, f"{t}/day=2024-01-01") == files


@pytest.mark.parametrize("lost", ["staging", "overwriting", "publishing"])
def test_a_lost_batch_is_repeated_without_loss(spark, monkeypatch, lost):
    """The driver dies after the batch was staged in part, before the overwrite, or half way through it."""
    t = scratch_dir(spark, "t_table") + "/t"
    feed = t + "-feed"
    put(spark, t, 0, ("a", 1, D1), ("b", 1, D1), feed=feed)
    name = {"staging": "write_note", "overwriting": "read_note", "publishing": "_publish"}[lost]
    real = getattr(T, name)

    def dies(*args):
        if lost == "publishing":
            T._remove(spark, f"{t}/day=2024-01-02")  # an overwrite that did not end
        raise RuntimeError("lost")

    monkeypatch.setattr(T, name, dies)
    with pytest.raises(RuntimeError):
        put(spark, t, 1, ("a", 2, D2), ("c", 2, D1), feed=feed)
    monkeypatch.setattr(T, name, real)
    put(spark, t, 1, ("a", 2, D2), ("c", 2, D1), feed=feed)
    assert state(spark, t) == [("a", 2, D2), ("b", 1, D1), ("c", 2, D1)]
    got = spark.read.parquet(f"{feed}/batch=1").collect()
    assert sorted((r.change, r.after.k) for r in got) == [("insert", "c"), ("update", "a")]


def test_a_feed_holds_what_differs_and_rebuilds_the_state(spark):
    t = scratch_dir(spark, "t_table") + "/t"
    feed = t + "-feed"
    put(spark, t, 0, ("a", 1, D1), ("b", 1, D1), ("n", None, None), feed=feed)
    old = spark.createDataFrame(state(spark, t), SCHEMA)
    put(spark, t, 1, ("a", 1, D1), ("b", 2, D3), ("c", 3, D2), ("n", None, None), feed=feed)  # a and n come again as they were
    rows = spark.read.parquet(f"{feed}/batch=1")
    assert sorted((r.change, r.before and r.before.v, r.after.v) for r in rows.collect()) == [("insert", None, 3), ("update", 1, 2)]
    assert sorted(map(tuple, apply_changes(old, rows.select("change", "before", "after"), "k").collect())) == state(spark, t)
    assert sorted((r.sign, r.k, r.v) for r in signed(rows).collect()) == [(-1, "b", 1), (1, "b", 2), (1, "c", 3)]
    put(spark, t, 2, ("a", 1, D1), feed=feed)
    assert spark.read.parquet(f"{feed}/batch=2").count() == 0


def test_changes_between_two_states(spark):
    before = spark.createDataFrame([("a", 1, D1), (None, 1, D1), ("gone", 1, D1), ("stamp", 1, D1)], SCHEMA)
    after = spark.createDataFrame([("a", None, D1), (None, 1, D1), ("new", 1, D1), ("stamp", 1, D2)], SCHEMA)
    got = changes_between(before, after, "k", ignore=("day",))
    assert sorted((r.change, (r.after or r.before).k) for r in got.collect()) == [("delete", "gone"), ("insert", "new"), ("update", "a")]
    assert sorted(map(str, apply_changes(before, changes_between(before, after, "k"), "k").collect())) == sorted(map(str, after.collect()))


SUMS = "k string, n_rows bigint, v bigint, day date"


def test_signed_sums_come_and_go(spark):
    t = scratch_dir(spark, "t_sums") + "/t"

    def add(n, *rows):
        T.merge_sums(spark.createDataFrame(rows, SUMS), t, "k", "day", n)
        table = T.read_table(spark, t)
        return sorted((r.k or "", r.n_rows, r.v) for r in table.collect()) if table is not None else []

    assert add(0, ("a", 2, 10, D1), (None, 1, 5, D1)) == [("", 1, 5), ("a", 2, 10)]
    assert add(1, ("a", -1, -4, D1), ("b", 1, 4, D2), ("same", 0, 0, D3)) == [("", 1, 5), ("a", 1, 6), ("b", 1, 4)]
    assert add(1, ("a", -1, -4, D1), ("b", 1, 4, D2), ("same", 0, 0, D3)) == [("", 1, 5), ("a", 1, 6), ("b", 1, 4)]
    assert add(2, ("a", -1, -6, D1), (None, -1, -5, D1)) == [("b", 1, 4)]
    assert folders(spark, t) == ["day=2024-01-02"]


def test_keys_are_replaced(spark):
    t = scratch_dir(spark, "t_keys") + "/t"

    def replace(n, keys, *rows):
        named = spark.createDataFrame([(k,) for k in keys], "k string")
        T.replace_keys(spark.createDataFrame(rows, SCHEMA), named, t, "k", "day", n)
        return state(spark, t)

    assert replace(0, ["a", "b"], ("a", 1, D1), ("a", 2, D1), ("b", 1, D2)) == [("a", 1, D1), ("a", 2, D1), ("b", 1, D2)]
    assert replace(1, ["a", "x"], ("a", 3, D2)) == [("a", 3, D2), ("b", 1, D2)]
    assert replace(2, ["a", "b"]) == []


def tx(i, status, day, total=10):
    ts = dt.datetime(2024, 1, day)
    return (f"t{i}", "u1", "purchase", ts, status, "paypal", "USD", "None", total, 0, total, "C", "S", "US", "C", "US", dt.datetime(2024, 2, 1) )


TX = ("transaction_id string, user_id string, transaction_type string, timestamp timestamp_ntz, status string, payment_method string, "
      "currency string, original_transaction_id string, subtotal int, tax int, total int, bill_city string, bill_state string, "
      "bill_country string, ship_city string, ship_country string, processed_at timestamp_ntz")


def test_daily_revenue_follows_status_and_date(spark):
    gold = GoldTables(spark, scratch_dir(spark, "t_gold"), ("daily_revenue",))

    def apply(n, *rows):
        gold.apply(n, transactions=spark.createDataFrame(rows, TX).selectExpr(
            "* except (subtotal, tax, total)", *[f"cast({c} as decimal(18,2)) {c}" for c in ("subtotal", "tax", "total")]))
        table = gold.read("daily_revenue")
        return {} if table is None else {str(r.sales_date): r.revenue if r.revenue is None else int(r.revenue) for r in table.collect()}

    assert apply(0, tx(1, "completed", 1), tx(2, "completed", 2)) == {"2024-01-01": 10, "2024-01-02": 10}
    assert apply(1, tx(1, "failed", 1)) == {"2024-01-02": 10}
    assert apply(2, tx(2, "completed", 3)) == {"2024-01-03": 10}
    assert apply(2, tx(2, "completed", 3)) == {"2024-01-03": 10}
    assert apply(3, tx(2, "completed", 3, None)) == {"2024-01-03": None}
    assert apply(4, tx(2, "failed", 3)) == {}


DRIFT = ['{"transaction_id": "1", "total": 12.50, "line_items": [{"quantity": "2"}]}', '{"transaction_id": "2", "line_items": [{"quantity": 2.0}]}',
         '{"transaction_id": "3", "total": "n/a"}', '{"transaction_id": "4"', "[1]", "", "7"]


def test_good_and_quarantined_are_all_lines_for_any_selection(spark):
    path = scratch_dir(spark, "t_drift") + "/x"
    spark.createDataFrame([(x,) for x in DRIFT], "value string").write.text(path)
    good = read_landing_json(spark, path, TRANSACTION_EVENT)
    for columns in (["transaction_id"], ["total"], good.columns):
        assert len(good.select(*columns).collect()) == 3
    assert good.count() == 3 and quarantine(spark, path).count() == 3
    got = {r.transaction_id: (r.total, r.line_items and r.line_items[0].quantity) for r in good.collect()}
    assert str(got["1"][0]) == "12.50" and got["1"][1] == got["2"][1] == 2 and got["3"] == (None, None)


def test_strict_fails_on_a_pruned_read(spark):
    path = scratch_dir(spark, "t_strict") + "/x"
    spark.createDataFrame([('{"event_id": "a", "quantity": "x"}',)], "value string").write.text(path)
    for read in (lambda df: df.select("event_id").collect(), lambda df: df.count()):
        with pytest.raises(Exception, match="malformed record"):
            read(read_landing_json(spark, path, USER_EVENT, strict=True))


def test_the_merge_tells_its_changes_and_one_feed_batch_names_each_key_once(spark):
    from pyspark.sql import functions as F

    from tidewater.operators.changes import newest
    from tidewater.operators.upsert import BEFORE, CHANGE, merge_upsert
    old = spark.createDataFrame([("a", 1, "x"), ("b", 2, "x"), (None, 3, "x"), ("d", None, "x")], "k string, v int, stamp string")
    new = spark.createDataFrame([("a", 1, "y"), ("b", 5, "y"), (None, 4, "y"), ("e", 6, "y"), ("d", None, "y")], "k string, v int, stamp string")
    got = merge_upsert(old, new, "k", track=("stamp",))
    assert {(r.k, r.v, r[CHANGE], r[BEFORE] and r[BEFORE].v) for r in got.collect()} == {
        ("a", 1, None, None), ("b", 5, "update", 2), (None, 4, "update", 3), ("e", 6, "insert", None), ("d", None, None, None)}
    feed = got.filter(F.col(CHANGE).isNotNull()).select(F.col(CHANGE).alias("change"), F.col(BEFORE).alias("before"), F.struct("k", "v").alias("after"))
    rows = newest(feed, "k")
    assert "Exchange" not in rows.select("v")._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in rows._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r.v for r in rows.collect()) == [4, 5, 6]


def test_a_batch_finds_keys_in_other_partitions_and_in_that_of_nulls(spark):
    path = scratch_dir(spark, "t_others") + "/table"
    kind = "k string, v int, m int"
    T.upsert_partitions(spark.createDataFrame([("a", 1, 1), ("b", 1, 2), ("c", 1, None), ("d", 1, 3)], kind), path, "k", "m", 0)
    T.upsert_partitions(spark.createDataFrame([("b", 2, 1), ("c", 2, 1), ("e", 2, 1)], kind), path, "k", "m", 1)
    assert {tuple(r) for r in T.read_table(spark, path).select("k", "v", "m").collect()} == {("a", 1, 1), ("b", 2, 1), ("c", 2, 1), ("e", 2, 1), ("d", 1, 3)}
    T.upsert_partitions(spark.createDataFrame([("a", 3, None)], kind), path, "k", "m", 2)
    assert {tuple(r) for r in T.read_table(spark, path).select("k", "v", "m").collect()} == {("a", 3, None), ("b", 2, 1), ("c", 2, 1), ("e", 2, 1), ("d", 1, 3)}


def test_new_keys_are_added_and_only_partitions_that_hold_a_key_are_written_anew(spark, monkeypatch):
    t = scratch_dir(spark, "t_added") + "/t"
    feed, merges, real = t + "-feed", [], T.merge_upsert

    def merging(base, *args, **options):
        merges.append([r.k for r in base.collect()])
        return real(base, *args, **options)

    def files(day):
        return {f for c in T._children(spark, f"{t}/day={day}") for f in T._children(spark, f"{t}/day={day}/{c}")}

    monkeypatch.setattr(T, "merge_upsert", merging)
    put(spark, t, 0, ("a", 1, D1), ("b", 1, D2), feed=feed)
    first = files(D1)
    put(spark, t, 1, ("c", 1, D1), (None, 1, D1), feed=feed)
    assert merges == [] and first < files(D1)
    put(spark, t, 1, ("c", 1, D1), (None, 1, D1), feed=feed)  # is published, so it was applied
    put(spark, t, 2, ("b", 2, D1), feed=feed)
    assert merges == [["b"]] and first < files(D1) and folders(spark, t) == ["day=2024-01-01"]
    assert state(spark, t) == sorted([("a", 1, D1), ("b", 2, D1), ("c", 1, D1), (None, 1, D1)], key=str)
    put(spark, t, 3, (None, 2, D1), ("d", 1, D3), feed=feed)
    assert len(merges) == 2 and len(merges[1]) == 4
    assert state(spark, t) == sorted([("a", 1, D1), ("b", 2, D1), ("c", 1, D1), (None, 2, D1), ("d", 1, D3)], key=str)
    got = spark.read.parquet(feed).collect()
    assert sorted((r.batch, r.change, r.before and r.before.v, r.after.k or "", r.after.v) for r in got) == [
        (0, "insert", None, "a", 1), (0, "insert", None, "b", 1), (1, "insert", None, "", 1), (1, "insert", None, "c", 1),
        (2, "update", 1, "b", 2), (3, "insert", None, "d", 1), (3, "update", 1, "", 2)]


def test_a_partition_of_many_batches_is_written_anew(spark, monkeypatch):
    monkeypatch.setattr(T, "_MOST_ADDED", 2)
    t = scratch_dir(spark, "t_crowded") + "/t"
    for n in range(4):
        put(spark, t, n, (f"k{n}", n, D1))
    assert T._children(spark, f"{t}/day=2024-01-01") == ["tw_batch=3"]
    assert state(spark, t) == [(f"k{n}", n, D1) for n in range(4)]


def test_batches_of_inserts_are_not_grouped(spark):
    from pyspark.sql import functions as F

    from tidewater.operators.changes import newest
    kind = "change string, before struct<k string, v int>, after struct<k string, v int>, batch int"
    rows = [("insert", None, ("a", 1), 0), ("insert", None, (None, 2), 1)]
    later = [*rows, ("update", ("a", 1), ("a", 3), 1)]
    for feed, grouped in ((rows, False), (later, True), ([r for r in later if r[3] == 1], False)):
        got = newest(spark.createDataFrame(feed, kind), "k")
        assert ("Aggregate" in got._jdf.queryExecution().optimizedPlan().toString()) == grouped
        assert got.select(F.max("v")).first()[0] == max(r[2][1] for r in feed)
    assert sorted(r.v for r in newest(spark.createDataFrame(later, kind), "k").collect()) == [2, 3]


@pytest.mark.parametrize("with_feed", [False, True])
def test_what_is_staged_goes_when_it_is_in_the_table(spark, with_feed):
    """No row of an applied batch stays staged, and the batch may still be repeated."""
    t = scratch_dir(spark, "t_staged") + "/t"
    options = {"feed": t + "-feed"} if with_feed else {}
    for _ in range(2):
        put(spark, t, 0, ("a", 1, D1), ("b", 1, D2), **options)
    for _ in range(2):
        put(spark, t, 1, ("a", 2, D1), ("c", 2, D3), **options)
        assert state(spark, t) == [("a", 2, D1), ("b", 1, D2), ("c", 2, D3)]
        assert sorted(T._children(spark, f"{t}-staged/batch={1:012d}")) == ["applied", "touched"]
    if with_feed:
        assert spark.read.parquet(t + "-feed").count() == 4
    named = spark.createDataFrame([("a",)], "k string")
    for _ in range(2):
        T.replace_keys(spark.createDataFrame([("a", 7, D2)], SCHEMA), named, t + "k", "k", "day", 0)
        assert state(spark, t + "k") == [("a", 7, D2)]
        assert sorted(T._children(spark, f"{t}k-staged/batch={0:012d}")) == ["applied", "touched"]
