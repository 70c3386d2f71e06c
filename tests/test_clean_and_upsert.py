import datetime as dt
import glob
import os
import time

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidewater.operators import clean
from tidewater.operators.latest import keep_latest
from tidewater.operators.upsert import merge_upsert
from tidewater.plans import facts, layers


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_keep_latest_total_order(spark):
    ts = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("a", ts, "x"), ("a", ts, "b"), ("b", ts, None)],
                               "k string, processed_at timestamp_ntz, v string")
    out = keep_latest(df, "k", "processed_at")
    assert rows(out, "k", "v") == [("a", "b"), ("b", None)]
    # survivor does not depend on partitioning
    out2 = keep_latest(df.repartition(3), "k", "processed_at")
    assert rows(out2, "k", "v") == rows(out, "k", "v")


def test_standardize_transactions_contract(spark):
    schema = ("transaction_id string, user_id string, transaction_type string, status string, "
              "payment_method string, line_items array<string>, timestamp string")
    df = spark.createDataFrame([
        ("t1", "u", "purchase", "completed", None, ["i"], "2024-01-02T03:04:05Z"),
        ("t1", "u", "purchase", "completed", "paypal", ["i"], "2024-01-02T03:04:05Z"),
        ("t1", "u", "purchase", "pending", None, ["i"], "2024-01-01T03:04:05Z"),
        ("t2", None, "purchase", "completed", "paypal", ["i"], "2024-01-02T03:04:05Z"),
        ("t3", "u", "refund", "completed", "paypal", None, "2024-01-02T03:04:05Z"),
        ("t4", "u", "refund", "completed", "paypal", ["i"], "bad"),
    ], schema)
    out = clean.standardize_transactions(df)
    got = rows(out, "transaction_id", "payment_method", "event_date")
    assert got == [("t1", "USD", dt.date(2024, 1, 2)), ("t4", "paypal", None)]


def test_coalesce_defaults_and_dynamic_columns(spark):
    df = spark.createDataFrame([("a", None, None)], "id string, product_id string, quantity int")
    out = clean.coalesce_defaults(df, {"product_id": "None", "quantity": 0})
    assert out.collect()[0].asDict() == {"id": "a", "product_id": "None", "quantity": 0}
    d = clean.dynamic_columns(out, {"add": {"q2": "quantity + 1"}, "rename": {"id": "key"},
                                    "drop": ["product_id"], "cast": {"quantity": "string"}})
    assert d.columns == ["key", "quantity", "q2"] and d.collect()[0].quantity == "0"


SCHEMA = "k string, cat string, v int"


def test_merge_same_batch_twice_is_no_change(spark):
    target = spark.createDataFrame([("a", "x", 1), ("b", "y", 2)], SCHEMA)
    batch = spark.createDataFrame([("b", "y", 20), ("c", "z", 3)], SCHEMA)
    once = merge_upsert(target, batch, "k")
    twice = merge_upsert(once, batch, "k")
    assert rows(once, "k", "cat", "v") == rows(twice, "k", "cat", "v") == [
        ("a", "x", 1), ("b", "y", 20), ("c", "z", 3)]


def test_merge_a_then_b_equals_latest_of_union(spark):
    target = spark.createDataFrame([("a", "x", 1)], SCHEMA)
    a = spark.createDataFrame([("a", "x", 5), ("b", "y", 6)], SCHEMA)
    b = spark.createDataFrame([("b", "y", 7), ("c", "z", 8)], SCHEMA)
    seq = merge_upsert(merge_upsert(target, a, "k"), b, "k")
    u = a.withColumn("o", F.lit(1)).unionByName(b.withColumn("o", F.lit(2)))
    latest = keep_latest(u, "k", "o").drop("o")
    assert rows(seq, "k", "cat", "v") == rows(merge_upsert(target, latest, "k"), "k", "cat", "v")


def test_merge_null_keys(spark):
    target = spark.createDataFrame([("d", None, 1)], SCHEMA)
    batch = spark.createDataFrame([("d", None, 2)], SCHEMA)
    safe = merge_upsert(target, batch, ["k", "cat"])
    plain = merge_upsert(target, batch, ["k", "cat"], null_safe=False)
    assert rows(safe, "k", "v") == [("d", 2)]
    assert rows(plain, "k", "v") == [("d", 1), ("d", 2)]


def test_merge_update_and_insert_column_lists(spark):
    target = spark.createDataFrame([("a", "x", 1)], SCHEMA)
    batch = spark.createDataFrame([("a", "NEW", 9), ("b", "y", 2)], SCHEMA)
    out = merge_upsert(target, batch, "k", update_cols=["v"], insert_cols=["k", "v"],
                       insert_defaults={"cat": "none"})
    assert rows(out, "k", "cat", "v") == [("a", "x", 9), ("b", "none", 2)]


@pytest.mark.parametrize("flip", [False, True])
def test_rows_that_differ_in_one_column_alone_have_a_fixed_survivor(spark, flip):
    """Equal key, times, status and total: the order goes on over all other columns."""
    ts = dt.datetime(2024, 1, 1)
    a = {c: "x" for c in facts.FACT_TRANSACTION_COLS} | {"bill_country": "x", "bill_city": "x", "bill_state": "x", "timestamp": ts, "processed_at": ts,
                                                         "total": 5, "subtotal": 4}
    both = [a | {"tax": 1}, a | {"tax": 2}]
    df = spark.createDataFrame(both[::-1] if flip else both).coalesce(1)
    got = facts.fact_transactions(df).collect()
    assert len(got) == 1
    survivor = got[0].tax
    assert facts.fact_transactions(spark.createDataFrame(both[::-1]).repartition(3)).first().tax == survivor
    items = [{"transaction_id": "t", "line_item_index": 0, "processed_at": ts, "timestamp": ts, "product_id": "p", "quantity": 1, "brand": b,
              **{c: "x" for c in ("user_id", "product_name", "category", "unit_price", "item_subtotal", "currency")}} for b in ("b1", "b2")]
    first, second = (facts.transaction_items(spark.createDataFrame(rows).coalesce(1)).first().brand for rows in (items, items[::-1]))
    assert first == second


def test_columns_that_settle_ties_may_end_the_order(spark):
    rows = [("a", 1, 5, "z"), ("a", 1, 5, "b"), ("a", 1, 5, None), ("b", 2, 1, "q"), ("b", 2, 0, "r"), (None, None, 1, "s"), (None, None, 1, "k")]
    df = spark.createDataFrame(rows, "k string, t int, v int, name string")
    ways = [keep_latest(df, "k", "t", tie_breakers=["v"], settled_last=["name"], all_read=x) for x in (False, True)]
    assert sorted(map(str, ways[0].collect())) == sorted(map(str, ways[1].collect()))
    assert "Aggregate" not in ways[1]._jdf.queryExecution().optimizedPlan().toString()


def test_landing_is_removed_and_its_shuffles_are_freed(spark, monkeypatch):
    """What cleaning needs on its way does not lie beside the cleaned files, nor the landing step's shuffles beside the next one's."""
    folders, landed, left = [], [], []
    scratch, write, free = layers.scratch_dir, layers.write_cleaned, layers.free_shuffles

    def freeing(*args):
        landed.append(shuffle_files(spark) - before)
        free(*args)

    def writing(*args):
        until = time.time() + 10
        while shuffle_files(spark) & landed[0] and time.time() < until:
            time.sleep(0.1)
        left.append(shuffle_files(spark) & landed[0])
        return write(*args)

    monkeypatch.setattr(layers, "scratch_dir", lambda *args: folders.append(scratch(*args)) or folders[-1])
    monkeypatch.setattr(layers, "free_shuffles", freeing)
    monkeypatch.setattr(layers, "write_cleaned", writing)
    before = shuffle_files(spark)
    cleaned = layers.clean_topics(spark, SF_SMALL, ("transaction_events",))["transaction_events"]
    assert spark.read.parquet(cleaned).count() > 0 and landed[0] and left == [set()]
    assert [f for _, _, files in os.walk(folders[0].removeprefix("file:")) for f in files] == []


def shuffle_files(spark) -> set:
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in dirs for f in glob.glob(f"{d}/**/shuffle_*.data", recursive=True)}
