"""One key holding a third of all rows: results stay whole and exact, and the
plans keep the hot key from crossing the shuffle in full."""

import datetime as dt
import decimal

from pyspark.sql import functions as F

from tidewater.operators.latest import keep_latest
from tidewater.operators.upsert import merge_upsert
from tidewater.plans import marts

N = 3000


def _items(spark):
    rows = []
    for i in range(N):
        tx = "HOT" if i % 3 == 0 else f"t{i}"
        rows.append((tx, i, f"c{i % 4}", decimal.Decimal(i % 50) + decimal.Decimal("0.25")))
    return spark.createDataFrame(rows, "transaction_id string, line_item_index int, category string, "
                                       "item_subtotal decimal(18,2)")


def test_keep_latest_hot_key_whole_and_limited_before_shuffle(spark):
    df = spark.range(N).select(F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.col("id").cast("string")).alias("k"),
                               F.col("id").alias("v"))
    out = keep_latest(df, "k", "v")
    assert out.filter("k = 'HOT'").collect()[0].v == max(i for i in range(N) if i % 3 == 0)
    assert out.count() == 1 + (N - N // 3)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        txt = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "WindowGroupLimit" in txt[txt.find("Exchange"):]


def test_refunds_by_category_hot_transaction(spark):
    items = _items(spark)
    fact = spark.createDataFrame(
        [("HOT", "refund", "completed", dt.date(2024, 1, 1))]
        + [(f"t{i}", "refund", "completed", dt.date(2024, 1, 2)) for i in range(N) if i % 3],
        "transaction_id string, transaction_type string, status string, transaction_date date")
    got = {(r.sales_date, r.category): (r.refund_count, r.refund_amount)
           for r in marts.refunds_by_category(items, fact).collect()}
    # brute force
    exp = {}
    for i in range(N):
        tx = "HOT" if i % 3 == 0 else f"t{i}"
        d = dt.date(2024, 1, 1) if tx == "HOT" else dt.date(2024, 1, 2)
        k = (d, f"c{i % 4}")
        txs, amt = exp.get(k, (set(), decimal.Decimal(0)))
        txs.add(tx)
        exp[k] = (txs, amt + decimal.Decimal(i % 50) + decimal.Decimal("0.25"))
    assert got == {k: (len(v[0]), v[1]) for k, v in exp.items()}


def test_refunds_by_category_preaggregates_before_join(spark):
    items = _items(spark)
    fact = spark.createDataFrame([("HOT", "refund", "completed", dt.date(2024, 1, 1))],
                                 "transaction_id string, transaction_type string, status string, "
                                 "transaction_date date")
    plan = marts.refunds_by_category(items, fact)._jdf.queryExecution().optimizedPlan().toString()
    join_at = plan.find("Join Inner")
    assert "Aggregate [transaction_id" in plan[join_at:], plan


def test_merge_with_hot_partition_key(spark):
    """One day holds a third of all rows of target and batch; every row is merged once."""
    day = F.when(F.col("id") % 3 == 0, "d").otherwise(F.col("id").cast("string")).alias("day")
    target = spark.range(N).select(day, F.col("id").cast("string").alias("k"), F.lit(0).alias("v"))
    batch = spark.range(0, N, 2).select(day, F.col("id").cast("string").alias("k"), F.lit(1).alias("v"))
    out = merge_upsert(target, batch, ["day", "k"])
    assert out.count() == N
    assert out.filter("v = 1").count() == len(range(0, N, 2))
    assert out.filter("day = 'd'").count() == len(range(0, N, 3))
