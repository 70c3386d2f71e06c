"""Streaming laws: stream result = batch result; a restart adds nothing."""

import os

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidewater.plans import facts, marts
from tidewater.plans import layers as P
from tidewater.plans import silver as S
from tidewater.plans.gold import GoldTables
from tidewater.session import scratch_dir
from tidewater.sources import fixtures as fx
from tidewater.sources.bronze import load_bronze
from tidewater.sources.landing import topic_lines, write_json_lines
from tidewater.streaming import jobs as J


def _rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def _silver(spark, topic, name, kept_marts=()):
    cleaned = P.clean_topics(spark, SF_SMALL, (topic,))[topic]
    root = scratch_dir(spark, name)
    gold = GoldTables(spark, f"{root}/tables", kept_marts)
    return gold, cleaned, root


def test_stream_equals_batch_and_restart_adds_nothing(spark):
    gold, cleaned, root = _silver(spark, "transaction_events", "t_stream")

    def run():
        J.stream_silver(spark, cleaned, "transaction_events", gold, f"{root}/_ckpt/silver", max_files=40)
        for c in ("fact_transactions", "transaction_items"):
            J.stream_consumer(gold, c, f"{root}/_ckpt/{c}")

    run()
    feeds = {f: sorted(os.listdir(gold.feed(f).removeprefix("file:"))) for f in ("transactions", "items", "fact_transactions", "transaction_items")}
    assert len(feeds["transactions"]) > 1  # several micro-batches
    bronze = load_bronze(spark, cleaned)
    cols = ["transaction_id", "user_id", "status", "total", "bill_city"]
    assert _rows(gold.read("stg_transactions"), cols) == _rows(S.silver_transactions(bronze), cols)
    icols = ["transaction_id", "line_item_index", "product_id", "quantity", "item_subtotal"]
    assert _rows(gold.read("transaction_items"), icols) == _rows(S.silver_transaction_items(bronze), icols)
    run()  # restart from the checkpoints with no new files: nothing is processed
    assert {f: sorted(os.listdir(gold.feed(f).removeprefix("file:"))) for f in feeds} == feeds


def test_a_stopped_consumer_catches_up_and_starves_no_other(spark):
    """Three consumers of one feed: one runs after every batch, one is stopped and started again, one starts at the end."""
    root = scratch_dir(spark, "t_consumers")
    gold = GoldTables(spark, f"{root}/tables", ("customer_risk", "refund_items_nested"))
    tx, items = fx.stg_transactions(spark, SF_SMALL), fx.stg_items(spark, SF_SMALL).drop("tie1", "tie2", "tie3", "tie4")
    gold.load("items", items, 0)
    J.stream_consumer(gold, "transaction_items", f"{root}/_ckpt/transaction_items")
    late = tx.withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 40 DAYS")).withColumn("status", F.lit("pending"))
    third = F.pmod(F.xxhash64("transaction_id"), F.lit(3))
    for n, rows in enumerate((late, tx.filter(third > 0), tx.filter(third == 0))):
        gold.load("transactions", rows, n)
        J.stream_consumer(gold, "fact_transactions", f"{root}/_ckpt/fact_transactions")  # the fast one
        if n != 1:
            J.stream_consumer(gold, "customer_risk", f"{root}/_ckpt/customer_risk", max_files=1)  # stopped for a batch
    J.stream_consumer(gold, "refund_items_nested", f"{root}/_ckpt/refund_items_nested", max_files=1)
    cols = ["transaction_id", "status", "transaction_date", "total"]
    assert _rows(gold.read("fact_transactions"), cols) == _rows(facts.fact_transactions(tx), cols)
    risk = ["user_id", "event_date", "num_refunds", "num_chargebacks", "bill_city"]
    assert _rows(gold.read("customer_risk"), risk) == _rows(marts.risk_counts(tx), risk)
    nested = marts.refund_items_nested(tx, facts.transaction_items(items))
    assert _rows(gold.read("refund_items_nested"), ["transaction_id", "purchase_items"]) == _rows(nested, ["transaction_id", "purchase_items"])


def test_stamp_is_one_per_batch(spark):
    gold, cleaned, root = _silver(spark, "user_events", "t_stamp")
    J.stream_silver(spark, cleaned, "user_events", gold, f"{root}/_ckpt")
    got = spark.read.parquet(gold.feed("events")).select("batch", "after.processed_at")
    assert got.distinct().count() == got.select("batch").distinct().count()


def _landing(spark, name, parts=3):
    root = scratch_dir(spark, name)
    events = P.packed_sources(spark, SF_SMALL)["user_events"].repartition(parts)
    write_json_lines(events, f"{root}/in")
    return root


def test_ingest_each_file_once_and_keep_bad_lines(spark):
    root = _landing(spark, "t_ingest")
    spark.createDataFrame([("{broken",), ('{"event_id": "z", "quantity": "n/a"}',), ("",)], "value string") \
        .write.mode("append").text(f"{root}/in")
    for _ in range(2):
        J.ingest_landing(spark, f"{root}/in", "user_events", f"{root}/out", f"{root}/_ckpt", max_files=1)
    lines = spark.read.text(f"{root}/in").filter("trim(value) <> ''").count()
    good = spark.read.parquet(f"{root}/out")
    assert good.count() + 1 == lines and good.filter("event_id = 'z' and quantity is null").count() == 1
    assert [r.value for r in spark.read.text(f"{root}/out/_quarantine").collect()] == ["{broken"]


def test_messages_go_through_the_parser_of_files(spark):
    """A stream of binary messages, as the topic source gives them (here from files): drift, bad and empty messages."""
    root = scratch_dir(spark, "t_messages")
    rows = [(b'{"event_id": "a", "quantity": "2"}', b"k"), (b'{"event_id": "b", "quantity": "n/a"}', None), (b"{broken", b"k"), (None, b"k"), (b"", b"k")]
    spark.createDataFrame(rows, "value binary, key binary").write.parquet(f"{root}/in")
    messages = spark.readStream.schema("value binary, key binary").parquet(f"{root}/in")
    for _ in range(2):
        J.ingest(topic_lines(messages), "user_events", f"{root}/out", f"{root}/_ckpt")
    assert sorted((r.event_id, r.quantity) for r in spark.read.parquet(f"{root}/out").collect()) == [("a", 2), ("b", None)]
    assert [r.value for r in spark.read.text(f"{root}/out/_quarantine").collect()] == ["{broken"]


def test_archive_moves_consumed_files(spark):
    root = _landing(spark, "t_archive")
    before = len([f for f in os.listdir(f"{root}/in") if f.startswith("part-")])
    for _ in range(2):
        J.ingest_landing(spark, f"{root}/in", "user_events", f"{root}/out", f"{root}/_ckpt",
                         max_files=1, archive_dir=f"{root}/archive")
    archived = [f for _, _, fs in os.walk(f"{root}/archive") for f in fs if f.startswith("part-")]
    left = [f for f in os.listdir(f"{root}/in") if f.startswith("part-")]
    assert len(archived) >= 2 and len(archived) + len(left) == before


def test_continuous_ingest_returns_the_running_query(spark):
    root = _landing(spark, "t_running")
    q = J.ingest_landing(spark, f"{root}/in", "user_events", f"{root}/out", f"{root}/_ckpt", available_now=False,
                         every="1 second")
    try:
        q.processAllAvailable()
        assert q.isActive and spark.read.parquet(f"{root}/out").count() == spark.read.text(f"{root}/in").count()
    finally:
        q.stop()
