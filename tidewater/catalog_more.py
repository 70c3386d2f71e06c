"""Queries of event-time streams, change feeds, reprocessing, running sums, flattening and table layouts."""

from __future__ import annotations

from collections.abc import Callable
from itertools import pairwise, zip_longest

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater import catalog as C
from tidewater.catalog import BODY, query
from tidewater.functions.casts import rounded_ratio
from tidewater.functions.flatten import flatten_json
from tidewater.operators.changes import apply_changes
from tidewater.operators.running import moving_sums, running_sums
from tidewater.operators.tables import read_table
from tidewater.plans import analytics as A
from tidewater.plans import dims, facts, marts
from tidewater.plans import layers as P
from tidewater.plans.etl import run_etl
from tidewater.plans.gold import TX_KEY, GoldTables
from tidewater.session import scratch_dir
from tidewater.sources import fixtures as fx
from tidewater.sources import sinks
from tidewater.sources.landing import pack_user_events, write_json_lines
from tidewater.sources.tables import table
from tidewater.streaming import events as E
from tidewater.streaming import jobs as J

# ------------------------------------------------------- event-time streams
SLICES = 3
HEARTBEAT_DAYS = 400


def _sliced(df: DataFrame, time_col: str, path: str, repeat: bool = False, heartbeat: bool = False) -> list[DataFrame]:
    """Stand-in for a topic: the rows in SLICES parts in order of time, for ``_arrive``.

    The rows are written once at ``path``, so that no part computes them again.
    ``repeat`` sends each part's rows once more with the next part;
    ``heartbeat`` ends with a row of nulls far in the future, as a source sends
    one to say that nothing older follows.
    """
    df.write.parquet(path)
    df = df.sparkSession.read.schema(df.schema).parquet(path)
    at = F.col(time_col).cast("timestamp").cast("double")
    cuts = df.select(at.alias("t")).approxQuantile("t", [i / SLICES for i in range(1, SLICES)], 0.01)
    bounds = [float("-inf"), *cuts, float("inf")]
    part = [df.filter((at > lo) & (at <= hi)) for lo, hi in pairwise(bounds)]
    if repeat:
        part = [p if k == 0 else p.unionByName(part[k - 1]) for k, p in enumerate(part)]
    if heartbeat:
        kind = df.schema[time_col].dataType
        beat = df.agg(F.max(F.col(time_col)).alias("t")).select(
            *[(F.col("t") + F.expr(f"INTERVAL {HEARTBEAT_DAYS} DAYS")).cast(kind).alias(c) if c == time_col else F.lit(None).cast(df.schema[c].dataType).alias(c)
              for c in df.columns])
        part.append(beat)
    return part


def _arrive(topics: dict[str, list[DataFrame]], drain: Callable[[], object]) -> None:
    """Part by part into the topics' folders, in as many files as it has tasks; ``drain`` runs the stream on what has
    arrived, from its checkpoint, so that no micro-batch takes rows of two parts."""
    for part in zip_longest(*topics.values()):
        for rows, path in zip(part, topics, strict=True):
            if rows is not None:  # a topic without rows has one part alone
                rows.write.mode("append").parquet(path)
        drain()


def _outcomes(spark: SparkSession, sf: str) -> DataFrame:
    shift = F.date_add(F.lit(C.CART_SHIFT_BASE).cast("date"), (F.col("transaction_id").cast("bigint") % C.CART_SHIFT_DAYS).cast("int"))
    t = fx.stg_transactions(spark, sf)
    bought = t.filter((F.col("status") == "completed") & (F.col("transaction_type") == "purchase"))
    items = facts.transaction_items(fx.stg_items(spark, sf), only_transactions=bought)
    carts, purchases = A.cart_inputs(facts.fact_user_events(fx.stg_user_events(spark, sf)), facts.fact_transactions(t), items,
                                     dims.dim_product(fx.stg_products(spark, sf)), C.CART_MATCH, shift)
    root = scratch_dir(spark, "cart_outcomes")
    carts = carts.withColumn("cart_ts", F.col("cart_date").cast("timestamp")).drop("cart_date")
    purchases = purchases.withColumn("purchase_ts", F.col("purchase_date").cast("timestamp")).drop("purchase_date")
    topics = {f"{root}/carts": _sliced(carts, "cart_ts", f"{root}/rows/carts", heartbeat=True),
              f"{root}/purchases": _sliced(purchases, "purchase_ts", f"{root}/rows/purchases", heartbeat=True)}

    def drain() -> None:
        streams = [E.read_stream(spark, path, parts[0].schema) for path, parts in topics.items()]
        E.append_stream(E.cart_outcomes(*streams, C.CART_WINDOW_DAYS), f"{root}/table", f"{root}/_ckpt")

    _arrive(topics, drain)
    return spark.read.parquet(f"{root}/table")


@query("stream_cart_to_purchase", BODY["cart_to_purchase"])
def q_stream_cart_to_purchase(spark, sf):
    """Carts and purchases as two streams, joined in event time over several micro-batches."""
    return E.conversions(_outcomes(spark, sf))


@query("stream_abandoned_carts", f"""
SELECT c.event_id, c.user_id, c.cart_date
FROM (SELECT e.event_id, e.user_id, d.category AS match_key, CAST(e.timestamp AS DATE) AS cart_date
      FROM fact_user_events e LEFT JOIN dim_product d ON d.product_id = e.product_id WHERE e.event_type = 'add_to_cart') c
WHERE NOT EXISTS (
  SELECT 1 FROM (SELECT DISTINCT f.user_id, i.category AS match_key,
                   CAST(DATE '{C.CART_SHIFT_BASE}' + CAST(CAST(f.transaction_id AS BIGINT) % {C.CART_SHIFT_DAYS} AS INTEGER) AS DATE) AS purchase_date
                 FROM fact_transactions f JOIN transaction_items i ON i.transaction_id = f.transaction_id
                 WHERE f.status = 'completed' AND f.transaction_type = 'purchase') p
  WHERE p.user_id = c.user_id AND p.match_key = c.match_key
    AND p.purchase_date BETWEEN c.cart_date AND CAST(c.cart_date + {C.CART_WINDOW_DAYS} AS DATE))""")
def q_stream_abandoned_carts(spark, sf):
    """Anti join across event streams: carts whose days have passed without a purchase."""
    return E.abandoned_carts(_outcomes(spark, sf))


@query("stream_dedupe_events", "SELECT * FROM fact_user_events")
def q_stream_dedupe_events(spark, sf):
    """User events of which each part repeats the one before, deduplicated within event time; the stream is stopped and restarted."""
    ev = facts.fact_user_events(fx.stg_user_events(spark, sf))
    root = scratch_dir(spark, "dedupe")
    late = "60 days"  # longer than two parts, so every repeat falls within it

    def drain() -> None:
        rows = E.dedupe(E.read_stream(spark, f"{root}/in", ev.schema), "event_id", "timestamp", late)
        E.append_stream(rows, f"{root}/table", f"{root}/_ckpt")

    _arrive({f"{root}/in": _sliced(ev, "timestamp", f"{root}/rows", repeat=True)}, drain)
    return spark.read.parquet(f"{root}/table")


@query("stream_daily_revenue_windows", BODY["daily_revenue"])
def q_stream_daily_revenue_windows(spark, sf):
    """Daily revenue in event-time windows: sums in the state, the days of each micro-batch upserted."""
    f = facts.fact_transactions(fx.stg_transactions(spark, sf))
    root = scratch_dir(spark, "windows")

    def drain() -> None:
        E.stream_daily_revenue(E.read_stream(spark, f"{root}/in", f.schema), f"{root}/table", f"{root}/_ckpt")

    _arrive({f"{root}/in": _sliced(f, "transaction_ts", f"{root}/rows")}, drain)
    return E.daily_revenue_of(spark, f"{root}/table").drop("batch", "event_month")


# -------------------------------------------------------------- change feeds

@query("change_feed_replayed", "SELECT * FROM fact_transactions")
def q_change_feed_replayed(spark, sf):
    """Three batches with corrections; the table is rebuilt from the rows of its change feed alone."""
    gold, source = GoldTables(spark, scratch_dir(spark, "feed"), ()), C._gold_feeds(spark, sf)
    state = None
    for n in range(3):
        gold.load("transactions", source["transactions"][n], n)
        feed = read_table(spark, f"{gold.feed('transactions')}/batch={n}")
        if state is None:
            state = feed.filter("after is not null").select("after.*")
        else:
            state = apply_changes(state, feed, TX_KEY)
    return facts.project_transactions(state)


@query("change_feed_rows", """
SELECT change, status_from, status_to, CAST(COUNT(*) AS BIGINT) AS n FROM (
  SELECT 'insert' AS change, CAST(NULL AS VARCHAR) AS status_from, CASE WHEN k < 2 THEN 'pending' ELSE status END AS status_to
  FROM (SELECT *, CAST(transaction_id AS BIGINT) % 3 AS k FROM fact_transactions)
  UNION ALL
  SELECT 'update', 'pending', status FROM fact_transactions WHERE CAST(transaction_id AS BIGINT) % 3 < 2)
GROUP BY ALL""")
def q_change_feed_rows(spark, sf):
    """Two thirds of the transactions arrive pending, then all as they are: inserts and updates, no row that did not change."""
    tx = fx.stg_transactions(spark, sf)
    third = F.pmod(F.col("transaction_id").cast("bigint"), F.lit(3))
    early = tx.filter(third < 2).withColumn("status", F.lit("pending")).withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 40 DAYS"))
    gold = GoldTables(spark, scratch_dir(spark, "feed_rows"), ())
    for n, rows in enumerate((early, tx, tx)):  # the third batch changes nothing
        gold.load("transactions", rows, n)
    feed = spark.read.parquet(gold.feed("transactions"))
    return feed.groupBy("change", F.col("before.status").alias("status_from"), F.col("after.status").alias("status_to")).agg(F.count("*").alias("n"))


@query("independent_consumers", BODY["customer_risk"])
def q_independent_consumers(spark, sf):
    """Two consumers of one feed: the fact follows every batch, the risk mart is stopped for two and catches up."""
    root = scratch_dir(spark, "consumers")
    gold, source = GoldTables(spark, f"{root}/tables", ("customer_risk",)), C._gold_feeds(spark, sf)
    gold.load("customers", fx.stg_customers(spark, sf), 0)
    J.stream_consumer(gold, "dim_customer", f"{root}/_ckpt/dim_customer")
    for n in range(3):
        gold.load("transactions", source["transactions"][n], n)
        J.stream_consumer(gold, "fact_transactions", f"{root}/_ckpt/fact_transactions")
        if n != 1:
            J.stream_consumer(gold, "customer_risk", f"{root}/_ckpt/customer_risk")
    return gold.read("customer_risk")


@query("stream_transaction_items", BODY["silver_transaction_items"])
def q_stream_transaction_items(spark, sf):
    """Feed of the silver items consumed by the item fact's stream."""
    return C._consumed(spark, sf, "transaction_events", "transaction_items").read("transaction_items")


@query("stream_fact_user_events", BODY["silver_user_events"])
def q_stream_fact_user_events(spark, sf):
    """Feed of the silver user events consumed by the event fact's stream."""
    return C._consumed(spark, sf, "user_events", "fact_user_events").read("fact_user_events")


def _streamed_dimension(spark: SparkSession, sf: str, topic: str) -> DataFrame:
    """A dimension's cleaned files through its silver stream, its feed and the gold dimension's stream."""
    cleaned = P.clean_topics(spark, sf, (topic,))[topic]
    root = scratch_dir(spark, f"stream_{topic}")
    gold = GoldTables(spark, f"{root}/tables", ())
    J.stream_silver(spark, cleaned, topic, gold, f"{root}/_ckpt/silver", max_files=C._files_for(spark, cleaned, 2))
    name = {"customers": "dim_customer", "products": "dim_product"}[topic]
    J.stream_consumer(gold, name, f"{root}/_ckpt/{name}")
    return gold.read(name).drop("processed_at")


@query("stream_dim_customer", BODY["dim_customer"])
def q_stream_dim_customer(spark, sf):
    """Customers: cleaned files -> silver -> change feed -> dimension, each by its own stream."""
    return _streamed_dimension(spark, sf, "customers")


@query("stream_dim_product", BODY["dim_product"])
def q_stream_dim_product(spark, sf):
    """Products: cleaned files -> silver -> change feed -> dimension, each by its own stream."""
    return _streamed_dimension(spark, sf, "products")


# ------------------------------------------------------------- reprocessing

@query("etl_range_then_all", """
SELECT event_id, event_type, CAST(timestamp AS DATE) AS event_date FROM src_user_events""")
def q_etl_range_then_all(spark, sf):
    """A run over two weeks, new files, a run over all: every event once."""
    ev = pack_user_events(fx.stg_user_events(spark, sf, defaults=False))
    root = scratch_dir(spark, "etl_range")
    for n, days in enumerate((("2024-01-03", "2024-01-16"), (None, None))):
        write_json_lines(ev.filter(F.col("event_id").cast("bigint") % 2 == n), f"{root}/new{n}")
        spark.read.text(f"{root}/new{n}").write.mode("append").text(f"{root}/landing/user_events")
        run_etl(spark, f"{root}/landing", f"{root}/out", topics=("user_events",), start=days[0], end=days[1], archive=f"{root}/archive")
    return spark.read.parquet(f"{root}/out/user_events").select("event_id", "event_type", "event_date")


@query("dim_date_replaced", BODY["dim_date"])
def q_dim_date_replaced(spark, sf):
    """The calendar of the first half of the history, replaced in full by that of all of it."""
    tx, path = fx.stg_transactions(spark, sf), scratch_dir(spark, "dim_date") + "/table"
    sinks.replace_table(dims.dim_date(tx.filter(F.col("timestamp") < F.lit("1996-01-01").cast("timestamp_ntz"))), path)
    sinks.replace_table(dims.dim_date(tx), path)
    return sinks.read_replaced(spark, path)


# ------------------------------------------------ running and moving, per event

_HOT = "CASE WHEN CAST(transaction_id AS BIGINT) % 3 = 0 THEN 'hot' ELSE user_id END"


def _spend_events(spark, sf) -> DataFrame:
    """Completed transactions of which one user has a third."""
    hot = F.when(F.col("transaction_id").cast("bigint") % 3 == 0, F.lit("hot")).otherwise(F.col("user_id"))
    return C._fact_tx(spark, sf).filter("status = 'completed'").select("transaction_id", hot.alias("user_id"), "transaction_ts", "total")


@query("running_spend_per_event", f"""
SELECT transaction_id, user_id, total,
  CAST(SUM(total) OVER (PARTITION BY user_id ORDER BY transaction_ts, transaction_id ROWS UNBOUNDED PRECEDING) AS DECIMAL(38,2)) AS running_spend
FROM (SELECT transaction_id, {_HOT} AS user_id, transaction_ts, total FROM fact_transactions WHERE status = 'completed')""")
def q_running_spend_per_event(spark, sf):
    """Running spend of every user at every transaction; the hot user's rows go through many tasks."""
    rows = running_sums(_spend_events(spark, sf), "user_id", ["transaction_ts", "transaction_id"], {"running_spend": "total"})
    return rows.select("transaction_id", "user_id", "total", F.col("running_spend").cast("decimal(38,2)").alias("running_spend"))


@query("moving_spend_per_event", f"""
SELECT transaction_id, user_id, total, {C.O.cents_ratio('SUM(total) OVER w', 'COUNT(total) OVER w')} AS moving_spend
FROM (SELECT transaction_id, {_HOT} AS user_id, transaction_ts, total FROM fact_transactions WHERE status = 'completed')
WINDOW w AS (PARTITION BY user_id ORDER BY transaction_ts, transaction_id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def q_moving_spend_per_event(spark, sf):
    """Average of every user's last seven transactions, across the borders of blocks."""
    rows = moving_sums(_spend_events(spark, sf), "user_id", ["transaction_ts", "transaction_id"], 7, {"s": "total"}, {"n": "total"})
    return rows.select("transaction_id", "user_id", "total", rounded_ratio("s", "n").alias("moving_spend"))


# ------------------------------------------------------- flattening and layouts

@query("flatten_json", f"""
SELECT t.transaction_id, t.user_id, t.transaction_type, t.status, t.total, t.bill_city, i.line_item_index, i.product_id,
  CAST(i.quantity AS BIGINT) AS quantity, i.unit_price, CAST(i.quantity * i.unit_price AS DECIMAL(18,2)) AS item_revenue
FROM src_transactions t LEFT JOIN {C._DENSE_ITEMS} i USING (transaction_id)""")
def q_flatten_json(spark, sf):
    """Landed JSON to item grain by the type that its own lines give; no array or struct is left."""
    lines = spark.read.text(f"{P.land_fixtures(spark, sf, ('transaction_events',))}/transaction_events")
    flat = flatten_json(lines)
    q, price = F.col("line_items_quantity").cast("bigint"), F.col("line_items_unit_price").cast("decimal(18,2)")
    return flat.select("transaction_id", "user_id", "transaction_type", "status", F.col("total").cast("decimal(18,2)").alias("total"),
                       F.col("billing_address_city").alias("bill_city"), F.col("line_items_index").cast("int").alias("line_item_index"),
                       F.col("line_items_product_id").alias("product_id"), q.alias("quantity"), price.alias("unit_price"),
                       (q * price).cast("decimal(18,2)").alias("item_revenue"))


QUARTER = (1995, 2)


def pruned_join(spark: SparkSession, fact: str, items: str, calendar: DataFrame) -> DataFrame:
    """Items of the transactions in the calendar's months: only those folders are read, and matching buckets meet without a shuffle."""
    months = calendar.select(F.trunc("date_value", "MM").alias("event_month")).distinct()
    f = spark.table(fact).join(F.broadcast(months), "event_month")
    return spark.table(items).join(f.drop("event_month"), "transaction_id")


def write_pruned(spark: SparkSession, sf: str, root: str, fact: str, items: str) -> None:
    f = C._fact_tx(spark, sf).select("transaction_id", "transaction_date", "transaction_type")
    i = C._items(spark, sf).select("transaction_id", "line_item_index", "category", "item_subtotal")
    n = C._buckets(table(spark, sf, "lineitem"))
    sinks.write_bucketed(P.with_month(f, "transaction_date"), spark, fact, f"{root}/fact", "transaction_id", n, ("event_month",))
    sinks.write_bucketed(i, spark, items, f"{root}/items", "transaction_id", n)


@query("partitioned_bucketed_join", f"""
SELECT i.transaction_id, i.line_item_index, i.category, i.item_subtotal, f.transaction_date, f.transaction_type
FROM transaction_items i JOIN fact_transactions f ON f.transaction_id = i.transaction_id
WHERE year(f.transaction_date) = {QUARTER[0]} AND quarter(f.transaction_date) = {QUARTER[1]}""")
def q_partitioned_bucketed_join(spark, sf):
    """Transactions in month folders and buckets, items in buckets: one quarter of the calendar prunes the folders."""
    root = scratch_dir(spark, "pruned")
    with sinks.catalog_tables(spark, "fact", "items") as (fact, items):
        write_pruned(spark, sf, root, fact, items)
        calendar = dims.dim_date(fx.stg_transactions(spark, sf)).filter((F.col("year") == QUARTER[0]) & (F.col("quarter") == QUARTER[1]))
        sinks.replace_table(calendar, f"{root}/calendar")
        pruned_join(spark, fact, items, sinks.read_replaced(spark, f"{root}/calendar")).write.parquet(f"{root}/joined")
    return spark.read.parquet(f"{root}/joined")


@query("validate_gold_tables", """
SELECT 'fact_transactions' AS table_name, COUNT(*) AS row_count, TRUE AS passed FROM fact_transactions
UNION ALL SELECT 'stg_transactions', COUNT(*), TRUE FROM stg_transactions
UNION ALL SELECT 'daily_revenue', COUNT(DISTINCT transaction_date), TRUE FROM fact_transactions WHERE status = 'completed'""")
def q_validate_gold_tables(spark, sf):
    """The check that ends a gold run: every persisted table of silver, facts and marts, by its key."""
    gold = GoldTables(spark, scratch_dir(spark, "validated"), ("daily_revenue",))
    gold.apply(0, transactions=fx.stg_transactions(spark, sf))
    return gold.validate().select("table_name", "row_count", "passed")
