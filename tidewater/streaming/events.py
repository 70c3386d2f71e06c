"""Event-time operators on streams: joins of two streams, dedupe, windowed revenue.

These keep state in Spark's state store (on disk in ``build_session``), bounded by watermarks.  ``late`` says
how far behind the newest event of its stream a row may come; later ones are
dropped, as documented on each operator.  The watermark moves after a
micro-batch, so a row counts as late by what earlier micro-batches have seen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.casts import rounded_quotient, rounded_ratio
from tidewater.operators.tables import read_table, upsert_partitions

SUM_TYPE = "decimal(38,2)"


def run_stream(writer, checkpoint: str, every: str | None = None):
    """Drains what has arrived and returns the ended query; with ``every`` the query runs on and is returned."""
    w = writer.option("checkpointLocation", checkpoint)
    q = (w.trigger(processingTime=every) if every else w.trigger(availableNow=True)).start()
    if not every:
        q.awaitTermination()
    return q


def append_stream(rows: DataFrame, path: str, checkpoint: str, every: str | None = None):
    """A stream into a Parquet table by Spark's file sink, whose log makes a repeated micro-batch count once."""
    return run_stream(rows.writeStream.outputMode("append").format("parquet").option("path", path), checkpoint, every)


def read_stream(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    return (r.option("maxFilesPerTrigger", max_files) if max_files else r).parquet(path)


def _day(column) -> F.Column:
    return F.date_trunc("day", F.col(column).cast("timestamp"))


def cart_outcomes(carts: DataFrame, purchases: DataFrame, days: int = 7, late: str = "2 days") -> DataFrame:
    """Carts and purchases, both streams: one row per cart and purchase day that follows it within ``days`` days.

    ``carts``: (event_id, user_id, match_key, cart_ts); ``purchases``:
    (user_id, match_key, purchase_ts).  The result (event_id, user_id, cart_day,
    purchase_day) is a left outer join with a time range.  A match comes out
    with the micro-batch that completes it.  A cart without one comes out with a null
    ``purchase_day`` once both watermarks have passed its last day, so those
    rows are the left anti join of the two streams.  Until then the cart waits
    in the state, which holds ``days`` days and the lateness, not the history.
    Rows without a time are left out; a null user or match key joins nothing.
    """
    c = (carts.select("event_id", "user_id", "match_key", _day("cart_ts").alias("cart_day")).filter("cart_day is not null")
         .withWatermark("cart_day", late))
    p = (purchases.select(F.col("user_id").alias("buyer"), F.col("match_key").alias("bought"), _day("purchase_ts").alias("purchase_day"))
         .filter("purchase_day is not null").withWatermark("purchase_day", late).dropDuplicates(["buyer", "bought", "purchase_day"]))
    near = (F.col("user_id") == F.col("buyer")) & (F.col("match_key") == F.col("bought")) \
        & (F.col("purchase_day") >= F.col("cart_day")) & (F.col("purchase_day") <= F.col("cart_day") + F.expr(f"INTERVAL {days} DAYS"))
    return c.join(p, near, "left_outer").select("event_id", "user_id", "cart_day", "purchase_day")


def abandoned_carts(outcomes: DataFrame) -> DataFrame:
    """Carts that no purchase followed: the anti join's rows of ``cart_outcomes``, written or streamed."""
    return outcomes.filter("purchase_day is null").select("event_id", "user_id", F.col("cart_day").cast("date").alias("cart_date"))


def conversions(outcomes: DataFrame) -> DataFrame:
    """Carts, conversions and rate by cart day, from written outcomes (a cart may have several purchase days)."""
    carts = outcomes.groupBy("event_id", "cart_day").agg(F.count("purchase_day").alias("hits"))
    g = carts.groupBy(F.col("cart_day").cast("date").alias("cart_date")).agg(F.count("*").alias("carts"), F.count_if(F.col("hits") > 0).alias("conversions"))
    return g.withColumn("conversion_rate", rounded_quotient("conversions", "carts", 4))


def dedupe(rows: DataFrame, keys, time_col: str, late: str = "2 days") -> DataFrame:
    """The first row of each key of a stream; a repeat within ``late`` of it, by event time, is dropped.

    The state holds the keys of the last ``late`` only.  A repeat that comes
    after its key has left the state passes again; the keyed tables downstream
    take it as an update.  Rows without a time are left out.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    event_time = rows.withColumn("event_time", F.col(time_col).cast("timestamp")).filter("event_time is not null")
    return event_time.withWatermark("event_time", late).dropDuplicatesWithinWatermark(keys).drop("event_time")


def revenue_windows(transactions: DataFrame, late: str = "2 days") -> DataFrame:
    """Completed transactions of a stream in windows of one day, for update mode.

    (sales_date, orders, revenue, tax).  A day's sums stay in the state until
    the watermark has passed it; a row later than that is dropped.  Each
    transaction is to come once (``dedupe``).
    """
    g = (transactions.filter(F.col("status") == "completed").withColumn("event_time", F.col("transaction_ts").cast("timestamp"))
         .filter("event_time is not null").withWatermark("event_time", late).groupBy(F.window("event_time", "1 day").alias("day"))
         .agg(F.count_if(F.col("transaction_type") == "purchase").alias("orders"), F.sum("total").cast(SUM_TYPE).alias("revenue"),
              F.sum("tax").cast(SUM_TYPE).alias("tax")))
    return g.select(F.col("day.start").cast("date").alias("sales_date"), "orders", "revenue", "tax")


def stream_daily_revenue(transactions: DataFrame, table: str, checkpoint: str, late: str = "2 days", every: str | None = None):
    """Daily revenue kept by a windowed stream: each micro-batch upserts the days that it touched.

    ``batch`` of a row is the micro-batch that touched the day last, so the
    rows a micro-batch wrote are known.
    """
    def upsert(days: DataFrame, n: int) -> None:
        rows = days.withColumn("batch", F.lit(n).cast("long")).withColumn("event_month", F.trunc("sales_date", "MM"))
        upsert_partitions(rows, table, "sales_date", "event_month", n)

    return run_stream(revenue_windows(transactions, late).writeStream.outputMode("update").foreachBatch(upsert), checkpoint, every)


def daily_revenue_of(spark: SparkSession, table: str) -> DataFrame:
    """The table of ``stream_daily_revenue`` with the average order value."""
    return read_table(spark, table).withColumn("avg_order_value", rounded_ratio("revenue", "orders"))
