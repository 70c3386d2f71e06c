"""Specified and named analytics (SP1-SP10, WN4-WN6, ST1-ST3).

Where the source only names a result, the definition here is ours and is
stated in the docstring.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.casts import rounded_quotient, rounded_ratio
from tidewater.operators.joins import broadcast_if_small
from tidewater.operators.ranking import rank_desc

SUM_TYPE = "decimal(38,2)"


def _completed(fact_tx: DataFrame, ttype: str | None = None) -> DataFrame:
    cond = F.col("status") == "completed"
    if ttype:
        cond = cond & (F.col("transaction_type") == ttype)
    return fact_tx.filter(cond)


def _period(grain: str):
    if grain == "day":
        return F.col("transaction_date").alias("sales_date")
    return F.trunc("transaction_date", "MM").alias("month")


def type_totals(fact_tx: DataFrame, ttype: str, grain: str = "day") -> DataFrame:
    """Completed transactions of one type per day or month: count and amount
    (absolute value, so refunds and chargebacks count as positive money)."""
    amount = F.col("total") if ttype == "purchase" else F.abs("total")
    return (_completed(fact_tx, ttype).groupBy(_period(grain))
            .agg(F.count("*").alias("transactions"), F.sum(amount).cast(SUM_TYPE).alias("amount")))


HEAVY_THRESHOLDS = {"refund": 10, "chargeback": 5}  # documented limits (fixed values)


def heavy_users(fact_tx: DataFrame, ttype: str, threshold: int | None = None) -> DataFrame:
    """Users with more than ``threshold`` completed ``ttype`` in one month; the documented limit by default."""
    if threshold is None:
        threshold = HEAVY_THRESHOLDS[ttype]
    return (_completed(fact_tx, ttype)
            .groupBy("user_id", _period("month"))
            .agg(F.count("*").alias("events"))
            .filter(F.col("events") > threshold))


def us_vs_others(fact_tx: DataFrame) -> DataFrame:
    """Completed purchases, billing country US against all others."""
    seg = F.when(F.col("billing_country") == "US", "US").otherwise("OTHER").alias("segment")
    g = (_completed(fact_tx, "purchase").groupBy(seg)
         .agg(F.count("*").alias("orders"), F.sum("total").cast(SUM_TYPE).alias("revenue"),
              F.count_distinct("user_id").alias("customers")))
    return g.withColumn("avg_order_value", rounded_ratio("revenue", "orders"))


def customer_monthly_spend(fact_tx: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Customer daily spend at month grain: completed, all types (refunds net off)."""
    g = (_completed(fact_tx).groupBy(_period("month"), "user_id")
         .agg(F.count("*").alias("orders"), F.sum("total").cast(SUM_TYPE).alias("spend")))
    d = dim_customer.select("user_id", F.col("full_name").alias("customer_name"), "email")
    return g.join(d, "user_id", "left").select("month", "user_id", "customer_name", "email",
                                               "orders", "spend")


def customer_ranked(fact_tx: DataFrame) -> DataFrame:
    """Rank of each customer by completed spend within the month (ties share a rank),
    computed without a month-wide window (see ``operators.ranking``)."""
    spend = (_completed(fact_tx).groupBy(_period("month"), "user_id")
             .agg(F.sum("total").cast(SUM_TYPE).alias("spend")))
    return rank_desc(spend, "month", "spend", "spend_rank")


def running_revenue(daily: DataFrame) -> DataFrame:
    """Cumulative revenue over the daily series.  The input is one row per
    calendar day, so the single ordered window is bounded by the day count."""
    w = Window.orderBy("sales_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return daily.select("sales_date", "revenue",
                        F.sum("revenue").over(w).cast(SUM_TYPE).alias("running_revenue"))


def moving_avg_revenue(daily: DataFrame, rows: int = 7) -> DataFrame:
    """Average revenue of the last ``rows`` daily rows (current included), exact cents."""
    w = Window.orderBy("sales_date").rowsBetween(-(rows - 1), Window.currentRow)
    s = F.sum("revenue").over(w)
    n = F.count("revenue").over(w)
    return daily.select("sales_date", "revenue", rounded_ratio(s, n).alias("moving_avg_revenue"))


def cart_to_purchase(cart_events: DataFrame, purchases: DataFrame, days: int = 7) -> DataFrame:
    """Share of add-to-cart events followed within ``days`` days (same day
    included) by a completed purchase of the same user and match key.

    ``cart_events``: (event_id, user_id, match_key, cart_date);
    ``purchases``: (user_id, match_key, purchase_date).

    No pair is ever built.  Carts and purchases are put in one stream per
    (user, key, week bucket) ordered by date; each cart looks up the first
    purchase on or after its date with a forward-running ``min``.  A purchase
    is copied into its own bucket and the one before, which covers every
    cart whose window reaches it (``days`` <= bucket width), and the bucket
    splits a hot user's history across tasks.
    """
    width = max(days, 1)
    p = purchases.select("user_id", "match_key", "purchase_date").dropDuplicates()
    pb = F.floor(F.datediff("purchase_date", F.lit("1970-01-01")) / width).cast("long")
    p2 = (p.withColumn("_b", F.explode(F.array(pb, pb - 1)))
          .select("user_id", "match_key", F.col("_b").alias("bucket"),
                  F.col("purchase_date").alias("d"), F.lit(1).alias("kind"),
                  F.lit(None).cast("string").alias("event_id")))
    cb = F.floor(F.datediff("cart_date", F.lit("1970-01-01")) / width).cast("long")
    c2 = cart_events.select("user_id", "match_key", cb.alias("bucket"), F.col("cart_date").alias("d"),
                            F.lit(0).alias("kind"), "event_id")
    w = (Window.partitionBy("user_id", "match_key", "bucket").orderBy("d", "kind", "event_id")
         .rowsBetween(Window.currentRow, Window.unboundedFollowing))
    nxt = F.min(F.when(F.col("kind") == 1, F.col("d"))).over(w)
    tagged = (c2.unionByName(p2).withColumn("next_purchase", nxt).filter(F.col("kind") == 0)
              .select("event_id", F.col("d").alias("cart_date"),
                      (F.col("next_purchase").isNotNull() & F.col("match_key").isNotNull()
                       & (F.col("next_purchase") <= F.date_add("d", days))).alias("converted")))
    g = tagged.groupBy("cart_date").agg(F.count("*").alias("carts"),
                                         F.count_if("converted").alias("conversions"))
    return g.withColumn("conversion_rate", rounded_quotient("conversions", "carts", 4))


def cart_inputs(user_events: DataFrame, fact_tx: DataFrame, items: DataFrame,
                products: DataFrame, match: str = "category", purchase_date=None):
    """Build the two inputs of ``cart_to_purchase`` from gold tables.
    ``match`` is ``product`` or ``category``; ``purchase_date`` overrides the
    purchase's date (the driver fixture shifts purchases into the event month)."""
    carts = user_events.filter(F.col("event_type") == "add_to_cart")
    pdate = purchase_date if purchase_date is not None else F.col("transaction_date")
    tx = _completed(fact_tx, "purchase").select("transaction_id", "user_id", pdate.alias("purchase_date"))
    if match == "category":
        prod = broadcast_if_small(products.select("product_id", F.col("category").alias("match_key")))
        carts = carts.join(prod, "product_id", "left")  # a cart of an unknown product converts to nothing
        it = items.select("transaction_id", F.col("category").alias("match_key")).dropDuplicates()
    else:
        carts = carts.withColumn("match_key", F.col("product_id"))
        it = items.select("transaction_id", F.col("product_id").alias("match_key")).dropDuplicates()
    carts = carts.select("event_id", "user_id", "match_key",
                         F.col("timestamp").cast("date").alias("cart_date"))
    purchases = tx.join(it, "transaction_id").select("user_id", "match_key", "purchase_date")
    return carts, purchases
