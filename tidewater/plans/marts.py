"""Gold daily marts (TB12-TB17).

Shapes chosen for scale:
* every mart aggregates *before* it joins a dimension, so the join sees one
  row per group, not one per event;
* refunds by category pre-aggregates items per (transaction, category) on the
  map side before the join, so a transaction with a huge item list crosses the
  shuffle as a handful of rows;
* risk takes counts and the latest location in a single aggregation
  (``max_by`` over a total order), one shuffle instead of window + join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.casts import rounded_ratio

SUM_TYPE = "decimal(38,2)"
REFUND_TYPES = ("refund", "chargeback")


def _sum(c) -> F.Column:
    return F.sum(c).cast(SUM_TYPE)


def daily_revenue(fact_tx: DataFrame) -> DataFrame:
    is_purchase = F.col("transaction_type") == "purchase"
    g = (fact_tx.filter(F.col("status") == "completed")
         .groupBy(F.col("transaction_date").alias("sales_date"))
         .agg(F.count_if(is_purchase).alias("orders"),
              _sum("total").alias("revenue"),
              _sum("tax").alias("tax")))
    return g.withColumn("avg_order_value", rounded_ratio("revenue", "orders"))


def revenue_by_category(items: DataFrame, completed_only_tx: DataFrame | None = None) -> DataFrame:
    """Units and revenue per day and category over *all* items (no status filter,
    as the source defines it).  Pass ``completed_only_tx`` to restrict."""
    src = items
    if completed_only_tx is not None:
        ok = completed_only_tx.filter(F.col("status") == "completed").select("transaction_id")
        src = src.join(ok, "transaction_id", "left_semi")
    return (src.groupBy(F.col("timestamp").cast("date").alias("sales_date"), "category")
            .agg(F.sum("quantity").cast("bigint").alias("units_sold"),
                 _sum("item_subtotal").alias("revenue")))


def refunds_by_category(items: DataFrame, fact_tx: DataFrame) -> DataFrame:
    per_tx = (items.groupBy("transaction_id", "category")
              .agg(F.sum(F.abs("item_subtotal")).alias("amount")))
    tx = (fact_tx.filter(F.col("transaction_type").isin(*REFUND_TYPES)
                         & (F.col("status") == "completed"))
          .select("transaction_id", F.col("transaction_date").alias("sales_date")))
    # after the pre-aggregation each (transaction, category) is one row, so
    # COUNT(DISTINCT transaction_id) per (day, category) is a plain count
    return (per_tx.join(tx, "transaction_id")
            .groupBy("sales_date", "category")
            .agg(F.count("*").alias("refund_count"), _sum("amount").alias("refund_amount")))


def customer_daily_spend(fact_tx: DataFrame, dim_customer: DataFrame) -> DataFrame:
    g = (fact_tx.filter(F.col("status") == "completed")
         .groupBy(F.col("transaction_date").alias("sales_date"), "user_id")
         .agg(F.count("*").alias("orders"), _sum("total").alias("spend")))
    return with_names(g, dim_customer, ["sales_date", "user_id", "customer_name", "email", "orders", "spend"])


def with_names(mart: DataFrame, dim_customer: DataFrame, columns: list[str]) -> DataFrame:
    """A mart by user with the customer's name and address, as they are now."""
    d = dim_customer.select("user_id", F.col("full_name").alias("customer_name"), "email")
    return mart.join(d, "user_id", "left").select(*columns)


RISK_COLS = ["user_id", "event_date", "customer_name", "email", "bill_city", "bill_country", "bill_state", "num_refunds", "num_chargebacks"]


def customer_risk(stg_tx: DataFrame, dim_customer: DataFrame) -> DataFrame:
    return with_names(risk_counts(stg_tx), dim_customer, RISK_COLS)


def risk_counts(stg_tx: DataFrame) -> DataFrame:
    """Refunds, chargebacks and latest billing place per user and day."""
    src = stg_tx.filter((F.col("status") == "completed")
                        & F.col("transaction_type").isin(*REFUND_TYPES))
    loc = F.struct("bill_city", "bill_country", "bill_state")
    # latest by time; equal times broken by the location itself -> total order
    order = F.struct("timestamp", "bill_city", "bill_country", "bill_state")
    g = (src.groupBy("user_id", F.col("timestamp").cast("date").alias("event_date"))
         .agg(F.count_if(F.col("transaction_type") == "refund").alias("num_refunds"),
              F.count_if(F.col("transaction_type") == "chargeback").alias("num_chargebacks"),
              F.max_by(loc, order).alias("loc")))
    return g.select("user_id", "event_date", F.col("loc.bill_city").alias("bill_city"), F.col("loc.bill_country").alias("bill_country"),
                    F.col("loc.bill_state").alias("bill_state"), "num_refunds", "num_chargebacks")


ITEM_STRUCT_FIELDS = ["product_id", "product_name", "category", "brand", "quantity",
                      "unit_price", "item_subtotal", "currency", "line_item_index"]


def refund_items_nested(stg_tx: DataFrame, items: DataFrame) -> DataFrame:
    """Completed refunds/chargebacks with their items as an array ordered by
    line index; a refund without items gets an empty array.

    The array holds the items of one transaction event, so its size is bounded
    by what one source event carries.
    """
    tx = (stg_tx.filter((F.col("status") == "completed")
                        & F.col("transaction_type").isin(*REFUND_TYPES))
          .select("user_id", "transaction_id", "timestamp", "bill_country", "bill_city", "bill_state"))
    # one row per transaction before the join: nothing fans out
    entry = F.struct(F.col("line_item_index").alias("k"), F.struct(*ITEM_STRUCT_FIELDS).alias("v"))
    per_tx = (items.join(tx.select("transaction_id").distinct(), "transaction_id", "left_semi")
              .groupBy("transaction_id").agg(F.transform(F.sort_array(F.collect_list(entry)), lambda x: x["v"]).alias("purchase_items")))
    kind = per_tx.schema["purchase_items"].dataType
    return tx.join(per_tx, "transaction_id", "left").select(
        "user_id", "transaction_id", "timestamp", "bill_country", "bill_city", "bill_state",
        F.coalesce("purchase_items", F.array().cast(kind)).alias("purchase_items"))
