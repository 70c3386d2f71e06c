"""Gold facts: keep-latest views of the silver tables (TB9-TB11)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.operators.latest import keep_latest

#: newest event wins; equal times go by these columns first, then by all the others
TX_TIES = ["status", "total"]
ITEM_TIES = ["product_id", "quantity"]
#: columns that come from a dimension and that many marts do not read
TX_LAST = ["bill_country", "bill_city", "bill_state"]
ITEM_LAST = ["product_name", "category", "brand"]
EVENT_TIES = ["event_type", "page"]

FACT_TRANSACTION_COLS = [
    "transaction_id", "user_id", "transaction_ts", "transaction_date", "transaction_type",
    "status", "payment_method", "tax", "total", "subtotal",
    "billing_country", "billing_city", "billing_state",
]
ITEM_COLS = [
    "transaction_id", "user_id", "timestamp", "product_id", "product_name", "category", "brand",
    "quantity", "unit_price", "item_subtotal", "currency", "line_item_index",
]
USER_EVENT_COLS = [
    "event_id", "event_type", "timestamp", "user_id", "session_id", "page", "device",
    "browser", "country", "city", "product_id", "quantity",
]


def fact_transactions(stg_transactions: DataFrame) -> DataFrame:
    return project_transactions(keep_latest(stg_transactions.filter(F.col("timestamp").isNotNull()),
                                            "transaction_id", ["processed_at", "timestamp"], tie_breakers=TX_TIES,
                                            settled_last=[c for c in [*TX_LAST, "ship_city", "ship_country"] if c in stg_transactions.columns]))


def project_transactions(latest: DataFrame) -> DataFrame:
    """Fact columns of silver rows that hold each key once."""
    return latest.select(
        "transaction_id", "user_id",
        F.col("timestamp").alias("transaction_ts"),
        F.col("timestamp").cast("date").alias("transaction_date"),
        "transaction_type", "status", "payment_method", "tax", "total", "subtotal",
        F.col("bill_country").alias("billing_country"),
        F.col("bill_city").alias("billing_city"),
        F.col("bill_state").alias("billing_state"),
    )


def transaction_items(stg_items: DataFrame, only_transactions: DataFrame | None = None, all_read: bool = False) -> DataFrame:
    """Latest row per (transaction_id, line_item_index).

    ``only_transactions`` (a frame with ``transaction_id``) restricts the build
    to those transactions *before* the keep-latest sort.  The window is
    partitioned by a key that contains transaction_id, so filtering on it
    first gives the same rows; the semi join's hash partitioning on
    transaction_id also satisfies the window, so no extra shuffle is added.
    ``all_read``: the reader takes the product's columns, too.
    """
    src = stg_items.filter(F.col("transaction_id").isNotNull() & F.col("line_item_index").isNotNull())
    if only_transactions is not None:
        src = src.join(only_transactions.select("transaction_id").distinct(), "transaction_id", "left_semi")
    return keep_latest(src, ["transaction_id", "line_item_index"], ["processed_at", "timestamp"],
                       tie_breakers=ITEM_TIES, settled_last=ITEM_LAST, all_read=all_read).select(*ITEM_COLS)


def fact_user_events(stg_user_events: DataFrame) -> DataFrame:
    src = stg_user_events.filter(F.col("event_id").isNotNull())
    return keep_latest(src, "event_id", ["processed_at", "timestamp"], tie_breakers=EVENT_TIES).select(*USER_EVENT_COLS)
