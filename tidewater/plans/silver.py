"""Silver builds (TB1-TB5): typed, keyed tables read out of bronze VARIANT rows.

Every field is a path lookup with ``try_variant_get`` and a ``try_`` cast, so
a missing path or bad text becomes NULL (then the silver default), never a
failed job.  Items are the line-item array exploded with its 0-based index.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.casts import try_date, try_decimal, try_number, try_timestamp_ntz


def vs(path: str, col: str = "raw") -> F.Column:
    """raw:path::STRING"""
    return F.try_variant_get(F.col(col), path, "string")


def _stamp(as_of):
    return (as_of if as_of is not None else F.current_timestamp()).alias("processed_at")


def silver_transactions(bronze: DataFrame, as_of=None) -> DataFrame:
    return bronze.select(
        vs("$.transaction_id").alias("transaction_id"),
        vs("$.user_id").alias("user_id"),
        vs("$.transaction_type").alias("transaction_type"),
        try_timestamp_ntz(vs("$.timestamp")).alias("timestamp"),
        vs("$.status").alias("status"),
        vs("$.payment_method").alias("payment_method"),
        vs("$.currency").alias("currency"),
        F.coalesce(vs("$.original_transaction_id"), F.lit("None")).alias("original_transaction_id"),
        try_decimal(vs("$.subtotal")).alias("subtotal"),
        try_decimal(vs("$.tax")).alias("tax"),
        try_decimal(vs("$.total")).alias("total"),
        vs("$.billing_address.city").alias("bill_city"),
        vs("$.billing_address.state").alias("bill_state"),
        vs("$.billing_address.country").alias("bill_country"),
        vs("$.shipping_address.city").alias("ship_city"),
        vs("$.shipping_address.country").alias("ship_country"),
        _stamp(as_of),
    )


def silver_transaction_items(bronze: DataFrame, as_of=None) -> DataFrame:
    """LATERAL FLATTEN of ``line_items``: inner (no items -> no rows), 0-based.

    What an item takes from its transaction is looked up once, before the items are told apart.
    """
    exploded = bronze.select(
        vs("$.transaction_id").alias("transaction_id"),
        vs("$.user_id").alias("user_id"),
        try_timestamp_ntz(vs("$.timestamp")).alias("timestamp"),
        vs("$.currency").alias("currency"),
        F.posexplode(F.try_variant_get(F.col("raw"), "$.line_items", "array<variant>"))
         .alias("line_item_index", "item"))
    qty = try_number(vs("$.quantity", "item"))
    price = try_decimal(vs("$.unit_price", "item"))
    return exploded.select(
        "transaction_id",
        F.col("line_item_index").cast("int").alias("line_item_index"),
        "user_id",
        "timestamp",
        "currency",
        vs("$.product_id", "item").alias("product_id"),
        vs("$.product_name", "item").alias("product_name"),
        vs("$.category", "item").alias("category"),
        vs("$.brand", "item").alias("brand"),
        qty.cast("bigint").alias("quantity"),
        price.alias("unit_price"),
        (qty * price).cast("decimal(18,2)").alias("item_subtotal"),
        _stamp(as_of),
    )


def silver_user_events(bronze: DataFrame, as_of=None) -> DataFrame:
    return bronze.select(
        vs("$.event_id").alias("event_id"),
        vs("$.event_type").alias("event_type"),
        try_timestamp_ntz(vs("$.timestamp")).alias("timestamp"),
        vs("$.user_id").alias("user_id"),
        vs("$.session_id").alias("session_id"),
        vs("$.page").alias("page"),
        vs("$.device").alias("device"),
        vs("$.browser").alias("browser"),
        vs("$.country").alias("country"),
        vs("$.city").alias("city"),
        F.coalesce(vs("$.product_id"), F.lit("None")).alias("product_id"),
        F.coalesce(try_number(vs("$.quantity")), F.lit(0)).cast("int").alias("quantity"),
        _stamp(as_of),
    )


def silver_customers(bronze: DataFrame, as_of=None) -> DataFrame:
    return bronze.select(
        vs("$.user_id").alias("user_id"),
        vs("$.email").alias("email"),
        vs("$.first_name").alias("first_name"),
        vs("$.last_name").alias("last_name"),
        try_date(vs("$.registration_date")).alias("registration_date"),
        vs("$.account_type").alias("account_type"),
        try_date(vs("$.date_of_birth")).alias("date_of_birth"),
        F.coalesce(try_number(vs("$.loyalty_points")), F.lit(0)).cast("bigint").alias("loyalty_points"),
        vs("$.state").alias("state"),
        _stamp(as_of),
    )


def silver_products(bronze: DataFrame, as_of=None, strict_boolean: bool = False) -> DataFrame:
    """``is_active`` is a hard boolean cast in the source (bad text fails the
    load): ``strict_boolean=True`` keeps that; default turns bad text to TRUE."""
    get = F.variant_get if strict_boolean else F.try_variant_get
    return bronze.select(
        vs("$.product_id").alias("product_id"),
        vs("$.product_name").alias("product_name"),
        vs("$.category").alias("category"),
        vs("$.subcategory").alias("subcategory"),
        vs("$.brand").alias("brand"),
        vs("$.manufacturer").alias("manufacturer"),
        try_decimal(vs("$.msrp")).alias("msrp"),
        try_decimal(vs("$.cost_price")).alias("cost_price"),
        try_date(vs("$.created_date")).alias("created_date"),
        F.coalesce(get(F.col("raw"), "$.is_active", "boolean"), F.lit(True)).alias("is_active"),
        _stamp(as_of),
    )
