"""Fixed source schemas (no per-batch inference: an optional field that is
absent from a whole batch must not make its column disappear)."""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, BooleanType, DecimalType, LongType, StringType,
                               StructField, StructType)

CORRUPT = "_corrupt_record"
MONEY = DecimalType(18, 2)


def _s(*names):
    return [StructField(n, StringType()) for n in names]


ADDRESS = StructType(_s("street", "city", "state", "zip_code", "country"))
LINE_ITEM = StructType(_s("product_id", "product_name", "category", "brand") + [
    StructField("quantity", LongType()), StructField("unit_price", MONEY)])

TRANSACTION_EVENT = StructType(
    _s("transaction_id", "user_id", "transaction_type", "timestamp", "status", "payment_method",
       "currency")
    + [StructField("line_items", ArrayType(LINE_ITEM)),
       StructField("subtotal", MONEY), StructField("tax", MONEY), StructField("total", MONEY),
       StructField("billing_address", ADDRESS), StructField("shipping_address", ADDRESS)]
    + _s("original_transaction_id"))

USER_EVENT = StructType(
    _s("event_id", "user_id", "session_id", "event_type", "timestamp", "page", "device", "browser",
       "ip_address", "country", "city", "search_query", "element_id", "product_id")
    + [StructField("quantity", LongType())])

# text-or-number fields are read as text; silver casts them with try_ helpers
CUSTOMER = StructType(_s("user_id", "email", "first_name", "last_name", "registration_date",
                         "account_type", "date_of_birth", "loyalty_points", "state"))
PRODUCT = StructType(_s("product_id", "product_name", "category", "subcategory", "brand",
                        "manufacturer", "msrp", "cost_price", "created_date")
                     + [StructField("is_active", BooleanType())])

# topic / landing sub-folder -> schema (fixed values)
TOPICS = {
    "transaction_events": TRANSACTION_EVENT,
    "user_events": USER_EVENT,
    "customers": CUSTOMER,
    "products": PRODUCT,
}

