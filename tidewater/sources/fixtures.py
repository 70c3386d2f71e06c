"""Driver tables reshaped into the pipeline's silver shapes.

The commerce sources (transaction events, user events, customers, products)
are not part of the driver data, so each is *derived* from the TPC-H-like
tables by fixed column rules.  Every rule below has a twin in
``tidewater.oracle`` written in DuckDB SQL; the two must stay in step.

With ``defaults=False`` the frames keep the source shape: optional fields that
an event does not carry are NULL (and are left out of packed JSON), and no
silver defaults are applied.  ``processed_at`` is a deterministic load-time
stand-in so keep-latest results can be checked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators.joins import broadcast_if_small
from tidewater.sources.tables import table

# fixed values of the reshaping rules
FIXED_PROCESSED_AT = "2024-02-01 00:00:00"
REFUND_PRIORITY = "1-URGENT"
CHARGEBACK_PRIORITY = "2-HIGH"


def _geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation + region: a fixed-size 25-row lookup (broadcast is size-checked)."""
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return n.join(broadcast_if_small(r), n.n_regionkey == r.r_regionkey, "left") \
            .select("n_nationkey", "n_name", "r_name")


def stg_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    g = broadcast_if_small(_geo(spark, sf_dir).select("n_nationkey", "n_name"))
    k = F.col("c_custkey")
    return (c.join(g, c.c_nationkey == g.n_nationkey, "left")
            .select(
                k.cast("string").alias("user_id"),
                F.when(k % 10 == 0, F.lit(None).cast("string"))
                 .otherwise(F.concat(F.lit("u"), k.cast("string"), F.lit("@example.com"))).alias("email"),
                F.lit("Customer").alias("first_name"),
                F.substring("c_name", 10, 1 << 20).alias("last_name"),
                F.date_add(F.lit("2020-01-01").cast("date"), (k % 1000).cast("int")).alias("registration_date"),
                F.lower("c_mktsegment").alias("account_type"),
                F.date_add(F.lit("1960-01-01").cast("date"), ((k * 37) % 15000).cast("int")).alias("date_of_birth"),
                F.floor("c_acctbal").cast("bigint").alias("loyalty_points"),
                F.col("n_name").alias("state"),
                F.lit(FIXED_PROCESSED_AT).cast("timestamp_ntz").alias("processed_at"),
            ))


def stg_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    msrp = F.col("p_retailprice").cast("decimal(18,2)")
    return p.select(
        k.cast("string").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.concat(F.lit("S"), F.col("p_size").cast("string")).alias("subcategory"),
        F.col("p_brand").alias("brand"),
        F.concat(F.lit("Manufacturer#"), (k % 5).cast("string")).alias("manufacturer"),
        msrp.alias("msrp"),
        (msrp - F.lit(1).cast("decimal(18,2)")).cast("decimal(18,2)").alias("cost_price"),
        F.date_add(F.lit("2020-01-01").cast("date"), (k % 730).cast("int")).alias("created_date"),
        (k % 7 != 0).alias("is_active"),
        F.lit(FIXED_PROCESSED_AT).cast("timestamp_ntz").alias("processed_at"),
    )


def stg_transactions(spark: SparkSession, sf_dir: str, defaults: bool = True) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    g = broadcast_if_small(_geo(spark, sf_dir))
    cust = c.join(g, c.c_nationkey == g.n_nationkey, "left")
    # customer is as large as the data grows: a shuffled (or AQE) join, no hint
    j = o.join(cust, o.o_custkey == cust.c_custkey, "left")
    k = F.col("o_orderkey")
    ttype = (F.when(F.col("o_orderpriority") == REFUND_PRIORITY, "refund")
             .when(F.col("o_orderpriority") == CHARGEBACK_PRIORITY, "chargeback")
             .otherwise("purchase"))
    gross = F.col("o_totalprice").cast("decimal(18,2)")
    tax = ((k % 100000).cast("decimal(18,0)") * F.lit(0.01).cast("decimal(3,2)")).cast("decimal(18,2)")
    orig = F.when(ttype != "purchase", (k - 1).cast("string"))
    if defaults:
        orig = F.coalesce(orig, F.lit("None"))
    city = F.concat(F.lit("City"), (F.col("c_custkey") % 50).cast("string"))
    country = F.when(F.col("r_name") == "AMERICA", "US").otherwise(F.col("r_name"))
    return j.select(
        k.cast("string").alias("transaction_id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        ttype.alias("transaction_type"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("timestamp"),
        (F.when(F.col("o_orderstatus") == "F", "completed")
         .when(F.col("o_orderstatus") == "O", "pending").otherwise("failed")).alias("status"),
        (F.when(k % 7 == 0, F.lit(None).cast("string")).when(k % 7 == 1, "paypal")
         .when(k % 7 == 2, "debit_card").otherwise("credit_card")).alias("payment_method"),
        F.lit("USD").alias("currency"),
        orig.alias("original_transaction_id"),
        (gross - tax).cast("decimal(18,2)").alias("subtotal"),
        tax.alias("tax"),
        F.when(ttype == "purchase", gross).otherwise(-gross).cast("decimal(18,2)").alias("total"),
        city.alias("bill_city"),
        F.col("n_name").alias("bill_state"),
        country.alias("bill_country"),
        city.alias("ship_city"),
        country.alias("ship_country"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("processed_at"),
    )


def stg_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their transaction's user and time.

    (transaction_id, line_item_index) is *not* unique in the driver data; the
    tie columns make keep-latest deterministic.
    """
    # the join with the orders comes last and is on the text id, so its shuffle also serves what groups by transaction_id
    li = table(spark, sf_dir, "lineitem").withColumn("transaction_id", F.col("l_orderkey").cast("string"))
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("order_id"), "o_custkey", "o_orderdate")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_brand", "p_retailprice")
    hinted = broadcast_if_small(p)
    if hinted is p:
        j = li.join(p, li.l_partkey == p.p_partkey, "left").join(o, li.transaction_id == o.order_id, "left")
    else:  # a broadcast join needs no shuffle, so it comes behind the other's, which then carries no names
        j = li.join(o, li.transaction_id == o.order_id, "left").join(hinted, li.l_partkey == p.p_partkey, "left")
    qty = F.col("l_quantity").cast("bigint")
    price = F.col("p_retailprice").cast("decimal(18,2)")
    return j.select(
        "transaction_id",
        (F.col("l_linenumber") - 1).cast("int").alias("line_item_index"),
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("timestamp"),
        F.lit("USD").alias("currency"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        qty.alias("quantity"),
        price.alias("unit_price"),
        (qty * price).cast("decimal(18,2)").alias("item_subtotal"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("processed_at"),
        F.col("l_suppkey").alias("tie1"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("tie2"),
        F.col("l_discount").cast("decimal(18,2)").alias("tie3"),
        F.col("l_tax").cast("decimal(18,2)").alias("tie4"),
    )


def stg_user_events(spark: SparkSession, sf_dir: str, defaults: bool = True) -> DataFrame:
    e = table(spark, sf_dir, "events")
    k = F.col("event_id")
    et = (F.when(F.col("event_type") == "view", "page_view")
          .when(F.col("event_type") == "purchase", "add_to_cart")
          .when(F.col("event_type") == "error", "remove_from_cart")
          .when(F.col("event_type") == "signup", "login")
          .otherwise(F.col("event_type")))
    cart = F.col("event_type").isin("purchase", "error")
    product = F.when(cart, (k % 200).cast("string"))
    qty = F.when(cart, (F.get_json_object("props", "$.k").cast("bigint") % 5 + 1).cast("int"))
    if defaults:
        product = F.coalesce(product, F.lit("None"))
        qty = F.coalesce(qty, F.lit(0))
    return e.select(
        k.cast("string").alias("event_id"),
        et.alias("event_type"),
        F.col("ts").cast("timestamp_ntz").alias("timestamp"),
        F.col("user_id").cast("string").alias("user_id"),
        F.concat(F.col("user_id").cast("string"), F.lit("-"),
                 F.col("ts").cast("date").cast("string")).alias("session_id"),
        (F.when(k % 4 == 0, "home").when(k % 4 == 1, "cart").when(k % 4 == 2, "products")
         .otherwise("checkout")).alias("page"),
        (F.when(k % 3 == 0, "desktop").when(k % 3 == 1, "mobile").otherwise("tablet")).alias("device"),
        (F.when(k % 4 == 0, "chrome").when(k % 4 == 1, "firefox").when(k % 4 == 2, "safari")
         .otherwise("edge")).alias("browser"),
        (F.when(F.col("user_id") % 5 == 0, "CA").otherwise("US")).alias("country"),
        F.concat(F.lit("City"), (F.col("user_id") % 50).cast("string")).alias("city"),
        product.alias("product_id"),
        qty.alias("quantity"),
        F.col("ts").cast("timestamp_ntz").alias("processed_at"),
    )
