"""Query registry: key -> Spark builder over (spark, sf_dir), and key -> DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater import oracle as O
from tidewater.plans import dims, facts, marts
from tidewater.session import apply_core_conf
from tidewater.sources import fixtures as fx
from tidewater.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
BODY: dict[str, str] = {}   # oracle SQL without the shared WITH chain


def query(key: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_core_conf(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        if sql is not None:
            BODY[key] = sql
            ORACLE[key] = O.with_chain(sql)
        return fn
    return deco


# ---------------------------------------------------------------- gold builds

def _fact_tx(spark, sf):
    return facts.fact_transactions(fx.stg_transactions(spark, sf))


def _items(spark, sf):
    return facts.transaction_items(fx.stg_items(spark, sf))


def _dim_customer(spark, sf):
    return dims.dim_customer(fx.stg_customers(spark, sf))


def _refund_ids(spark, sf):
    """Completed refunds/chargebacks: the only transactions the refund marts read."""
    t = fx.stg_transactions(spark, sf)
    return t.filter((F.col("status") == "completed")
                    & F.col("transaction_type").isin(*marts.REFUND_TYPES)).select("transaction_id")


def _refund_items(spark, sf):
    return facts.transaction_items(fx.stg_items(spark, sf), only_transactions=_refund_ids(spark, sf))


@query("fact_transactions", "SELECT * FROM fact_transactions")
def q_fact_transactions(spark, sf):
    return _fact_tx(spark, sf)


@query("transaction_items", "SELECT * FROM transaction_items")
def q_transaction_items(spark, sf):
    return _items(spark, sf)


@query("fact_user_events", "SELECT * FROM fact_user_events")
def q_fact_user_events(spark, sf):
    return facts.fact_user_events(fx.stg_user_events(spark, sf))


@query("dim_customer", "SELECT * FROM dim_customer")
def q_dim_customer(spark, sf):
    return _dim_customer(spark, sf).drop("processed_at")


@query("dim_product", "SELECT * FROM dim_product")
def q_dim_product(spark, sf):
    return dims.dim_product(fx.stg_products(spark, sf)).drop("processed_at")


@query("dim_date", """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS date_value,
  CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
  CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name, CAST(day(d) AS INTEGER) AS day,
  CAST(weekofyear(d) AS INTEGER) AS week_of_year, CAST(isodow(d) AS INTEGER) AS day_of_week,
  strftime(d, '%a') AS day_name, isodow(d) IN (6, 7) AS is_weekend
FROM (SELECT CAST(unnest(generate_series(min_d, max_d, INTERVAL 1 DAY)) AS DATE) AS d
      FROM (SELECT CAST(MIN(CAST(timestamp AS DATE)) - 30 AS DATE) AS min_d,
                   CAST(MAX(CAST(timestamp AS DATE)) + 30 AS DATE) AS max_d
            FROM stg_transactions WHERE timestamp IS NOT NULL) b
      WHERE min_d IS NOT NULL)""")
def q_dim_date(spark, sf):
    return dims.dim_date(fx.stg_transactions(spark, sf))


@query("daily_revenue", f"""
SELECT transaction_date AS sales_date,
  CAST(COUNT_IF(transaction_type = 'purchase') AS BIGINT) AS orders,
  CAST(SUM(total) AS DECIMAL(38,2)) AS revenue,
  CAST(SUM(tax) AS DECIMAL(38,2)) AS tax,
  {O.cents_ratio('SUM(total)', "COUNT_IF(transaction_type = 'purchase')")} AS avg_order_value
FROM fact_transactions WHERE status = 'completed' GROUP BY transaction_date""")
def q_daily_revenue(spark, sf):
    """Flagship: completed transactions -> revenue, tax, orders, AOV per day."""
    return marts.daily_revenue(_fact_tx(spark, sf))


@query("revenue_by_category", """
SELECT CAST(timestamp AS DATE) AS sales_date, category,
  CAST(SUM(quantity) AS BIGINT) AS units_sold, CAST(SUM(item_subtotal) AS DECIMAL(38,2)) AS revenue
FROM transaction_items GROUP BY 1, 2""")
def q_revenue_by_category(spark, sf):
    return marts.revenue_by_category(_items(spark, sf))


@query("refunds_by_category", """
SELECT transaction_date AS sales_date, category, COUNT(*) AS refund_count, CAST(SUM(amount) AS DECIMAL(38,2)) AS refund_amount
FROM (SELECT transaction_id, category, SUM(CASE WHEN item_subtotal < 0 THEN -item_subtotal ELSE item_subtotal END) AS amount
      FROM transaction_items GROUP BY ALL) amounts
NATURAL JOIN (SELECT transaction_id, transaction_date FROM fact_transactions
              WHERE status = 'completed' AND transaction_type IN ('refund', 'chargeback')) returned
GROUP BY ALL""")
def q_refunds_by_category(spark, sf):
    return marts.refunds_by_category(_refund_items(spark, sf), _fact_tx(spark, sf))


@query("customer_daily_spend", """
SELECT f.transaction_date AS sales_date, f.user_id, d.full_name AS customer_name, d.email AS email,
  CAST(COUNT(*) AS BIGINT) AS orders, CAST(SUM(f.total) AS DECIMAL(38,2)) AS spend
FROM fact_transactions f LEFT JOIN dim_customer d ON f.user_id = d.user_id
WHERE f.status = 'completed'
GROUP BY 1, 2, 3, 4""")
def q_customer_daily_spend(spark, sf):
    return marts.customer_daily_spend(_fact_tx(spark, sf), _dim_customer(spark, sf))


@query("customer_risk", """
SELECT user_id, event_date, full_name AS customer_name, email, place.c AS bill_city, place.n AS bill_country,
  place.s AS bill_state, num_refunds, num_chargebacks
FROM (SELECT user_id, timestamp::DATE AS event_date, COUNT(*) FILTER (transaction_type = 'refund') AS num_refunds,
        COUNT(*) FILTER (transaction_type = 'chargeback') AS num_chargebacks,
        max(struct_pack(t := timestamp, c := bill_city, n := bill_country, s := bill_state)) AS place
      FROM stg_transactions WHERE status = 'completed' AND transaction_type IN ('refund', 'chargeback')
      GROUP BY 1, 2) days
LEFT JOIN (SELECT user_id, full_name, email FROM dim_customer) USING (user_id)""")
def q_customer_risk(spark, sf):
    return marts.customer_risk(fx.stg_transactions(spark, sf), _dim_customer(spark, sf))


@query("refund_items_nested", """
SELECT user_id, transaction_id, timestamp, bill_country, bill_city, bill_state, ifnull(purchase_items, []) AS purchase_items
FROM stg_transactions LEFT JOIN (
  SELECT transaction_id, list(struct_pack(product_id, product_name, category, brand, quantity, unit_price,
                                          item_subtotal, currency, line_item_index) ORDER BY line_item_index) AS purchase_items
  FROM transaction_items GROUP BY transaction_id) bought USING (transaction_id)
WHERE status = 'completed' AND transaction_type IN ('refund', 'chargeback')""")
def q_refund_items_nested(spark, sf):
    return marts.refund_items_nested(fx.stg_transactions(spark, sf), _refund_items(spark, sf))


# ----------------------------------------------------------- single operators

from tidewater.functions.casts import rounded_ratio, try_decimal, try_number  # noqa: E402
from tidewater.operators import clean  # noqa: E402
from tidewater.operators.latest import keep_latest  # noqa: E402
from tidewater.plans import analytics as A  # noqa: E402

_UE_SRC_COLS = ", ".join(O.UE_COLS)


@query("drop_na", "SELECT * FROM src_user_events WHERE product_id IS NOT NULL AND quantity IS NOT NULL")
def q_drop_na(spark, sf):
    return clean.drop_na(fx.stg_user_events(spark, sf, defaults=False), ["product_id", "quantity"])


@query("fill_na", "SELECT * REPLACE (COALESCE(payment_method, 'USD') AS payment_method) FROM src_transactions")
def q_fill_na(spark, sf):
    return clean.fill_na(fx.stg_transactions(spark, sf, defaults=False), clean.TRANSACTION_FILL)


@query("drop_duplicates", """
SELECT transaction_id, line_item_index, product_id, quantity FROM (
  SELECT transaction_id, line_item_index, product_id, quantity,
    ROW_NUMBER() OVER (PARTITION BY transaction_id, line_item_index
                       ORDER BY product_id ASC NULLS FIRST, quantity ASC NULLS FIRST) AS rn
  FROM stg_items) WHERE rn = 1""")
def q_drop_duplicates(spark, sf):
    src = fx.stg_items(spark, sf).select("transaction_id", "line_item_index", "product_id", "quantity")
    return clean.drop_duplicates(src, ["transaction_id", "line_item_index"])


_TX_EVENT_FLAT = """
SELECT t.* REPLACE (COALESCE(payment_method, 'USD') AS payment_method),
  CAST(t.timestamp AS DATE) AS event_date, n.item_count
FROM src_transactions t
JOIN (SELECT transaction_id, CAST(COUNT(*) AS INTEGER) AS item_count FROM transaction_items GROUP BY 1) n
  USING (transaction_id)"""


def _flat_tx_events(df):
    return df.withColumn("item_count", F.size("line_items")).drop("line_items")


@query("standardize_transactions", _TX_EVENT_FLAT)
def q_standardize_transactions(spark, sf):
    """Typed transaction events (with their item arrays) through the standard
    cleaning chain; output flattened for comparison."""
    from tidewater.sources.landing import pack_transaction_events  # typed, before JSON
    tx = fx.stg_transactions(spark, sf, defaults=False)
    ev = tx.join(pack_transaction_events(tx, _items(spark, sf))
                 .select("transaction_id", "line_items"), "transaction_id", "left")
    out = clean.standardize(ev, clean.TRANSACTION_REQUIRED, clean.TRANSACTION_FILL,
                            clean.TRANSACTION_KEY)
    out = out.withColumn("event_date", F.col("timestamp").cast("date"))
    return _flat_tx_events(out)


@query("standardize_user_events", f"SELECT *, CAST(timestamp AS DATE) AS event_date FROM src_user_events")
def q_standardize_user_events(spark, sf):
    return clean.standardize_user_events(fx.stg_user_events(spark, sf, defaults=False))


@query("coalesce_defaults", "SELECT * FROM stg_user_events")
def q_coalesce_defaults(spark, sf):
    src = fx.stg_user_events(spark, sf, defaults=False)
    return clean.coalesce_defaults(src, {"product_id": "None", "quantity": 0})


@query("item_subtotal", """
SELECT transaction_id, line_item_index, tie1,
  CAST(CAST(quantity AS DECIMAL(18,0)) * unit_price AS DECIMAL(38,2)) AS item_subtotal
FROM stg_items""")
def q_item_subtotal(spark, sf):
    """quantity (TRY_TO_NUMBER of its text) x unit_price (TRY_TO_NUMBER(.,18,2))."""
    src = fx.stg_items(spark, sf)
    q = try_number(F.col("quantity").cast("string"))
    p = try_decimal(F.col("unit_price").cast("string"))
    return src.select("transaction_id", "line_item_index", "tie1",
                      (q * p).cast("decimal(38,2)").alias("item_subtotal"))


DYNAMIC_SPEC = {
    "add": {"net_amount": "CAST(total - tax AS DECIMAL(18,2))"},
    "cast": {"transaction_date": "string"},
    "rename": {"total": "amount", "billing_country": "country"},
    "drop": ["subtotal", "billing_city", "billing_state"],
}


@query("dynamic_columns", """
SELECT transaction_id, user_id, transaction_ts, CAST(transaction_date AS VARCHAR) AS transaction_date,
  transaction_type, status, payment_method, tax, total AS amount, billing_country AS country,
  CAST(total - tax AS DECIMAL(18,2)) AS net_amount
FROM fact_transactions""")
def q_dynamic_columns(spark, sf):
    return clean.dynamic_columns(_fact_tx(spark, sf), DYNAMIC_SPEC)


@query("filter_completed", "SELECT * FROM fact_transactions WHERE status = 'completed'")
def q_filter_completed(spark, sf):
    return _fact_tx(spark, sf).filter(F.col("status") == "completed")


@query("filter_not_null", "SELECT * FROM src_transactions WHERE original_transaction_id IS NOT NULL")
def q_filter_not_null(spark, sf):
    return fx.stg_transactions(spark, sf, defaults=False).filter(F.col("original_transaction_id").isNotNull())


@query("join_inner", """
SELECT i.transaction_id, i.line_item_index, i.category, i.item_subtotal, f.transaction_date,
  f.transaction_type
FROM transaction_items i JOIN fact_transactions f ON f.transaction_id = i.transaction_id""")
def q_join_inner(spark, sf):
    f = _fact_tx(spark, sf).select("transaction_id", "transaction_date", "transaction_type")
    return _items(spark, sf).select("transaction_id", "line_item_index", "category",
                                    "item_subtotal").join(f, "transaction_id")


@query("join_left_dim", """
SELECT f.transaction_id, f.user_id, f.total, d.full_name, d.email
FROM fact_transactions f LEFT JOIN dim_customer d ON f.user_id = d.user_id""")
def q_join_left_dim(spark, sf):
    d = _dim_customer(spark, sf).select("user_id", "full_name", "email")
    return _fact_tx(spark, sf).select("transaction_id", "user_id", "total").join(d, "user_id", "left")


@query("join_anti", """
SELECT e.event_id, e.user_id, e.timestamp FROM fact_user_events e
WHERE e.event_type = 'add_to_cart' AND NOT EXISTS (
  SELECT 1 FROM fact_transactions f
  WHERE f.user_id = e.user_id AND f.status = 'completed' AND f.transaction_type = 'purchase')""")
def q_join_anti(spark, sf):
    """Cart events of users who never completed a purchase."""
    ev = facts.fact_user_events(fx.stg_user_events(spark, sf)).filter(F.col("event_type") == "add_to_cart")
    buyers = _fact_tx(spark, sf).filter((F.col("status") == "completed")
                                        & (F.col("transaction_type") == "purchase")).select("user_id")
    return ev.select("event_id", "user_id", "timestamp").join(buyers, "user_id", "left_anti")


@query("agg_count", """
SELECT transaction_type, status, CAST(COUNT(*) AS BIGINT) AS n FROM fact_transactions GROUP BY 1, 2""")
def q_agg_count(spark, sf):
    return _fact_tx(spark, sf).groupBy("transaction_type", "status").agg(F.count("*").alias("n"))


@query("agg_count_distinct", """
SELECT category, CAST(COUNT(DISTINCT transaction_id) AS BIGINT) AS transactions
FROM transaction_items GROUP BY 1""")
def q_agg_count_distinct(spark, sf):
    return _items(spark, sf).groupBy("category").agg(F.count_distinct("transaction_id").alias("transactions"))


@query("agg_count_if", """
SELECT transaction_date,
  CAST(COUNT_IF(transaction_type = 'purchase') AS BIGINT) AS purchases,
  CAST(COUNT_IF(transaction_type = 'refund') AS BIGINT) AS refunds,
  CAST(COUNT_IF(transaction_type = 'chargeback') AS BIGINT) AS chargebacks
FROM fact_transactions GROUP BY 1""")
def q_agg_count_if(spark, sf):
    t = F.col("transaction_type")
    return _fact_tx(spark, sf).groupBy("transaction_date").agg(
        F.count_if(t == "purchase").alias("purchases"), F.count_if(t == "refund").alias("refunds"),
        F.count_if(t == "chargeback").alias("chargebacks"))


@query("agg_sum", """
SELECT billing_country, CAST(SUM(total) AS DECIMAL(38,2)) AS total, CAST(SUM(tax) AS DECIMAL(38,2)) AS tax
FROM fact_transactions GROUP BY 1""")
def q_agg_sum(spark, sf):
    return _fact_tx(spark, sf).groupBy("billing_country").agg(
        F.sum("total").cast("decimal(38,2)").alias("total"), F.sum("tax").cast("decimal(38,2)").alias("tax"))


@query("agg_sum_abs", """
SELECT transaction_type, CAST(SUM(ABS(total)) AS DECIMAL(38,2)) AS gross FROM fact_transactions GROUP BY 1""")
def q_agg_sum_abs(spark, sf):
    return _fact_tx(spark, sf).groupBy("transaction_type").agg(
        F.sum(F.abs("total")).cast("decimal(38,2)").alias("gross"))


@query("agg_safe_ratio", f"""
SELECT payment_method, CAST(SUM(total) AS DECIMAL(38,2)) AS revenue,
  CAST(COUNT_IF(transaction_type = 'purchase') AS BIGINT) AS orders,
  {O.cents_ratio('SUM(total)', "COUNT_IF(transaction_type = 'purchase')")} AS avg_order_value
FROM fact_transactions WHERE status = 'completed' GROUP BY 1""")
def q_agg_safe_ratio(spark, sf):
    g = (_fact_tx(spark, sf).filter(F.col("status") == "completed").groupBy("payment_method")
         .agg(F.sum("total").cast("decimal(38,2)").alias("revenue"),
              F.count_if(F.col("transaction_type") == "purchase").alias("orders")))
    return g.withColumn("avg_order_value", rounded_ratio("revenue", "orders"))


@query("agg_bounds", """
SELECT MIN(transaction_date) AS min_date, MAX(transaction_date) AS max_date,
  MIN(total) AS min_total, MAX(total) AS max_total FROM fact_transactions""")
def q_agg_bounds(spark, sf):
    return _fact_tx(spark, sf).agg(F.min("transaction_date").alias("min_date"),
                                   F.max("transaction_date").alias("max_date"),
                                   F.min("total").alias("min_total"), F.max("total").alias("max_total"))


@query("agg_nested_items", """
SELECT tr.transaction_id,
  COALESCE(string_agg(CAST(it.line_item_index AS VARCHAR) || ':' || it.product_id || ':'
                      || CAST(it.quantity AS VARCHAR) || ':' || CAST(it.unit_price AS VARCHAR), ';'
                      ORDER BY it.line_item_index), '') AS items_text,
  CAST(COUNT(it.transaction_id) AS INTEGER) AS item_count
FROM stg_transactions tr LEFT JOIN transaction_items it ON it.transaction_id = tr.transaction_id
WHERE tr.status = 'completed' AND tr.transaction_type IN ('refund', 'chargeback')
GROUP BY 1""")
def q_agg_nested_items(spark, sf):
    """The ordered item array of each refund, rendered as canonical text."""
    nested = marts.refund_items_nested(fx.stg_transactions(spark, sf), _refund_items(spark, sf))
    text = F.array_join(F.transform("purchase_items", lambda x: F.concat_ws(
        ":", x["line_item_index"].cast("string"), x["product_id"], x["quantity"].cast("string"),
        x["unit_price"].cast("string"))), ";")
    return nested.select("transaction_id", text.alias("items_text"),
                         F.size("purchase_items").alias("item_count"))


@query("keep_latest", """
SELECT user_id, event_id, event_type, timestamp FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY timestamp DESC NULLS LAST,
                               event_id ASC NULLS FIRST, event_type ASC NULLS FIRST) AS rn
  FROM fact_user_events) WHERE rn = 1""")
def q_keep_latest(spark, sf):
    """Each user's latest event."""
    ev = facts.fact_user_events(fx.stg_user_events(spark, sf)).select(
        "user_id", "event_id", "event_type", "timestamp")
    return keep_latest(ev, "user_id", "timestamp")


@query("keep_latest_composite", """
SELECT user_id, session_id, event_id, event_type, timestamp FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, session_id ORDER BY timestamp DESC NULLS LAST,
                               event_id ASC NULLS FIRST, event_type ASC NULLS FIRST) AS rn
  FROM fact_user_events) WHERE rn = 1""")
def q_keep_latest_composite(spark, sf):
    """Latest event per (user, session)."""
    ev = facts.fact_user_events(fx.stg_user_events(spark, sf)).select(
        "user_id", "session_id", "event_id", "event_type", "timestamp")
    return keep_latest(ev, ["user_id", "session_id"], "timestamp")


@query("latest_location", """
SELECT user_id, event_date, bill_city, bill_country, bill_state FROM (
  SELECT user_id, CAST(timestamp AS DATE) AS event_date, bill_city, bill_country, bill_state,
    ROW_NUMBER() OVER (PARTITION BY user_id, CAST(timestamp AS DATE)
      ORDER BY timestamp DESC NULLS LAST, bill_city DESC NULLS LAST, bill_country DESC NULLS LAST,
               bill_state DESC NULLS LAST) AS rn
  FROM stg_transactions WHERE status = 'completed') WHERE rn = 1""")
def q_latest_location(spark, sf):
    """Latest billing location per user and day, over all completed transactions."""
    src = fx.stg_transactions(spark, sf).filter(F.col("status") == "completed")
    d = F.col("timestamp").cast("date")
    return keep_latest(src.select("user_id", d.alias("event_date"), "timestamp", "bill_city",
                                  "bill_country", "bill_state"),
                       ["user_id", "event_date"], ["timestamp", "bill_city", "bill_country", "bill_state"],
                       tie_breakers=[]).drop("timestamp")


_DAILY = f"""(SELECT transaction_date AS sales_date, CAST(SUM(total) AS DECIMAL(38,2)) AS revenue
  FROM fact_transactions WHERE status = 'completed' GROUP BY 1)"""


@query("running_revenue", f"""
SELECT sales_date, revenue,
  CAST(SUM(revenue) OVER (ORDER BY sales_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
       AS DECIMAL(38,2)) AS running_revenue
FROM {_DAILY}""")
def q_running_revenue(spark, sf):
    return A.running_revenue(marts.daily_revenue(_fact_tx(spark, sf)))


@query("moving_avg_revenue", f"""
SELECT sales_date, revenue,
  {O.cents_ratio('SUM(revenue) OVER w', 'COUNT(revenue) OVER w')} AS moving_avg_revenue
FROM {_DAILY}
WINDOW w AS (ORDER BY sales_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def q_moving_avg_revenue(spark, sf):
    return A.moving_avg_revenue(marts.daily_revenue(_fact_tx(spark, sf)))


def _user_sets(spark, sf):
    cust = fx.stg_customers(spark, sf).select("user_id")
    buyers = _fact_tx(spark, sf).select("user_id")
    active = fx.stg_user_events(spark, sf).select("user_id")
    return cust, buyers, active


@query("set_union", """
SELECT user_id FROM fact_transactions UNION SELECT user_id FROM stg_user_events""")
def q_set_union(spark, sf):
    _, buyers, active = _user_sets(spark, sf)
    return buyers.unionByName(active).distinct()


@query("set_intersect", """
SELECT user_id FROM fact_transactions INTERSECT SELECT user_id FROM stg_user_events""")
def q_set_intersect(spark, sf):
    _, buyers, active = _user_sets(spark, sf)
    return buyers.intersect(active)


@query("set_except", """
SELECT user_id FROM stg_customers
EXCEPT SELECT user_id FROM fact_transactions WHERE status = 'completed' AND transaction_type = 'purchase'""")
def q_set_except(spark, sf):
    """Customers without a completed purchase."""
    cust, _, _ = _user_sets(spark, sf)
    buyers = _fact_tx(spark, sf).filter((F.col("status") == "completed")
                                        & (F.col("transaction_type") == "purchase")).select("user_id")
    return cust.subtract(buyers)


# --------------------------------------------------------- JSON round trip
from tidewater.plans import layers as P  # noqa: E402
from tidewater.plans import silver as S  # noqa: E402
from tidewater.sources.landing import read_landing_json, extract_topics  # noqa: E402
from tidewater.sources.schemas import TOPICS  # noqa: E402

_ISO = "strftime(timestamp, '%Y-%m-%dT%H:%M:%S.%fZ')"
_COUNTS = "(SELECT transaction_id, CAST(COUNT(*) AS INTEGER) AS n FROM transaction_items GROUP BY 1)"
_DENSE_ITEMS = """(SELECT transaction_id,
    CAST(ROW_NUMBER() OVER (PARTITION BY transaction_id ORDER BY line_item_index) - 1 AS INTEGER) AS line_item_index,
    user_id, timestamp, currency, product_id, product_name, category, brand, quantity, unit_price,
    CAST(quantity * unit_price AS DECIMAL(18,2)) AS item_subtotal
  FROM transaction_items)"""


def _size0(c):
    return F.when(F.col(c).isNull(), F.lit(0)).otherwise(F.size(c)).cast("int")


@query("read_landing_json", f"""
SELECT transaction_id, user_id, transaction_type, {_ISO} AS timestamp, status, payment_method, currency,
  subtotal, tax, total, bill_city, original_transaction_id, CAST(COALESCE(n.n, 0) AS INTEGER) AS item_count
FROM src_transactions LEFT JOIN {_COUNTS} n USING (transaction_id)""")
def q_read_landing_json(spark, sf):
    df = read_landing_json(spark, f"{P.land_fixtures(spark, sf, ("transaction_events",))}/transaction_events",
                           TOPICS["transaction_events"])
    return df.select("transaction_id", "user_id", "transaction_type", "timestamp", "status",
                     "payment_method", "currency", "subtotal", "tax", "total",
                     F.col("billing_address.city").alias("bill_city"), "original_transaction_id",
                     _size0("line_items").alias("item_count"))


@query("extract_topics", f"""
SELECT 'transaction_events' AS topic, substr({_ISO}, 1, 10) AS day, COUNT(*) AS n FROM src_transactions GROUP BY 1, 2
UNION ALL
SELECT 'user_events' AS topic, substr({_ISO}, 1, 10) AS day, COUNT(*) AS n FROM src_user_events GROUP BY 1, 2""")
def q_extract_topics(spark, sf):
    frames = extract_topics(spark, P.land_fixtures(spark, sf))
    out = None
    for topic, df in frames.items():
        g = df.groupBy(F.lit(topic).alias("topic"), F.substring("timestamp", 1, 10).alias("day")) \
              .agg(F.count("*").alias("n"))
        out = g if out is None else out.unionByName(g)
    return out


@query("strict_load", f"""
SELECT event_id, user_id, session_id, event_type, {_ISO} AS timestamp, page, device, browser, country,
  city, product_id, CAST(quantity AS BIGINT) AS quantity
FROM src_user_events""")
def q_strict_load(spark, sf):
    """User events read FAILFAST: any malformed line would fail the load."""
    df = read_landing_json(spark, f"{P.land_fixtures(spark, sf, ("user_events",))}/user_events", TOPICS["user_events"],
                           strict=True)
    return df.drop("ip_address", "search_query", "element_id")


@query("bronze_transactions", f"""
SELECT transaction_id, CAST(timestamp AS DATE) AS event_date, n.n AS item_count,
  TRUE AS row_num_valid, TRUE AS has_source_file
FROM src_transactions JOIN {_COUNTS} n USING (transaction_id)""")
def q_bronze_transactions(spark, sf):
    b = P.bronze(spark, sf, "transaction_events")
    return b.select(S.vs("$.transaction_id").alias("transaction_id"),
                    F.try_variant_get("raw", "$.event_date", "date").alias("event_date"),
                    F.size(F.try_variant_get("raw", "$.line_items", "array<variant>")).cast("int")
                     .alias("item_count"),
                    (F.col("row_num") >= 1).alias("row_num_valid"),
                    F.col("source_file").endswith(".parquet").alias("has_source_file"))


@query("bronze_user_events", """
SELECT event_id, event_type, CAST(timestamp AS DATE) AS event_date, TRUE AS row_num_valid
FROM src_user_events""")
def q_bronze_user_events(spark, sf):
    b = P.bronze(spark, sf, "user_events")
    return b.select(S.vs("$.event_id").alias("event_id"), S.vs("$.event_type").alias("event_type"),
                    F.try_variant_get("raw", "$.event_date", "date").alias("event_date"),
                    (F.col("row_num") >= 1).alias("row_num_valid"))


@query("flatten_items", f"""
SELECT transaction_id, line_item_index, product_id, quantity, unit_price FROM {_DENSE_ITEMS}""")
def q_flatten_items(spark, sf):
    """Typed LATERAL un-nest: one row per array element with its 0-based index."""
    df = read_landing_json(spark, f"{P.land_fixtures(spark, sf, ("transaction_events",))}/transaction_events",
                           TOPICS["transaction_events"])
    x = df.select("transaction_id", F.posexplode("line_items").alias("line_item_index", "it"))
    return x.select("transaction_id", F.col("line_item_index").cast("int").alias("line_item_index"),
                    "it.product_id", "it.quantity", "it.unit_price")


@query("flatten_transactions", """
SELECT f.transaction_id, f.user_id, f.transaction_ts, f.status, f.payment_method, i.currency,
  i.line_item_index, i.product_id, i.quantity, i.unit_price, i.item_subtotal AS item_revenue
FROM transaction_items i JOIN fact_transactions f ON f.transaction_id = i.transaction_id""")
def q_flatten_transactions(spark, sf):
    """Item-grain flat transactions: no arrays, no structs."""
    f = _fact_tx(spark, sf).select("transaction_id", "user_id", "transaction_ts", "status",
                                   "payment_method")
    i = _items(spark, sf).select("transaction_id", "currency", "line_item_index", "product_id",
                                 "quantity", "unit_price", F.col("item_subtotal").alias("item_revenue"))
    return i.join(f, "transaction_id")


@query("silver_transactions", f"""
SELECT t.* EXCLUDE (processed_at) REPLACE (COALESCE(payment_method, 'USD') AS payment_method)
FROM stg_transactions t WHERE transaction_id IN (SELECT transaction_id FROM transaction_items)""")
def q_silver_transactions(spark, sf):
    return S.silver_transactions(P.bronze(spark, sf, "transaction_events")).drop("processed_at")


@query("silver_transaction_items", f"SELECT * FROM {_DENSE_ITEMS}")
def q_silver_transaction_items(spark, sf):
    return S.silver_transaction_items(P.bronze(spark, sf, "transaction_events")).drop("processed_at")


@query("silver_user_events", "SELECT * EXCLUDE (processed_at) FROM stg_user_events")
def q_silver_user_events(spark, sf):
    return S.silver_user_events(P.bronze(spark, sf, "user_events")).drop("processed_at")


@query("silver_customers", "SELECT * EXCLUDE (processed_at) FROM stg_customers")
def q_silver_customers(spark, sf):
    return S.silver_customers(P.bronze(spark, sf, "customers")).drop("processed_at")


@query("silver_products", "SELECT * EXCLUDE (processed_at) FROM stg_products")
def q_silver_products(spark, sf):
    return S.silver_products(P.bronze(spark, sf, "products")).drop("processed_at")


# ------------------------------------------------------ write and read back
from tidewater.operators.quality import quality_report  # noqa: E402
from tidewater.operators.tables import read_table, upsert_partitions  # noqa: E402
from tidewater.operators.upsert import merge_upsert  # noqa: E402
from tidewater.session import scratch_dir  # noqa: E402
from tidewater.sources import sinks  # noqa: E402

CUTOFF_OLD = "1999-01-01"   # target snapshot: transactions before this day
CUTOFF_NEW = "1998-01-01"   # batch: transactions from this day on, all completed
_FACT_COLS = ", ".join(facts.FACT_TRANSACTION_COLS)


def _merge_inputs(spark, sf):
    f = _fact_tx(spark, sf)
    target = f.filter(F.col("transaction_date") < F.lit(CUTOFF_OLD).cast("date"))
    batch = (f.filter(F.col("transaction_date") >= F.lit(CUTOFF_NEW).cast("date"))
             .withColumn("status", F.lit("completed")))
    return target, batch


_MERGED_SQL = f"""
SELECT * REPLACE (CASE WHEN transaction_date >= DATE '{CUTOFF_NEW}' THEN 'completed' ELSE status END AS status)
FROM fact_transactions"""


@query("merge_upsert", _MERGED_SQL)
def q_merge_upsert(spark, sf):
    """Snapshot before 1999 + batch from 1998 on (status now completed): one
    year updated in place, later years inserted, older rows untouched."""
    target, batch = _merge_inputs(spark, sf)
    return merge_upsert(target, batch, "transaction_id", update_cols=["status", "total"])


@query("replay_idempotent", _MERGED_SQL)
def q_replay_idempotent(spark, sf):
    """A batch merged into the written table, repeated under its number and sent again under the next: no change."""
    target, batch = _merge_inputs(spark, sf)
    path = f"{scratch_dir(spark, 'replay')}/fact"
    for n, rows in ((0, target), (1, batch), (1, batch), (2, batch)):
        upsert_partitions(P.with_month(rows, "transaction_date"), path, "transaction_id", "event_month", n)
    return read_table(spark, path).drop("event_month")


@query("write_parquet_roundtrip", "SELECT * FROM fact_transactions")
def q_write_parquet_roundtrip(spark, sf):
    path = scratch_dir(spark, "fact_parquet")
    sinks.write_parquet(P.with_month(_fact_tx(spark, sf), "transaction_date"), path, partition_by=("event_month",))
    return spark.read.parquet(path).drop("event_month")


@query("csv_roundtrip", BODY["daily_revenue"])
def q_csv_roundtrip(spark, sf):
    df = marts.daily_revenue(_fact_tx(spark, sf))
    path = scratch_dir(spark, "daily_revenue_csv")
    sinks.write_csv(df, path)
    return spark.read.schema(df.schema).option("header", True).csv(path)


@query("publish_staging", f"""
SELECT *, CASE WHEN transaction_date < DATE '{CUTOFF_NEW}' THEN 1 ELSE 2 END AS batch FROM fact_transactions""")
def q_publish_staging(spark, sf):
    """Two loads appended under staging/<dataset>/batch=<id>; read back whole."""
    f = _fact_tx(spark, sf)
    root = scratch_dir(spark, "staging")
    cut = F.lit(CUTOFF_NEW).cast("date")
    sinks.publish_staging(f.filter(F.col("transaction_date") < cut), root, "fact_transactions", "1")
    sinks.publish_staging(f.filter(F.col("transaction_date") >= cut), root, "fact_transactions", "2")
    return spark.read.parquet(f"{root}/fact_transactions")


BUCKET_BYTES = 128 << 20


def _buckets(source) -> int:
    """Buckets of about BUCKET_BYTES of the files a table is built from; a power of two."""
    from tidewater.operators.joins import estimated_bytes
    size = estimated_bytes(source) or 0
    return 1 << max(2, min(16, (size // BUCKET_BYTES).bit_length()))


@query("bucketed_join", BODY["join_inner"])
def q_bucketed_join(spark, sf):
    """Items and transactions stored bucketed by transaction_id: the join reads
    matching buckets side by side, with no shuffle."""
    root = scratch_dir(spark, "bucketed")
    f = _fact_tx(spark, sf).select("transaction_id", "transaction_date", "transaction_type")
    i = _items(spark, sf).select("transaction_id", "line_item_index", "category", "item_subtotal")
    n = _buckets(table(spark, sf, "lineitem"))
    with sinks.catalog_tables(spark, "fact", "items") as (tf, ti):
        sinks.write_bucketed(f, spark, tf, f"{root}/fact", "transaction_id", n)
        sinks.write_bucketed(i, spark, ti, f"{root}/items", "transaction_id", n)
        return spark.table(ti).join(spark.table(tf), "transaction_id")  # resolved: it reads the files, not the catalog


BACKFILL_FROM = "1998-01-01"


@query("backfill_range", BODY["daily_revenue"])
def q_backfill_range(spark, sf):
    """Mart built for the older history, then everything from a day on recomputed
    from a partition-pruned read and written by dynamic partition overwrite."""
    fact_path = scratch_dir(spark, "fact_by_date")
    sinks.write_parquet(P.with_month(_fact_tx(spark, sf), "transaction_date"), fact_path, partition_by=("event_month",))
    fact = spark.read.parquet(fact_path).drop("event_month")
    mart = scratch_dir(spark, "daily_revenue_mart")
    lo = F.lit(BACKFILL_FROM).cast("date")
    first = marts.daily_revenue(fact.filter(F.col("transaction_date") < lo))
    sinks.write_parquet(P.with_month(first, "sales_date"), mart, partition_by=("event_month",))
    again = marts.daily_revenue(fact.filter(F.col("transaction_date") >= lo))
    sinks.write_parquet(P.with_month(again, "sales_date"), mart, partition_by=("event_month",))
    return spark.read.parquet(mart).drop("event_month")


_QUALITY_TABLES = [("fact_transactions", ["transaction_id"]),
                   ("transaction_items", ["transaction_id", "line_item_index"]),
                   ("fact_user_events", ["event_id"]),
                   ("dim_customer", ["user_id"]),
                   ("dim_product", ["product_id"])]


def _quality_sql():
    parts = []
    for t, ks in _QUALITY_TABLES:
        kl = ", ".join(ks)
        nulls = " OR ".join(f"{k} IS NULL" for k in ks)
        parts.append(f"""SELECT '{t}' AS table_name, (SELECT COUNT(*) FROM {t}) AS row_count,
  (SELECT COUNT(*) FROM {t} WHERE {nulls}) AS null_keys,
  (SELECT COUNT(*) FROM (SELECT {kl} FROM {t} GROUP BY {kl} HAVING COUNT(*) > 1)) AS duplicate_keys,
  (SELECT COUNT(*) FROM {t}) > 0
    AND (SELECT COUNT(*) FROM {t} WHERE {nulls}) = 0
    AND (SELECT COUNT(*) FROM (SELECT {kl} FROM {t} GROUP BY {kl} HAVING COUNT(*) > 1)) = 0 AS passed""")
    return "\nUNION ALL\n".join(parts)


@query("validate_outputs", _quality_sql())
def q_validate_outputs(spark, sf):
    tables = {
        "fact_transactions": _fact_tx(spark, sf),
        "transaction_items": _items(spark, sf),
        "fact_user_events": facts.fact_user_events(fx.stg_user_events(spark, sf)),
        "dim_customer": _dim_customer(spark, sf),
        "dim_product": dims.dim_product(fx.stg_products(spark, sf)),
    }
    return quality_report({t: (tables[t], ks) for t, ks in _QUALITY_TABLES})


# ------------------------------------------------- specified / named analytics
HEAVY_THRESHOLD_FIXTURE = 1   # the driver data has at most 2-3 per user-month (documented 10 / 5)


def _type_sql(ttype: str, grain: str) -> str:
    amount = "total" if ttype == "purchase" else "ABS(total)"
    period = ("transaction_date AS sales_date" if grain == "day"
              else "CAST(date_trunc('month', transaction_date) AS DATE) AS month")
    return f"""SELECT {period}, CAST(COUNT(*) AS BIGINT) AS transactions,
  CAST(SUM({amount}) AS DECIMAL(38,2)) AS amount
FROM fact_transactions WHERE status = 'completed' AND transaction_type = '{ttype}' GROUP BY 1"""


def _register_type_totals(key: str, ttype: str, grain: str):
    @query(key, _type_sql(ttype, grain))
    def _q(spark, sf):
        return A.type_totals(_fact_tx(spark, sf), ttype, grain)
    _q.__doc__ = f"Completed {ttype} count and amount per {grain}."


for _k, _t in (("purchases", "purchase"), ("chargebacks", "chargeback"), ("refunds", "refund")):
    _register_type_totals(f"{_k}_daily", _t, "day")
    _register_type_totals(f"{_k}_monthly", _t, "month")


def _heavy_sql(ttype: str, threshold: int) -> str:
    return f"""SELECT user_id, CAST(date_trunc('month', transaction_date) AS DATE) AS month,
  CAST(COUNT(*) AS BIGINT) AS events
FROM fact_transactions WHERE status = 'completed' AND transaction_type = '{ttype}'
GROUP BY 1, 2 HAVING COUNT(*) > {threshold}"""


@query("heavy_refunders", _heavy_sql("refund", HEAVY_THRESHOLD_FIXTURE))
def q_heavy_refunders(spark, sf):
    return A.heavy_users(_fact_tx(spark, sf), "refund", HEAVY_THRESHOLD_FIXTURE)


@query("heavy_chargebackers", _heavy_sql("chargeback", HEAVY_THRESHOLD_FIXTURE))
def q_heavy_chargebackers(spark, sf):
    return A.heavy_users(_fact_tx(spark, sf), "chargeback", HEAVY_THRESHOLD_FIXTURE)


@query("us_vs_others", f"""
SELECT CASE WHEN billing_country = 'US' THEN 'US' ELSE 'OTHER' END AS segment,
  CAST(COUNT(*) AS BIGINT) AS orders, CAST(SUM(total) AS DECIMAL(38,2)) AS revenue,
  CAST(COUNT(DISTINCT user_id) AS BIGINT) AS customers,
  {O.cents_ratio('SUM(total)', 'COUNT(*)')} AS avg_order_value
FROM fact_transactions WHERE status = 'completed' AND transaction_type = 'purchase' GROUP BY 1""")
def q_us_vs_others(spark, sf):
    return A.us_vs_others(_fact_tx(spark, sf))


_MONTHLY_SPEND = """
SELECT CAST(date_trunc('month', f.transaction_date) AS DATE) AS month, f.user_id,
  d.full_name AS customer_name, d.email AS email,
  CAST(COUNT(*) AS BIGINT) AS orders, CAST(SUM(f.total) AS DECIMAL(38,2)) AS spend
FROM fact_transactions f LEFT JOIN dim_customer d ON f.user_id = d.user_id
WHERE f.status = 'completed' GROUP BY 1, 2, 3, 4"""


@query("customer_monthly_spend", _MONTHLY_SPEND)
def q_customer_monthly_spend(spark, sf):
    return A.customer_monthly_spend(_fact_tx(spark, sf), _dim_customer(spark, sf))


@query("customer_ranked", f"""
SELECT month, user_id, spend,
  CAST(RANK() OVER (PARTITION BY month ORDER BY spend DESC NULLS LAST) AS BIGINT) AS spend_rank
FROM ({_MONTHLY_SPEND})""")
def q_customer_ranked(spark, sf):
    return A.customer_ranked(_fact_tx(spark, sf))


CART_WINDOW_DAYS = 7
CART_MATCH = "category"
# the driver's orders are years before its events: purchases are moved into the
# event month by day = 2024-01-01 + (transaction id mod 45) (fixed values)
CART_SHIFT_BASE, CART_SHIFT_DAYS = "2024-01-01", 45


@query("cart_to_purchase", f"""
SELECT cart_date, CAST(COUNT(*) AS BIGINT) AS carts, CAST(COUNT_IF(conv) AS BIGINT) AS conversions,
  CASE WHEN COUNT(*) = 0 THEN NULL ELSE CAST(CAST((2 * COUNT_IF(conv) * 10000 + COUNT(*)) // (2 * COUNT(*))
       AS DECIMAL(18,0)) * 0.0001 AS DECIMAL(18,4)) END AS conversion_rate
FROM (SELECT c.cart_date, EXISTS (
        SELECT 1 FROM (SELECT DISTINCT f.user_id, i.category AS match_key,
                         CAST(DATE '{CART_SHIFT_BASE}' + CAST(CAST(f.transaction_id AS BIGINT) % {CART_SHIFT_DAYS} AS INTEGER) AS DATE) AS purchase_date
                       FROM fact_transactions f JOIN transaction_items i ON i.transaction_id = f.transaction_id
                       WHERE f.status = 'completed' AND f.transaction_type = 'purchase') p
        WHERE p.user_id = c.user_id AND p.match_key = c.match_key
          AND p.purchase_date BETWEEN c.cart_date AND CAST(c.cart_date + {CART_WINDOW_DAYS} AS DATE)) AS conv
      FROM (SELECT e.event_id, e.user_id, d.category AS match_key, CAST(e.timestamp AS DATE) AS cart_date
            FROM fact_user_events e LEFT JOIN dim_product d ON d.product_id = e.product_id
            WHERE e.event_type = 'add_to_cart') c)
GROUP BY 1""")
def q_cart_to_purchase(spark, sf):
    ev = facts.fact_user_events(fx.stg_user_events(spark, sf))
    shift = F.date_add(F.lit(CART_SHIFT_BASE).cast("date"),
                       (F.col("transaction_id").cast("bigint") % CART_SHIFT_DAYS).cast("int"))
    t = fx.stg_transactions(spark, sf)
    bought = t.filter((F.col("status") == "completed") & (F.col("transaction_type") == "purchase"))
    items = facts.transaction_items(fx.stg_items(spark, sf), only_transactions=bought)
    carts, purchases = A.cart_inputs(ev, _fact_tx(spark, sf), items,
                                     dims.dim_product(fx.stg_products(spark, sf)), CART_MATCH, shift)
    return A.cart_to_purchase(carts, purchases, CART_WINDOW_DAYS)


# ------------------------------------------------------------------ streaming
from tidewater.plans.gold import CONSUMERS, GoldTables  # noqa: E402
from tidewater.streaming import jobs as J  # noqa: E402


def _files_for(spark, path: str, batches: int) -> int:
    """Files a trigger takes so that a folder is read in about ``batches`` micro-batches."""
    names = spark.read.format("binaryFile").load(path).select("path").count()
    return max(1, -(-names // batches))


@query("ingest_landing", BODY["strict_load"])
def q_ingest_landing(spark, sf):
    """Landing topic -> typed Parquet by a checkpointed file stream in several
    micro-batches (the poll window), drained with availableNow."""
    landing = f"{P.land_fixtures(spark, sf, ('user_events',))}/user_events"
    root = scratch_dir(spark, "ingest")
    J.ingest_landing(spark, landing, "user_events", f"{root}/out", f"{root}/_ckpt", max_files=_files_for(spark, landing, 3))
    return spark.read.parquet(f"{root}/out").drop("ip_address", "search_query", "element_id", "batch")


@query("archive_processed", BODY["read_landing_json"])
def q_archive_processed(spark, sf):
    """File stream with cleanSource=archive over a private landing folder: the
    consumed files are moved below the archive folder, and the answer is read
    from there and from what the last batch left behind."""
    landing = f"{P.land_fixtures(spark, sf, ('transaction_events',))}/transaction_events"
    root = scratch_dir(spark, "archive")
    J.ingest_landing(spark, landing, "transaction_events", f"{root}/out", f"{root}/_ckpt",
                     max_files=_files_for(spark, landing, 3), archive_dir=f"{root}/archive")
    lines = spark.read.option("recursiveFileLookup", True).text([p for p in (f"{root}/archive", landing) if _has_files(spark, p)])
    df = parse_lines(lines, TOPICS["transaction_events"])
    return df.select("transaction_id", "user_id", "transaction_type", "timestamp", "status",
                     "payment_method", "currency", "subtotal", "tax", "total",
                     F.col("billing_address.city").alias("bill_city"), "original_transaction_id",
                     _size0("line_items").alias("item_count"))


def _has_files(spark, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(p) and fs.listFiles(p, True).hasNext()


def _streamed(spark, sf, topic: str, kept_marts=()) -> tuple[GoldTables, str]:
    """Cleaned files of a topic through the silver stream in about three micro-batches; the tables and their root."""
    cleaned = P.clean_topics(spark, sf, (topic,))[topic]
    root = scratch_dir(spark, f"stream_{topic}")
    gold = GoldTables(spark, f"{root}/tables", kept_marts)
    J.stream_silver(spark, cleaned, topic, gold, f"{root}/_ckpt/silver", max_files=_files_for(spark, cleaned, 3))
    return gold, root


def _consumed(spark, sf, topic: str, *consumers: str) -> GoldTables:
    """The given gold tables by their own streams over the change feeds, two micro-batches or more each."""
    gold, root = _streamed(spark, sf, topic)
    for c in consumers:
        files = max(_files_for(spark, f"{gold.feed(f)}/*/*.parquet", 2) for f in CONSUMERS[c].feeds)
        J.stream_consumer(gold, c, f"{root}/_ckpt/{c}", max_files=files)
    return gold


@query("stream_silver", BODY["silver_transactions"])
def q_stream_silver(spark, sf):
    """Bronze stream -> silver transactions and items, upserted by several micro-batches."""
    return _streamed(spark, sf, "transaction_events")[0].read("stg_transactions").drop("processed_at")


@query("stream_silver_events", BODY["silver_user_events"])
def q_stream_silver_events(spark, sf):
    """Bronze stream of user events -> silver table."""
    return _streamed(spark, sf, "user_events")[0].read("stg_user_events").drop("processed_at")


@query("change_feed", """
SELECT * REPLACE (COALESCE(payment_method, 'USD') AS payment_method) FROM fact_transactions
WHERE transaction_id IN (SELECT transaction_id FROM transaction_items)""")
def q_change_feed(spark, sf):
    """Feed of the silver transactions consumed by the fact's stream, with its own checkpoint."""
    return _consumed(spark, sf, "transaction_events", "fact_transactions").read("fact_transactions")


@query("daily_revenue_stream", f"""
SELECT transaction_date AS sales_date,
  CAST(COUNT_IF(transaction_type = 'purchase') AS BIGINT) AS orders,
  CAST(SUM(total) AS DECIMAL(38,2)) AS revenue,
  CAST(SUM(tax) AS DECIMAL(38,2)) AS tax,
  {O.cents_ratio('SUM(total)', "COUNT_IF(transaction_type = 'purchase')")} AS avg_order_value
FROM fact_transactions
WHERE status = 'completed' AND transaction_id IN (SELECT transaction_id FROM transaction_items)
GROUP BY transaction_date""")
def q_daily_revenue_stream(spark, sf):
    """Daily revenue by a stream over the feed of the fact: changed rows take their old share away and add the new one."""
    return _consumed(spark, sf, "transaction_events", "fact_transactions", "daily_revenue").read("daily_revenue")


# ------------------------------------------- batches with updates and moves

def _third(key: str):
    return F.pmod(F.xxhash64(key), F.lit(3))


def _batches(df, key: str, wrong: dict):
    """Three batches whose end is ``df``: first two thirds with wrong values and an
    early stamp, then the rest and one correction, then the other correction again with it."""
    early = df.filter(_third(key) < 2).withColumns(wrong).withColumn(
        "processed_at", F.col("processed_at") - F.expr("INTERVAL 4000 DAYS"))
    return [early, df.filter(_third(key) != 1), df.filter(_third(key) != 2)]


def _wrong_tx():
    return {"status": F.lit("pending"), "timestamp": F.col("timestamp") + F.expr("INTERVAL 40 DAYS"),
            "total": F.col("total") + F.lit(1).cast("decimal(18,2)")}


def _gold_feeds(spark, sf) -> dict:
    moved = F.col("timestamp") + F.expr("INTERVAL 40 DAYS")
    return {
        "transactions": _batches(fx.stg_transactions(spark, sf), "transaction_id", _wrong_tx()),
        "items": _batches(fx.stg_items(spark, sf).drop("tie1", "tie2", "tie3", "tie4"), "transaction_id",
                          {"timestamp": moved, "quantity": F.col("quantity") + 1}),
        "events": _batches(fx.stg_user_events(spark, sf), "event_id", {"timestamp": moved, "page": F.lit("old")}),
        "customers": _batches(fx.stg_customers(spark, sf), "user_id", {"last_name": F.lit("Old"), "email": F.lit("old")}),
        "products": _batches(fx.stg_products(spark, sf), "product_id", {"category": F.lit("old")}),
    }


def _gold(spark, sf, feeds, kept_marts=(), batches=(0, 1, 2)) -> GoldTables:
    """Gold tables after batches of the given feeds."""
    gold, source = GoldTables(spark, scratch_dir(spark, "gold"), kept_marts), _gold_feeds(spark, sf)
    for n in batches:
        gold.apply(n, **{f: source[f][n] for f in feeds})
    return gold


def _register_gold(name: str, feeds: tuple, body: str):
    @query(f"gold_{name}_incremental", body)
    def _q(spark, sf):
        replayed = (0, 1, 1, 2, 2) if name == "fact_transactions" else (0, 1, 2)
        return _gold(spark, sf, feeds, [m for m in GoldTables.MARTS if m == name], replayed).read(name).drop("processed_at")
    _q.__doc__ = f"{name} kept through three batches with corrections and moved dates."


_TX_DIM = ("transactions", "customers")
for _name, _feeds, _sql in (
    ("stg_customers", ("customers",), BODY["silver_customers"]),
    ("stg_products", ("products",), BODY["silver_products"]),
    ("dim_customer", ("customers",), BODY["dim_customer"]),
    ("dim_product", ("products",), BODY["dim_product"]),
    ("fact_transactions", ("transactions",), BODY["fact_transactions"]),
    ("transaction_items", ("items",), BODY["transaction_items"]),
    ("fact_user_events", ("events",), BODY["fact_user_events"]),
    ("daily_revenue", ("transactions",), BODY["daily_revenue"]),
    ("revenue_by_category", ("items",), BODY["revenue_by_category"]),
    ("refunds_by_category", ("transactions", "items"), BODY["refunds_by_category"]),
    ("customer_daily_spend", _TX_DIM, BODY["customer_daily_spend"]),
    ("customer_risk", _TX_DIM, BODY["customer_risk"]),
    ("refund_items_nested", ("transactions", "items"), BODY["refund_items_nested"]),
):
    _register_gold(_name, _feeds, _sql)


def _upserted(spark, name: str, *batches):
    """A table by months of transactions after (number, rows) batches."""
    path = f"{scratch_dir(spark, name)}/table"
    for n, rows in batches:
        upsert_partitions(P.with_month(rows, "transaction_date"), path, "transaction_id", "event_month", n)
    return read_table(spark, path).drop("event_month")


@query("upsert_moved_date", "SELECT * FROM fact_transactions")
def q_upsert_moved_date(spark, sf):
    """Every transaction first lies 40 days late; the second batch moves it."""
    f = _fact_tx(spark, sf)
    return _upserted(spark, "moved", (0, f.withColumn("transaction_date", F.date_add("transaction_date", 40))), (1, f))


@query("upsert_null_date", """
SELECT * REPLACE (CASE WHEN CAST(transaction_id AS BIGINT) % 3 = 0 THEN NULL ELSE transaction_date END AS transaction_date)
FROM fact_transactions""")
def q_upsert_null_date(spark, sf):
    """Rows without a date come in two batches; the second must not lose those of the first."""
    k = F.col("transaction_id").cast("bigint")
    f = _fact_tx(spark, sf).withColumn("transaction_date", F.when(k % 3 != 0, F.col("transaction_date")))
    return _upserted(spark, "nulls", (0, f.filter(k % 2 == 0)), (1, f.filter(k % 2 == 1)))


@query("upsert_three_batches", _MERGED_SQL)
def q_upsert_three_batches(spark, sf):
    """Old snapshot, a batch of updates and new rows, and the same batch replayed."""
    target, batch = _merge_inputs(spark, sf)
    return _upserted(spark, "three", (0, target), (1, batch), (1, batch), (2, batch))


@query("daily_revenue_updates", BODY["daily_revenue"])
def q_daily_revenue_updates(spark, sf):
    """Later batches change status and date of earlier rows and empty the days of a month."""
    tx, gold = fx.stg_transactions(spark, sf), GoldTables(spark, scratch_dir(spark, "updates"), ("daily_revenue",))
    wrong = tx.withColumns(_wrong_tx()).withColumn("processed_at", F.col("processed_at") - F.expr("INTERVAL 4000 DAYS"))
    alone = wrong.withColumns({"timestamp": F.lit("1970-05-05").cast("timestamp_ntz"), "status": F.lit("completed")})
    gold.apply(0, transactions=wrong.filter(_third("transaction_id") > 0).unionByName(alone.filter(_third("transaction_id") == 0)))
    gold.apply(1, transactions=tx.filter(_third("transaction_id") == 0))
    gold.apply(2, transactions=tx.filter(_third("transaction_id") > 0))
    return gold.read("daily_revenue")


# --------------------------------------------------- landing with bad lines
from tidewater.plans.etl import run_etl  # noqa: E402
from tidewater.sources.landing import parse_lines, quarantine  # noqa: E402


def _dirty(spark, sf) -> str:
    """User events as JSON lines in which numbers drift to text and some lines are broken."""
    ev = fx.stg_user_events(spark, sf, defaults=False).select("event_id", "event_type", "quantity")
    k = F.col("event_id").cast("bigint")
    q = F.coalesce(F.col("quantity").cast("string"), F.lit("null"))
    number = (F.when(F.col("quantity").isNull(), "null").when(k % 4 == 0, F.concat(F.lit('"'), q, F.lit('"')))
              .when(k % 4 == 1, F.concat(q, F.lit(".0"))).when(k % 4 == 2, F.lit('"n/a"')).otherwise(q))
    line = F.concat(F.lit('{"event_id": "'), F.col("event_id"), F.lit('", "event_type": "'), F.col("event_type"),
                    F.lit('", "quantity": '), number, F.lit("}"))
    broken = F.when(k % 7 == 3, F.concat(F.lit("{broken "), F.col("event_id"))).when(k % 7 == 4, F.lit("")).otherwise(line)
    path = f"{scratch_dir(spark, 'dirty')}/user_events"
    ev.select(broken.alias("value")).write.text(path)
    return path


@query("read_landing_dirty", """
SELECT event_id, event_type,
  CASE WHEN CAST(event_id AS BIGINT) % 4 <> 2 THEN CAST(quantity AS BIGINT) END AS quantity
FROM src_user_events WHERE CAST(event_id AS BIGINT) % 7 NOT IN (3, 4)""")
def q_read_landing_dirty(spark, sf):
    """Every line that is a JSON object keeps its row, whatever its number fields hold."""
    return read_landing_json(spark, _dirty(spark, sf), TOPICS["user_events"]).select("event_id", "event_type", "quantity")


@query("quarantine_rows", """
SELECT '{broken ' || event_id AS line FROM src_user_events WHERE CAST(event_id AS BIGINT) % 7 = 3""")
def q_quarantine_rows(spark, sf):
    return quarantine(spark, _dirty(spark, sf)).select(F.col("_corrupt_record").alias("line"))


@query("etl_two_landings", """
SELECT event_id, event_type, CAST(timestamp AS DATE) AS event_date FROM src_user_events""")
def q_etl_two_landings(spark, sf):
    """Two landings that share days: the second run appends its files and keeps the first's rows."""
    from tidewater.sources.landing import pack_user_events, write_json_lines
    ev = pack_user_events(fx.stg_user_events(spark, sf, defaults=False))
    root = scratch_dir(spark, "two_landings")
    for n in range(2):
        write_json_lines(ev.filter(F.col("event_id").cast("bigint") % 2 == n), f"{root}/new{n}")
        spark.read.text(f"{root}/new{n}").write.mode("append").text(f"{root}/landing/user_events")
        run_etl(spark, f"{root}/landing", f"{root}/out")
    return spark.read.parquet(f"{root}/out/user_events").select("event_id", "event_type", "event_date")
