"""DuckDB SQL twins of the Spark builders, used as the correctness oracle.

Each ``STG_*`` text is the SQL form of the matching rule in
``tidewater.sources.fixtures``; each gold text mirrors ``tidewater.plans``.
Queries are assembled as one WITH chain over the driver's table views.
"""

from __future__ import annotations

STG = {}

STG["v_geo"] = """
SELECT n_nationkey, n_name, r_name
FROM nation LEFT JOIN region ON n_regionkey = r_regionkey"""

STG["stg_customers"] = """
SELECT CAST(c_custkey AS VARCHAR) AS user_id,
  CASE WHEN c_custkey % 10 = 0 THEN NULL
       ELSE 'u' || CAST(c_custkey AS VARCHAR) || '@example.com' END AS email,
  'Customer' AS first_name,
  substring(c_name, 10) AS last_name,
  CAST(DATE '2020-01-01' + CAST(c_custkey % 1000 AS INTEGER) AS DATE) AS registration_date,
  lower(c_mktsegment) AS account_type,
  CAST(DATE '1960-01-01' + CAST((c_custkey * 37) % 15000 AS INTEGER) AS DATE) AS date_of_birth,
  CAST(floor(c_acctbal) AS BIGINT) AS loyalty_points,
  n_name AS state,
  TIMESTAMP '2024-02-01 00:00:00' AS processed_at
FROM customer LEFT JOIN v_geo ON c_nationkey = n_nationkey"""

STG["stg_products"] = """
SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name, p_type AS category,
  'S' || CAST(p_size AS VARCHAR) AS subcategory, p_brand AS brand,
  'Manufacturer#' || CAST(p_partkey % 5 AS VARCHAR) AS manufacturer,
  CAST(p_retailprice AS DECIMAL(18,2)) AS msrp,
  CAST(CAST(p_retailprice AS DECIMAL(18,2)) - CAST(1 AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS cost_price,
  CAST(DATE '2020-01-01' + CAST(p_partkey % 730 AS INTEGER) AS DATE) AS created_date,
  p_partkey % 7 <> 0 AS is_active,
  TIMESTAMP '2024-02-01 00:00:00' AS processed_at
FROM part"""

_TX_BODY = """
SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id,
  CAST(o_custkey AS VARCHAR) AS user_id,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'refund'
       WHEN o_orderpriority = '2-HIGH' THEN 'chargeback' ELSE 'purchase' END AS transaction_type,
  CAST(o_orderdate AS TIMESTAMP) AS timestamp,
  CASE WHEN o_orderstatus = 'F' THEN 'completed' WHEN o_orderstatus = 'O' THEN 'pending'
       ELSE 'failed' END AS status,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 7 = 1 THEN 'paypal'
       WHEN o_orderkey % 7 = 2 THEN 'debit_card' ELSE 'credit_card' END AS payment_method,
  'USD' AS currency,
  {orig} AS original_transaction_id,
  CAST(CAST(o_totalprice AS DECIMAL(18,2))
       - CAST(CAST(o_orderkey % 100000 AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS subtotal,
  CAST(CAST(o_orderkey % 100000 AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,2)) AS tax,
  CAST(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN -CAST(o_totalprice AS DECIMAL(18,2))
            ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS DECIMAL(18,2)) AS total,
  'City' || CAST(c_custkey % 50 AS VARCHAR) AS bill_city,
  n_name AS bill_state,
  CASE WHEN r_name = 'AMERICA' THEN 'US' ELSE r_name END AS bill_country,
  'City' || CAST(c_custkey % 50 AS VARCHAR) AS ship_city,
  CASE WHEN r_name = 'AMERICA' THEN 'US' ELSE r_name END AS ship_country,
  CAST(o_orderdate AS TIMESTAMP) AS processed_at
FROM orders
LEFT JOIN (SELECT c_custkey, c_nationkey, n_name, r_name
           FROM customer LEFT JOIN v_geo ON c_nationkey = n_nationkey) c
  ON o_custkey = c.c_custkey"""
_ORIG = ("CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') "
         "THEN CAST(o_orderkey - 1 AS VARCHAR) END")
STG["stg_transactions"] = _TX_BODY.format(orig=f"COALESCE({_ORIG}, 'None')")
STG["src_transactions"] = _TX_BODY.format(orig=_ORIG)

STG["stg_items"] = """
SELECT CAST(l_orderkey AS VARCHAR) AS transaction_id,
  CAST(l_linenumber - 1 AS INTEGER) AS line_item_index,
  CAST(o_custkey AS VARCHAR) AS user_id,
  CAST(o_orderdate AS TIMESTAMP) AS timestamp,
  'USD' AS currency,
  CAST(l_partkey AS VARCHAR) AS product_id,
  p_name AS product_name, p_type AS category, p_brand AS brand,
  CAST(l_quantity AS BIGINT) AS quantity,
  CAST(p_retailprice AS DECIMAL(18,2)) AS unit_price,
  CAST(CAST(l_quantity AS BIGINT) * CAST(p_retailprice AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS item_subtotal,
  CAST(l_shipdate AS TIMESTAMP) AS processed_at,
  l_suppkey AS tie1,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS tie2,
  CAST(l_discount AS DECIMAL(18,2)) AS tie3,
  CAST(l_tax AS DECIMAL(18,2)) AS tie4
FROM lineitem
LEFT JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN part ON l_partkey = p_partkey"""

_UE_BODY = """
SELECT CAST(event_id AS VARCHAR) AS event_id,
  CASE WHEN event_type = 'view' THEN 'page_view' WHEN event_type = 'purchase' THEN 'add_to_cart'
       WHEN event_type = 'error' THEN 'remove_from_cart' WHEN event_type = 'signup' THEN 'login'
       ELSE event_type END AS event_type,
  CAST(ts AS TIMESTAMP) AS timestamp,
  CAST(user_id AS VARCHAR) AS user_id,
  CAST(user_id AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS session_id,
  CASE WHEN event_id % 4 = 0 THEN 'home' WHEN event_id % 4 = 1 THEN 'cart'
       WHEN event_id % 4 = 2 THEN 'products' ELSE 'checkout' END AS page,
  CASE WHEN event_id % 3 = 0 THEN 'desktop' WHEN event_id % 3 = 1 THEN 'mobile'
       ELSE 'tablet' END AS device,
  CASE WHEN event_id % 4 = 0 THEN 'chrome' WHEN event_id % 4 = 1 THEN 'firefox'
       WHEN event_id % 4 = 2 THEN 'safari' ELSE 'edge' END AS browser,
  CASE WHEN user_id % 5 = 0 THEN 'CA' ELSE 'US' END AS country,
  'City' || CAST(user_id % 50 AS VARCHAR) AS city,
  {product} AS product_id,
  {qty} AS quantity,
  CAST(ts AS TIMESTAMP) AS processed_at
FROM events"""
_UE_PRODUCT = "CASE WHEN event_type IN ('purchase', 'error') THEN CAST(event_id % 200 AS VARCHAR) END"
_UE_QTY = ("CASE WHEN event_type IN ('purchase', 'error') "
           "THEN CAST(CAST(props ->> '$.k' AS BIGINT) % 5 + 1 AS INTEGER) END")
STG["stg_user_events"] = _UE_BODY.format(product=f"COALESCE({_UE_PRODUCT}, 'None')",
                                         qty=f"COALESCE({_UE_QTY}, 0)")
STG["src_user_events"] = _UE_BODY.format(product=_UE_PRODUCT, qty=_UE_QTY)

TX_COLS = ["transaction_id", "user_id", "transaction_type", "timestamp", "status", "payment_method",
           "currency", "original_transaction_id", "subtotal", "tax", "total", "bill_city",
           "bill_state", "bill_country", "ship_city", "ship_country", "processed_at"]
ITEM_SRC_COLS = ["transaction_id", "line_item_index", "user_id", "timestamp", "currency",
                 "product_id", "product_name", "category", "brand", "quantity", "unit_price",
                 "item_subtotal", "processed_at", "tie1", "tie2", "tie3", "tie4"]
UE_COLS = ["event_id", "event_type", "timestamp", "user_id", "session_id", "page", "device",
           "browser", "country", "city", "product_id", "quantity", "processed_at"]
CUST_COLS = ["user_id", "email", "first_name", "last_name", "registration_date", "account_type",
             "date_of_birth", "loyalty_points", "state", "processed_at"]
PROD_COLS = ["product_id", "product_name", "category", "subcategory", "brand", "manufacturer",
             "msrp", "cost_price", "created_date", "is_active", "processed_at"]


def latest_sql(src: str, keys: list[str], order: list[str], ties: list[str], where: str = "TRUE") -> str:
    """ROW_NUMBER()=1 per key: ``order`` desc, then ``ties`` asc
    (NULLS FIRST for asc, NULLS LAST for desc: Spark's defaults)."""
    ob = ", ".join([f"{c} DESC NULLS LAST" for c in order] + [f"{c} ASC NULLS FIRST" for c in ties])
    return (f"SELECT * EXCLUDE (rn__) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY "
            f"{', '.join(keys)} ORDER BY {ob}) AS rn__ FROM {src} WHERE {where}) WHERE rn__ = 1")


GOLD = {}
GOLD["fact_transactions"] = f"""
SELECT transaction_id, user_id, timestamp AS transaction_ts, CAST(timestamp AS DATE) AS transaction_date,
  transaction_type, status, payment_method, tax, total, subtotal,
  bill_country AS billing_country, bill_city AS billing_city, bill_state AS billing_state
FROM ({latest_sql('stg_transactions', ['transaction_id'], ['processed_at', 'timestamp'],
                  ['status', 'total'], 'timestamp IS NOT NULL')})"""
GOLD["transaction_items"] = f"""
SELECT transaction_id, user_id, timestamp, product_id, product_name, category, brand, quantity,
  unit_price, item_subtotal, currency, line_item_index
FROM ({latest_sql('stg_items', ['transaction_id', 'line_item_index'], ['processed_at', 'timestamp'], ['product_id', 'quantity'],
                  'transaction_id IS NOT NULL AND line_item_index IS NOT NULL')})"""
GOLD["fact_user_events"] = f"""
SELECT event_id, event_type, timestamp, user_id, session_id, page, device, browser, country, city,
  product_id, quantity
FROM ({latest_sql('stg_user_events', ['event_id'], ['processed_at', 'timestamp'],
                  ['event_type', 'page'], 'event_id IS NOT NULL')})"""
GOLD["dim_customer"] = f"""
SELECT user_id, first_name, last_name, first_name || ' ' || last_name AS full_name, email,
  account_type, registration_date, date_of_birth, loyalty_points, state, TRUE AS is_active
FROM ({latest_sql('stg_customers', ['user_id'], ['processed_at'], [c for c in CUST_COLS if c not in ('user_id', 'processed_at')])})"""
GOLD["dim_product"] = f"""
SELECT product_id, product_name, category, subcategory, manufacturer, brand, msrp, cost_price,
  created_date, is_active
FROM ({latest_sql('stg_products', ['product_id'], ['processed_at'], [c for c in PROD_COLS if c not in ('product_id', 'processed_at')])})"""

GOLD_ORDER = ["fact_transactions", "transaction_items", "fact_user_events", "dim_customer",
              "dim_product"]


def cents_ratio(amount: str, n: str) -> str:
    """Twin of ``rounded_ratio``: half-away-from-zero cents by integer division."""
    c = f"CAST(({amount}) * 100 AS HUGEINT)"
    return (f"CASE WHEN ({n}) = 0 THEN NULL ELSE CAST(CAST(sign({c}) * ((2 * abs({c}) + ({n})) "
            f"// (2 * ({n}))) AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,2)) END")


def with_chain(body: str, extra: dict | None = None) -> str:
    parts = [f"{k} AS ({v})" for k, v in STG.items()]
    parts += [f"{k} AS ({GOLD[k]})" for k in GOLD_ORDER]
    for k, v in (extra or {}).items():
        parts.append(f"{k} AS ({v})")
    return "WITH " + ",\n".join(parts) + "\n" + body
