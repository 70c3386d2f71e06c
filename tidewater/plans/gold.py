"""Persisted silver and gold tables, kept up to date from change feeds.

A batch of silver rows is upserted into its table, and the rows that differ
appear in the table's feed.  Every gold table is a consumer of one or two feeds
with its own position in them (a batch number here, a checkpoint in a stream),
so one that is slow or stopped neither holds up nor starves another.

* Facts and dimensions upsert the new rows of the feed; facts have feeds too.
* Revenue and spend marts hold sums: a changed row takes its old share away
  and adds its new one.  They read the feed and the touched months of the mart.
* Risk, refund and nested-item marts are not sums of rows: the keys that a feed
  names are computed anew from the tables.  That is right however far the
  tables are ahead of the consumer, as later batches name their keys again.

Customer names are joined when a mart is read, so a new name needs no upkeep.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.casts import rounded_ratio
from tidewater.operators.changes import newest, signed
from tidewater.operators.latest import keep_latest
from tidewater.operators.quality import assert_quality, quality_report
from tidewater.operators.tables import merge_sums, read_table, replace_keys, upsert_partitions
from tidewater.plans import dims, facts, marts
from tidewater.plans.layers import with_month

TX_KEY, ITEM_KEY, EVENT_KEY = ["transaction_id"], ["transaction_id", "line_item_index"], ["event_id"]
NEWEST = ["processed_at", "timestamp"]
MONTH, BUCKET = "event_month", "bucket"
BUCKETS = 16


class Silver(NamedTuple):
    table: str
    keys: list[str]
    order: list[str]
    ties: list[str] | None


SILVER = {
    "transactions": Silver("stg_transactions", TX_KEY, NEWEST, facts.TX_TIES),
    "items": Silver("stg_transaction_items", ITEM_KEY, NEWEST, facts.ITEM_TIES),
    "events": Silver("stg_user_events", EVENT_KEY, NEWEST, facts.EVENT_TIES),
    "customers": Silver("stg_customers", ["user_id"], ["processed_at"], None),
    "products": Silver("stg_products", ["product_id"], ["processed_at"], None),
}


def _bucketed(rows: DataFrame, key: str) -> DataFrame:
    return rows.withColumn(BUCKET, F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int"))


def _share(column: str, type_: str = "decimal(38,2)") -> list:
    """Signed sum of a column and of its rows that are not null, which tell an empty sum from zero."""
    return [F.coalesce(F.sum(F.col("sign") * F.col(column)), F.lit(0)).cast(type_).alias(column),
            F.coalesce(F.sum(F.when(F.col(column).isNotNull(), F.col("sign"))), F.lit(0)).cast("long").alias(f"n_{column}")]


def _rows() -> F.Column:
    return F.sum("sign").cast("long").alias("n_rows")


def _sum_of(column: str) -> F.Column:
    return F.when(F.col(f"n_{column}") != 0, F.col(column))


class GoldTables:
    """Tables below ``root``: five of silver, two dimensions, three facts and six marts, and the feeds between them."""

    MARTS = ("daily_revenue", "revenue_by_category", "refunds_by_category", "customer_daily_spend", "customer_risk",
             "refund_items_nested")

    def __init__(self, spark: SparkSession, root: str, kept_marts=MARTS):
        self.spark, self.root = spark, root
        always = [c for c in CONSUMERS if c not in self.MARTS]
        self.consumers = [*always, *[m for m in self.MARTS if m in kept_marts]]

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def feed(self, name: str) -> str:
        return f"{self.root}/_feeds/{name}"

    def current(self, table: str) -> DataFrame | None:
        """A table as it is stored, with its folder column."""
        return read_table(self.spark, self.path(table))

    def read(self, table: str) -> DataFrame | None:
        """A table as its users see it: without folder columns, marts with their derived columns."""
        rows = self.current(table)
        if rows is None:
            return None
        if table in VIEWS:
            rows = VIEWS[table](self, rows)
        return rows.drop(MONTH, BUCKET)

    # ------------------------------------------------------------- batches
    def load(self, feed: str, rows: DataFrame, n: int) -> None:
        """Upserts batch ``n`` into a silver table and publishes what changed."""
        s = SILVER[feed]
        rows = keep_latest(rows.filter(F.col(s.keys[0]).isNotNull()) if feed == "events" else rows, s.keys, s.order, tie_breakers=s.ties)
        rows = _bucketed(rows, s.keys[0]) if feed in ("customers", "products") else with_month(rows, "timestamp")
        upsert_partitions(rows, self.path(s.table), s.keys, BUCKET if feed in ("customers", "products") else MONTH, n, feed=self.feed(feed))

    def consume(self, consumer: str, feeds: dict[str, DataFrame], n: int) -> None:
        """One batch of a consumer: rows (change, before, after) of a batch of its feeds, or of several with their ``batch``."""
        CONSUMERS[consumer].fold(self, feeds, n)

    def apply(self, n: int, **rows: DataFrame | None) -> None:
        """Batch ``n`` of rows of the feeds in SILVER through all tables; the last ``n`` may be repeated."""
        for feed, new in rows.items():
            if new is not None:
                self.load(feed, new, n)
        for name in self.consumers:
            feeds = {f: self.feed_batch(f, n) for f in CONSUMERS[name].feeds}
            feeds = {f: df for f, df in feeds.items() if df is not None}
            if feeds:
                self.consume(name, feeds, n)

    def feed_batch(self, feed: str, n: int) -> DataFrame | None:
        return read_table(self.spark, f"{self.feed(feed)}/batch={n}")

    def validate(self) -> DataFrame:
        """Rows, null keys and repeated keys of every table that has rows; fails the run where a rule is broken."""
        known = {name: self.current(name) for name in KEYS}
        report = quality_report({name: (rows, KEYS[name]) for name, rows in known.items() if rows is not None})
        assert_quality(report)
        return report

    # ------------------------------------------------------------- facts and dimensions
    def _upsert(self, table: str, rows: DataFrame, keys: list[str], part: str, n: int, feed: bool = False) -> None:
        upsert_partitions(rows, self.path(table), keys, part, n, feed=self.feed(table) if feed else None)

    def _fact_transactions(self, feeds: dict, n: int) -> None:
        rows = newest(feeds["transactions"], TX_KEY).filter("timestamp is not null")
        self._upsert("fact_transactions", with_month(facts.project_transactions(rows), "transaction_date"), TX_KEY, MONTH, n, feed=True)

    def _transaction_items(self, feeds: dict, n: int) -> None:
        rows = newest(feeds["items"], ITEM_KEY).filter("transaction_id is not null and line_item_index is not null")
        self._upsert("transaction_items", with_month(rows.select(*facts.ITEM_COLS), "timestamp"), ITEM_KEY, MONTH, n, feed=True)

    def _fact_user_events(self, feeds: dict, n: int) -> None:
        rows = newest(feeds["events"], EVENT_KEY).select(*facts.USER_EVENT_COLS)
        self._upsert("fact_user_events", with_month(rows, "timestamp"), EVENT_KEY, MONTH, n)

    def _dim_customer(self, feeds: dict, n: int) -> None:
        self._upsert("dim_customer", _bucketed(dims.dim_customer(newest(feeds["customers"], "user_id")), "user_id"), ["user_id"], BUCKET, n)

    def _dim_product(self, feeds: dict, n: int) -> None:
        self._upsert("dim_product", _bucketed(dims.dim_product(newest(feeds["products"], "product_id")), "product_id"), ["product_id"], BUCKET, n)

    # ------------------------------------------------------------- marts of sums
    def _daily_revenue(self, feeds: dict, n: int) -> None:
        rows = signed(feeds["fact_transactions"]).filter("status = 'completed'")
        orders = F.sum(F.when(F.col("transaction_type") == "purchase", F.col("sign")).otherwise(0)).cast("long").alias("orders")
        deltas = rows.groupBy(F.col("transaction_date").alias("sales_date")).agg(_rows(), orders, *_share("total"), *_share("tax"))
        merge_sums(with_month(deltas, "sales_date"), self.path("daily_revenue"), ["sales_date"], MONTH, n)

    def _revenue_by_category(self, feeds: dict, n: int) -> None:
        deltas = (signed(feeds["transaction_items"]).groupBy(F.col("timestamp").cast("date").alias("sales_date"), "category")
                  .agg(_rows(), *_share("quantity", "long"), *_share("item_subtotal")))
        merge_sums(with_month(deltas, "sales_date"), self.path("revenue_by_category"), ["sales_date", "category"], MONTH, n)

    def _customer_daily_spend(self, feeds: dict, n: int) -> None:
        deltas = (signed(feeds["fact_transactions"]).filter("status = 'completed'")
                  .groupBy(F.col("transaction_date").alias("sales_date"), "user_id").agg(_rows(), *_share("total")))
        merge_sums(with_month(deltas, "sales_date"), self.path("customer_daily_spend"), ["sales_date", "user_id"], MONTH, n)

    # ------------------------------------------------------------- marts by key
    def _affected(self, mart: str, keys: DataFrame, n: int) -> DataFrame:
        """The keys that batch ``n`` names for a mart, computed once, whatever reads them."""
        path = f"{self.path(mart)}-staged/batch={n:012d}/named"
        keys.distinct().write.mode("overwrite").parquet(path)
        return self.spark.read.schema(keys.schema).parquet(path)

    def _months(self, table: str, days: DataFrame, day: str) -> DataFrame | None:
        """The months of a table that hold the given days; a semi join on the folder column, which prunes the rest."""
        rows = self.current(table)
        if rows is None:
            return None
        months = with_month(days, day).select(MONTH).distinct()
        return rows.join(F.broadcast(months), rows[MONTH].eqNullSafe(months[MONTH]), "left_semi")

    def _customer_risk(self, feeds: dict, n: int) -> None:
        named = (_refunds(signed(feeds["transactions"])).select("user_id", F.col("timestamp").cast("date").alias("event_date")))
        named = self._affected("customer_risk", named, n)
        source = self._months("stg_transactions", named, "event_date").withColumn("event_date", F.col("timestamp").cast("date"))
        mine = source.join(named, [source[k].eqNullSafe(named[k]) for k in ("user_id", "event_date")], "left_semi").drop("event_date")
        replace_keys(with_month(marts.risk_counts(mine)), named, self.path("customer_risk"), ["user_id", "event_date"], MONTH, n)

    def _refunds_by_category(self, feeds: dict, n: int) -> None:
        tx, items = self.current("fact_transactions"), self.current("transaction_items")
        if tx is None or items is None:
            return
        days = self.spark.createDataFrame([], "sales_date date")
        if "fact_transactions" in feeds:
            days = days.union(_refunds(signed(feeds["fact_transactions"])).select("transaction_date"))
        if "transaction_items" in feeds:
            ids = signed(feeds["transaction_items"]).select("transaction_id").distinct()
            days = days.union(_refunds(tx).join(ids, "transaction_id", "left_semi").select("transaction_date"))
        days = F.broadcast(self._affected("refunds_by_category", days, n))  # never more than the calendar has
        mine = _refunds(self._months("fact_transactions", days, "sales_date"))
        mine = mine.join(days, mine["transaction_date"].eqNullSafe(days["sales_date"]), "left_semi")
        rows = marts.refunds_by_category(items.join(mine.select("transaction_id"), "transaction_id", "left_semi"), mine)
        replace_keys(with_month(rows, "sales_date"), days, self.path("refunds_by_category"), ["sales_date"], MONTH, n)

    def _refund_items_nested(self, feeds: dict, n: int) -> None:
        stg, items = self.current("stg_transactions"), self.current("transaction_items")
        if stg is None:
            return
        ids = self.spark.createDataFrame([], "transaction_id string")
        if "transactions" in feeds:
            ids = ids.union(_refunds(signed(feeds["transactions"])).select("transaction_id"))
        if "transaction_items" in feeds:
            touched = signed(feeds["transaction_items"]).select("transaction_id").distinct()
            ids = ids.union(_refunds(stg).join(touched, "transaction_id", "left_semi").select("transaction_id"))
        ids = self._affected("refund_items_nested", ids, n)
        if items is None:
            items = self.spark.createDataFrame([], _ITEM_SCHEMA)
        rows = marts.refund_items_nested(stg.join(ids, "transaction_id", "left_semi"), items.join(ids, "transaction_id", "left_semi"))
        replace_keys(with_month(rows, "timestamp"), ids, self.path("refund_items_nested"), ["transaction_id"], MONTH, n)


_ITEM_SCHEMA = ("transaction_id string, line_item_index int, product_id string, product_name string, category string, brand string, "
                "quantity bigint, unit_price decimal(18,2), item_subtotal decimal(38,2), currency string")


def _refunds(rows: DataFrame) -> DataFrame:
    return rows.filter((F.col("status") == "completed") & F.col("transaction_type").isin(*marts.REFUND_TYPES))


class Consumer(NamedTuple):
    feeds: tuple[str, ...]
    fold: Callable[[GoldTables, dict, int], None]


#: Every gold table, after the tables whose feeds it takes.
CONSUMERS = {
    "fact_transactions": Consumer(("transactions",), GoldTables._fact_transactions),
    "transaction_items": Consumer(("items",), GoldTables._transaction_items),
    "fact_user_events": Consumer(("events",), GoldTables._fact_user_events),
    "dim_customer": Consumer(("customers",), GoldTables._dim_customer),
    "dim_product": Consumer(("products",), GoldTables._dim_product),
    "daily_revenue": Consumer(("fact_transactions",), GoldTables._daily_revenue),
    "revenue_by_category": Consumer(("transaction_items",), GoldTables._revenue_by_category),
    "refunds_by_category": Consumer(("fact_transactions", "transaction_items"), GoldTables._refunds_by_category),
    "customer_daily_spend": Consumer(("fact_transactions",), GoldTables._customer_daily_spend),
    "customer_risk": Consumer(("transactions",), GoldTables._customer_risk),
    "refund_items_nested": Consumer(("transactions", "transaction_items"), GoldTables._refund_items_nested),
}


#: Keys that hold no null; those of the marts by category or user may, and are not checked.
KEYS = {
    **{s.table: s.keys for s in SILVER.values()}, "fact_transactions": TX_KEY, "transaction_items": ITEM_KEY, "fact_user_events": EVENT_KEY,
    "dim_customer": ["user_id"], "dim_product": ["product_id"], "daily_revenue": ["sales_date"], "refund_items_nested": TX_KEY,
}


def _named(gold: GoldTables, rows: DataFrame, columns: list[str]) -> DataFrame:
    customers = gold.current("dim_customer")
    if customers is None:
        customers = gold.spark.createDataFrame([], "user_id string, full_name string, email string")
    return marts.with_names(rows, customers, columns)


VIEWS = {
    "daily_revenue": lambda g, m: (m.select("sales_date", "orders", _sum_of("total").alias("revenue"), _sum_of("tax").alias("tax"))
                                   .withColumn("avg_order_value", rounded_ratio("revenue", "orders"))),
    "revenue_by_category": lambda g, m: m.select("sales_date", "category", _sum_of("quantity").alias("units_sold"),
                                                 _sum_of("item_subtotal").alias("revenue")),
    "customer_daily_spend": lambda g, m: _named(g, m.select("sales_date", "user_id", F.col("n_rows").alias("orders"), _sum_of("total").alias("spend")),
                                                ["sales_date", "user_id", "customer_name", "email", "orders", "spend"]),
    "customer_risk": lambda g, m: _named(g, m, marts.RISK_COLS),
}
