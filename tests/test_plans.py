"""Plan checks: pushdown, pre-shuffle group limit, no cartesian products."""

import pytest

from tests.conftest import SF_SMALL
from tidewater import catalog
from tidewater.operators.joins import broadcast_if_small


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(spark, df):
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def test_scan_filters_and_columns(spark):
    """The null filter reaches the scan, and daily revenue reads the order columns it needs, no more."""
    txt = formatted(spark, catalog.QUERIES["daily_revenue"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(o_orderdate)]" in txt
    schemas = [line for line in txt.splitlines() if line.startswith("ReadSchema")]
    read = {c.split(":")[0] for line in schemas for c in line.split("<", 1)[1].rstrip(">").split(",")}
    assert {"o_orderkey", "o_orderdate", "o_totalprice", "o_orderstatus", "o_orderpriority"} <= read
    assert not read & {"n_name", "r_name", "o_clerk", "o_comment"}  # nothing that it does not show


def test_ranking_joins_no_rows_on_the_month_alone(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        txt = plan(catalog.QUERIES["customer_ranked"](spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    joins = [line for line in txt.splitlines() if "Join" in line]
    assert joins and all("spend" in j or "_range" in j for j in joins if "month" in j)


def test_keep_latest_limits_before_shuffle(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        txt = plan(catalog.QUERIES["transaction_items"](spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    i_ex = txt.find("Exchange hashpartitioning")
    below = txt[i_ex:]
    assert "WindowGroupLimit" in below, txt


@pytest.mark.parametrize("key", [k for k in catalog.QUERIES
                                 if not any(w in k for w in ("stream", "ingest", "archive", "change",
                                                             "bucketed", "backfill", "roundtrip",
                                                             "staging", "replay", "bronze", "silver",
                                                             "landing", "extract", "strict",
                                                             "flatten_items", "gold_", "upsert_", "updates", "dirty", "quarantine", "landings", "ranked"))])
def test_no_cartesian_product(spark, key):
    txt = plan(catalog.QUERIES[key](spark, SF_SMALL))
    assert "CartesianProduct" not in txt and "BroadcastNestedLoopJoin" not in txt


def test_broadcast_only_under_limit(spark):
    small = broadcast_if_small(spark.range(10))
    assert "broadcast" in small._jdf.queryExecution().analyzed().toString().lower()
    big = broadcast_if_small(spark.range(10), limit_bytes=1)
    assert "broadcast" not in big._jdf.queryExecution().analyzed().toString().lower()
