import datetime as dt
import decimal
import os

import pytest
from pyspark.sql import functions as F

from tidewater.plans import marts, silver
from tidewater.plans.dims import dim_customer
from tidewater.session import scratch_dir
from tidewater.sources.bronze import load_bronze
from tidewater.sources.landing import extract_topics, quarantine, read_landing_json
from tidewater.sources.schemas import TOPICS, USER_EVENT


def write_lines(root, topic, lines):
    path = f"{root}/{topic}"
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/part-0.json", "w") as fh:
        fh.write("\n".join(lines) + "\n")
    return path


def test_malformed_line_goes_to_quarantine_and_fails_strict(spark):
    root = scratch_dir(spark, "bad_json")
    p = write_lines(root, "user_events", ['{"event_id": "e1", "event_type": "click"}', '{"event_id": '])
    good = read_landing_json(spark, p, USER_EVENT)
    assert [r.event_id for r in good.collect()] == ["e1"]
    assert quarantine(spark, p).count() == 1
    with pytest.raises(Exception):
        read_landing_json(spark, p, USER_EVENT, strict=True).collect()


def test_empty_topic_does_not_block_the_other(spark):
    root = scratch_dir(spark, "topics")
    write_lines(root, "user_events", ['{"event_id": "e1", "event_type": "click"}'])
    frames = extract_topics(spark, root)  # no transaction_events folder at all
    assert frames["transaction_events"].count() == 0
    assert frames["user_events"].count() == 1


def _bronze_from_rows(spark, rows, schema):
    root = scratch_dir(spark, "bronze_rows")
    spark.createDataFrame(rows, schema).write.parquet(f"{root}/p")
    return load_bronze(spark, f"{root}/p")


def test_silver_products_boolean_default_and_strict(spark):
    b = _bronze_from_rows(spark, [("p1", None), ("p2", "false"), ("p3", "zz")],
                          "product_id string, is_active string")
    got = dict((r.product_id, r.is_active) for r in silver.silver_products(b).collect())
    assert got == {"p1": True, "p2": False, "p3": True}
    with pytest.raises(Exception):
        silver.silver_products(b, strict_boolean=True).collect()


def test_flatten_empty_missing_null_items_give_no_rows(spark):
    b = _bronze_from_rows(spark, [("t1", []), ("t2", None)],
                          "transaction_id string, line_items array<struct<product_id:string>>")
    assert silver.silver_transaction_items(b).count() == 0


def test_bronze_row_numbers_are_one_based(spark):
    b = _bronze_from_rows(spark, [("a",), ("b",)], "x string")
    nums = sorted(r.row_num for r in b.collect())
    assert nums[0] == 1


TX = ("transaction_id string, user_id string, transaction_type string, timestamp timestamp_ntz, "
      "status string, bill_city string, bill_country string, bill_state string, total decimal(18,2), "
      "tax decimal(18,2)")


def test_no_purchase_day_gives_zero_orders_and_null_aov(spark):
    f = spark.createDataFrame([("t1", "u", "refund", dt.date(2024, 1, 1), "completed",
                                decimal.Decimal("-5.00"), decimal.Decimal("1.00"))],
                              "transaction_id string, user_id string, transaction_type string, "
                              "transaction_date date, status string, total decimal(18,2), tax decimal(18,2)")
    r = marts.daily_revenue(f).collect()[0]
    assert r.orders == 0 and r.avg_order_value is None and r.revenue == decimal.Decimal("-5.00")


def test_refund_without_items_gets_empty_array(spark):
    ts = dt.datetime(2024, 1, 1)
    tx = spark.createDataFrame([("t1", "u", "refund", ts, "completed", "c", "US", "s",
                                 decimal.Decimal("-1"), decimal.Decimal("0"))], TX)
    items = spark.createDataFrame([], "transaction_id string, product_id string, product_name string, "
                                      "category string, brand string, quantity bigint, unit_price decimal(18,2), "
                                      "item_subtotal decimal(18,2), currency string, line_item_index int")
    r = marts.refund_items_nested(tx, items).collect()[0]
    assert r.purchase_items == []


def test_full_name_null_when_last_name_null(spark):
    c = spark.createDataFrame([("u1", "e", "Ann", None, dt.datetime(2024, 1, 1))],
                              "user_id string, email string, first_name string, last_name string, "
                              "processed_at timestamp_ntz")
    c = c.withColumns({k: F.lit(None).cast(t) for k, t in [("registration_date", "date"),
                      ("date_of_birth", "date"), ("account_type", "string"),
                      ("loyalty_points", "bigint"), ("state", "string")]})
    assert dim_customer(c).collect()[0].full_name is None


def test_risk_latest_location_ties_broken_by_location(spark):
    ts = dt.datetime(2024, 1, 1, 10)
    tx = spark.createDataFrame([
        ("t1", "u", "refund", ts, "completed", "A", "US", "s", decimal.Decimal("-1"), decimal.Decimal("0")),
        ("t2", "u", "chargeback", ts, "completed", "B", "US", "s", decimal.Decimal("-1"), decimal.Decimal("0")),
    ], TX)
    dim = spark.createDataFrame([("u", "N", "e")], "user_id string, full_name string, email string")
    r = marts.customer_risk(tx, dim).collect()[0]
    assert (r.num_refunds, r.num_chargebacks, r.bill_city) == (1, 1, "B")


def test_a_landed_line_is_parsed_once_and_the_items_shuffled_once(spark):
    from tidewater.operators.clean import standardize_transactions
    from tidewater.plans import layers as P
    from tidewater.sources.landing import parse_lines
    from tidewater.sources.schemas import TOPICS
    from tests.conftest import SF_SMALL
    lines = spark.createDataFrame([('{"transaction_id": "1"}',)], "value string")
    plan = standardize_transactions(parse_lines(lines, TOPICS["transaction_events"]))._jdf.queryExecution().executedPlan().toString()
    assert sum(line.count("parseJson(") for line in plan.split("\n")) == 1
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        items = P.packed_sources(spark, SF_SMALL)["transaction_events"]._jdf.queryExecution().executedPlan().toString().split("collect_list", 1)[1]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert items.count("Exchange hashpartitioning(transaction_id") == 1 and "Exchange hashpartitioning(transaction_id#" in items
