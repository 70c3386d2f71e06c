"""Gold dimensions (TB6-TB8): SCD type 1, one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.casts import date_key, day_name, iso_day_of_week, month_name
from tidewater.operators.latest import keep_latest

DIM_DATE_MARGIN_DAYS = 30  # days added on each side of the data (fixed value)


def dim_customer(stg_customers: DataFrame, as_of=None) -> DataFrame:
    latest = keep_latest(stg_customers, "user_id", "processed_at")
    return latest.select(
        "user_id", "first_name", "last_name",
        F.concat(F.col("first_name"), F.lit(" "), F.col("last_name")).alias("full_name"),
        "email", "account_type", "registration_date", "date_of_birth", "loyalty_points", "state",
        F.lit(True).alias("is_active"),
        (as_of if as_of is not None else F.current_timestamp()).alias("processed_at"),
    )


def dim_product(stg_products: DataFrame, as_of=None) -> DataFrame:
    latest = keep_latest(stg_products, "product_id", "processed_at")
    return latest.select(
        "product_id", "product_name", "category", "subcategory", "manufacturer", "brand",
        "msrp", "cost_price", "created_date", "is_active",
        (as_of if as_of is not None else F.current_timestamp()).alias("processed_at"),
    )


def dim_date(stg_transactions: DataFrame) -> DataFrame:
    """Calendar 30 days either side of the data, every day of it.

    The bounds are one global min/max (partial aggregation on every task, one
    row to the final step); the span is generated from that single row and is
    bounded by the date type, so it never grows with the data.
    """
    d = F.col("timestamp").cast("date")
    bounds = (stg_transactions.filter(F.col("timestamp").isNotNull())
              .agg(F.date_sub(F.min(d), DIM_DATE_MARGIN_DAYS).alias("min_d"),
                   F.date_add(F.max(d), DIM_DATE_MARGIN_DAYS).alias("max_d")))
    span = bounds.filter(F.col("min_d").isNotNull()).select(
        F.explode(F.sequence(F.col("min_d"), F.col("max_d"))).alias("d"))
    d = F.col("d")
    dow = iso_day_of_week(d)
    return span.select(
        date_key(d).alias("date_key"),
        d.alias("date_value"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        month_name(d).alias("month_name"),
        F.dayofmonth(d).alias("day"),
        F.weekofyear(d).alias("week_of_year"),
        dow.alias("day_of_week"),
        day_name(d).alias("day_name"),
        dow.isin(6, 7).alias("is_weekend"),
    )
