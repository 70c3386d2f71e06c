"""Landing -> cleaned Parquet -> bronze -> silver, as batch steps.

``land_fixtures`` packs the driver-derived sources into landing JSON (one
folder per topic) under the shared folder; ``clean_topics`` is the ETL job
(standardize + Parquet in month folders); ``bronze``/``silver`` read back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators.clean import standardize_transactions, standardize_user_events
from tidewater.plans import facts
from tidewater.session import free_shuffles, remove_folder, scratch_dir
from tidewater.sources import fixtures as fx
from tidewater.sources.bronze import load_bronze
from tidewater.sources.landing import (pack_customers, pack_products, pack_transaction_events,
                                       pack_user_events, read_landing_json, write_json_lines)
from tidewater.sources.schemas import TOPICS
from tidewater.sources.sinks import write_parquet

EVENT_TOPICS = ("transaction_events", "user_events")
DIM_TOPICS = ("customers", "products")


def packed_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    tx = fx.stg_transactions(spark, sf_dir, defaults=False)
    items = facts.transaction_items(fx.stg_items(spark, sf_dir), all_read=True)
    return {
        "transaction_events": pack_transaction_events(tx, items),
        "user_events": pack_user_events(fx.stg_user_events(spark, sf_dir, defaults=False)),
        "customers": pack_customers(fx.stg_customers(spark, sf_dir)),
        "products": pack_products(fx.stg_products(spark, sf_dir)),
    }


def land_fixtures(spark: SparkSession, sf_dir: str, topics=EVENT_TOPICS + DIM_TOPICS) -> str:
    """Landing folders of the given topics, written with the input's own parallelism; a fresh root on every call."""
    root = scratch_dir(spark, "landing")
    sources = packed_sources(spark, sf_dir)
    for topic in topics:
        write_json_lines(sources[topic], f"{root}/{topic}")
        free_shuffles(spark)
    return root


def clean_topic(spark: SparkSession, landing_root: str, topic: str) -> DataFrame:
    df = read_landing_json(spark, f"{landing_root}/{topic}", TOPICS[topic])
    if topic == "transaction_events":
        return standardize_transactions(df)
    if topic == "user_events":
        return standardize_user_events(df)
    return df


def with_month(df: DataFrame, date_col: str = "event_date") -> DataFrame:
    """``event_month``, the first day of the month: the folder column of event tables.
    Days would be thousands of folders of a few rows each; the day stays a column."""
    return df.withColumn("event_month", F.trunc(F.col(date_col).cast("date"), "MM"))


def write_cleaned(df: DataFrame, path: str, topic: str, mode: str = "overwrite") -> str:
    if topic in EVENT_TOPICS:
        return write_parquet(with_month(df), path, partition_by=("event_month",), mode=mode)
    return write_parquet(df, path, partition_by=(), mode=mode)


def clean_topics(spark: SparkSession, sf_dir: str, topics=EVENT_TOPICS + DIM_TOPICS) -> dict[str, str]:
    """The ETL step: each topic cleaned and written on its own, so an empty or
    failing topic never blocks the other.  Its landing folder, made for it, goes behind it."""
    landing = land_fixtures(spark, sf_dir, topics)
    root, done = scratch_dir(spark, "cleaned"), {}
    for t in topics:
        done[t] = write_cleaned(clean_topic(spark, landing, t), f"{root}/{t}", t)
        remove_folder(spark, f"{landing}/{t}")
        free_shuffles(spark)
    return done


def bronze(spark: SparkSession, sf_dir: str, topic: str) -> DataFrame:
    return load_bronze(spark, clean_topics(spark, sf_dir, (topic,))[topic])
