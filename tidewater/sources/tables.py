"""Readers for the driver's Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
                 "lineitem", "events")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet table, listed afresh on every call; the scan's own splits set its parallelism."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
