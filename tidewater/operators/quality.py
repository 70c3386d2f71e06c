"""Output validation (IO14): row count, NULL keys and duplicated keys per table.

Each table costs one aggregation: the per-key counts are pre-aggregated on
the map side, so a hot key is one row per task in the shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def table_quality(name: str, df: DataFrame, keys) -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"),
                                    F.max(null_key.cast("int")).alias("has_null"))
    out = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("row_count"),
        F.coalesce(F.sum(F.when(F.col("has_null") == 1, F.col("n"))), F.lit(0)).cast("bigint").alias("null_keys"),
        F.count_if(F.col("n") > 1).alias("duplicate_keys"))
    return out.select(F.lit(name).alias("table_name"), "row_count", "null_keys", "duplicate_keys",
                      ((F.col("row_count") > 0) & (F.col("null_keys") == 0)
                       & (F.col("duplicate_keys") == 0)).alias("passed"))


def quality_report(tables: dict) -> DataFrame:
    """``tables``: name -> (DataFrame, key columns)."""
    return reduce(DataFrame.unionByName, [table_quality(n, df, ks) for n, (df, ks) in tables.items()])


def assert_quality(report: DataFrame) -> None:
    """Fail the job when any rule breaks (the report is a handful of rows)."""
    bad = report.filter(~F.col("passed")).select("table_name").collect()
    if bad:
        raise ValueError(f"output validation failed for: {[r.table_name for r in bad]}")
