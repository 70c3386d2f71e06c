"""Sinks (IO5, IO7, IO11-IO13): Parquet/CSV writers, staging publish, bucketed tables.

No single-file ``coalesce(1)``: every task writes its own file, and a
date-partitioned dataset is overwritten one partition at a time (dynamic
partition overwrite), so a rerun of one day never touches another.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, partition_by=("event_date",), mode: str = "overwrite",
                  files: int | None = None) -> str:
    """Write Parquet; with ``partition_by`` one folder per value.

    Rows are range-partitioned on (partition value, row hash): each task then
    holds a contiguous run of dates and writes a few folders, not one file per
    date per task, while the hash part lets the sampler cut a hot date into
    several tasks instead of sending it to one.
    """
    cols = [c for c in (partition_by or []) if c in df.columns]
    if cols:
        df = cluster_by_partition(df, cols, files)
    w = df.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    if cols:
        w = w.partitionBy(*cols)
    w.parquet(path)
    return path


def cluster_by_partition(df: DataFrame, cols, files: int | None = None) -> DataFrame:
    """Range-partition on (partition columns, row hash) before a partitioned
    write: ``files`` writer tasks (default: the configured shuffle
    parallelism), each covering a contiguous run of partition values."""
    n = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = F.xxhash64(*[F.col(c) for c in df.columns])
    return df.repartitionByRange(n, *[F.col(c) for c in cols], spread)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("header", True).csv(path)
    return path


def publish_staging(df: DataFrame, staging_root: str, dataset: str, batch_id: str) -> str:
    """Append-only publish: each load lands in its own ``batch=<id>`` folder under
    ``staging/<dataset>/``; existing objects are never overwritten."""
    path = f"{staging_root.rstrip('/')}/{dataset}/batch={batch_id}"
    df.write.mode("errorifexists").parquet(path)
    return path


def write_bucketed(df: DataFrame, spark: SparkSession, table: str, path: str, key: str,
                   buckets: int, partition_by=()) -> str:
    """Bucketed + sorted catalog table, in folders of ``partition_by`` if given: later joins on
    ``key`` with the same bucket count read co-located data and skip the shuffle, and a join
    on a folder column with a filtered dimension reads only the folders that it names."""
    if partition_by:  # each bucket's rows of a folder in one file
        df = df.repartition(buckets, key)
    w = df.write.mode("overwrite").format("parquet").option("path", path)
    w = w.partitionBy(*partition_by) if partition_by else w
    w.bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return table


@contextlib.contextmanager
def catalog_tables(spark: SparkSession, *names: str) -> Iterator[tuple[str, ...]]:
    """Table names of this block alone; the tables are dropped behind it."""
    tag = uuid.uuid4().hex[:12]
    tables = tuple(f"tw_{n}_{tag}" for n in names)
    try:
        yield tables
    finally:
        for t in tables:
            spark.sql(f"DROP TABLE IF EXISTS {t}")


def replace_table(df: DataFrame, path: str) -> str:
    """Full replace: the table at ``path`` holds exactly ``df`` from now on.

    The rows are one folder (``whole=1``) that Spark's dynamic overwrite swaps
    when all of them are written, so readers see the old state or the new one.
    """
    df.withColumn("whole", F.lit(1)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("whole").parquet(path)
    return path


def read_replaced(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("whole")
