"""Helpers of the training-data operators: table reads, written intermediate tables, Arrow maps."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import scratch_dir


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_SHIPPED: set[str] = set()


def _ship_package(spark: SparkSession) -> None:
    """Spark sends the package to the workers, which need not have it on their path."""
    package = Path(__file__).resolve().parents[1]
    app = spark.sparkContext.applicationId
    if app in _SHIPPED or not package.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="tidewater-package-")) / "tidewater_package.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(app)


def small_batches(df: DataFrame, most: str = "8m") -> DataFrame:
    """``df`` itself; its session has the package on the workers, and hands them rows of about ``most`` bytes at a time, from now on."""
    _ship_package(df.sparkSession)
    for key, value in (("spark.sql.execution.arrow.maxRecordsPerBatch", "2000"), ("spark.sql.execution.arrow.maxBytesPerBatch", most)):
        df.sparkSession.conf.set(key, value)
    return df


def written(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """The rows of ``df`` as a Parquet table in the shared folder: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark, name)}/table"
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Freed memory of this worker goes back to the system, where the C library can; workers live on between tasks and stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, most: str = "8m") -> DataFrame:
    """``fn`` over every Arrow batch; batches of whole rows, one in memory at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = fn(batch)
            if out is not None and out.num_rows:
                yield out
        give_back()

    return small_batches(df, most).mapInArrow(run, schema)


def broadcast_up_to(df: DataFrame, rows: int) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows; else as it is, for a shuffle join."""
    return F.broadcast(df) if df.count() <= rows else df
