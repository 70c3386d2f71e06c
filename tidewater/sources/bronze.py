"""Bronze layer (IO8, IO9): every cleaned row kept whole as one VARIANT value,
with the file it came from and its 1-based row number within that file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BRONZE_COLS = ["raw", "source_file", "row_num"]


def to_bronze(df: DataFrame) -> DataFrame:
    """``df`` must come straight from a Parquet scan (it reads ``_metadata``)."""
    payload = [c for c in df.columns]
    return df.select(
        F.to_variant_object(F.struct(*payload)).alias("raw"),
        F.col("_metadata.file_path").alias("source_file"),
        (F.col("_metadata.row_index") + 1).alias("row_num"),
    )


def load_bronze(spark: SparkSession, cleaned_path: str, schema=None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return to_bronze(reader.parquet(cleaned_path))


def stream_bronze(spark: SparkSession, cleaned_path: str, schema) -> DataFrame:
    """Streaming twin: the file source's checkpoint makes each file load once."""
    return to_bronze(spark.readStream.schema(schema).parquet(cleaned_path))
