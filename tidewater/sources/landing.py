"""Landing zone: JSON-lines files per topic (IO1-IO4, IO10).

The topic source is written for Kafka (``read_topic``); where that connector
is not installed the JSON file source under ``landing/<topic>/`` is used, with
the same parser, quarantine and downstream code.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from tidewater.sources.schemas import CORRUPT, TOPICS

ISO_Z = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def parse_lines(lines: DataFrame, schema, strict: bool = False) -> DataFrame:
    """JSON text lines (column ``value``) -> typed rows, one per line that is a JSON object.

    Fields are path lookups with ``try_`` casts, so a number written as text,
    or text where a number belongs, keeps its row (the field is NULL if it
    cannot be read) and the rows never depend on the columns asked for.
    ``strict`` fails on the first line that is no object or has a number field
    that is none, also when only other columns are read.
    """
    text = lines.filter(F.trim("value") != "")
    # exploded, each line is parsed once; as a plain column it would be parsed for every filter on a field
    v = F.col("__tw_v")
    if strict:
        rows = text.select("value", F.explode(F.array(F.try_parse_json("value"))).alias("__tw_v"))
        rows = rows.filter(F.when(_is_object(v) & ~_drifts(v, schema), True).otherwise(
            F.raise_error(F.concat(F.lit("malformed record: "), F.substring("value", 1, 200))).cast("boolean")))
    else:
        rows = text.select(F.explode(F.filter(F.array(F.try_parse_json("value")), lambda x: _is_object(x))).alias("__tw_v"))
    return rows.select(*[_typed(v, f.dataType, f"$.{f.name}").alias(f.name) for f in schema.fields])


def _is_object(v: F.Column, path: str = "$") -> F.Column:
    return F.try_variant_get(v, path, "struct<>").isNotNull()  # no field is asked for, so none is copied


def _typed(v: F.Column, kind, path: str = "$") -> F.Column:
    """What lies at a path of a variant, by one lookup for every plain value."""
    if isinstance(kind, StructType):
        inner = F.struct(*[_typed(v, f.dataType, f"{path}.{f.name}").alias(f.name) for f in kind.fields])
        return F.when(_is_object(v, path), inner)
    if isinstance(kind, ArrayType):
        return F.transform(F.try_variant_get(v, path, "array<variant>"), lambda x: _typed(x, kind.elementType))
    return F.try_variant_get(v, path, kind.simpleString())


def _drifts(v: F.Column, kind) -> F.Column:
    """Whether a value is there but cannot be read as its field's type."""
    if isinstance(kind, StructType):
        checks = [_drifts(F.try_variant_get(v, f"$.{f.name}", "variant"), f.dataType) for f in kind.fields]
        return F.coalesce(reduce(lambda a, b: a | b, checks), F.lit(False))
    if isinstance(kind, ArrayType):
        return F.coalesce(F.exists(F.try_variant_get(v, "$", "array<variant>"), lambda x: _drifts(x, kind.elementType)), F.lit(False))
    text = F.try_variant_get(v, "$", "string")
    return F.coalesce(text.isNotNull() & F.try_variant_get(v, "$", kind.simpleString()).isNull(), F.lit(False))


def _text(spark: SparkSession, path: str) -> DataFrame | None:
    """The folder's lines; None where there is no folder."""
    try:
        return spark.read.text(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return None
        raise


def read_landing_json(spark: SparkSession, path: str, schema, strict: bool = False) -> DataFrame:
    """The good lines of a landing folder with a fixed schema; the others are ``quarantine``'s.

    A missing folder is an empty frame, not an error.
    """
    lines = _text(spark, path)
    return spark.createDataFrame([], schema) if lines is None else parse_lines(lines, schema, strict)


def bad_lines(lines: DataFrame) -> DataFrame:
    """Lines that hold something but no JSON object."""
    return lines.filter((F.trim("value") != "") & ~_is_object(F.try_parse_json("value")))


def quarantine(spark: SparkSession, path: str) -> DataFrame:
    """The malformed lines of a landing folder, for a dead-letter table, with their file.
    Good and quarantined lines together are all lines that are not blank."""
    lines = _text(spark, path)
    if lines is None:
        return spark.createDataFrame([], f"{CORRUPT} string, source_file string")
    return bad_lines(lines).select(F.col("value").alias(CORRUPT), F.col("_metadata.file_path").alias("source_file"))


def extract_topics(spark: SparkSession, landing_root: str, topics=None) -> dict[str, DataFrame]:
    """One frame per topic folder; each topic is independent of the others."""
    names = topics or ["transaction_events", "user_events"]
    return {t: read_landing_json(spark, f"{landing_root.rstrip('/')}/{t}", TOPICS[t]) for t in names}


def read_topic(spark: SparkSession, bootstrap: str, topic: str, streaming: bool = True, starting: str = "earliest",
               max_offsets: int | None = None) -> DataFrame:
    """Kafka topic -> its messages as lines (needs the Kafka connector on the class path).

    They go through ``parse_lines`` and the quarantine like the lines of a
    file.  ``max_offsets`` bounds one micro-batch.
    """
    src = (spark.readStream if streaming else spark.read).format("kafka")
    src = src.option("kafka.bootstrap.servers", bootstrap).option("subscribe", topic).option("startingOffsets", starting)
    return topic_lines((src.option("maxOffsetsPerTrigger", max_offsets) if max_offsets else src).load())


def topic_lines(messages: DataFrame) -> DataFrame:
    """Messages (binary ``value``, whatever else) as text lines; a message without a value is a blank line."""
    return messages.select(F.coalesce(F.col("value").cast("string"), F.lit("")).alias("value"))


# ----------------------------------------------------------- packing to JSON

def pack_transaction_events(tx: DataFrame, items: DataFrame) -> DataFrame:
    """Typed transactions + unique items -> transaction-event shape.

    Items are grouped per transaction on the map side of one shuffle by
    transaction_id; the join that follows reuses that partitioning.
    A transaction without items carries no ``line_items`` field.
    """
    li = (items.groupBy(F.col("transaction_id").alias("_tid"))
          .agg(F.sort_array(F.collect_list(F.struct(
              "line_item_index", "product_id", "product_name", "category", "brand",
              "quantity", "unit_price"))).alias("_li")))
    j = tx.join(li, tx.transaction_id == li._tid, "left")

    def addr(city, country):
        return F.struct(F.lit(None).cast("string").alias("street"), F.col(city).alias("city"),
                        F.col("bill_state").alias("state"), F.lit(None).cast("string").alias("zip_code"),
                        F.col(country).alias("country"))

    return j.select(
        "transaction_id", "user_id", "transaction_type",
        F.date_format("timestamp", ISO_Z).alias("timestamp"),
        "status", "payment_method", "currency",
        F.transform("_li", lambda x: x.dropFields("line_item_index")).alias("line_items"),
        "subtotal", "tax", "total",
        addr("bill_city", "bill_country").alias("billing_address"),
        addr("ship_city", "ship_country").alias("shipping_address"),
        "original_transaction_id",
    )


def pack_user_events(ev: DataFrame) -> DataFrame:
    return ev.select(
        "event_id", "user_id", "session_id", "event_type",
        F.date_format("timestamp", ISO_Z).alias("timestamp"),
        "page", "device", "browser", "country", "city", "product_id",
        F.col("quantity").cast("bigint").alias("quantity"))


def pack_customers(c: DataFrame) -> DataFrame:
    return c.select("user_id", "email", "first_name", "last_name",
                    F.col("registration_date").cast("string").alias("registration_date"),
                    "account_type",
                    F.col("date_of_birth").cast("string").alias("date_of_birth"),
                    "loyalty_points", "state")


def pack_products(p: DataFrame) -> DataFrame:
    return p.select("product_id", "product_name", "category", "subcategory", "brand",
                    "manufacturer", "msrp", "cost_price",
                    F.col("created_date").cast("string").alias("created_date"), "is_active")


def write_json_lines(df: DataFrame, path: str) -> str:
    """One compressed file per task; Spark's text readers take it as it is."""
    df.write.mode("overwrite").option("compression", "gzip").json(path)
    return path
