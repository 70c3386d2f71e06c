"""Row-level cleaning (PR1-PR6, PR9, PR13)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.casts import try_date
from tidewater.operators.latest import keep_latest

# fixed values: the transaction cleaning contract
TRANSACTION_REQUIRED = ["transaction_type", "status", "line_items", "transaction_id", "user_id"]
TRANSACTION_FILL = {"payment_method": "USD"}
TRANSACTION_KEY = ["transaction_id"]


def drop_na(df: DataFrame, subset) -> DataFrame:
    present = [c for c in subset if c in df.columns]
    return df.dropna(subset=present) if present else df


def fill_na(df: DataFrame, values: dict) -> DataFrame:
    present = {k: v for k, v in values.items() if k in df.columns}
    return df.fillna(present) if present else df


def drop_duplicates(df: DataFrame, subset=None, order_by=None, descending: bool = False) -> DataFrame:
    """Whole-row duplicates go by ``dropDuplicates()``.  With a key subset the
    survivor is chosen by a total order (``order_by`` then every other column),
    so it does not depend on partitioning: the first row by default."""
    if not subset:
        return df.dropDuplicates()
    order = list(order_by or [])
    if not order:
        return keep_latest(df, subset, [], descending=descending)
    return keep_latest(df, subset, order, descending=descending)


def add_event_date(df: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    """``event_date`` from the event time; bad text gives NULL, never an error."""
    return df.withColumn("event_date", try_date(ts_col))


def standardize(df: DataFrame, drop_na_cols=None, fill_na_values=None, dedupe_keys=None,
                dedupe_order=None) -> DataFrame:
    """Optional drop-na, fill-na, dedupe in this fixed order, then ``event_date``."""
    if drop_na_cols:
        df = drop_na(df, drop_na_cols)
    if fill_na_values:
        df = fill_na(df, fill_na_values)
    if dedupe_keys:
        df = drop_duplicates(df, dedupe_keys, dedupe_order, descending=bool(dedupe_order))
    return add_event_date(df)


def standardize_transactions(df: DataFrame) -> DataFrame:
    """Of events with one id the newest survives."""
    return standardize(df, TRANSACTION_REQUIRED, TRANSACTION_FILL, TRANSACTION_KEY, ["timestamp"])


def standardize_user_events(df: DataFrame) -> DataFrame:
    return standardize(df)


def coalesce_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """Missing value -> default ('None', 0, TRUE ...), type kept."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType))
                           for c, v in defaults.items() if c in df.columns})


def dynamic_columns(df: DataFrame, spec: dict) -> DataFrame:
    """Apply a column spec: ``add`` {name: SQL expr}, ``cast`` {name: type},
    ``rename`` {old: new}, ``drop`` [names] — in that order, all one projection."""
    if spec.get("add"):
        df = df.withColumns({k: F.expr(v) for k, v in spec["add"].items()})
    if spec.get("cast"):
        df = df.withColumns({k: F.col(k).cast(t) for k, t in spec["cast"].items()})
    if spec.get("rename"):
        df = df.withColumnsRenamed(spec["rename"])
    if spec.get("drop"):
        df = df.drop(*spec["drop"])
    return df
