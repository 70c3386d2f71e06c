"""Change feeds: the rows in which two states of a keyed table differ.

A feed row is (change, before, after): an insert has no ``before``, a delete no
``after``, an update both.  Unchanged rows do not occur, so a consumer's work
follows the changes, and sums can be kept by taking the old row's share away
and adding the new one's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _same(left: DataFrame, right: DataFrame, keys) -> list:
    return [left[k].eqNullSafe(right[k]) for k in keys]


def changes_between(before: DataFrame, after: DataFrame, keys, ignore=()) -> DataFrame:
    """Feed that turns ``before`` into ``after``; both hold one row per key and the same columns.

    Rows that differ in ``ignore`` columns alone (load stamps) count as the
    same.  Keys match null-safe.  Maps and variants cannot be compared.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    compared = [c for c in after.columns if c not in ignore]

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(*[F.col(k).alias(f"{name}_{i}") for i, k in enumerate(keys)], F.struct(*after.columns).alias(name),
                         F.struct(*compared).alias(f"{name}_compared"))

    old, new = side(before, "before"), side(after, "after")
    on = [F.col(f"before_{i}").eqNullSafe(F.col(f"after_{i}")) for i in range(len(keys))]
    rows = old.join(new, on, "full_outer").filter(~F.col("before_compared").eqNullSafe(F.col("after_compared")))
    change = F.when(F.col("before").isNull(), "insert").when(F.col("after").isNull(), "delete").otherwise("update")
    return rows.select(change.alias("change"), "before", "after")


def inserts(after: DataFrame) -> DataFrame:
    """Feed that fills an empty table."""
    row = F.struct(*after.columns)
    return after.select(F.lit("insert").alias("change"), row.alias("after")).select(
        "change", F.when(F.lit(False), F.col("after")).alias("before"), "after")


def apply_changes(state: DataFrame, feed: DataFrame, keys) -> DataFrame:
    """The state after a feed with one change per key."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    touched = feed.select(*[F.coalesce(F.col(f"after.{k}"), F.col(f"before.{k}")).alias(k) for k in keys])
    kept = state.join(touched, _same(state, touched, keys), "left_anti")
    return kept.unionByName(feed.filter("after is not null").select("after.*"))


def signed(feed: DataFrame) -> DataFrame:
    """Rows of a feed with ``sign``: -1 for what was, 1 for what is now."""
    both = F.array(F.struct(F.lit(-1).alias("sign"), F.col("before").alias("row")), F.struct(F.lit(1).alias("sign"), F.col("after").alias("row")))
    return feed.select(F.explode(both).alias("s")).filter("s.row is not null").select("s.sign", "s.row.*")


def _names_once(feed: DataFrame) -> bool:
    found = feed.agg(F.count_if(F.col("change") != "insert").alias("later"), F.min("batch").eqNullSafe(F.max("batch")).alias("alone")).first()
    return found.alone or not found.later


def newest(feed: DataFrame, keys) -> DataFrame:
    """The last state of every key in several batches of a feed (column ``batch``) or, without that column, in one,
    which names each key once; deleted keys are left out.

    Batches that only insert name each key once, too, and so does one batch that
    comes alone, which is looked up in two small columns: only others are grouped.
    """
    if "batch" not in feed.columns or _names_once(feed):
        return feed.filter("after is not null").select("after.*")
    keys = [keys] if isinstance(keys, str) else list(keys)
    key = [F.coalesce(F.col(f"after.{k}"), F.col(f"before.{k}")).alias(f"key_{i}") for i, k in enumerate(keys)]
    last = feed.groupBy(*key).agg(F.max_by("after", "batch").alias("after"))
    return last.filter("after is not null").select("after.*")
