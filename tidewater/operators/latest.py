"""Keep-latest: one row per key, the newest by an order column.

``row_number() = 1`` over a window partitioned by the key.  Catalyst plans it
with a partial ``WindowGroupLimit`` *below* the shuffle, so every map task
already keeps one row per key before anything is exchanged: a key that holds a
third of all rows costs one row per map task in the shuffle, not a third of
the data.  The order is made total by ascending tie-breakers over the other
columns, so the survivor never depends on the run; where some are named as
``tie_breakers``, those come first, then a hash of the rest, then the rest.
Rows that differ in a map or variant alone are alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

_RN = "__tw_rn"


def _orderable(df: DataFrame, name: str) -> bool:
    dt = df.schema[name].dataType
    return not isinstance(dt, (MapType, VariantType))


def keep_latest(df: DataFrame, keys, order_by, descending: bool = True,
                tie_breakers=None, settled_last=(), all_read: bool = False) -> DataFrame:
    """One row per key, see above.

    ``settled_last`` are columns that a reader may not need: the order goes over
    all others, and of rows equal in those the smallest tuple of these is taken,
    by an aggregate that Spark drops, with the columns below it, where nothing
    above reads them.  With ``all_read`` they end the order instead, which gives
    the same rows without the aggregate's sort by every column.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    order_by = [order_by] if isinstance(order_by, str) else list(order_by or [])
    key_cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    order = [F.col(c).desc() if descending else F.col(c).asc() for c in order_by]
    others = [c for c in df.columns if c not in {*keys, *order_by, *(tie_breakers or []), *settled_last} and _orderable(df, c)]
    order += [F.col(c).asc() for c in tie_breakers or []]
    if tie_breakers is not None and others:
        order.append(F.xxhash64(*others).asc())  # settles nearly every tie in one comparison
    order += [F.col(c).asc() for c in others]
    if all_read:
        order += [F.col(c).asc() for c in settled_last]
    w = Window.partitionBy(*key_cols).orderBy(*order)
    if all_read or not settled_last:
        return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)
    alike = df.withColumn(_RN, F.rank().over(w)).filter(F.col(_RN) == 1).drop(_RN)
    # rows of one key are equal in every grouping column here, and already in one task
    one = alike.groupBy(*[c for c in df.columns if c not in settled_last]).agg(F.min(F.struct(*settled_last)).alias(_RN))
    return one.select(*[F.col(f"{_RN}.{c}").alias(c) if c in settled_last else F.col(c) for c in df.columns])
