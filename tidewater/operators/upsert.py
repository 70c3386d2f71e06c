"""Keyed upsert (MERGE ... WHEN MATCHED UPDATE / WHEN NOT MATCHED INSERT).

Plain Parquet takes no MERGE, so the merge is one full outer join on the key
(null-safe by default, still planned as an equi-join).  ``operators.tables``
writes it back, partition by partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.latest import keep_latest

_T, _S = "__tw_t", "__tw_s"
CHANGE, BEFORE = "__tw_change", "__tw_before"


def merge_upsert(target: DataFrame, source: DataFrame, keys, update_cols=None, insert_cols=None,
                 insert_defaults: dict | None = None, null_safe: bool = True,
                 source_order: str | None = None, stamp: Column | None = None,
                 stamp_col: str = "processed_at", track: tuple | None = None) -> DataFrame:
    """Return the target after the upsert.

    * ``update_cols`` (default: every non-key column the source has) are
      overwritten on matched rows; other target columns keep their values.
    * ``insert_cols`` (default: every column the source has) are taken from
      the source for new keys; the rest get ``insert_defaults`` or NULL.
    * The source must hold one row per key; ``source_order`` enforces that by
      keep-latest on that column first.
    * ``stamp`` (e.g. ``current_timestamp()``) is written to ``stamp_col`` on
      updated and inserted rows.
    * ``null_safe=False`` mirrors plain ``=`` matching (a NULL key never
      matches, so it is inserted again on every run).
    * ``track`` names columns that do not count as changes (an empty tuple:
      all count) and adds ``CHANGE`` ('insert', 'update' or null) and
      ``BEFORE`` (the row as it was, of updates).
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if source_order:
        source = keep_latest(source, keys, source_order)
    tcols = target.columns
    scols = set(source.columns)
    upd = [c for c in (update_cols or [c for c in tcols if c in scols]) if c not in keys]
    ins = list(insert_cols or [c for c in tcols if c in scols])
    defaults = insert_defaults or {}

    s = source.select(*[F.col(c).alias(f"{_S}{c}") for c in source.columns], F.lit(True).alias(_S))
    t = target.withColumn(_T, F.lit(True))
    cond = None
    for k in keys:
        e = t[k].eqNullSafe(s[f"{_S}{k}"]) if null_safe else (t[k] == s[f"{_S}{k}"])
        cond = e if cond is None else cond & e
    j = t.join(s, cond, "full_outer")
    matched = F.col(_T).isNotNull() & F.col(_S).isNotNull()
    new = F.col(_T).isNull()
    out = []
    for c in tcols:
        dtype = target.schema[c].dataType
        src_val = F.col(f"{_S}{c}") if c in scols else None
        if c == stamp_col and stamp is not None:
            ins_val = stamp
            upd_val = stamp
        else:
            ins_val = src_val if (c in ins and src_val is not None) else F.lit(defaults.get(c))
            upd_val = src_val if (c in upd and src_val is not None) else F.col(c)
        if c in keys:
            expr = F.when(new, src_val).otherwise(F.col(c))
        else:
            expr = F.when(new, ins_val).when(matched, upd_val).otherwise(F.col(c))
        out.append(expr.cast(dtype).alias(c))
    if track is None:
        return j.select(*out)
    compared = [c for c in tcols if c not in track]
    held = F.struct(*[F.col(c) for c in tcols])
    rows = j.select(*out, F.when(matched, held).alias(BEFORE), new.alias(_T))
    differs = F.col(BEFORE).isNotNull() & ~F.struct(*[F.col(f"{BEFORE}.{c}").alias(c) for c in compared]).eqNullSafe(
        F.struct(*[F.col(c) for c in compared]))
    rows = rows.withColumn(CHANGE, F.when(F.col(_T), "insert").when(differs, "update")).drop(_T)
    return rows.withColumn(BEFORE, F.when(F.col(CHANGE) == "update", F.col(BEFORE)))
