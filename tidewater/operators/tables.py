"""Keyed Parquet tables kept batch by batch with Spark's dynamic partition overwrite.

A batch computes the new rows of the partitions it touches, old and new, and
stages them beside the table; then those partitions, and no others, are
overwritten from there.  Staging comes first because an overwrite that is lost
half way has to be repeated from rows that do not depend on the table.  Batches
come in order of their number; the last one may be repeated, and if it was
staged it is applied again rather than computed from a table that has it.  What
is staged goes as soon as nothing needs it: the batch when it is merged, the rows
when they are in the table.

An upserted table has a folder per batch in each partition: only partitions in
which a key of the batch is held are written anew, to the others its rows are added.

Partition columns are dates or integers, as their text is a folder's name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from tidewater.operators.changes import inserts
from tidewater.operators.upsert import BEFORE, CHANGE, merge_upsert
from tidewater.session import free_shuffles, read_note, write_note
from tidewater.session import remove_folder as _remove

_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
_ADDED = "tw_batch"     # folder below a partition of an upserted table: the batch that wrote its rows
_CHANGED = "tw_changed"  # folder of staged rows: whether the feed has them
_APPLIED = "applied"    # note beside a staged batch: it is in the table, whole
_MOST_ADDED = 16        # a partition with more batches than this is written anew by the next batch


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _children(spark: SparkSession, path: str) -> list[str]:
    p, fs = _path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def _has(spark: SparkSession, path: str) -> bool:
    return any(not c.startswith(("_", ".")) for c in _children(spark, path))


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None where it has no rows."""
    return spark.read.parquet(path).drop(_ADDED) if _has(spark, path) else None


def _table(like: DataFrame, path: str, part: str) -> DataFrame:
    """The table to which rows such as ``like`` go; empty before its first batch."""
    table = read_table(like.sparkSession, path)
    if table is None:
        return like.sparkSession.createDataFrame([], like.schema)
    return table.withColumn(part, F.col(part).cast(like.schema[part].dataType))  # folders of nulls alone have no type


def _within(part: str, values: list) -> Column:
    known = [v for v in values if v is not None]
    found = F.col(part).isin(known) if known else F.lit(False)
    return found | F.col(part).isNull() if None in values else found & F.col(part).isNotNull()


def _values(df: DataFrame, part: str) -> list:
    """Distinct partition values of a batch; there are never more than the table has folders."""
    return [r[0] for r in df.select(part).distinct().collect()]


def _text(value) -> str | None:
    return None if value is None else str(value)


def _folder(path: str, part: str, text: str | None) -> str:
    return f"{path}/{part}={_NULL_FOLDER if text is None else text}"


def _forget(spark: SparkSession, path: str, n: int) -> None:
    """Removes what batches before ``n`` staged."""
    for old in _children(spark, f"{path}-staged"):
        if old < f"batch={n:012d}":
            _remove(spark, f"{path}-staged/{old}")


def _clear(spark: SparkSession, staged: str) -> None:
    """Notes that a staged batch is in the table, and removes its rows."""
    write_note(spark, f"{staged}/{_APPLIED}", True)
    for part in ("batch", "keys", "rows"):
        _remove(spark, f"{staged}/{part}")


def _fold(spark: SparkSession, path: str, part: str, n: int, make: Callable[[str], tuple]) -> None:
    """Stages and applies batch ``n``; ``make(folder)`` gives (new rows, partition values touched)."""
    staged = f"{path}-staged/batch={n:012d}"
    done = _children(spark, staged)
    if _APPLIED in done:
        return
    if "touched" not in done:
        rows, touched = make(staged)
        if not touched:
            return
        # a folder's rows meet in a few tasks; Spark splits those of a large folder by measured size
        rows.hint("rebalance", part).write.mode("overwrite").parquet(f"{staged}/rows")
        write_note(spark, f"{staged}/touched", [_text(v) for v in touched])  # the last: what is staged is whole
        free_shuffles(spark)
    rows = spark.read.parquet(f"{staged}/rows")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(path)
    left = {_text(v) for v in _values(rows, part)}
    for folder in read_note(spark, f"{staged}/touched"):
        if folder not in left:  # all of its rows moved away
            _remove(spark, _folder(path, part, folder))
    _clear(spark, staged)
    _forget(spark, path, n)


def _published(spark: SparkSession, feed: str, n: int) -> bool:
    p, fs = _path(spark, f"{feed}/batch={n}")
    return fs.exists(p)


def _publish(spark: SparkSession, staged: str, feed: str, n: int) -> None:
    """The finished feed batch appears under its name at once and is never written again: readers take each file once."""
    target, fs = _path(spark, f"{feed}/batch={n}")
    if not fs.exists(target):
        fs.mkdirs(target.getParent())
        fs.rename(_path(spark, staged)[0], target)


def _writer(rows: DataFrame) -> DataFrameWriter:
    return rows.write.mode("overwrite").option("compression", "zstd")


def _with_changes(merged: DataFrame) -> DataFrame:
    """Rows of a merge in the shape of a feed, and whether they belong to it."""
    columns = [c for c in merged.columns if c not in (CHANGE, BEFORE)]
    row = F.struct(*columns).alias("after")
    if CHANGE not in merged.columns:
        return merged.select(F.lit(False).alias(_CHANGED), row)
    return merged.select(F.col(CHANGE).isNotNull().alias(_CHANGED), F.col(CHANGE).alias("change"), F.col(BEFORE).alias("before"), row)


def upsert_partitions(batch: DataFrame, path: str, keys, part: str, n: int, feed: str | None = None,
                      ignore=("processed_at",), **options) -> None:
    """Merges batch ``n`` (one row per key) into the table at ``path``, which is partitioned by ``part``.

    The partitions that hold the batch's keys now are found by a semi join with
    the key and partition columns of the table.  They alone are merged and
    written anew; in other partitions the batch's rows are added in a folder of
    their own.  A key whose partition changes leaves the old one.  A null
    partition value is a partition like any other; a partition without rows
    goes.  With ``feed`` the rows that differ afterwards (in more than
    ``ignore``) appear in ``feed/batch=<n>``; the merge's own join tells them.
    Rows are staged in the feed's shape, so that its part of them becomes the
    feed; a batch that is published was applied.  Options are those of
    ``merge_upsert``.
    """
    spark = batch.sparkSession
    keys = [keys] if isinstance(keys, str) else list(keys)
    staged = f"{path}-staged/batch={n:012d}"
    done = _children(spark, staged)
    if _APPLIED in done or feed is not None and _published(spark, feed, n):
        return
    if "touched" not in done:
        given = inserts(batch)
        _writer(given).parquet(f"{staged}/batch")  # computed once, whatever reads it
        rows = spark.read.schema(given.schema).parquet(f"{staged}/batch").select("after.*")
        new = _values(rows, part)
        if not new:
            return
        held = []
        if read_table(spark, path) is not None:
            table = _table(rows, path, part)
            found = table.join(rows.select(*keys), [table[k].eqNullSafe(rows[k]) for k in keys], "left_semi")
            held = _values(found, part)
            held += [v for v in new if v not in held and len(_children(spark, _folder(path, part, _text(v)))) > _MOST_ADDED]
        merge = bool(held or options)
        if merge:
            table = _table(rows, path, part)
            merged = merge_upsert(table.filter(_within(part, held)), rows, keys, track=tuple(ignore) if feed else None, **options)
            merged = _with_changes(merged)
            _writer(merged).partitionBy(_CHANGED).parquet(f"{staged}/rows")
            if feed and f"{_CHANGED}=true" not in _children(spark, f"{staged}/rows"):  # nothing differs
                merged.drop(_CHANGED).limit(0).write.parquet(f"{staged}/rows/{_CHANGED}=true")
        write_note(spark, f"{staged}/touched", {"merged": merge, "anew": [_text(v) for v in held]})  # the last: what is staged is whole
        free_shuffles(spark)
    note = read_note(spark, f"{staged}/touched")
    if note["merged"]:
        _remove(spark, f"{staged}/batch")
    rows = spark.read.parquet(f"{staged}/rows" if note["merged"] else f"{staged}/batch").select("after.*")
    # a folder's rows meet in a few tasks; Spark splits those of a large folder by measured size
    rows = rows.hint("rebalance", part).withColumn(_ADDED, F.lit(n))
    _writer(rows).option("partitionOverwriteMode", "dynamic").partitionBy(part, _ADDED).parquet(path)
    for folder in (_folder(path, part, text) for text in note["anew"]):
        written = _children(spark, folder)
        if f"{_ADDED}={n}" not in written:  # all of its rows moved away
            _remove(spark, folder)
        for old in written:
            if old != f"{_ADDED}={n}":
                _remove(spark, f"{folder}/{old}")
    if feed is not None:
        _publish(spark, f"{staged}/rows/{_CHANGED}=true" if note["merged"] else f"{staged}/batch", feed, n)
    _clear(spark, staged)
    _forget(spark, path, n)
    free_shuffles(spark)


def merge_sums(deltas: DataFrame, path: str, keys, part: str, n: int, rows: str = "n_rows") -> None:
    """Adds batch ``n`` of signed sums to a table of sums, one row per key; a key whose ``rows`` come to nothing goes.

    All columns but the keys and ``part``, which follows from them, are added
    up.  Only partitions with a key of the batch are read.
    """
    spark = deltas.sparkSession
    keys = [keys] if isinstance(keys, str) else list(keys)
    sums = [c for c in deltas.columns if c not in keys and c != part]
    changed = deltas.filter(" or ".join(f"{c} <> 0" for c in sums))

    def make(staged: str) -> tuple:
        changed.write.mode("overwrite").parquet(f"{staged}/batch")
        more = spark.read.schema(deltas.schema).parquet(f"{staged}/batch")
        touched = _values(more, part)
        base = _table(more, path, part).filter(_within(part, touched))
        total = [F.sum(c).cast(deltas.schema[c].dataType).alias(c) for c in sums]
        return base.unionByName(more).groupBy(*keys, part).agg(*total).filter(F.col(rows) != 0).select(*deltas.columns), touched

    _fold(spark, path, part, n, make)


def replace_keys(rows: DataFrame, affected: DataFrame, path: str, keys, part: str, n: int) -> None:
    """The keys in ``affected`` have exactly ``rows`` from now on (none, if none are given); ``keys`` may be part of a row's key."""
    spark = rows.sparkSession
    keys = [keys] if isinstance(keys, str) else list(keys)

    def make(staged: str) -> tuple:
        rows.write.mode("overwrite").parquet(f"{staged}/batch")
        affected.select(*keys).distinct().write.mode("overwrite").parquet(f"{staged}/keys")
        new, gone = spark.read.schema(rows.schema).parquet(f"{staged}/batch"), spark.read.parquet(f"{staged}/keys")
        table = _table(new, path, part)
        same = [table[k].eqNullSafe(gone[k]) for k in keys]
        touched = _values(table.join(gone, same, "left_semi").select(part).unionByName(new.select(part)), part)
        base = table.filter(_within(part, touched))
        kept = base.join(gone, [base[k].eqNullSafe(gone[k]) for k in keys], "left_anti")
        return kept.unionByName(new), touched

    _fold(spark, path, part, n, make)
