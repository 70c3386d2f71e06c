"""Batch ETL job: landing JSON topics -> cleaned Parquet, validated, new files only.

    spark-submit -m tidewater.plans.etl --landing L --out O [--from D] [--to D] [--archive A] [--config k=v ...]

Each topic is read, standardized and written on its own, so an empty or
missing topic never blocks the other.  A run takes the files that no run has
taken before (a checkpointed file stream, drained once) and appends them below
``out/<topic>/batch=<n>``; a repeated batch rewrites its own folder.  Lines
without a JSON object go to ``out/<topic>/_quarantine``.  ``--archive`` moves
consumed files there.  ``--from`` and ``--to`` never keep a row out: after the
new files are taken whole, the days of the range are computed anew from all
landed files, archived ones too, and replace those days in the output
(``reprocess``).  Errors are not swallowed: the job exits non-zero and
the scheduler's retry can act, and so it does if a batch breaks a rule.
``--config`` pairs are split on the first ``=`` only.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators.clean import standardize_transactions, standardize_user_events
from tidewater.operators.quality import assert_quality, quality_report
from tidewater.plans.layers import EVENT_TOPICS, with_month, write_cleaned
from tidewater.session import read_note, write_note
from tidewater.sources.landing import parse_lines
from tidewater.sources.schemas import TOPICS

CLEAN = {"transaction_events": standardize_transactions, "user_events": standardize_user_events}
KEYS = {"transaction_events": ["transaction_id"], "user_events": ["event_id"]}
#: Topics whose batches must hold each key once; user events pass through as they come.
UNIQUE = {"transaction_events"}


def parse_config(pairs) -> dict:
    out = {}
    for p in pairs or []:
        if "=" not in p:
            raise ValueError(f"--config expects key=value, got {p!r}")
        k, v = p.split("=", 1)
        out[k.strip()] = v.strip()
    return out


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def between(df: DataFrame, start: str | None, end: str | None) -> DataFrame:
    """Rows whose event date lies in [start, end]; rows without a date only without bounds."""
    return df.filter(_inside(start, end)) if start or end else df


def _inside(start: str | None, end: str | None) -> Column:
    day = F.col("event_date")
    after = day >= F.lit(start).cast("date") if start else day.isNotNull()
    return after & (day <= F.lit(end).cast("date")) if end else after


def run_etl(spark: SparkSession, landing: str, out: str, topics=EVENT_TOPICS, start: str | None = None,
            end: str | None = None, archive: str | None = None) -> dict[str, str]:
    """Clean every topic that has a landing folder; returns topic -> cleaned folder.

    With ``start`` or ``end`` the days of that range are reprocessed afterwards.
    """
    from tidewater.streaming.jobs import ingest_landing

    done = {}
    for topic in topics:
        source, target = f"{landing.rstrip('/')}/{topic}", f"{out.rstrip('/')}/{topic}"
        if not _exists(spark, source):
            continue

        began = dt.datetime.now(dt.timezone.utc)

        def write(rows: DataFrame, path: str, topic: str = topic) -> None:
            write_cleaned(CLEAN[topic](rows), path, topic)
            if topic in UNIQUE and not _empty(spark, path):
                assert_quality(quality_report({topic: (spark.read.parquet(path), KEYS[topic])}))

        ingest_landing(spark, source, topic, target, f"{out.rstrip('/')}/_checkpoints/{topic}",
                       archive_dir=f"{archive.rstrip('/')}/{topic}" if archive else None, clean=write)
        if start or end:
            reprocess(spark, [source, *([f"{archive.rstrip('/')}/{topic}"] if archive else [])], target, topic, start, end, began)
        done[topic] = target
    return done


PLACE = ["batch", "event_month"]


def reprocess(spark: SparkSession, sources: list[str], target: str, topic: str, start: str | None, end: str | None,
              before: dt.datetime) -> None:
    """Replaces the days of [start, end] in a cleaned topic by what the landed files below ``sources`` give now.

    The files are read plainly, apart from the incremental run's checkpoint, as
    long as they landed ``before`` it began, so that none is taken twice.  A
    repeated transaction is dropped across all of them.
    Only folders that hold a day of the range are read and overwritten (Spark's
    dynamic partition overwrite); their other days stay.  New rows lie below
    ``batch=-<run>``.  The new content is staged first, so a run that is lost
    half way is finished by the next run of the same range.
    """
    staged = f"{target.rsplit('/', 1)[0]}/_reprocess/{topic}/{start or 'begin'}_{end or 'end'}"
    touched = read_note(spark, f"{staged}/touched")
    if touched is None:
        lines = [spark.read.option("recursiveFileLookup", True).text(p).filter(F.col("_metadata.file_modification_time") < F.lit(before))
                 .select("value") for p in sources if _exists(spark, p)]
        fresh = between(CLEAN[topic](parse_lines(reduce(DataFrame.union, lines), TOPICS[topic])), start, end)
        held = None if _no_batches(spark, target) else spark.read.parquet(target)
        run, places = -1, []
        if held is not None:
            run = min(held.agg(F.min("batch")).first()[0], 0) - 1
            places = between(held, start, end).select(*PLACE).distinct()
            kept = held.filter(~F.coalesce(_inside(start, end), F.lit(False))).join(F.broadcast(places), PLACE, "left_semi")
        new = with_month(fresh).withColumn("batch", F.lit(run))
        if topic in UNIQUE:
            assert_quality(quality_report({topic: (new, KEYS[topic])}).filter("row_count > 0"))
        rows = new if held is None else new.unionByName(kept.withColumn("batch", F.col("batch").cast("int")))
        rows.hint("rebalance", *PLACE).write.mode("overwrite").parquet(f"{staged}/rows")
        touched = [[r.batch, str(r.event_month)] for r in places.collect()] if held is not None else []
        write_note(spark, f"{staged}/touched", touched)
    rows = spark.read.parquet(f"{staged}/rows")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PLACE).parquet(target)
    left = {(r.batch, str(r.event_month)) for r in rows.select(*PLACE).distinct().collect()}
    for batch, month in touched:
        if (batch, month) not in left:
            _delete(spark, f"{target}/batch={batch}/event_month={month}")
    _delete(spark, staged)


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def _no_batches(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return not fs.exists(p) or not any(st.getPath().getName().startswith("batch=") and not _empty(spark, st.getPath().toString()) for st in fs.listStatus(p))


def _empty(spark: SparkSession, path: str) -> bool:
    """Whether a written folder holds no partition: nothing was left of the batch."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return not any(st.isDirectory() for st in p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p))


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(description="landing JSON -> cleaned Parquet")
    ap.add_argument("--landing", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--from", dest="start")
    ap.add_argument("--to", dest="end")
    ap.add_argument("--archive")
    ap.add_argument("--name", default="tidewater-etl")
    ap.add_argument("--master", default=None)
    ap.add_argument("--config", action="append")
    a = ap.parse_args(argv)
    from tidewater.session import build_session
    spark = build_session(a.master, app=a.name, extra=parse_config(a.config))
    try:
        print(run_etl(spark, a.landing, a.out, start=a.start, end=a.end, archive=a.archive))
        return 0
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
