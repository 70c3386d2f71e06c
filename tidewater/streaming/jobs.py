"""Structured Streaming jobs (SR1-SR9, IO1, IO2, IO6, IO8).

Every job is incremental through its checkpoint: ``trigger(availableNow=True)``
drains what has arrived and stops (a finite task for a scheduler), and the
same query with ``processingTime`` runs forever and is returned to the caller.
Writes go through ``foreachBatch`` into tables that take a batch number, so a
replayed micro-batch (at-least-once input) leaves them unchanged.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators.tables import read_table
from tidewater.plans import silver as S
from tidewater.plans.gold import CONSUMERS, GoldTables
from tidewater.sources.bronze import to_bronze
from tidewater.sources.landing import bad_lines, parse_lines, read_topic
from tidewater.sources.schemas import TOPICS


def _run(writer, available_now: bool = True, every: str = "2 minutes"):
    """A finished query, its failure raised; or the running one."""
    w = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)
    q = w.start()
    if available_now:
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
    return q


def _batch_time() -> Column:
    """One literal per micro-batch, so all of its writes carry the same stamp."""
    return F.lit(dt.datetime.now(dt.timezone.utc))


def ingest_landing(spark: SparkSession, landing_dir: str, topic: str, out_dir: str, checkpoint: str,
                   max_files: int | None = None, archive_dir: str | None = None,
                   available_now: bool = True, every: str = "5 seconds", clean=None):
    """Topic folder -> typed Parquet below ``out_dir/batch=<n>``, each file once (checkpointed).

    Lines that hold no JSON object go to ``out_dir/_quarantine/batch=<n>``.
    ``max_files`` bounds one micro-batch (the poll window of the source);
    ``archive_dir`` moves consumed files there (``cleanSource=archive``).
    ``clean(df, path)`` writes the typed rows of a batch in another way.
    """
    r = spark.readStream
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    if archive_dir:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return ingest(r.text(landing_dir), topic, out_dir, checkpoint, available_now, every, clean)


def ingest_topic(spark: SparkSession, bootstrap: str, topic: str, out_dir: str, checkpoint: str, max_offsets: int | None = None,
                 starting: str = "earliest", available_now: bool = True, every: str = "5 seconds", clean=None):
    """As ``ingest_landing``, from a message topic (needs the Kafka connector); the checkpoint holds its offsets, committed after the write."""
    return ingest(read_topic(spark, bootstrap, topic, starting=starting, max_offsets=max_offsets), topic, out_dir, checkpoint, available_now, every, clean)


def ingest(lines: DataFrame, topic: str, out_dir: str, checkpoint: str, available_now: bool = True, every: str = "5 seconds", clean=None):
    """A stream of JSON lines (column ``value``), whatever its source -> typed Parquet and quarantine, by one parser."""

    def sink(lines: DataFrame, n: int) -> None:
        rows, path = parse_lines(lines, TOPICS[topic]), f"{out_dir}/batch={n}"
        if clean is None:
            rows.write.mode("overwrite").parquet(path)
        else:
            clean(rows, path)
        bad_lines(lines).select("value").write.mode("overwrite").text(f"{out_dir}/_quarantine/batch={n}")

    return _run(lines.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint), available_now, every)


def _cleaned(spark: SparkSession, cleaned_dir: str, max_files: int | None) -> DataFrame:
    r = spark.readStream.schema(spark.read.parquet(cleaned_dir).schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return to_bronze(r.parquet(cleaned_dir))


class SilverSink:
    """foreachBatch target: the silver tables of one topic; what changed in them appears in their feeds."""

    BUILDS = {
        "transaction_events": {"transactions": S.silver_transactions, "items": S.silver_transaction_items},
        "user_events": {"events": S.silver_user_events},
        "customers": {"customers": S.silver_customers},
        "products": {"products": S.silver_products},
    }

    def __init__(self, gold: GoldTables, topic: str):
        self.gold, self.builds = gold, self.BUILDS[topic]

    def __call__(self, batch: DataFrame, n: int) -> None:
        stamp = _batch_time()
        for feed, build in self.builds.items():
            self.gold.load(feed, build(batch, stamp), n)


def stream_silver(spark: SparkSession, cleaned_dir: str, topic: str, gold: GoldTables, checkpoint: str,
                  max_files: int | None = None, available_now: bool = True, every: str = "2 minutes"):
    """Cleaned files of a topic -> its silver tables and their change feeds."""
    w = _cleaned(spark, cleaned_dir, max_files).writeStream.foreachBatch(SilverSink(gold, topic)).option("checkpointLocation", checkpoint)
    return _run(w, available_now, every)


def stream_consumer(gold: GoldTables, consumer: str, checkpoint: str, max_files: int | None = None,
                    available_now: bool = True, every: str = "2 minutes"):
    """One gold table from its change feeds, with a checkpoint of its own; None while its feeds are empty.

    Consumers do not wait for each other: each takes its feeds at its own pace
    (``max_files`` files of a feed at a time) and goes on from its own position.
    """
    spark, source, schemas = gold.spark, None, {}
    for feed in CONSUMERS[consumer].feeds:
        table = read_table(spark, gold.feed(feed))
        if table is None:
            continue
        schemas[feed] = table.schema
        r = spark.readStream.schema(table.schema)
        if max_files:
            r = r.option("maxFilesPerTrigger", max_files)
        rows = r.parquet(gold.feed(feed)).select(F.lit(feed).alias("feed"), F.struct(*table.columns).alias(feed))
        source = rows if source is None else source.unionByName(rows, allowMissingColumns=True)
    if source is None:
        return None

    def fold(batch: DataFrame, n: int) -> None:
        gold.consume(consumer, {f: batch.filter(F.col("feed") == f).select(f"{f}.*") for f in schemas}, n)

    return _run(source.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint), available_now, every)


def stream_gold(gold: GoldTables, checkpoints: str, max_files: int | None = None, available_now: bool = True, every: str = "2 minutes"):
    """Every consumer of ``gold``: drained one after the other in the order of their feeds, or all running."""
    return {c: stream_consumer(gold, c, f"{checkpoints}/{c}", max_files, available_now, every) for c in gold.consumers}
