"""Event-time streams: matches, unmatched rows, late rows, repeats, restarts, windows."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tidewater.operators.tables import read_table
from tidewater.session import scratch_dir
from tidewater.streaming import events as E

CART = "event_id string, user_id string, match_key string, cart_ts timestamp"
BUY = "user_id string, match_key string, purchase_ts timestamp"


def day(d, hour=0):
    return dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(days=d - 1, hours=hour)


def put(spark, path, schema, *rows):
    spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(path)


class Carts:
    def __init__(self, spark):
        self.spark, self.root = spark, scratch_dir(spark, "t_carts")

    def land(self, carts, buys):
        put(self.spark, f"{self.root}/carts", CART, *carts)
        put(self.spark, f"{self.root}/buys", BUY, *buys)

    def run(self):
        c, b = (E.read_stream(self.spark, f"{self.root}/{n}", s, max_files=1) for n, s in (("carts", CART), ("buys", BUY)))
        E.append_stream(E.cart_outcomes(c, b, days=7, late="2 days"), f"{self.root}/out", f"{self.root}/_ckpt")
        got = self.spark.read.parquet(f"{self.root}/out")
        return sorted((r.event_id, r.cart_day.day, r.purchase_day and r.purchase_day.day) for r in got.collect())


def test_carts_meet_purchases_and_the_others_come_out_when_time_has_passed(spark):
    t = Carts(spark)
    t.land([("hit", "u", "k", day(1, 5)), ("other key", "u", "x", day(1)), ("null key", "u", None, day(1)), ("edge", "v", "k", day(2))],
           [("u", "k", day(1)), ("u", "k", day(1, 9)), ("u", "k", day(3))])
    assert t.run() == [("hit", 1, 1), ("hit", 1, 3)]  # two purchase days, the repeated one once; the others wait
    t.land([("open", "u", "k", day(9))], [("v", "k", day(9)), ("v", "k", day(10))])
    assert t.run() == [("edge", 2, 9), ("hit", 1, 1), ("hit", 1, 3)]  # after a restart, on the seventh day
    t.land([("later", "w", "k", day(30))], [("w", "z", day(30))])
    done = [("edge", 2, 9), ("hit", 1, 1), ("hit", 1, 3), ("null key", 1, None), ("open", 9, None), ("other key", 1, None)]
    assert t.run() == sorted(done, key=lambda r: (r[0], r[1], r[2] or 0))
    t.land([("late", "u", "k", day(5))], [("u", "k", day(5))])  # both older than two days before the newest
    assert [r for r in t.run() if r[0] == "late"] == []
    assert E.abandoned_carts(spark.read.parquet(f"{t.root}/out")).count() == 3
    rates = {r.cart_date.day: (r.carts, r.conversions, float(r.conversion_rate)) for r in E.conversions(spark.read.parquet(f"{t.root}/out")).collect()}
    assert rates == {1: (3, 1, 0.3333), 2: (1, 1, 1.0), 9: (1, 0, 0.0)}


EVENT = "event_id string, at timestamp, page string"


def test_repeats_across_batches_and_a_restart_leave_one_row(spark):
    root = scratch_dir(spark, "t_dedupe")

    def run(*rows):
        put(spark, f"{root}/in", EVENT, *rows)
        E.append_stream(E.dedupe(E.read_stream(spark, f"{root}/in", EVENT), "event_id", "at", "2 days"), f"{root}/out", f"{root}/_ckpt")
        return sorted((r.event_id, r.page) for r in spark.read.parquet(f"{root}/out").collect())

    assert run(("a", day(1), "x"), ("a", day(1), "x"), ("b", day(1), "x"), ("t", None, "x")) == [("a", "x"), ("b", "x")]
    assert run(("a", day(1, 6), "again"), ("c", day(2), "x")) == [("a", "x"), ("b", "x"), ("c", "x")]
    run(("d", day(20), "x"))
    got = run(("a", day(1), "too late"), ("a", day(20), "key has left"))
    assert got == [("a", "key has left"), ("a", "x"), ("b", "x"), ("c", "x"), ("d", "x")]


TX = "transaction_id string, transaction_type string, status string, transaction_ts timestamp, total decimal(18,2), tax decimal(18,2)"


def test_windowed_revenue_touches_the_days_of_a_batch(spark):
    root = scratch_dir(spark, "t_windows")

    def run(*rows):
        put(spark, f"{root}/in", TX, *[(str(i), kind, status, at, Decimal(total), Decimal(1)) for i, (kind, status, at, total) in enumerate(rows)])
        E.stream_daily_revenue(E.read_stream(spark, f"{root}/in", TX), f"{root}/table", f"{root}/_ckpt", late="2 days")
        return {r.sales_date.day: (r.orders, float(r.revenue), r.batch) for r in E.daily_revenue_of(spark, f"{root}/table").collect()}

    first = run(("purchase", "completed", day(1), 10), ("refund", "completed", day(1, 20), -4), ("purchase", "pending", day(2), 5))
    assert {d: v[:2] for d, v in first.items()} == {1: (1, 6.0)}
    second = run(("purchase", "completed", day(1, 3), 1), ("purchase", "completed", day(2), 7))
    assert {d: v[:2] for d, v in second.items()} == {1: (2, 7.0), 2: (1, 7.0)}
    third = run(("purchase", "completed", day(9), 2))
    assert third[1] == second[1] and third[9][2] > second[1][2]  # only the touched day was written
    last = run(("purchase", "completed", day(1), 100), ("purchase", "completed", day(8), 3))  # the first is too late
    assert {d: v[:2] for d, v in last.items()} == {1: (2, 7.0), 2: (1, 7.0), 8: (1, 3.0), 9: (1, 2.0)}
    assert read_table(spark, f"{root}/table").select(F.countDistinct("sales_date")).first()[0] == 4


def test_parts_of_a_topic_arrive_whole_in_the_files_of_several_tasks(spark):
    from tidewater import catalog_more as M
    root = scratch_dir(spark, "t_sliced")
    rows = spark.range(0, 3000, 1, 6).select("id", F.timestamp_seconds("id").alias("at"))
    seen = []
    M._arrive({f"{root}/a": M._sliced(rows, "at", f"{root}/ra"), f"{root}/b": M._sliced(rows.limit(0), "at", f"{root}/rb")},
              lambda: seen.append((spark.read.parquet(f"{root}/a").count(), spark.read.schema(rows.schema).parquet(f"{root}/b").count())))
    assert len(seen) == M.SLICES and seen[-1] == (3000, 0) and 900 <= seen[0][0] <= 1100
    files = spark.read.format("binaryFile").load(f"{root}/a/*.parquet").select("path").count()
    assert files > M.SLICES  # not one task a part


def test_a_topic_of_one_month_and_many_files_takes_three_micro_batches(spark):
    from tidewater import catalog as C
    from tests.conftest import SF_SMALL
    gold, root = C._streamed(spark, SF_SMALL, "user_events")
    assert spark.read.text(f"{root}/_ckpt/silver/commits/*").filter("value = 'v1'").count() == 3
    assert gold.read("stg_user_events").count() == spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
