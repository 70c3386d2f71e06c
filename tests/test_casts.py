import datetime as dt
import decimal
import random

from pyspark.sql import functions as F

from tidewater.functions.casts import (date_key, day_name, iso_day_of_week, month_name,
                                       rounded_quotient, rounded_ratio, try_date, try_decimal,
                                       try_number, try_timestamp_ntz)


def one(spark, col, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"v {dtype}")
    return df.select(col(F.col("v")).alias("r")).collect()[0].r


def test_try_number(spark):
    assert one(spark, try_number, "2.5") == 3
    assert one(spark, try_number, " 7 ") == 7
    assert one(spark, try_number, "") is None
    assert one(spark, try_number, "x") is None


def test_try_decimal(spark):
    assert one(spark, try_decimal, "2.345") == decimal.Decimal("2.35")
    assert one(spark, try_decimal, "-2.345") == decimal.Decimal("-2.35")
    assert one(spark, try_decimal, "1e3") == decimal.Decimal("1000.00")
    assert one(spark, try_decimal, "junk") is None


def test_try_timestamp_ntz_keeps_wall_clock(spark):
    assert one(spark, try_timestamp_ntz, "2024-01-01T10:00:00.123456Z") == dt.datetime(2024, 1, 1, 10, 0, 0, 123456)
    assert one(spark, try_timestamp_ntz, "2024-01-01T10:00:00+05:00") == dt.datetime(2024, 1, 1, 10, 0)
    assert one(spark, try_timestamp_ntz, "bad") is None


def test_try_date(spark):
    assert one(spark, try_date, "2026-13-01") is None
    assert one(spark, try_date, "2024-03-05T10:11:12Z") == dt.date(2024, 3, 5)


def test_calendar_helpers_year_end(spark):
    df = spark.createDataFrame([(dt.date(2024, 12, 30),)], "d date")
    r = df.select(date_key("d").alias("k"), F.weekofyear("d").alias("w"), iso_day_of_week("d").alias("dow"),
                  month_name("d").alias("m"), day_name("d").alias("n")).collect()[0]
    assert (r.k, r.w, r.dow, r.m, r.n) == (20241230, 1, 1, "December", "Mon")


def _py_round(amount: decimal.Decimal, n: int):
    if n == 0:
        return None
    q = (amount / n).quantize(decimal.Decimal("0.01"), rounding=decimal.ROUND_HALF_UP)
    return q


def test_rounded_ratio_matches_half_away_from_zero(spark):
    rnd = random.Random(7)
    rows = [(decimal.Decimal(rnd.randint(-10**9, 10**9)) / 100, rnd.randint(0, 400)) for _ in range(400)]
    rows += [(decimal.Decimal("0.05"), 2), (decimal.Decimal("-0.05"), 2), (decimal.Decimal("0.01"), 2)]
    df = spark.createDataFrame(rows, "a decimal(18,2), n bigint")
    got = df.select("a", "n", rounded_ratio("a", "n").alias("r")).collect()
    for r in got:
        assert r.r == _py_round(r.a, r.n), (r.a, r.n, r.r)


def test_rounded_quotient(spark):
    df = spark.createDataFrame([(1, 3), (2, 3), (0, 5), (5, 0)], "a bigint, b bigint")
    got = [r.q for r in df.select(rounded_quotient("a", "b", 4).alias("q")).collect()]
    assert got == [decimal.Decimal("0.3333"), decimal.Decimal("0.6667"), decimal.Decimal("0.0000"), None]
