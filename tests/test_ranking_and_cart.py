import datetime as dt
import decimal
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.operators.ranking import rank_desc
from tidewater.plans.analytics import cart_to_purchase


def test_rank_desc_equals_window_rank(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(3000):
        g = "hot" if i % 3 else f"g{i % 7}"           # one group holds two thirds of the rows
        v = None if i % 97 == 0 else decimal.Decimal(rnd.randint(0, 300)) / 10
        rows.append((g, f"u{i}", v))
    df = spark.createDataFrame(rows, "g string, u string, v decimal(18,2)")
    mine = rank_desc(df, "g", "v", "r")
    w = Window.partitionBy("g").orderBy(F.col("v").desc_nulls_last())
    ref = df.withColumn("r", F.rank().over(w))
    a = sorted(tuple(r) for r in mine.select("g", "u", "r").collect())
    b = sorted(tuple(r) for r in ref.select("g", "u", "r").collect())
    assert a == b


def brute_cart(carts, purchases, days):
    out = {}
    for eid, user, key, d in carts:
        conv = any(u == user and k == key and d <= pd <= d + dt.timedelta(days=days)
                   for u, k, pd in purchases)
        c = out.setdefault(d, [0, 0])
        c[0] += 1
        c[1] += int(conv)
    return out


def test_cart_to_purchase_against_brute_force(spark):
    rnd = random.Random(11)
    base = dt.date(2024, 1, 1)
    carts = [(f"e{i}", f"u{rnd.randint(0, 5)}", f"k{rnd.randint(0, 2)}", base + dt.timedelta(rnd.randint(0, 40)))
             for i in range(400)]
    purchases = [(f"u{rnd.randint(0, 5)}", f"k{rnd.randint(0, 2)}", base + dt.timedelta(rnd.randint(0, 50)))
                 for _ in range(60)]
    cdf = spark.createDataFrame(carts, "event_id string, user_id string, match_key string, cart_date date")
    pdf = spark.createDataFrame(purchases, "user_id string, match_key string, purchase_date date")
    got = {r.cart_date: [r.carts, r.conversions] for r in cart_to_purchase(cdf, pdf, 7).collect()}
    assert got == brute_cart(carts, purchases, 7)


def test_heavy_users_by_the_documented_limits(spark):
    from tidewater.plans.analytics import heavy_users
    day = dt.date(2024, 3, 5)
    rows = [("r11", "refund")] * 11 + [("r10", "refund")] * 10 + [("c6", "chargeback")] * 6 + [("c5", "chargeback")] * 5
    fact = spark.createDataFrame([(u, t, "completed", day) for u, t in rows],
                                 "user_id string, transaction_type string, status string, transaction_date date")
    assert [(r.user_id, r.events) for r in heavy_users(fact, "refund").collect()] == [("r11", 11)]
    assert [(r.user_id, r.events) for r in heavy_users(fact, "chargeback").collect()] == [("c6", 6)]
