"""Selected tiles and ranks equal the plain window and the sorted list."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from starmart.operators import quality as Q
from starmart.operators import selection as S


def data(spark, n, seed=3):
    rng = random.Random(seed)
    rows = [
        (k * 7 - 50, rng.choice([None, 0, 0, 0, 1, 5]), rng.randint(-(10**12), 10**12), None if rng.random() < 0.1 else f"{rng.randint(0, 10**6) / 100:.2f}", dt.date(2000, 1, 1) + dt.timedelta(rng.randint(0, 400)))
        for k in range(n)
    ]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "id long, few int, wide long, money string, day date").repartition(5)
    return df.withColumn("money", F.col("money").cast("decimal(12,2)"))


ORDERS = {"t_few": ("few", True), "t_few_down": ("few", False), "t_wide": ("wide", False), "t_money": ("money", True), "t_money_down": ("money", False), "t_day": ("day", True)}


@pytest.mark.parametrize("n,k,buckets,few", [(700, 5, 4096, 2000), (700, 7, 16, 3), (23, 4, 8, 1), (3, 5, 4096, 2000), (1, 4, 8, 1)])
def test_tiles_equal_ntile(spark, monkeypatch, n, k, buckets, few):
    monkeypatch.setattr(S, "BUCKETS", buckets)
    monkeypatch.setattr(S, "FEW", few)
    df = data(spark, n)
    got = S.with_tiles(df, k, ORDERS, "id")
    for name, (c, asc) in ORDERS.items():
        order = F.col(c).asc_nulls_first() if asc else F.col(c).desc_nulls_last()
        got = got.withColumn(f"want_{name}", F.ntile(k).over(Window.orderBy(order, "id")))
    for r in got.collect():
        assert all(r[name] == r[f"want_{name}"] for name in ORDERS)


def test_no_rows_and_no_order(spark):
    df = data(spark, 5).limit(0)
    assert S.with_tiles(df, 5, ORDERS, "id").collect() == []
    with pytest.raises(TypeError, match="same order"):
        S.with_tiles(df.withColumn("x", F.lit("a")), 5, {"t": ("x", True)}, "id")


def test_tiles_sort_nothing(spark):
    df = data(spark, 50).checkpoint()
    plan = S.with_tiles(df, 5, ORDERS, "id")._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Window" not in plan and "Sort" not in plan


def test_describe_equals_sorted_values(spark, monkeypatch):
    monkeypatch.setattr(S, "BUCKETS", 8)
    monkeypatch.setattr(S, "FEW", 2)
    rng = random.Random(5)
    for n in (1, 2, 6, 101):
        cents = [rng.choice([100, 100, rng.randint(0, 10**7)]) for _ in range(n)]
        df = spark.createDataFrame([(c,) for c in cents] + [(None,)], "c long").select((F.col("c") / F.lit(100)).cast("decimal(12,2)").alias("price"))
        r = Q.describe_money(df, "price").first()
        ordered = sorted(cents)
        for q, got in ((1, r.p25), (2, r.p50), (3, r.p75)):
            i, m = divmod((n - 1) * q, 4)
            exact = ordered[i] * 4 + m * (ordered[min(n - 1, i + 1)] - ordered[i])
            assert float(got) == pytest.approx(int(exact / 4 + 0.5) / 100, abs=1e-9)
        assert (r["count"], r.min, r.max) == (n, ordered[0] / 100, ordered[-1] / 100)
    assert Q.describe_money(df.limit(0), "price").first()["count"] == 0
