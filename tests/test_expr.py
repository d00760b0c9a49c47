"""Semantic traps of the column expressions (N1, N2, P8, P19, %W, rounding)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from starmart.functions import expr as E


def test_floor_days_n1(spark):
    rows = [
        (dt.datetime(2018, 1, 1, 23, 0), dt.datetime(2018, 1, 2, 1, 0), 0),  # datediff would say 1
        (dt.datetime(2018, 1, 1, 0, 0), dt.datetime(2018, 1, 2, 1, 0), 1),  # 25 h
        (dt.datetime(2018, 1, 1, 2, 0), dt.datetime(2018, 1, 1, 0, 0), -1),  # -2 h floors to -1
        (dt.datetime(2018, 1, 1), None, None),
    ]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz, want int")
    got = df.select(E.floor_days("a", "b").alias("g"), "want").collect()
    assert [r.g for r in got] == [r.want for r in got]


def test_title_case_n2(spark):
    cases = {
        "sao paulo": "Sao Paulo",
        "d'oeste": "D'Oeste",
        "mogi-guacu": "Mogi-Guacu",
        "sp2x": "Sp2X",
        "1-URGENT": "1-Urgent",
        "2nd street": "2Nd Street",
        "ÁGUA branca": "Água Branca",
    }
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    got = {r.s: r.t for r in df.select("s", E.title_case("s").alias("t")).collect()}
    assert got == {k: k.title() for k in cases} == cases


def test_strip_matches_python(spark):
    vals = ["  a b ", "\tx\n", "", "y"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    assert [r.t for r in df.select(E.strip("s").alias("t")).collect()] == [v.strip() for v in vals]


def test_band_right_closed_p19(spark):
    vals = [None, Decimal("0"), Decimal("0.01"), Decimal("50"), Decimal("50.01"), Decimal("200"), Decimal("500"), Decimal("500.01")]
    df = spark.createDataFrame([(v,) for v in vals], "p decimal(10,2)")
    got = [r.b for r in df.select(E.band("p", E.PRICE_BAND_EDGES, E.PRICE_BAND_LABELS).alias("b")).collect()]
    assert got == ["Unknown", "Unknown", "Budget", "Budget", "Mid-Range", "Mid-Range", "Premium", "Luxury"]


def test_date_key_and_week_w(spark):
    days = [dt.date(2016, 1, 1) + dt.timedelta(days=i) for i in range(0, 1461, 7)] + [dt.date(2018, 12, 31), dt.date(2017, 1, 1)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = df.select("d", E.date_key("d").alias("k"), E.week_of_year_monday("d").alias("w")).collect()
    for r in got:
        assert r.k == int(r.d.strftime("%Y%m%d"))
        assert r.w == int(r.d.strftime("%W"))


def test_round_half_away_exact(spark):
    rows = [(201, 200), (-201, 200), (1, 3), (2, 3), (1005, 1000), (10, 0), (-5, 10)]
    df = spark.createDataFrame(rows, "n long, d long")
    got = [r.r for r in df.select(E.round_half_away(F.col("n"), F.col("d"), 2).alias("r")).collect()]
    assert got == [1.01, -1.01, 0.33, 0.67, 1.01, None, -0.5]


def test_status_category_unmapped_is_null(spark):
    df = spark.createDataFrame([("delivered",), ("weird",), (None,)], "s string")
    assert [r.c for r in df.select(E.status_category("s").alias("c")).collect()] == ["Completed", None, None]
