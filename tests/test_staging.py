"""Routing, staging and dimension invariants on literal frames (dirty rows)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from starmart.operators import dims as D
from starmart.operators import staging as S
from starmart.operators.routing import route

T = dt.datetime


def orders_df(spark):
    rows = [
        ("o1", "c1", "delivered", "2018-01-01 10:00:00", "2018-01-03 09:00:00", "2018-01-10 00:00:00"),
        ("o2", "c2", "shipped", "not a date", None, "2018-01-10 00:00:00"),  # unparseable -> rejected
        ("o3", "c3", "delivered", "2018-01-05 10:00:00", "2018-01-04 10:00:00", "2018-01-10 00:00:00"),  # delivered < purchase
        ("o3", "c3", "delivered", "2018-01-06 10:00:00", None, "2018-01-10 00:00:00"),  # same id: dropped too
        ("o4", "c4", "weird", "2018-01-07 10:00:00", "2018-01-20 00:00:00", "2018-01-10 00:00:00"),  # late, unmapped status
    ]
    return spark.createDataFrame(
        rows,
        "order_id string, customer_id string, order_status string, order_purchase_timestamp string, "
        "order_delivered_customer_date string, order_estimated_delivery_date string",
    ).withColumn("order_approved_at", F.col("order_purchase_timestamp")).withColumn("order_delivered_carrier_date", F.lit(None).cast("string"))


def test_stage_orders_routes(spark):
    st = S.stage_orders(orders_df(spark))
    kept = {r.order_id: r for r in st.kept.collect()}
    assert set(kept) == {"o1", "o4"}
    assert kept["o1"].delivery_days == 1 and kept["o1"].is_on_time == 1 and kept["o1"].date_key == 20180101
    assert kept["o1"].status_category == "Completed"
    assert kept["o4"].is_on_time == 0 and kept["o4"].status_category is None and kept["o4"].delivery_delay_days == 10
    reasons = sorted((r.order_id, r.reject_reason) for r in st.rejects.collect())
    assert reasons == [("o2", S.R_NULL_PURCHASE), ("o3", S.R_DELIVERY_BEFORE_PURCHASE)]


def test_stage_items_routes_and_null_price(spark):
    st_o = S.stage_orders(orders_df(spark)).kept
    items = spark.createDataFrame(
        [
            ("o1", 1, "p1", "s1", Decimal("10.00"), None),
            ("o1", 2, "p2", "s1", Decimal("0.00"), Decimal("1.00")),
            ("o1", 3, "p2", "s1", None, Decimal("1.00")),
            ("o3", 1, "p1", "s2", Decimal("5.00"), Decimal("1.00")),  # order rejected -> orphan
            (None, 1, "p1", "s2", Decimal("5.00"), Decimal("1.00")),  # NULL key -> orphan (SQL semantics)
        ],
        "order_id string, order_item_id int, product_id string, seller_id string, price decimal(12,2), freight_value decimal(12,2)",
    ).withColumn("shipping_limit_date", F.lit("2018-01-02 00:00:00"))
    st = S.stage_items(items, st_o)
    kept = st.kept.collect()
    assert [(r.order_id, r.order_item_id, r.freight_value, r.total_cost) for r in kept] == [("o1", 1, Decimal("0.00"), Decimal("10.00"))]
    rej = sorted((str(r.order_id), r.reject_reason) for r in st.rejects.collect())
    assert rej == [("None", S.R_ORPHAN_ITEM), ("o1", S.R_BAD_PRICE), ("o3", S.R_ORPHAN_ITEM)]
    assert st.null_price.count() == 1
    # kept + rejected + null-price = input
    assert len(kept) + len(rej) + st.null_price.count() == items.count()


def test_route_partition_property(spark):
    df = spark.range(100).withColumn("x", F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id")))
    kept, rej = route(df, F.col("x") > 50, "big")
    assert kept.count() + rej.count() == 100


def test_stage_customers_dedupe_and_normalise(spark):
    df = spark.createDataFrame(
        [("c1", "u2", " sao paulo ", " sp "), ("c1", "u1", "rio", "rj"), ("c2", "u3", "d'oeste", "mg")],
        "customer_id string, customer_unique_id string, customer_city string, customer_state string",
    ).withColumn("customer_zip_code_prefix", F.lit("01"))
    got = {r.customer_id: r for r in S.stage_customers(df, "2020-01-01").collect()}
    assert got["c1"].customer_unique_id == "u1" and got["c1"].customer_city == "Rio"  # smallest tie-break wins
    assert got["c2"].customer_city == "D'Oeste" and got["c2"].customer_state == "MG"


def test_payment_mode_tiebreak(spark):
    rows = [("o1", "a", 1, Decimal("1"), 3), ("o1", "b", 2, Decimal("1"), 1), ("o1", "a", 1, Decimal("1"), 5), ("o1", "b", 1, Decimal("1"), 2),
            ("o2", "x", 1, Decimal("1"), 2), ("o2", "y", 3, Decimal("2"), 1), ("o3", None, 1, None, 1)]
    df = spark.createDataFrame(rows, "order_id string, payment_type string, payment_installments int, payment_value decimal(12,2), payment_seq int")
    got = {r.order_id: r for r in S.stage_payments(df).collect()}
    assert got["o1"].primary_payment_type == "b"  # 2-2 tie, b seen first
    assert got["o2"].primary_payment_type == "y" and got["o2"].payment_installments == 3 and got["o2"].payment_types_used == 2
    assert got["o3"].primary_payment_type is None and got["o3"].total_payment_value == 0


def test_scd2_invariants(spark):
    feed = lambda rows: spark.createDataFrame(rows, "customer_id long, customer_unique_id string, customer_city string, customer_state string, customer_zip_code_prefix string")
    d0 = D.empty_dim_customer(spark)
    r1 = D.scd2_merge(d0, feed([(1, "u1", "A", "X", "1"), (2, "u2", None, "Y", "2")]), "2020-01-01")
    d1 = r1.dim.checkpoint()
    r2 = D.scd2_merge(d1, feed([(1, "u1", "B", "X", "1"), (2, "u2", None, "Y", "9"), (3, "u3", "C", "Z", "3")]), "2020-02-01")
    d2 = r2.dim.checkpoint()
    acts = {r.customer_id: r.action for r in r2.actions.collect()}
    assert acts == {1: "updated", 2: "unchanged", 3: "new"}  # NULL city is not a change; zip is untracked
    rows = d2.collect()
    assert len(rows) == 4
    cur = [r for r in rows if r.is_current]
    assert sorted(r.customer_id for r in cur) == [1, 2, 3]  # one current row per id
    v = sorted((r.customer_id, r.record_version, r.is_current, str(r.effective_end_date)) for r in rows)
    assert v == [(1, 1, False, "2020-02-01"), (1, 2, True, "None"), (2, 1, True, "None"), (3, 1, True, "None")]
    assert len({r.customer_key for r in rows}) == 4  # keys unique and stable
    r3 = D.scd2_merge(d2, feed([(1, "u1", "B", "X", "1"), (2, "u2", None, "Y", "9"), (3, "u3", "C", "Z", "3")]), "2020-03-01")
    assert sorted(tuple(r) for r in r3.dim.collect()) == sorted(tuple(r) for r in rows)  # same feed: no-op


def test_assign_keys_stable(spark):
    ex = spark.createDataFrame([("a", 1), ("c", 2)], "id string, k long")
    inc = spark.createDataFrame([("c",), ("b",), ("a",), ("d",)], "id string")
    got = {r.id: r.k for r in D.assign_keys(inc, "id", "k", ex).collect()}
    assert got == {"a": 1, "c": 2, "b": 3, "d": 4}


def test_dim_date_calendar(spark):
    d = D.build_dim_date(spark, "2016-01-01", "2019-12-31")
    assert d.count() == 1461
    r = d.where("date_key = 20180101").first()
    assert (r.day_name, r.day_of_week, r.week_of_year, r.quarter_name, r.is_month_start) == ("Monday", 1, 1, "Q1", True)
    assert d.where("is_month_end").count() == 48
