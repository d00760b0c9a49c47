"""Dashboard marts (M1-M11) and post-load verification queries (D6, F8).

All are grouped aggregates over the fact plus dimension lookups. Every mart
takes an optional ``year`` / ``month`` slice (M11); it becomes a range
predicate on ``date_key`` (YYYYMMDD), a plain fact column, so it reaches the
parquet scan as a pushed filter (and prunes year partitions when the fact is
written partitioned by year).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import cents
from ..functions.expr import round_half_away as rha
from .analytics import per_order

COMPLETED = "Completed"


def date_slice(year: int | None = None, month: int | None = None):
    if year is None:
        return None
    if month is None:
        lo, hi = year * 10000 + 101, year * 10000 + 1231
    else:
        lo, hi = year * 10000 + month * 100 + 1, year * 10000 + month * 100 + 31
    return F.col("date_key").between(lo, hi)


def _fact(star: dict, year=None, month=None) -> DataFrame:
    f = star["fact_sales"]
    s = date_slice(year, month)
    if s is None:
        return f
    if "fact_year" in f.columns:  # written fact: prune year partitions too
        s = s & (F.col("fact_year") == year)
    return f.where(s)


def share(part: str, whole_window: Window) -> F.Column:
    return rha(cents(part) * 100, cents(F.sum(part).over(whole_window)), 2)


# --------------------------------------------------------------------- M1
def m1_kpi_cards(star: dict, year=None, month=None) -> DataFrame:
    """Revenue, orders, customers, revenue per order, on-time % of completed
    lines and completed share of orders."""
    done = F.col("status_category") == COMPLETED
    orders = per_order(
        _fact(star, year, month), "customer_key",
        _rev=F.sum("gross_revenue"), _ot=F.sum(F.when(done, F.col("is_on_time"))), _done_rows=F.count_if(done),
    )
    customers = orders.groupBy("customer_key").agg(
        F.sum("_rev").alias("_rev"), F.count(F.lit(1)).alias("_orders"),
        F.count_if(F.col("_done_rows") > 0).alias("_done_orders"),
        F.sum("_ot").alias("_ot"), F.sum("_done_rows").alias("_done_rows"),
    )
    return customers.agg(
        F.sum("_rev").alias("total_revenue"),
        F.coalesce(F.sum("_orders"), F.lit(0)).alias("total_orders"),
        F.count(F.lit(1)).alias("total_customers"),
        F.coalesce(F.sum("_done_orders"), F.lit(0)).alias("_done_orders"),
        F.sum("_ot").alias("_ot"),
        F.sum("_done_rows").alias("_done_rows"),
    ).select(*kpi_columns("total_revenue", F.col("total_orders"), F.col("total_customers"), F.col("_done_orders"), F.col("_ot"), F.col("_done_rows")))


def kpi_columns(revenue: str, orders: F.Column, customers: F.Column, done_orders: F.Column, ot: F.Column, done_rows: F.Column) -> list[F.Column]:
    """The cards from sums of lines and counts of orders and customers."""
    return [
        F.round(revenue, 2).alias("total_revenue"),
        orders.alias("total_orders"),
        customers.alias("total_customers"),
        rha(cents(revenue), orders * 100, 2).alias("revenue_per_order"),
        rha(ot * 100, done_rows, 2).alias("on_time_pct"),
        rha(done_orders * 100, orders, 2).alias("completed_order_pct"),
    ]


# --------------------------------------------------------------------- M2
def m2_monthly(star: dict, year=None, month=None) -> DataFrame:
    cal = F.broadcast(star["dim_date"].select("date_key", "year_month"))  # bounded calendar
    return (
        _fact(star, year, month)
        .join(cal, "date_key")
        .groupBy("year_month")
        .agg(F.sum("gross_revenue").alias("revenue"), F.count_distinct("order_id").alias("orders"))
        .orderBy("year_month")
    )


# --------------------------------------------------------------------- M3 / M8
def _by_product_attribute(star: dict, attribute: str, year=None, month=None, by: tuple[str, ...] = ()) -> DataFrame:
    """Revenue and distinct orders per product attribute (and calendar columns ``by``).

    The fact is reduced to one row per (product, order) before it meets the
    product: no raw line is shuffled by product, and a hot product is combined
    map-side. Orders are then distinct (attribute, order) pairs.
    """
    p = star["dim_product"].select("product_key", attribute)
    lines = per_order(_fact(star, year, month), "product_key", "date_key", revenue=F.sum("gross_revenue"))
    if by:
        cal = F.broadcast(star["dim_date"].select("date_key", *by))  # bounded calendar
        lines = lines.join(cal, "date_key")
    orders = lines.join(p, "product_key").groupBy(*by, attribute, "order_id").agg(F.sum("revenue").alias("revenue"))
    return orders.groupBy(*by, attribute).agg(F.sum("revenue").alias("revenue"), F.count(F.lit(1)).alias("orders"))


def m3_top_categories(star: dict, top: int = 10, year=None, month=None) -> DataFrame:
    return _by_product_attribute(star, "product_category", year, month).orderBy(F.desc("revenue"), "product_category").limit(top)


def m8_category_revenue(star: dict, year=None, month=None) -> DataFrame:
    return _by_product_attribute(star, "product_category", year, month).orderBy(F.desc("revenue"), "product_category")


def m8_price_band_by_year(star: dict, year=None, month=None) -> DataFrame:
    return _by_product_attribute(star, "price_band", year, month, by=("year",)).orderBy("year", "price_band")


def m8_price_band_pivot(star: dict, bands=("Budget", "Mid-Range", "Premium", "Luxury", "Unknown"), year=None, month=None) -> DataFrame:
    """Revenue per year with one column per price band. The pivot values are
    given, so Spark does not run a distinct-values job first; the input is
    the small (year, band) aggregate."""
    long = m8_price_band_by_year(star, year, month)
    return long.groupBy("year").pivot("price_band", list(bands)).agg(F.first("revenue")).orderBy("year")


# --------------------------------------------------------------------- M4
def m4_payment_types(star: dict, year=None, month=None) -> DataFrame:
    g = (
        _fact(star, year, month)
        .groupBy("primary_payment_type")
        .agg(F.sum("gross_revenue").alias("revenue"), F.count_distinct("order_id").alias("orders"))
    )
    return g.withColumn("revenue_pct", share("revenue", Window.partitionBy())).orderBy(F.desc("revenue"))


# --------------------------------------------------------------------- M5 / M7
def _per_customer(star: dict, year=None, month=None) -> DataFrame:
    """Additive per-customer-key measures joined to the customer attributes.

    Aggregating before the join (map-side combined) means no raw fact row is
    shuffled by customer; an order belongs to one customer key, so distinct
    order counts add up across keys.
    """
    per_key = _fact(star, year, month).groupBy("customer_key").agg(
        F.sum("gross_revenue").alias("revenue"),
        F.count_distinct("order_id").alias("orders"),
        F.sum("delivery_days").alias("_sd"),
        F.count("delivery_days").alias("_nd"),
        F.sum("is_on_time").alias("_ot"),
        F.count(F.lit(1)).alias("_rows"),
    )
    c = star["dim_customer"].select("customer_key", "customer_state", "customer_city")
    return per_key.join(c, "customer_key")


def m5_states(star: dict, year=None, month=None) -> DataFrame:
    g = _per_customer(star, year, month).groupBy("customer_state").agg(F.sum("revenue").alias("revenue"))
    return g.withColumn("revenue_pct", share("revenue", Window.partitionBy())).orderBy(F.desc("revenue"))


def m5_cities(star: dict, year=None, month=None) -> DataFrame:
    g = _per_customer(star, year, month).groupBy("customer_state", "customer_city").agg(
        F.sum("revenue").alias("revenue"), F.sum("orders").alias("orders")
    )
    return g.orderBy(F.desc("revenue"), "customer_state", "customer_city")


def m7_state_metrics(star: dict, year=None, month=None) -> DataFrame:
    g = _per_customer(star, year, month).groupBy("customer_state").agg(
        F.sum("orders").alias("orders"),
        F.count(F.lit(1)).alias("customers"),
        F.sum("revenue").alias("revenue"),
        F.sum("_sd").alias("_sd"),
        F.sum("_nd").alias("_nd"),
        F.sum("_ot").alias("_ot"),
        F.sum("_rows").alias("_rows"),
    )
    return g.select(*state_columns("revenue", "orders", "customers", "_sd", "_nd", "_ot", "_rows")).orderBy(F.desc("revenue"))


def state_columns(revenue: str, orders: str, customers: str, sd: str, nd: str, ot: str, rows: str) -> list[F.Column]:
    """The state table from sums and counts."""
    return [
        F.col("customer_state"),
        F.col(orders).alias("orders"),
        F.col(customers).alias("customers"),
        F.round(revenue, 2).alias("revenue"),
        rha(cents(revenue), F.col(orders) * 100, 2).alias("revenue_per_order"),
        rha(F.col(sd), F.col(nd), 1).alias("avg_delivery_days"),
        rha(F.col(ot) * 100, F.col(rows), 2).alias("on_time_pct"),
    ]


# --------------------------------------------------------------------- M6
def m6_order_status(star: dict, year=None, month=None) -> DataFrame:
    g = _fact(star, year, month).groupBy("order_status").agg(F.count_distinct("order_id").alias("orders"))
    whole = F.sum("orders").over(Window.partitionBy())  # one row per status
    return g.withColumn("orders_pct", rha(F.col("orders") * 100, whole, 2)).orderBy(F.desc("orders"))


# ------------------------------------------------------------- verification
def fact_totals(star: dict) -> DataFrame:
    return star["fact_sales"].agg(
        F.count(F.lit(1)).alias("total_rows"), F.round(F.sum("gross_revenue"), 2).alias("total_revenue")
    )


def fact_revenue_by_year(star: dict) -> DataFrame:
    cal = F.broadcast(star["dim_date"].select("date_key", "year"))
    return (
        star["fact_sales"]
        .join(cal, "date_key")
        .groupBy("year")
        .agg(F.count_distinct("order_id").alias("orders"), F.round(F.sum("gross_revenue"), 2).alias("revenue"))
        .orderBy("year")
    )


def fact_revenue_by_status(star: dict) -> DataFrame:
    return (
        star["fact_sales"]
        .groupBy("status_category")
        .agg(F.count(F.lit(1)).alias("records"), F.round(F.sum("gross_revenue"), 2).alias("revenue"))
        .orderBy(F.desc("revenue"))
    )


def fact_top_categories(star: dict, top: int = 5) -> DataFrame:
    g = _by_product_attribute(star, "product_category")
    return g.withColumn("revenue", F.round("revenue", 2)).orderBy(F.desc("revenue"), "product_category").limit(top)


def fact_revenue_by_payment(star: dict) -> DataFrame:
    return (
        star["fact_sales"]
        .groupBy("primary_payment_type")
        .agg(F.count(F.lit(1)).alias("transactions"), F.round(F.sum("gross_revenue"), 2).alias("revenue"))
        .orderBy(F.desc("revenue"))
    )


def dim_verify_counts(star: dict) -> DataFrame:
    d = star["dim_date"].agg(
        F.count(F.lit(1)).alias("dim_date_rows"), F.min("full_date").alias("date_min"), F.max("full_date").alias("date_max")
    )
    s = star["dim_seller"].agg(F.count(F.lit(1)).alias("dim_seller_rows"))
    p = star["dim_product"].agg(F.count(F.lit(1)).alias("dim_product_rows"))
    c = star["dim_customer"].agg(F.count_if(F.col("is_current")).alias("dim_customer_current_rows"))
    return d.crossJoin(s).crossJoin(p).crossJoin(c)  # four one-row aggregates


def dim_price_bands(star: dict) -> DataFrame:
    return (
        star["dim_product"]
        .groupBy("price_band")
        .agg(F.count(F.lit(1)).alias("product_count"))
        .orderBy(F.desc("product_count"), "price_band")
    )
