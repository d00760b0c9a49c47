"""The nine analytics queries over the star schema (X1-X9).

Every function takes the star (a dict with ``fact_sales`` and the
dimensions) plus parameters and returns a lazy DataFrame. Money stays
DECIMAL(.,2) (sums are exact); averages and percentages are rounded half away
from zero with exact integer arithmetic (``round_half_away``).

Windows without ``partitionBy`` appear only over inputs whose size is fixed
by the calendar (months, quarters: at most 12 or 4 rows per year of
``dim_date``). Windows over customers, sellers and products go through the
distributed global ranking operators (``operators/ranking.py``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import cents, round_half_away as rha
from ..operators.ranking import global_scan, ntile_from_rn, with_rank
from ..operators.selection import with_tiles

COMPLETED = "Completed"


def _fact(star: dict, status: str | None = COMPLETED, filters=None) -> DataFrame:
    f = star["fact_sales"]
    if status is not None:
        f = f.where(F.col("status_category") == status)
    if filters is not None:
        f = f.where(filters)
    return f


def _calendar(star: dict, *cols: str) -> DataFrame:
    # dim_date has one row per calendar day of the configured range: a
    # bounded table, so broadcasting it is safe at any fact size.
    return F.broadcast(star["dim_date"].select("date_key", *cols))


def per_order(f: DataFrame, *keys: str, **measures: F.Column) -> DataFrame:
    """Fact rows reduced to one row per order and ``keys`` (map-side combined).

    An order has one customer, one day and one status, so distinct orders and
    customers become counts of rows of this and the next coarser grain, and no
    fact row is copied for a second COUNT(DISTINCT).
    """
    return f.groupBy("order_id", *keys).agg(*[v.alias(k) for k, v in measures.items()])


def _avg_money(sum_col: str, n_col: str) -> F.Column:
    return rha(cents(sum_col), F.col(n_col) * 100, 2)


# --------------------------------------------------------------------- X1
def x1_monthly_trend(star: dict, status: str = COMPLETED) -> DataFrame:
    f = _fact(star, status).select("date_key", "order_id", "customer_key", "gross_revenue")
    month = ("year", "month_num", "month_name", "year_month")
    orders = per_order(f, "date_key", "customer_key", revenue=F.sum("gross_revenue"), _n=F.count("gross_revenue"))
    m = (
        orders.join(_calendar(star, *month), "date_key")
        .groupBy(*month, "customer_key")
        .agg(F.sum("revenue").alias("revenue"), F.count(F.lit(1)).alias("total_orders"), F.sum("_n").alias("_n"))
        .groupBy(*month)
        .agg(
            F.sum("revenue").alias("revenue"),
            F.sum("total_orders").alias("total_orders"),
            F.count(F.lit(1)).alias("unique_customers"),
            F.sum("_n").alias("_n"),
        )
    )
    w = Window.orderBy("year", "month_num")  # one row per calendar month
    ytd = Window.partitionBy("year").orderBy("month_num").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    m = m.withColumn("prev_month_revenue", F.lag("revenue").over(w))
    return m.select(
        "year_month",
        "month_name",
        "year",
        F.round("revenue", 2).alias("revenue"),
        "total_orders",
        "unique_customers",
        _avg_money("revenue", "_n").alias("avg_order_value"),
        "prev_month_revenue",
        rha((cents("revenue") - cents("prev_month_revenue")) * 100, cents("prev_month_revenue"), 2).alias("mom_growth_pct"),
        F.round(F.sum("revenue").over(ytd), 2).alias("ytd_revenue"),
        "month_num",
    ).orderBy("year", "month_num").drop("month_num")


# --------------------------------------------------------------------- X2
def x2_year_over_year(star: dict, years: Sequence[int] = (2016, 2017, 2018), status: str = COMPLETED) -> DataFrame:
    """Same month across years: revenue for every year in ``years``, orders
    and growth for the last two."""
    f = _fact(star, status).select("date_key", "order_id", "gross_revenue")
    m = (
        f.join(_calendar(star, "year", "month_num", "month_name"), "date_key")
        .groupBy("year", "month_num", "month_name")
        .agg(F.sum("gross_revenue").alias("revenue"), F.count_distinct("order_id").alias("orders"))
    )
    prev, last = years[-2], years[-1]
    aggs = [F.max(F.when(F.col("year") == y, F.col("revenue"))).alias(f"rev_{y}") for y in years]
    aggs += [F.max(F.when(F.col("year") == y, F.col("orders"))).alias(f"orders_{y}") for y in years[1:]]
    out = m.groupBy("month_name", "month_num").agg(*aggs)
    growth = rha((cents(f"rev_{last}") - cents(f"rev_{prev}")) * 100, cents(f"rev_{prev}"), 2)
    return out.withColumn("yoy_growth_pct", growth).orderBy("month_num")


# --------------------------------------------------------------------- X3
RFM_SEGMENTS = ((13, "Champions"), (10, "Loyal Customers"), (7, "Potential Loyalists"), (5, "At Risk"))
RFM_OTHER = "Lost"


def x3_rfm_customers(
    star: dict,
    as_of: str = "2018-10-17",
    tiles: int = 5,
    segments=RFM_SEGMENTS,
    other: str = RFM_OTHER,
    score_direction: str = "as_written",
    status: str = COMPLETED,
    customer_col: str = "customer_key",
) -> DataFrame:
    """Per-customer recency / frequency / monetary, NTILE scores and segment.

    ``score_direction='as_written'`` reproduces the source query (NTILE over
    recency ASC and frequency/monetary DESC, so 1 is best while the segment
    thresholds reward high totals); ``'high_is_best'`` flips the orders so
    that 5 is best. Ties are broken by customer_key (NTILE is tie-dependent).
    The three scores come from one selection (``operators.selection``): the customers are written
    once, counted a few times, and never sorted.
    ``customer_col='customer_unique_id'`` scores people instead of customer ids (N13); a person's key, city and
    state are those of their smallest key.
    """
    f = _fact(star, status).select("date_key", "customer_key", "order_id", "gross_revenue")
    person = [] if customer_col == "customer_key" else [customer_col]
    cust = star["dim_customer"].where(F.col("is_current")).select("customer_key", "customer_city", "customer_state", *person)
    # Aggregate per customer key first (map-side combined), then attach the
    # current customer attributes: the attributes depend only on the unique
    # surrogate key, so this equals join-then-group, and no raw fact row is
    # shuffled by customer even when the dimension is too big to broadcast.
    per_key = (
        f.join(_calendar(star, "full_date"), "date_key")
        .groupBy("customer_key")
        .agg(
            F.datediff(F.lit(as_of).cast("date"), F.max("full_date")).alias("recency_days"),
            F.count_distinct("order_id").alias("frequency"),
            F.round(F.sum("gross_revenue"), 2).alias("monetary"),
        )
    )
    base = per_key.join(cust, "customer_key")
    shown = ["customer_key", "customer_city", "customer_state", "recency_days", "frequency", "monetary"]
    if customer_col != "customer_key":
        # orders belong to one customer key, so counts and sums of a person's keys add up
        shown = [customer_col, *shown]
        base = base.groupBy(customer_col).agg(
            F.min("recency_days").alias("recency_days"), F.sum("frequency").alias("frequency"), F.sum("monetary").alias("monetary"),
            *[F.min_by(c, "customer_key").alias(c) for c in ("customer_city", "customer_state")], F.min("customer_key").alias("customer_key"),
        )
    base = base.select(*shown).checkpoint(eager=True)
    flip = score_direction == "high_is_best"
    s = with_tiles(base, tiles, {"r_score": ("recency_days", not flip), "f_score": ("frequency", flip), "m_score": ("monetary", flip)}, "customer_key")
    total = F.col("r_score") + F.col("f_score") + F.col("m_score")
    seg = None
    for thr, label in segments:
        seg = F.when(total >= thr, label) if seg is None else seg.when(total >= thr, label)
    return s.withColumns({"rfm_total": total, "customer_segment": seg.otherwise(other)})


def x3_rfm_segments(star: dict, **kw) -> DataFrame:
    c = x3_rfm_customers(star, **kw)
    g = c.groupBy("customer_segment").agg(
        F.count(F.lit(1)).alias("customer_count"),
        F.sum("recency_days").alias("_sr"),
        F.sum("frequency").alias("_sf"),
        F.sum("monetary").alias("total_segment_revenue"),
    )
    tot = Window.partitionBy()  # over the handful of segment rows
    return g.select(
        "customer_segment",
        "customer_count",
        rha(F.col("_sr"), F.col("customer_count"), 0).alias("avg_recency_days"),
        rha(F.col("_sf"), F.col("customer_count"), 2).alias("avg_frequency"),
        rha(cents("total_segment_revenue"), F.col("customer_count") * 100, 2).alias("avg_monetary"),
        F.round("total_segment_revenue", 2).alias("total_segment_revenue"),
        rha(cents("total_segment_revenue") * 100, cents(F.sum("total_segment_revenue").over(tot)), 2).alias("revenue_pct"),
    ).orderBy(F.desc("total_segment_revenue"))


# --------------------------------------------------------------------- X4
def x4_product_ranking(star: dict, top: int | None = 50, status: str = COMPLETED) -> DataFrame:
    """Per-product revenue and volume ranks, share and running revenue within
    the category. Hot categories are split over tasks (global_scan)."""
    f = _fact(star, status).select("product_key", "order_id", "gross_revenue", "unit_price")
    prod = star["dim_product"].select("product_key", "product_category", "price_band")
    per_key = f.groupBy("product_key").agg(
        F.count_distinct("order_id").alias("order_count"),
        F.sum("gross_revenue").alias("total_revenue"),
        F.sum("unit_price").alias("_sp"),
        F.count("unit_price").alias("_np"),
    )
    ps = per_key.join(prod, "product_key")  # attributes of the unique key, after aggregation
    P = ["product_category"]
    # One scan gives the running revenue, the category total and the
    # revenue rank (same order); the volume rank needs its own order.
    ps = global_scan(
        ps,
        [("total_revenue", False), ("product_key", True)],
        P,
        row_number=None,
        running_sums={"_cum": F.col("total_revenue")},
        partition_sums={"_cat": F.col("total_revenue")},
        rank="revenue_rank",
        rank_cols=1,
    )
    ps = with_rank(ps, [("order_count", False)], "volume_rank", P, dense=True)
    out = ps.select(
        "product_category",
        "product_key",
        "price_band",
        "order_count",
        F.round("total_revenue", 2).alias("total_revenue"),
        _avg_money("_sp", "_np").alias("avg_selling_price"),
        "revenue_rank",
        "volume_rank",
        rha(cents("total_revenue") * 100, cents("_cat"), 2).alias("pct_of_category"),
        F.round("_cum", 2).alias("cumulative_revenue"),
    )
    out = out.orderBy("product_category", "revenue_rank", "product_key")
    return out.limit(top) if top else out


# --------------------------------------------------------------------- X5
def x5_seller_performance(star: dict, top: int | None = 20, quartiles: int = 4, status: str = COMPLETED) -> DataFrame:
    f = _fact(star, status).select(
        "seller_key", "date_key", "order_id", "customer_key", "gross_revenue", "delivery_days", "is_on_time"
    )
    sel = star["dim_seller"].select("seller_key", "seller_city", "seller_state")
    add = ("_rev", "_n", "_sd", "_nd", "_ot", "_rows")
    orders = per_order(
        f, "seller_key", "customer_key", "date_key",
        _rev=F.sum("gross_revenue"), _n=F.count("gross_revenue"), _sd=F.sum("delivery_days"), _nd=F.count("delivery_days"),
        _ot=F.sum("is_on_time"), _rows=F.count(F.lit(1)),
    )
    m = (
        orders.join(_calendar(star, "year_month"), "date_key")
        .groupBy("seller_key", "customer_key", "year_month")
        .agg(F.count(F.lit(1)).alias("_orders"), *[F.sum(c).alias(c) for c in add])
        .groupBy("seller_key")
        .agg(
            F.sum("_orders").alias("total_orders"),
            F.count_distinct("customer_key").alias("unique_customers"),
            F.count_distinct("year_month").alias("active_months"),
            *[F.sum(c).alias(c) for c in add],
        )
        .join(sel, "seller_key")  # attributes of the unique key, after aggregation
    )
    m = m.select(
        "seller_key",
        "seller_city",
        "seller_state",
        "total_orders",
        "unique_customers",
        F.round("_rev", 2).alias("total_revenue"),
        _avg_money("_rev", "_n").alias("avg_order_value"),
        rha(F.col("_sd"), F.col("_nd"), 1).alias("avg_delivery_days"),
        rha(F.col("_ot") * 100, F.col("_rows"), 2).alias("on_time_pct"),
        "active_months",
    )
    # Revenue rank and quartile share one order: one scan gives both.
    m = global_scan(
        m, [("total_revenue", False), ("seller_key", True)], row_number="_rn", partition_count="_n",
        rank="revenue_rank", rank_cols=1,
    )
    m = m.withColumn("revenue_quartile", ntile_from_rn(F.col("_rn"), F.col("_n"), quartiles)).drop("_rn", "_n")
    m = with_rank(m, [("on_time_pct", False)], "delivery_rank")
    out = m.orderBy(F.desc("total_revenue"), "seller_key")
    return out.limit(top) if top else out


# --------------------------------------------------------------------- X6
def x6_cohort_retention(
    star: dict, max_months: int = 6, status: str = COMPLETED, customer_col: str = "customer_key"
) -> DataFrame:
    """Cohort (first purchase month) x months since first purchase.

    Activity is first reduced to distinct (customer, month) pairs with a
    partial aggregate; each customer then has at most one row per calendar
    month, so the per-customer ``min`` window holds a bounded number of rows
    even for the hottest customer (no self-join of activity with first
    purchase). Distinct customers per cell are then plain counts.
    """
    f = _fact(star, status).select("date_key", "customer_key")
    act = f.join(_calendar(star, "year_month"), "date_key").select("customer_key", "year_month").distinct()
    if customer_col != "customer_key":  # one person across order-level ids, joined after the reduction
        who = star["dim_customer"].select("customer_key", customer_col)
        act = act.join(who, "customer_key").select(customer_col, "year_month").distinct()
    act = act.withColumn("cohort_month", F.min("year_month").over(Window.partitionBy(customer_col)))
    first_day = lambda c: F.to_date(F.concat(F.col(c), F.lit("-01")), "yyyy-MM-dd")
    act = act.withColumn(
        "months_since_first",
        F.timestamp_diff("MONTH", first_day("cohort_month").cast("timestamp"), first_day("year_month").cast("timestamp")).cast("int"),
    )
    g = (
        act.where(F.col("months_since_first") <= max_months)
        .groupBy("cohort_month", "months_since_first")
        .agg(F.count(F.lit(1)).alias("active_customers"))
    )
    base = F.max(F.when(F.col("months_since_first") == 0, F.col("active_customers"))).over(Window.partitionBy("cohort_month"))
    return g.withColumn("retention_pct", rha(F.col("active_customers") * 100, base, 2)).orderBy(
        "cohort_month", "months_since_first"
    )


# --------------------------------------------------------------------- X7
def delivery_bucket_names(buckets: Sequence[int]) -> list[str]:
    a, b, c = buckets
    return [f"delivered_within_{a}d", f"delivered_{a + 1}_to_{b}d", f"delivered_{b + 1}_to_{c}d", f"delivered_over_{c}d"]


def x7_delivery_performance(star: dict, buckets: Sequence[int] = (5, 10, 20), status: str = COMPLETED) -> DataFrame:
    a, b, c = buckets
    n1, n2, n3, n4 = delivery_bucket_names(buckets)
    f = _fact(star, status).where(F.col("delivery_days").isNotNull())
    f = f.select("seller_key", "delivery_days", "delivery_delay_days", "is_on_time")
    dd = F.col("delivery_days")
    # Additive measures per seller key first, then per state (sums of sums).
    per_key = f.groupBy("seller_key").agg(
        F.count(F.lit(1)).alias("total_deliveries"),
        F.count_if(dd <= a).alias(n1),
        F.count_if(dd.between(a + 1, b)).alias(n2),
        F.count_if(dd.between(b + 1, c)).alias(n3),
        F.count_if(dd > c).alias(n4),
        F.sum("delivery_days").alias("_sd"),
        F.count("delivery_days").alias("_nd"),
        F.sum("delivery_delay_days").alias("_sl"),
        F.count("delivery_delay_days").alias("_nl"),
        F.sum("is_on_time").alias("_ot"),
    )
    add = ["total_deliveries", n1, n2, n3, n4, "_sd", "_nd", "_sl", "_nl", "_ot"]
    g = (
        per_key.join(star["dim_seller"].select("seller_key", "seller_state"), "seller_key")
        .groupBy("seller_state")
        .agg(*[F.sum(x).alias(x) for x in add])
    )
    return g.select(
        "seller_state",
        "total_deliveries",
        n1,
        n2,
        n3,
        n4,
        rha(F.col("_sd"), F.col("_nd"), 1).alias("avg_delivery_days"),
        rha(F.col("_sl"), F.col("_nl"), 1).alias("avg_delay_days"),
        rha(F.col("_ot") * 100, F.col("total_deliveries"), 2).alias("on_time_pct"),
    ).orderBy(F.desc("on_time_pct"), "seller_state")


# --------------------------------------------------------------------- X8
def x8_pareto(
    star: dict, top: int | None = 100, cutoff_pct: float = 80.0, status: str = COMPLETED, customer_col: str = "customer_key"
) -> DataFrame:
    """Customers by revenue with running share of the total; ``top=None``
    classifies every customer (the running sum is distributed).
    ``customer_col='customer_unique_id'`` ranks people instead of order-level
    customer ids (N13); a person's state is that of their smallest key."""
    f = _fact(star, status).select("customer_key", "order_id", "gross_revenue")
    cols = ["customer_key", "customer_state"] + ([customer_col] if customer_col != "customer_key" else [])
    cust = star["dim_customer"].where(F.col("is_current")).select(*cols)
    # Per key first (orders belong to one customer key, so distinct orders
    # add up), then the current attributes, then the requested grain.
    per_key = f.groupBy("customer_key").agg(
        F.sum("gross_revenue").alias("_rev"), F.count_distinct("order_id").alias("_orders")
    )
    cr = per_key.join(cust, "customer_key")
    if customer_col != "customer_key":
        cr = cr.groupBy(customer_col).agg(
            F.sum("_rev").alias("_rev"), F.sum("_orders").alias("_orders"),
            F.min_by("customer_state", "customer_key").alias("customer_state"),
        )
    cr = cr.select(
        customer_col, "customer_state", F.round("_rev", 2).alias("total_revenue"), F.col("_orders").alias("total_orders")
    )
    # Rank, running revenue and grand total from one distributed scan.
    cr = global_scan(
        cr,
        [("total_revenue", False), (customer_col, True)],
        row_number=None,
        running_sums={"_cum": F.col("total_revenue")},
        partition_sums={"_tot": F.col("total_revenue")},
        rank="revenue_rank",
        rank_cols=1,
    )
    pct = rha(cents("_cum") * 100, cents("_tot"), 2)
    out = cr.select(
        "revenue_rank",
        customer_col,
        "customer_state",
        "total_revenue",
        "total_orders",
        pct.alias("cumulative_pct"),
    ).withColumn(
        "pareto_segment",
        F.when(F.col("cumulative_pct") <= cutoff_pct, "Top 80% Revenue Drivers").otherwise("Remaining 20%"),
    )
    out = out.orderBy("revenue_rank", customer_col)
    return out.limit(top) if top else out


# --------------------------------------------------------------------- X9
def x9_quarterly_kpis(star: dict, status: str = COMPLETED) -> DataFrame:
    f = _fact(star, status).select(
        "date_key", "order_id", "customer_key", "gross_revenue", "freight_value", "delivery_days", "is_on_time"
    )
    quarter = ("year", "quarter", "quarter_name")
    add = ("_rev", "_n", "_fr", "_sd", "_nd", "_ot", "_rows")
    orders = per_order(
        f, "date_key", "customer_key",
        _rev=F.sum("gross_revenue"), _n=F.count("gross_revenue"), _fr=F.sum("freight_value"), _sd=F.sum("delivery_days"),
        _nd=F.count("delivery_days"), _ot=F.sum("is_on_time"), _rows=F.count(F.lit(1)),
    )
    q = (
        orders.join(_calendar(star, *quarter), "date_key")
        .groupBy(*quarter, "customer_key")
        .agg(F.count(F.lit(1)).alias("total_orders"), *[F.sum(c).alias(c) for c in add])
        .groupBy(*quarter)
        .agg(F.sum("total_orders").alias("total_orders"), F.count(F.lit(1)).alias("unique_customers"),
             *[F.sum(c).alias(c) for c in add])
    )
    w = Window.orderBy("year", "quarter")  # one row per calendar quarter
    q = q.withColumn("_prev", F.lag("_rev").over(w))
    return q.select(
        "year",
        "quarter_name",
        F.concat_ws(" ", F.col("year").cast("string"), F.col("quarter_name")).alias("period"),
        "total_orders",
        "unique_customers",
        F.round("_rev", 2).alias("gross_revenue"),
        _avg_money("_rev", "_n").alias("avg_order_value"),
        F.round("_fr", 2).alias("total_freight"),
        rha(cents("_fr") * 100, cents("_rev"), 2).alias("freight_pct_of_revenue"),
        rha(F.col("_sd"), F.col("_nd"), 1).alias("avg_delivery_days"),
        rha(F.col("_ot") * 100, F.col("_rows"), 2).alias("on_time_delivery_pct"),
        rha((cents("_rev") - cents("_prev")) * 100, cents("_prev"), 2).alias("qoq_growth_pct"),
        "quarter",
    ).orderBy("year", "quarter").drop("quarter")
