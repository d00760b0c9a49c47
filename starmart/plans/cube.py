"""Year-month cube of the dashboard marts (M1-M8 for any slice, M11).

The marts scan the fact for each slice. The cube is built once per load and holds what every slice is a merge of:

``cube_orders``     (month, part, a, b): money, orders and delivery sums of all orders and by status, payment type, state and city
``cube_products``   (month, part, a): revenue and orders by category and by price band
``cube_customers``  (month, state, bucket): the customers who bought, as bitmaps over the dense customer keys

An order has one purchase day, so its month is the only one that counts it: orders of months add up. Customers
come back, so their distinct count over months is a merge of bitmaps (32,768 keys each, 4 KB), never a sum.
A cube has as many rows as months x attribute values (x buckets of customers); slices read the months they
need by a predicate on the partition column. ``refresh`` rewrites the months of a load alone.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import stored
from .analytics import per_order
from .marts import COMPLETED, kpi_columns, rha, share, state_columns
from .warehouse import Warehouse

TABLES = ("cube_orders", "cube_products", "cube_customers")
SLICE = ("slice_year", "slice_month")
_ADDED = ("revenue", "orders", "done_orders", "done_ot", "done_rows", "ot", "sd", "nd", "rows")


def month_of(date_key: str = "date_key") -> Column:
    return F.expr(f"{date_key} div 100").cast("int")


def _months(f: DataFrame, months: Iterable[int] | None) -> DataFrame:
    """The fact, or the rows of some months: ranges of ``date_key`` that reach the scan, year folders as literals."""
    if months is not None:
        months = sorted(months)  # at most the calendar's
        days = F.lit(False)
        for m in months:
            days = days | F.col("date_key").between(m * 100 + 1, m * 100 + 31)
        f = f.where(days)
        if "fact_year" in f.columns:
            f = f.where(F.col("fact_year").isin(sorted({m // 100 for m in months})))
    return f


def build(star: dict[str, DataFrame], months: Iterable[int] | None = None, tables: Iterable[str] = TABLES) -> dict[str, DataFrame]:
    """The three tables (or those of ``tables``), of all months or of the given ones. Orders and customers are counted from one
    grain, stored where both are built, so that a fact that is still a plan is assembled once for them."""
    tables, out = set(tables), {}
    if tables & {"cube_orders", "cube_customers"}:
        grain = _grain(star, months)
        if tables >= {"cube_orders", "cube_customers"}:
            grain = stored(grain)
        out = {"cube_orders": _order_cells(grain), "cube_customers": _customers(grain)}
    if "cube_products" in tables:
        out["cube_products"] = _product_cells(star, months)
    return {n: out[n] for n in TABLES if n in tables}


def _grain(star: dict[str, DataFrame], months: Iterable[int] | None) -> DataFrame:
    """One row per month, customer, status and payment type, with the customer's state and city."""
    f = _months(star["fact_sales"], months)
    c = star["dim_customer"].select("customer_key", "customer_state", "customer_city", F.lit(True).alias("known"))
    # lines -> orders (one shuffle), then all attribute grains of an order in one aggregation
    done = F.col("status_category") == COMPLETED
    orders = per_order(
        f, "date_key", "customer_key", "order_status", "primary_payment_type",
        revenue=F.sum("gross_revenue"), done_ot=F.sum(F.when(done, F.col("is_on_time"))), done_rows=F.count_if(done),
        ot=F.sum("is_on_time"), sd=F.sum("delivery_days"), nd=F.count("delivery_days"), rows=F.count(F.lit(1)),
    ).withColumns({"month": month_of(), "done_orders": (F.col("done_rows") > 0).cast("long"), "orders": F.lit(1).cast("long")})
    # one row per customer and month before the cells are laid over them
    grain = orders.groupBy("month", "customer_key", "order_status", "primary_payment_type").agg(*[F.sum(x).alias(x) for x in _ADDED])
    return grain.join(c, "customer_key", "left")


def _order_cells(grain: DataFrame) -> DataFrame:
    by = F.array(
        _cell("all", True), _cell("status", True, "order_status"), _cell("payment", True, "primary_payment_type"),
        _cell("state", "known", "customer_state"), _cell("city", "known", "customer_state", "customer_city"),
    )
    cells = grain.withColumn("cell", F.explode(F.filter(by, lambda x: x["held"])))
    return cells.groupBy("month", "cell.part", "cell.a", "cell.b").agg(*[F.sum(x).alias(x) for x in _ADDED])


def _customers(grain: DataFrame) -> DataFrame:
    """Bitmaps of the customers. Their keys are dealt by month and bucket first, so each bitmap is made whole in one task:
    partial bitmaps of every task (4 KB each, however few their customers) would outgrow the keys themselves."""
    keys = grain.select("month", "customer_key", "known", "customer_state", F.expr("bitmap_bucket_number(customer_key)").alias("bucket"))
    return keys.repartition("month", "bucket").distinct().groupBy("month", "known", "customer_state", "bucket").agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(customer_key))").alias("customers")
    )


def _product_cells(star: dict[str, DataFrame], months: Iterable[int] | None) -> DataFrame:
    """Cells by category and price band. Lines that carry their product's attributes (``fact_products``) are dealt by order already;
    others meet the products and are then dealt by order, once: the cells of an order need no shuffle of their own."""
    if "fact_products" in star:
        lines = _months(star["fact_products"], months)
    else:
        p = star["dim_product"].select("product_key", "product_category", "price_band")
        f = _months(star["fact_sales"], months).select("order_id", "product_key", "date_key", "gross_revenue")
        lines = f.join(p, "product_key").drop("product_key").repartition("order_id")
    held = per_order(lines, "date_key", "product_category", "price_band", revenue=F.sum("gross_revenue"))
    kinds = F.array(_cell("category", True, "product_category"), _cell("band", True, "price_band"))
    of_order = held.withColumn("cell", F.explode(kinds)).groupBy(month_of().alias("month"), "cell.part", "cell.a", "order_id").agg(F.sum("revenue").alias("revenue"))
    return of_order.groupBy("month", "part", "a").agg(F.sum("revenue").alias("revenue"), F.count(F.lit(1)).alias("orders"))


def _cell(part: str, held: bool | str, a: str | None = None, b: str | None = None) -> Column:
    text = lambda x: (F.col(x) if x else F.lit(None)).cast("string")
    flag = F.coalesce(F.col(held), F.lit(False)) if isinstance(held, str) else F.lit(held)
    return F.struct(F.lit(part).alias("part"), text(a).alias("a"), text(b).alias("b"), flag.alias("held"))


def refresh(spark: SparkSession, base: str, log_id: int, months: Iterable[int] | None = None) -> None:
    """Build the cube from the committed star and commit its three tables together. With ``months`` (YYYYMM, those
    that a load or a changed dimension touched) only they are rebuilt; the others keep their files."""
    wh = Warehouse(spark, base)
    with wh.begin(log_id, "cube") as tx:
        star = {n: tx.read(n) for n in ("fact_sales", "dim_customer", "dim_product")}
        if months is None:  # every month of the fact, and those that only the old cube has
            found = star["fact_sales"].select(month_of().alias("month")).distinct().collect()  # at most the calendar's
            touched = {r["month"] for r in found} | {int(p) for p in tx.folders.get("cube_orders", {}).values()}
        else:
            touched = set(months)
        if not touched and tx.read("cube_orders") is not None:
            return
        for name, df in build(star, None if months is None else touched).items():
            tx.replace_partitions(name, df, "month", touched)
        tx.loaded = len(touched)


def months_of_load(spark: SparkSession, base: str) -> list[int]:
    """The months that the fact's last load wrote: what ``refresh`` has to rebuild after it."""
    wh = Warehouse(spark, base)
    lines = wh.last_load("fact_sales")
    return sorted(r["month"] for r in lines.select(month_of().alias("month")).distinct().collect())  # at most the calendar's


def read(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """The cube as of the latest commit."""
    wh = Warehouse(spark, base)
    snap = wh.snapshot()
    return {n: wh.read(n, snap) for n in TABLES}


# ------------------------------------------------------------------ slices
def _slice(df: DataFrame, year: int | None, month: int | None, every: bool) -> tuple[DataFrame, tuple[str, ...]]:
    """Rows of a slice; or of all slices at once, each row in its month's, its year's and the whole one."""
    if year is not None:
        lo, hi = (year * 100 + 1, year * 100 + 12) if month is None else (year * 100 + month,) * 2
        df = df.where(F.col("month").between(lo, hi))
    if not every:
        return df, ()
    y, m, none = F.expr("month div 100").cast("int"), (F.col("month") % 100).cast("int"), F.lit(None).cast("int")
    cut = [F.struct(a.alias("slice_year"), b.alias("slice_month")) for a, b in ((y, m), (y, none), (none, none))]
    return df.withColumn("_cut", F.explode(F.array(*cut))).select("*", "_cut.*").drop("_cut"), SLICE


def _same_slice(a: str, b: str) -> Column:
    return (F.col(f"{a}.slice_year").eqNullSafe(F.col(f"{b}.slice_year"))) & (F.col(f"{a}.slice_month").eqNullSafe(F.col(f"{b}.slice_month")))


def _count_customers(df: DataFrame, *keys: str) -> DataFrame:
    """Distinct customers by ``keys``: bitmaps of a bucket merged, the set bits of all buckets summed."""
    merged = df.groupBy(*keys, "bucket").agg(F.expr("bitmap_count(bitmap_or_agg(customers))").alias("n"))
    return merged.groupBy(*keys).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("customers"))


def _orders(cube: dict[str, DataFrame], part: str, year, month, every: bool, /, **names: str) -> tuple[DataFrame, tuple[str, ...]]:
    df, cut = _slice(cube["cube_orders"].where(F.col("part") == part), year, month, every)
    keys = [F.col(v).alias(k) for k, v in names.items()]
    return df.groupBy(*cut, *keys).agg(*[F.sum(x).alias(x) for x in _ADDED]), cut


def m1_kpi_cards(cube: dict[str, DataFrame], year=None, month=None, every: bool = False) -> DataFrame:
    o, cut = _orders(cube, "all", year, month, every)
    c, _ = _slice(cube["cube_customers"], year, month, every)
    n = _count_customers(c, *cut)
    both = o.alias("o").join(n.alias("n"), _same_slice("o", "n") if every else F.lit(True))  # one row a slice on both sides
    return both.select(*[F.col(f"o.{x}") for x in (*cut, *_ADDED)], F.col("n.customers")).select(
        *cut,
        *kpi_columns("revenue", F.coalesce("orders", F.lit(0)), F.col("customers"), F.coalesce("done_orders", F.lit(0)), F.col("done_ot"), F.col("done_rows")),
    )


def m2_monthly(cube: dict[str, DataFrame], year=None, month=None) -> DataFrame:
    o, _ = _orders(cube, "all", year, month, False, month="month")
    text = F.concat_ws("-", F.expr("lpad(cast(month div 100 as string), 4, '0')"), F.expr("lpad(cast(month % 100 as string), 2, '0')"))
    return o.select(text.alias("year_month"), "revenue", "orders").orderBy("year_month")


def _products(cube, part: str, name: str, year, month, every: bool, *more: Column) -> tuple[DataFrame, tuple[str, ...]]:
    df, cut = _slice(cube["cube_products"].where(F.col("part") == part), year, month, every)
    return df.groupBy(*cut, *more, F.col("a").alias(name)).agg(F.sum("revenue").alias("revenue"), F.sum("orders").alias("orders")), cut


def m3_top_categories(cube: dict[str, DataFrame], top: int = 10, year=None, month=None, every: bool = False) -> DataFrame:
    """The ``top`` categories by revenue (of each slice)."""
    g, cut = _products(cube, "category", "product_category", year, month, every)
    place = F.row_number().over(Window.partitionBy(*cut).orderBy(F.desc("revenue"), "product_category"))  # a row a category and slice
    return g.withColumn("_place", place).where(F.col("_place") <= top).drop("_place")


def m4_payment_types(cube: dict[str, DataFrame], year=None, month=None, every: bool = False) -> DataFrame:
    o, cut = _orders(cube, "payment", year, month, every, primary_payment_type="a")
    return o.select(*cut, "primary_payment_type", "revenue", "orders").withColumn("revenue_pct", share("revenue", Window.partitionBy(*cut)))


def m5_states(cube: dict[str, DataFrame], year=None, month=None, every: bool = False) -> DataFrame:
    o, cut = _orders(cube, "state", year, month, every, customer_state="a")
    return o.select(*cut, "customer_state", "revenue").withColumn("revenue_pct", share("revenue", Window.partitionBy(*cut)))


def m5_cities(cube: dict[str, DataFrame], year=None, month=None, every: bool = False) -> DataFrame:
    o, cut = _orders(cube, "city", year, month, every, customer_state="a", customer_city="b")
    return o.select(*cut, "customer_state", "customer_city", "revenue", "orders")


def m6_order_status(cube: dict[str, DataFrame], year=None, month=None, every: bool = False) -> DataFrame:
    o, cut = _orders(cube, "status", year, month, every, order_status="a")
    whole = F.sum("orders").over(Window.partitionBy(*cut))  # a row a status and slice
    return o.select(*cut, "order_status", "orders", rha(F.col("orders") * 100, whole, 2).alias("orders_pct"))


def m7_state_metrics(cube: dict[str, DataFrame], year=None, month=None, every: bool = False) -> DataFrame:
    o, cut = _orders(cube, "state", year, month, every, customer_state="a")
    c, _ = _slice(cube["cube_customers"].where("known"), year, month, every)
    n = _count_customers(c, *cut, "customer_state")
    same = F.col("o.customer_state").eqNullSafe(F.col("n.customer_state"))
    both = o.alias("o").join(n.alias("n"), (same & _same_slice("o", "n")) if every else same)
    named = both.select(*[F.col(f"o.{x}") for x in (*cut, "customer_state", *_ADDED)], F.col("n.customers"))
    return named.select(*cut, *state_columns("revenue", "orders", "customers", "sd", "nd", "ot", "rows"))


def m8_category_revenue(cube: dict[str, DataFrame], year=None, month=None, every: bool = False) -> DataFrame:
    return _products(cube, "category", "product_category", year, month, every)[0]


def m8_price_band_by_year(cube: dict[str, DataFrame], year=None, month=None) -> DataFrame:
    return _products(cube, "band", "price_band", year, month, False, F.expr("month div 100").cast("int").alias("year"))[0]
