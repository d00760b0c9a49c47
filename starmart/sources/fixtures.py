"""Adapter: driver test tables -> the retail source shape the operators expect.

This is the only place that knows the fixture tables. Every function returns a
lazy DataFrame that reads the parquet files (with pruned columns); nothing is
collected. Mapping (see FIXTURES.md):

  orders.order_id / customer_id        o_orderkey / o_custkey
  orders.order_status                  F->delivered, O->shipped, P->processing
  purchase / approved timestamps       o_orderdate
  carrier / customer delivery          min / max l_shipdate per order (NULL if no lines)
  estimated delivery                   o_orderdate + 1000 days
  items                                lineitem (price = extendedprice, freight = round(price*tax,2))
  payments                             one per line (type = returnflag, value = round(price*(1-discount),2))
  customers                            custkey, name, mktsegment as city, nation name as state
  products                             partkey, p_type as category, p_size as weight
  sellers                              suppkey, region name as city, nation name as state
  category translation                 distinct non-PROMO p_type -> lower(p_type)
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stored

# Fixed values of the fixture mapping.
ORDER_STATUS_FROM_CODE = {"F": "delivered", "O": "shipped", "P": "processing"}
ESTIMATED_DELIVERY_DAYS = 1000
UNTRANSLATED_TYPE_PREFIX = "PROMO"

# Parameter overrides that make every branch non-empty on the fixture data.
FIXTURE_PARAMS = {
    "date_start": "1995-01-01",
    "date_end": "2001-12-31",
    "price_band_edges": (0.0, 45000.0, 53000.0, 60000.0, float("inf")),
    "weight_band_edges": (0.0, 10.0, 20.0, 40.0, float("inf")),
    "delivery_buckets": (250, 500, 1000),
    "yoy_years": (1998, 1999, 2000),
    "rfm_as_of": "2001-12-31",
    "run_date": "2002-01-01",
    "as_of_ts": "2002-01-01 00:00:00",
}

MONEY = "decimal(12,2)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _line_ship_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy(F.col("l_orderkey").alias("order_id")).agg(
        F.min("l_shipdate").alias("order_delivered_carrier_date"),
        F.max("l_shipdate").alias("order_delivered_customer_date"),
    )


def source_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    status = F.create_map(*[F.lit(x) for kv in ORDER_STATUS_FROM_CODE.items() for x in kv])
    base = o.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.try_element_at(status, F.col("o_orderstatus")).alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
        F.col("o_orderdate").alias("order_approved_at"),
        (F.col("o_orderdate") + F.make_interval(days=F.lit(ESTIMATED_DELIVERY_DAYS))).alias(
            "order_estimated_delivery_date"
        ),
    )
    # Per-order ship bounds: a partial (map-side) aggregate of lineitem joined
    # on the order key; both sides hash-partition on order_id.
    out = base.join(_line_ship_bounds(spark, sf_dir), "order_id", "left")
    return out.select(
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    )


def source_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice").cast(MONEY)
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        price.alias("price"),
        F.round(price * F.col("l_tax").cast("decimal(4,2)"), 2).cast(MONEY).alias("freight_value"),
    )


def source_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payment row per line; ``(l_linenumber, l_partkey, l_suppkey)`` is the
    arrival sequence used as the first-seen tie-break of the payment mode."""
    li = table(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice").cast(MONEY)
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_returnflag").alias("payment_type"),
        F.col("l_quantity").cast("int").alias("payment_installments"),
        F.round(price * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)")), 2).cast(MONEY).alias("payment_value"),
        F.struct(
            F.col("l_linenumber").alias("a"), F.col("l_partkey").alias("b"), F.col("l_suppkey").alias("c")
        ).alias("payment_seq"),
    )


def source_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # nation is a fixed 25-row reference table: broadcasting it is bounded.
    return c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey, "left").select(
        F.col("c_custkey").alias("customer_id"),
        # people hold several customer ids: those whose balances agree up to the last digit
        F.concat(F.lit("P"), F.floor(F.col("c_acctbal") / 10).cast("string")).alias("customer_unique_id"),
        F.col("c_mktsegment").alias("customer_city"),
        F.col("n_name").alias("customer_state"),
        F.col("c_nationkey").cast("string").alias("customer_zip_code_prefix"),
    )


def source_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("product_category_name"),
        F.col("p_size").cast("string").alias("product_weight_g"),
        F.lit(None).cast("string").alias("product_length_cm"),
        F.lit(None).cast("string").alias("product_height_cm"),
        F.lit(None).cast("string").alias("product_width_cm"),
    )


def source_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    nr = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey, "left")  # 25 x 5 fixed rows
    return s.join(F.broadcast(nr), s.s_nationkey == nr.n_nationkey, "left").select(
        F.col("s_suppkey").alias("seller_id"),
        F.col("r_name").alias("seller_city"),
        F.col("n_name").alias("seller_state"),
        F.col("s_nationkey").cast("string").alias("seller_zip_code_prefix"),
    )


def source_category_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return (
        p.select(F.col("p_type").alias("product_category_name"))
        .where(~F.col("product_category_name").startswith(UNTRANSLATED_TYPE_PREFIX))
        .distinct()
        .select("product_category_name", F.lower("product_category_name").alias("product_category_name_english"))
    )


def customer_feed(spark: SparkSession, sf_dir: str, as_of: str) -> DataFrame:
    """Customer snapshot as known on ``as_of`` (an SCD2 input feed).

    Members are the customers with at least one order placed before
    ``as_of``; the tracked ``customer_city`` is the priority class of their
    latest order before ``as_of`` (so it moves between snapshots), the state
    is the nation name, zip the nation key (untracked).
    """
    o = table(spark, sf_dir, "orders").where(F.col("o_orderdate") < F.lit(as_of).cast("timestamp_ntz"))
    latest = o.groupBy(F.col("o_custkey").alias("customer_id")).agg(
        F.max_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey")).alias("customer_city")
    )
    cust = source_customers(spark, sf_dir).drop("customer_city")
    return cust.join(latest, "customer_id", "inner").select(
        "customer_id", "customer_unique_id", "customer_city", "customer_state", "customer_zip_code_prefix"
    )


def sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "orders": source_orders(spark, sf_dir),
        "items": source_items(spark, sf_dir),
        "payments": source_payments(spark, sf_dir),
        "customers": source_customers(spark, sf_dir),
        "products": source_products(spark, sf_dir),
        "sellers": source_sellers(spark, sf_dir),
        "category_translation": source_category_translation(spark, sf_dir),
    }


def as_date(s: str) -> _dt.date:
    return _dt.date.fromisoformat(s)


def sellers_in_orders(spark: SparkSession, sf_dir: str, start: str | None, end: str) -> DataFrame:
    """Ids of the sellers with an item of an order placed in [start, end): the seller extract of an
    earlier load (items of the other sellers fail the lookup)."""
    day = F.col("o_orderdate")
    o = table(spark, sf_dir, "orders").where(day < F.lit(end).cast("timestamp_ntz"))
    if start is not None:
        o = o.where(day >= F.lit(start).cast("timestamp_ntz"))
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_suppkey").alias("seller_id"))
    # the orders of the days are stored: Spark knows how few they are before it would shuffle the lines to them
    return stored(li.join(stored(o.select("o_orderkey")), "o_orderkey").select("seller_id").distinct())


def faulty_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The source tables with faults in some months, so that every check and reject route finds some.

    Orders in processing: purchased in January, a purchase time that is no time; February, ten years
    later; March, approved the day before; April, an unknown customer; May, the row twice. First items by
    the month of their shipping limit: January, price 0; February, no price; March, no freight; April, an
    unknown order; May, the price a hundred times. Customers of the machinery segment are there twice, the second time in another
    city. Purchase times are text throughout.
    """
    src = sources(spark, sf_dir)
    p = "order_purchase_timestamp"
    o = src["orders"].withColumn("_m", F.when(F.col("order_status") == "processing", F.month(p)))
    m = F.coalesce("_m", F.lit(0))
    o = o.withColumns({
        "order_approved_at": F.when(m == 3, F.col(p) - F.make_interval(days=F.lit(1))).otherwise(F.col("order_approved_at")),
        "customer_id": F.when(m == 4, -F.col("customer_id") - 1).otherwise(F.col("customer_id")),
        p: F.when(m == 1, "unknown").otherwise(
            F.date_format(F.when(m == 2, F.col(p) + F.make_interval(years=F.lit(10))).otherwise(F.col(p)), "yyyy-MM-dd HH:mm:ss")
        ),
    })
    o = o.unionByName(o.where(m == 5)).drop("_m")
    k = F.when(F.col("order_item_id") == 1, F.month("shipping_limit_date"))
    i = src["items"].withColumn("_m", F.coalesce(k, F.lit(0)))
    i = i.withColumns({
        "price": F.when(F.col("_m") == 1, F.lit(0).cast(MONEY)).when(F.col("_m") == 5, (F.col("price") * 100).cast(MONEY)).when(F.col("_m") != 2, F.col("price")),
        "freight_value": F.when(F.col("_m") != 3, F.col("freight_value")),
        "order_id": F.when(F.col("_m") == 4, -F.col("order_id") - 1).otherwise(F.col("order_id")),
    }).drop("_m")
    c = src["customers"]
    c = c.unionByName(c.where(F.col("customer_city") == "MACHINERY").withColumn("customer_city", F.lit(" a town ")))
    return dict(src, orders=o, items=i, customers=c)
