"""Fact assembly: incremental selection, joins, surrogate lookups, failure routing."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored

# The columns of the fact table.
FACT_COLUMNS = (
    "date_key",
    "customer_key",
    "product_key",
    "seller_key",
    "order_id",
    "order_item_seq",
    "unit_price",
    "freight_value",
    "gross_revenue",
    "total_cost",
    "delivery_days",
    "delivery_delay_days",
    "is_on_time",
    "primary_payment_type",
    "payment_installments",
    "total_payment_value",
    "order_status",
    "status_category",
    "etl_load_date",
)

# What identifies a line: the keys of products and sellers are stable.
LINE_KEY = ("order_id", "order_item_seq", "product_key", "seller_key")
# Ids that the lookups start from; with the fact's date and money they must be there and not NULL.
LOOKUP_IDS = ("customer_id", "product_id", "seller_id")
REQUIRED_COLS = ("date_key", *LOOKUP_IDS, "gross_revenue", "delivery_delay_days")


def incremental_orders(stg_orders: DataFrame, watermark, clock: str = "order_purchase_timestamp") -> DataFrame:
    """Orders strictly after the watermark (``None`` -> all). The predicate is
    on a plain column, so it reaches the parquet scan as a pushed filter."""
    if watermark is None:
        return stg_orders
    return stg_orders.where(F.col(clock) > F.lit(watermark).cast("timestamp_ntz"))


@dataclass
class FactBuild:
    fact: DataFrame  # final projection, lookups resolved
    failures: DataFrame  # rows with any surrogate lookup miss or no date (+ failed_dims)
    assembled: DataFrame  # before failure routing (for required-column audits)
    carried: DataFrame  # the fact with the product attributes that its lines carry


def key_map(dim: DataFrame, id_col: str, key_col: str, alias: str, carry: Sequence[str] = ()) -> DataFrame:
    """(id, key) with one row per id, so that a lookup never multiplies lines: the latest key of an id
    loaded twice (``duplicate_members`` counts those). ``carry``: attributes of that key's row."""
    held = [F.max_by(c, key_col).alias(c) for c in carry]
    return dim.groupBy(F.col(id_col).alias(alias)).agg(F.max(key_col).alias(key_col), *held)


def duplicate_members(dims: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Per dimension, the business keys held by more than one (current) row."""
    parts = []
    for name, (dim, id_col) in dims.items():
        twice = dim.groupBy(id_col).count().where(F.col("count") > 1)
        parts.append(twice.agg(F.count(F.lit(1)).alias("duplicate_ids")).select(F.lit(name).alias("dimension"), "duplicate_ids"))
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def with_line_keys(items: DataFrame, dim_product: DataFrame, dim_seller: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """The lines with their product and seller keys (NULL where the lookup misses), and the product attributes ``carry``.

    The lookups come first, while a line is only its ids and money: a dimension too large to broadcast then
    shuffles narrow lines, and what follows stays partitioned by order.
    """
    items = items.drop("product_key", "seller_key", *carry)
    pmap = key_map(dim_product, "product_id", "product_key", "_p_id", carry)
    smap = key_map(dim_seller, "seller_id", "seller_key", "_s_id")
    f = items.join(pmap, items["product_id"] == pmap["_p_id"], "left").drop("_p_id")
    return f.join(smap, f["seller_id"] == smap["_s_id"], "left").drop("_s_id")


def build_fact(
    stg_items: DataFrame,
    orders: DataFrame,
    stg_payments: DataFrame,
    dim_customer: DataFrame,
    dim_product: DataFrame,
    dim_seller: DataFrame,
    run_date: str,
    materialize: bool = False,
    keyed: bool = False,
    carry: Sequence[str] = (),
) -> FactBuild:
    """Items of the selected orders joined to order fields, order-level
    payments and the three surrogate keys.

    The source's semi join on the selected order ids followed by a left join
    to the same orders is an inner join. The customer key is resolved on the
    orders (one row per order, several times fewer than lines), so the
    customer lookup never reshuffles the line-level fact; payments are
    pre-aggregated per order. Products and sellers are looked up on the narrow
    lines (``with_line_keys``; ``keyed``: the caller has done so, ``carry``: with these product attributes); items, orders and payments then all meet on
    order_id, which the fact stays partitioned by. Surrogate lookups are left joins against (id, key); the
    customer lookup uses current versions only; an id held by several rows
    resolves to its latest key. Lines without a date or with a lookup that
    misses are failures; a column the fact needs and the input lacks raises.
    Dimension sides are sized by
    Spark (statistics, then AQE at runtime): broadcast when small, shuffle
    join otherwise.
    """
    # what the fact needs of an order comes from the order itself, whatever the lines carry along
    needed = {*FACT_COLUMNS, *LOOKUP_IDS, "order_purchase_timestamp"}
    o = orders.select(*[c for c in orders.columns if c in needed])
    items = stg_items.drop(*[c for c in stg_items.columns if c in orders.columns and c != "order_id"])
    if not keyed:
        items = with_line_keys(items, dim_product, dim_seller)
    cmap = key_map(dim_customer.where(F.col("is_current")), "customer_id", "customer_key", "_c_id")
    o = o.join(cmap, o["customer_id"] == cmap["_c_id"], "left").drop("_c_id")
    pay = stg_payments.select("order_id", "primary_payment_type", "payment_installments", "total_payment_value")
    f = items.join(o, "order_id", "inner").join(pay, "order_id", "left")

    failed = F.filter(
        F.array(
            F.when(F.col("customer_key").isNull(), F.lit("customer")),
            F.when(F.col("product_key").isNull(), F.lit("product")),
            F.when(F.col("seller_key").isNull(), F.lit("seller")),
            F.when(F.col("date_key").isNull(), F.lit("date")),
        ),
        lambda x: x.isNotNull(),
    )
    f = f.withColumn("failed_dims", failed)
    absent = missing_columns(_as_fact(f, run_date), FACT_COLUMNS)
    if absent:
        raise ValueError(f"the staged input lacks fact columns: {', '.join(absent)}")
    if materialize:  # both outputs written: assemble once
        f = stored(f)
    ok = F.size("failed_dims") == 0
    failures = f.where(~ok).drop(*carry)
    fact = _as_fact(f.where(ok), run_date)
    return FactBuild(fact.select(*FACT_COLUMNS), failures, f.drop(*carry), fact.select(*FACT_COLUMNS, *carry))


def _as_fact(lines: DataFrame, run_date: str) -> DataFrame:
    named = lines.withColumnsRenamed({"order_item_id": "order_item_seq", "price": "unit_price"})
    return named.withColumn("etl_load_date", F.lit(run_date).cast("date"))


def fact_inputs(stg_items: DataFrame) -> DataFrame:
    """The staged lines without the columns that neither the fact nor the failure queue takes."""
    needed = {*FACT_COLUMNS, *LOOKUP_IDS, "order_item_id", "price"}
    return stg_items.select(*[c for c in stg_items.columns if c in needed])


def missing_columns(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    return [c for c in wanted if c not in df.columns]


def required_column_audit(assembled: DataFrame, required: Sequence[str] = REQUIRED_COLS) -> DataFrame:
    """(column, present, nulls) for each required fact column, one pass."""
    present = [c for c in required if c in assembled.columns]
    row = assembled.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in present])
    stack = ", ".join(f"'{c}', `{c}`" for c in present)
    out = row.selectExpr(f"stack({len(present)}, {stack}) as (column_name, nulls)").withColumn("present", F.lit(True))
    absent = [c for c in required if c not in assembled.columns]
    if absent:
        spark = assembled.sparkSession
        miss = spark.createDataFrame([(c, None, False) for c in absent], "column_name string, nulls long, present boolean")
        out = out.unionByName(miss)
    return out.select("column_name", "present", F.col("nulls").cast("long").alias("nulls"))


def fact_key_audit(star: dict) -> DataFrame:
    """(check, rows): facts whose key has no calendar day or dimension row, or whose key is NULL."""
    f = star["fact_sales"]
    parts = []
    for dim, key in (("dim_date", "date_key"), ("dim_customer", "customer_key"), ("dim_product", "product_key"), ("dim_seller", "seller_key")):
        # one row per key value first, so that no fact row is shuffled to the dimension
        held = f.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        lost = held.join(star[dim].select(key).distinct(), key, "left_anti")
        n = F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("rows")
        parts.append(lost.where(F.col(key).isNotNull()).agg(n).select(F.lit(f"{key} not in {dim}").alias("check_name"), "rows"))
        parts.append(held.where(F.col(key).isNull()).agg(n).select(F.lit(f"{key} is null").alias("check_name"), "rows"))
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def dedupe_against(new_rows: DataFrame, existing_fact: DataFrame, key: Sequence[str] = LINE_KEY) -> DataFrame:
    """Idempotent append guard: drop lines already in the fact. The grain is
    the line, because some lines of an order may have failed a lookup."""
    return new_rows.join(existing_fact.select(*key), list(key), "left_anti")
