"""Staging: clean, derive and route the raw extract (orders, items, customers,
products, payments). Each function is DataFrame -> DataFrame(s), lazy."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import expr as E
from .routing import REJECT_REASON, route, union_rejects, unrouted

ORDER_TS_COLS = (
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)

# Fixed reject reasons.
R_NULL_PURCHASE = "NULL purchase timestamp"
R_DELIVERY_BEFORE_PURCHASE = "Delivery date before purchase date"
R_BAD_PRICE = "Zero or negative price"
R_ORPHAN_ITEM = "No matching order in orders table"
R_NULL_PRICE = "NULL price"

# Order columns the items inherit from the cleaned orders.
ORDER_COLS_FOR_ITEMS = (
    "date_key",
    "order_year",
    "order_month",
    "order_quarter",
    "is_on_time",
    "delivery_days",
    "status_category",
)


@dataclass
class Staged:
    kept: DataFrame
    rejects: DataFrame


def coerce_order_timestamps(orders: DataFrame) -> DataFrame:
    types = dict((f.name, f.dataType) for f in orders.schema.fields)
    return orders.withColumns({c: E.coerce_timestamp(c, types.get(c)) for c in ORDER_TS_COLS if c in types})


def derive_order_fields(df: DataFrame) -> DataFrame:
    p, d, e = "order_purchase_timestamp", "order_delivered_customer_date", "order_estimated_delivery_date"
    return df.withColumns(
        {
            "date_key": E.date_key(p),
            "order_year": F.year(p),
            "order_month": F.month(p),
            "order_quarter": F.quarter(p),
            "delivery_days": E.floor_days(p, d),
            "is_on_time": F.when(F.coalesce(F.col(d) <= F.col(e), F.lit(False)), 1).otherwise(0),
            "delivery_delay_days": E.floor_days(e, d),
            "status_category": E.status_category("order_status"),
        }
    )


def stage_orders(orders: DataFrame, key: str = "order_id") -> Staged:
    """Coerce timestamps, reject NULL purchase time and delivery-before-purchase
    (dropping *every* row of an offending order id), derive reporting fields."""
    o = coerce_order_timestamps(orders)
    o, rej_null = route(o, F.col("order_purchase_timestamp").isNull(), R_NULL_PURCHASE)
    bad = F.col("order_delivered_customer_date").isNotNull() & (
        F.col("order_delivered_customer_date") < F.col("order_purchase_timestamp")
    )
    rej_bad = o.where(bad).withColumn(REJECT_REASON, F.lit(R_DELIVERY_BEFORE_PURCHASE))
    # Marked within the rows of an id, so that the extract is read and dealt once. A missing id matches no other row: it is kept.
    marked = o.withColumn("_offends", F.max(bad).over(Window.partitionBy(key)))
    kept = marked.where(F.col(key).isNull() | ~F.col("_offends")).drop("_offends")
    return Staged(derive_order_fields(kept), union_rejects([rej_null, rej_bad]))


@dataclass
class StagedItems:
    kept: DataFrame
    rejects: DataFrame
    null_price: DataFrame  # rows the source logic silently drops (audit only)


def stage_items(
    items: DataFrame, clean_orders: DataFrame, key: str = "order_id", null_safe: bool = False, materialize: bool = False
) -> StagedItems:
    """Price routes, freight fill, orphan route and the order-field join.

    The orphan route (anti join against the cleaned orders) and the
    inheritance of order fields (left join) are one left join here: rows
    with a match are kept (fanning out like the source if an order id
    repeats), rows without one are the orphans. ``materialize`` checkpoints
    the joined rows once when both outputs are written (the ETL job), so the
    item x order join is not run twice.
    """
    priced, rej_price = route(items, F.col("price") <= 0, R_BAD_PRICE, keep_if=F.col("price") > 0)
    lost = unrouted(items, F.col("price") <= 0, F.col("price") > 0).withColumn(REJECT_REASON, F.lit(R_NULL_PRICE))
    priced = priced.withColumn("freight_value", F.coalesce(F.col("freight_value"), F.lit(0).cast("decimal(12,2)")))
    oc = clean_orders.select(F.col(key).alias("_ok"), *ORDER_COLS_FOR_ITEMS).withColumn("_matched", F.lit(True))
    cond = priced[key].eqNullSafe(oc["_ok"]) if null_safe else priced[key] == oc["_ok"]
    j = priced.join(oc, cond, "left").drop("_ok")
    if materialize:
        j = j.checkpoint(eager=True)
    orphans = j.where(F.col("_matched").isNull()).select(*priced.columns).withColumn(REJECT_REASON, F.lit(R_ORPHAN_ITEM))
    types = dict((f.name, f.dataType) for f in items.schema.fields)
    kept = (
        j.where(F.col("_matched"))
        .drop("_matched")
        .withColumns(
            {
                "gross_revenue": F.col("price"),
                "total_cost": F.col("price") + F.col("freight_value"),
                "shipping_limit_date": E.coerce_timestamp("shipping_limit_date", types.get("shipping_limit_date")),
            }
        )
    )
    return StagedItems(kept, union_rejects([rej_price, orphans]), lost)


def stage_customers(customers: DataFrame, run_date: str, key: str = "customer_id", tiebreak: Sequence[str] | None = None) -> DataFrame:
    """Normalise city (strip + Python title case) and state (strip + upper),
    keep one row per customer id, stamp the load date.

    "Keep first" is the first line of the extract where the source carries its lines' places (``row_order``, see
    ``sources.raw``). Without a file order it has no meaning, and the surviving row is
    the one with the smallest ``tiebreak`` tuple (default: all other columns).
    ``min_by`` is a partial aggregate, so a heavily duplicated id is combined
    map-side instead of landing whole in one task.
    """
    c = customers.withColumns(
        {"customer_city": E.title_case(E.strip("customer_city")), "customer_state": F.upper(E.strip("customer_state"))}
    )
    others = [x for x in c.columns if x not in (key, "row_order")]
    tb = list(tiebreak) if tiebreak else ["row_order"] if "row_order" in c.columns else others
    first = F.min_by(F.struct(*others), F.struct(*tb)).alias("_r")
    d = c.groupBy(key).agg(first).select(key, "_r.*")
    return d.withColumn("etl_load_date", F.lit(run_date).cast("date"))


def mean_price_per_product(raw_items: DataFrame, key: str = "product_id") -> DataFrame:
    """Mean item price per product over the *raw* items (rejects included)."""
    return raw_items.where(F.col(key).isNotNull()).groupBy(key).agg(F.avg("price").alias("avg_price"))


def stage_products(
    products: DataFrame,
    category_translation: DataFrame,
    raw_items: DataFrame,
    price_edges: Sequence[float] = E.PRICE_BAND_EDGES,
    weight_edges: Sequence[float] = E.WEIGHT_BAND_EDGES,
    null_safe: bool = False,
) -> DataFrame:
    """English category (NULL -> 'uncategorized', strip, '_' -> ' ', title),
    price band over the mean raw price, weight band."""
    t = category_translation.select(
        F.col("product_category_name").alias("_cat"), "product_category_name_english"
    )
    cond = (
        products["product_category_name"].eqNullSafe(t["_cat"])
        if null_safe
        else products["product_category_name"] == t["_cat"]
    )
    # The translation table has one row per category: AQE turns this into a
    # broadcast join from its measured size.
    p = products.join(t, cond, "left").drop("_cat")
    eng = F.coalesce(F.col("product_category_name_english"), F.lit(E.UNCATEGORIZED))
    p = p.withColumn("product_category_name_english", E.title_case(F.replace(E.strip(eng), F.lit("_"), F.lit(" "))))
    p = p.join(mean_price_per_product(raw_items), "product_id", "left")
    return p.withColumns(
        {
            "price_band": E.band("avg_price", price_edges, E.PRICE_BAND_LABELS),
            "weight_category": E.band(E.coerce_number("product_weight_g", "double"), weight_edges, E.WEIGHT_BAND_LABELS),
        }
    )


def stage_payments(payments: DataFrame, key: str = "order_id", seq: str = "payment_seq") -> DataFrame:
    """One row per order: total value (all-NULL -> 0), max installments,
    number of distinct types and the primary (most frequent) type.

    Mode tie-break is declared: most rows first, then earliest arrival
    ``seq``, then the type itself. Both aggregations (per (order, type), then
    per order) stream over rows dealt once by order: the few payments of an order
    seldom share a type, so combining them before a shuffle saves nothing.
    """
    per_type = payments.repartition(key).groupBy(key, "payment_type").agg(
        F.count(F.lit(1)).alias("_n"),
        F.min(seq).alias("_first"),
        F.sum("payment_value").alias("_v"),
        F.max("payment_installments").alias("_inst"),
    )
    rank_key = F.struct((-F.col("_n")).alias("n"), F.col("_first").alias("f"), F.col("payment_type").alias("t"))
    return per_type.groupBy(key).agg(
        F.coalesce(F.sum("_v"), F.lit(0).cast("decimal(12,2)")).cast("decimal(14,2)").alias("total_payment_value"),
        F.max("_inst").alias("payment_installments"),
        F.count("payment_type").alias("payment_types_used"),
        F.min_by(F.col("payment_type"), F.when(F.col("payment_type").isNotNull(), rank_key)).alias("primary_payment_type"),
    )
