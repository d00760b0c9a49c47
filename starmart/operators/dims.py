"""Dimensions: calendar, surrogate keys, full-reload dims and SCD type 2."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import expr as E
from .ranking import with_row_number


def keep_absent(new: DataFrame, previous: DataFrame | None, key: str) -> DataFrame:
    """Rows whose surrogate key is not in the new load stay in the dimension: members that left the feed, and older keys of an
    id that was once loaded twice. No key is ever given to others, and none that the fact uses disappears."""
    if previous is None:
        return new
    return new.unionByName(previous.join(new.select(key), key, "left_anti").select(*new.columns))


def one_per_id(feed: DataFrame, id_col: str) -> DataFrame:
    """One row for each id (a NULL id is one value): of several the one that sorts first by the other columns."""
    others = [c for c in feed.columns if c != id_col]
    if not others:
        return feed.distinct()
    kept = feed.groupBy(id_col).agg(F.min(F.struct(*others)).alias("_r"))
    return kept.select(id_col, "_r.*").select(*feed.columns)


def repeated_ids(feed: DataFrame, id_col: str) -> DataFrame:
    """member (as text), rows: ids that a feed holds more than once."""
    n = feed.groupBy(id_col).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    return n.select(F.col(id_col).cast("string").alias("member"), "rows")


def calendar_span(dates: DataFrame, column: str) -> DataFrame:
    """One row: first day of the first year and last day of the last year of ``column``."""
    y = F.year(column)
    return dates.agg(F.min(y).alias("_a"), F.max(y).alias("_b")).select(
        F.make_date("_a", F.lit(1), F.lit(1)).alias("start"), F.make_date("_b", F.lit(12), F.lit(31)).alias("end")
    )


def build_dim_date(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Calendar ``start..end``; see ``calendar``."""
    return calendar(spark.range(1).select(F.lit(start).cast("date").alias("start"), F.lit(end).cast("date").alias("end")))


def calendar(span: DataFrame) -> DataFrame:
    """Daily calendar of a one-row (start, end) frame with 16 attributes (key YYYYMMDD, %W week,
    ISO weekday 1=Mon, weekend = Sat/Sun, month start/end, 'yyyy-MM')."""
    d = span.select(F.explode(F.sequence("start", "end", F.expr("interval 1 day"))).alias("full_date"))
    dow = F.weekday("full_date") + 1
    return d.select(
        E.date_key("full_date").alias("date_key"),
        "full_date",
        F.year("full_date").alias("year"),
        F.quarter("full_date").alias("quarter"),
        F.concat(F.lit("Q"), F.quarter("full_date")).alias("quarter_name"),
        F.month("full_date").alias("month_num"),
        F.date_format("full_date", "MMMM").alias("month_name"),
        F.date_format("full_date", "MMM").alias("month_short"),
        E.week_of_year_monday("full_date").alias("week_of_year"),
        F.dayofmonth("full_date").alias("day_of_month"),
        dow.alias("day_of_week"),
        F.date_format("full_date", "EEEE").alias("day_name"),
        (dow >= 6).alias("is_weekend"),
        (F.dayofmonth("full_date") == 1).alias("is_month_start"),
        (F.col("full_date") == F.last_day("full_date")).alias("is_month_end"),
        F.date_format("full_date", "yyyy-MM").alias("year_month"),
    )


def assign_keys(
    incoming: DataFrame,
    id_col: str,
    key_col: str,
    existing: DataFrame | None = None,
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """Stable surrogate keys.

    Members already in ``existing`` (columns ``id_col``, ``key_col``) keep
    their key; new members are numbered ``max(existing key) + 1, ...`` in
    ``order_by`` (default: the business key) order. The numbering is a
    distributed global row number, not a single-partition window.
    """
    order = [(c, True) for c in (order_by or [id_col])]
    if existing is None:
        return with_row_number(incoming, order, key_col).withColumn(key_col, F.col(key_col).cast("long"))
    ex = existing.groupBy(F.col(id_col).alias("_id")).agg(F.max(key_col).alias("_key"))  # an id held twice: its latest key
    j = incoming.join(ex, incoming[id_col] == ex["_id"], "left").drop("_id")
    old = j.where(F.col("_key").isNotNull()).withColumnRenamed("_key", key_col)
    new = j.where(F.col("_key").isNull()).drop("_key")
    base = existing.agg(F.coalesce(F.max(key_col), F.lit(0)).alias("_base"))
    new = with_row_number(new, order, "_nrn").crossJoin(F.broadcast(base))  # one row
    new = new.withColumn(key_col, (F.col("_base") + F.col("_nrn")).cast("long")).drop("_nrn", "_base")
    return old.unionByName(new)


def build_dim_seller(sellers: DataFrame, run_date: str, existing: DataFrame | None = None) -> DataFrame:
    s = sellers.select(
        "seller_id",
        E.title_case(E.strip("seller_city")).alias("seller_city"),
        F.upper(E.strip("seller_state")).alias("seller_state"),
        F.col("seller_zip_code_prefix").cast("string").alias("seller_zip_prefix"),
        F.lit(run_date).cast("date").alias("etl_load_date"),
    )
    s = assign_keys(one_per_id(s, "seller_id"), "seller_id", "seller_key", existing)
    return s.select("seller_key", "seller_id", "seller_city", "seller_state", "seller_zip_prefix", "etl_load_date")


def build_dim_product(stg_products: DataFrame, run_date: str, existing: DataFrame | None = None) -> DataFrame:
    p = stg_products.select(
        "product_id",
        F.col("product_category_name_english").alias("product_category"),
        "price_band",
        "weight_category",
        *[E.coerce_number(c, "decimal(10,2)").alias(c) for c in ("product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")],
        F.lit(run_date).cast("date").alias("etl_load_date"),
    )
    p = assign_keys(one_per_id(p, "product_id"), "product_id", "product_key", existing)
    return p.select(
        "product_key",
        "product_id",
        "product_category",
        "price_band",
        "weight_category",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
        "etl_load_date",
    )


DIM_CUSTOMER_COLS = (
    "customer_key",
    "customer_id",
    "customer_unique_id",
    "customer_city",
    "customer_state",
    "customer_zip_prefix",
    "effective_start_date",
    "effective_end_date",
    "is_current",
    "record_version",
    "etl_load_date",
)


@dataclass
class Scd2Result:
    dim: DataFrame  # the new snapshot (all versions)
    actions: DataFrame  # one row per incoming member: id, action in (new, updated, unchanged)


def empty_dim_customer(spark: SparkSession, id_type: str = "bigint") -> DataFrame:
    """The customer dimension before its first load; ``id_type`` is the feed's."""
    schema = (
        f"customer_key long, customer_id {id_type}, customer_unique_id string, customer_city string, "
        "customer_state string, customer_zip_prefix string, effective_start_date date, "
        "effective_end_date date, is_current boolean, record_version int, etl_load_date date"
    )
    return spark.createDataFrame([], schema)


def scd2_merge(
    dim: DataFrame,
    incoming: DataFrame,
    run_date: str,
    key: str = "customer_id",
    tracked: Sequence[str] = ("customer_city", "customer_state"),
    surrogate: str = "customer_key",
) -> Scd2Result:
    """Type-2 merge of a staged customer feed into the dimension snapshot.

    * id without a current row        -> insert version 1 (start = run_date)
    * a tracked attribute differs      -> expire the current row (end =
      run_date, is_current = false) and insert version max+1
    * otherwise                        -> unchanged
    Untracked attributes (zip, unique id) never create versions; ids absent
    from the feed stay current. The comparison is NULL-safe, so a NULL city
    does not "change" on every run.

    One left join of the feed against the current rows decides every action;
    the new snapshot is history + expired rows + new versions. Nothing is
    updated in place: the caller writes the result as a new snapshot.
    """
    rd = F.lit(run_date).cast("date")
    cur = dim.where(F.col("is_current")).select(
        F.col(key).alias("_cid"),
        F.col(surrogate).alias("_ckey"),
        F.col("record_version").alias("_cver"),
        *[F.col(t).alias(f"_old_{t}") for t in tracked],
    )
    feed = incoming.select(
        key,
        F.col("customer_unique_id").cast("string").alias("customer_unique_id"),
        *tracked,
        F.col("customer_zip_code_prefix").cast("string").alias("customer_zip_prefix")
        if "customer_zip_code_prefix" in incoming.columns
        else F.col("customer_zip_prefix").cast("string"),
    )
    cmp = feed.join(cur, feed[key] == cur["_cid"], "left")
    changed = None
    for t in tracked:
        c = ~F.col(t).eqNullSafe(F.col(f"_old_{t}"))
        changed = c if changed is None else changed | c
    action = F.when(F.col("_ckey").isNull(), "new").when(changed, "updated").otherwise("unchanged")
    # Read three times below (expiries, inserts, action counts): compute the
    # feed x current comparison once.
    cmp = cmp.withColumn("action", action).checkpoint(eager=True)

    expired_keys = cmp.where(F.col("action") == "updated").select(F.col("_ckey").alias("_xkey"), F.lit(True).alias("_x"))
    kept = dim.join(expired_keys, dim[surrogate] == expired_keys["_xkey"], "left").drop("_xkey")
    kept = kept.withColumns(
        {
            "effective_end_date": F.when(F.col("_x"), rd).otherwise(F.col("effective_end_date")),
            "is_current": F.when(F.col("_x"), F.lit(False)).otherwise(F.col("is_current")),
        }
    ).drop("_x")

    inserts = cmp.where(F.col("action") != "unchanged").select(
        key,
        "customer_unique_id",
        *tracked,
        "customer_zip_prefix",
        rd.alias("effective_start_date"),
        F.lit(None).cast("date").alias("effective_end_date"),
        F.lit(True).alias("is_current"),
        F.coalesce(F.col("_cver") + 1, F.lit(1)).cast("int").alias("record_version"),
        rd.alias("etl_load_date"),
    )
    base = dim.agg(F.coalesce(F.max(surrogate), F.lit(0)).cast("long").alias("_base"))
    inserts = with_row_number(inserts, [(key, True)], "_nrn").crossJoin(F.broadcast(base))  # base: one row
    inserts = inserts.withColumn(surrogate, (F.col("_base") + F.col("_nrn")).cast("long")).drop("_nrn", "_base")
    out = kept.select(*DIM_CUSTOMER_COLS).unionByName(inserts.select(*DIM_CUSTOMER_COLS))
    return Scd2Result(out, cmp.select(key, "action"))


def scd2_action_counts(actions: DataFrame) -> DataFrame:
    return actions.groupBy("action").agg(F.count(F.lit(1)).alias("customers"))
