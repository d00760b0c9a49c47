"""Profiling and data-quality checks (Q1-Q16) as distributed aggregates.

Each check is one aggregate per table (or an anti join) and returns a small
result DataFrame; nothing that grows with the data is collected to the driver.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import expr as E
from ..functions.expr import cents
from ..functions.expr import round_half_away as rha
from .selection import select_ranks
from .staging import coerce_order_timestamps


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def shape(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Q1: rows and column count per table."""
    return _union(
        [
            df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"), "row_count", F.lit(len(df.columns)).alias("column_count")
            )
            for name, df in tables.items()
        ]
    )


def null_audit(tables: Mapping[str, DataFrame], columns: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Q2: per (table, column) NULL count and % of rows, columns with nulls only.

    One pass per table: a single ``agg`` of ``count_if(isNull)`` for every
    column, unpivoted with ``stack``.
    """
    parts = []
    for name, df in tables.items():
        cols = list((columns or {}).get(name, df.columns))
        row = df.agg(F.count(F.lit(1)).alias("_total"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
        stack = ", ".join(f"'{c}', `{c}`" for c in cols)
        long = row.selectExpr("_total", f"stack({len(cols)}, {stack}) as (column_name, null_count)")
        parts.append(
            long.where(F.col("null_count") > 0).select(
                F.lit(name).alias("table_name"),
                "column_name",
                F.col("null_count").cast("long").alias("null_count"),
                rha(F.col("null_count") * 100, F.col("_total"), 2).alias("null_pct"),
            )
        )
    return _union(parts)


def duplicate_keys(checks: Sequence[tuple[str, DataFrame, Sequence[str]]]) -> DataFrame:
    """Q3: ``rows - distinct(key)`` per table; a NULL key counts as one value.

    ``groupBy(key).count()`` combines map-side, so a heavily duplicated key
    does not put its rows in one task.
    """
    parts = []
    for name, df, keys in checks:
        g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        parts.append(
            g.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("duplicate_rows")).select(
                F.lit(name).alias("table_name"), F.lit(",".join(keys)).alias("key_columns"), "duplicate_rows"
            )
        )
    return _union(parts)


def column_types(spark: SparkSession, name: str, df: DataFrame) -> DataFrame:
    """Q4: (table, column, type) from the schema, with the values each column holds."""
    row = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f.name) for f in df.schema.fields])
    held = ", ".join(f"'{f.name}', '{f.dataType.simpleString()}', `{f.name}`" for f in df.schema.fields)
    return row.selectExpr(f"'{name}' as table_name", f"stack({len(df.schema.fields)}, {held}) as (column_name, data_type, held)")


def referential_integrity(
    checks: Sequence[tuple[str, DataFrame, str, DataFrame, str]], null_safe: bool = False
) -> DataFrame:
    """Q5: child rows whose key has no parent (``left_anti``).

    SQL semantics by default (a NULL child key is an orphan); ``null_safe``
    matches NULL to NULL like pandas ``isin``.
    """
    parts = []
    for name, child, ck, parent, pk in checks:
        p = parent.select(F.col(pk).alias("_pk")).distinct()
        cond = child[ck].eqNullSafe(p["_pk"]) if null_safe else child[ck] == p["_pk"]
        orphans = child.join(p, cond, "left_anti")
        parts.append(orphans.agg(F.count(F.lit(1)).alias("orphan_rows")).select(F.lit(name).alias("check_name"), "orphan_rows"))
    return _union(parts)


def orphan_rows(child: DataFrame, ck: str, parent: DataFrame, pk: str) -> DataFrame:
    """The orphan rows themselves (for the exception sink)."""
    p = parent.select(F.col(pk).alias("_pk")).distinct()
    return child.join(p, child[ck] == p["_pk"], "left_anti")


def date_logic(orders: DataFrame, as_of_ts: str) -> DataFrame:
    """Q6-Q9 in one pass: delivered before purchase, purchase after ``as_of``,
    unparseable / NULL purchase time, approved before purchase."""
    o = coerce_order_timestamps(orders)
    p, d, a = F.col("order_purchase_timestamp"), F.col("order_delivered_customer_date"), F.col("order_approved_at")
    return o.agg(
        F.count_if(d.isNotNull() & (d < p)).alias("invalid_delivery_dates"),
        F.count_if(p > F.lit(as_of_ts).cast("timestamp_ntz")).alias("future_orders"),
        F.count_if(p.isNull()).alias("unparseable_purchase_dates"),
        F.count_if(a.isNotNull() & (a < p)).alias("approval_before_purchase"),
    )


def value_distribution(df: DataFrame, column: str, table: str) -> DataFrame:
    """Q10: count and % of *all* rows per non-NULL value (NULLs are in the
    denominator only), descending by count."""
    total = df.agg(F.count(F.lit(1)).alias("_total"))
    g = df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("value")).agg(
        F.count(F.lit(1)).alias("value_count")
    )
    # total is one row: the cross join is a broadcast of a scalar.
    return (
        g.crossJoin(F.broadcast(total))
        .select(
            F.lit(table).alias("table_name"),
            F.lit(column).alias("column_name"),
            "value",
            "value_count",
            rha(F.col("value_count") * 100, F.col("_total"), 2).alias("value_pct"),
        )
        .orderBy(F.desc("value_count"), "value")
    )


def describe_money(df: DataFrame, column: str) -> DataFrame:
    """Q11: count, mean, sample std, min, p25, p50, p75, max, rounded to 2.

    Quartiles are exact and interpolated linearly (pandas ``describe``). The values at
    the six ranks they need come from a selection (``selection.select_ranks``): the column is counted
    in buckets a few times where it lies; nothing is sorted or shuffled by value, and no task
    holds all values (Spark's exact ``percentile`` would). Mean and std come from exact integer sums of cents.
    """
    x = df.where(F.col(column).isNotNull()).select(cents(column).cast("long").alias("c"))
    wide = F.col("c").cast("decimal(19,0)")
    f = x.agg(F.count(F.lit(1)).alias("n"), F.sum("c").alias("s1"), F.sum(wide * wide).alias("s2"), F.min("c").alias("lo"), F.max("c").alias("hi")).first()  # one row
    n, at = f["n"], {}
    places = [((n - 1) * q // 4 + 1, (n - 1) * q % 4) for q in (1, 2, 3)] if n else []
    if n:
        ranks = sorted({min(n, r + d) for r, _ in places for d in (0, 1)})
        found = select_ranks(x, {"c": F.col("c")}, None, {"c": ranks}, {"c": (f["lo"], f["hi"])}, None)["c"]
        at = {r: c for r, (c, _) in zip(ranks, found)}
    s1, s2 = int(f["s1"] or 0), int(f["s2"] or 0)
    std = math.floor(math.sqrt(float(n * s2 - s1 * s1) / float(n * (n - 1))) + 0.5) / 100.0 if n > 1 else None
    quarters = [at[r] * 4 + m * (at[min(n, r + 1)] - at[r]) for r, m in places] or [None] * 3
    kinds = "count long, s1 long, std double, lo long, hi long, q1 long, q2 long, q3 long"
    row = df.sparkSession.createDataFrame([(n, f["s1"], std, f["lo"], f["hi"], *quarters)], kinds)
    return row.select(
        F.lit(column).alias("column_name"),
        "count",
        rha(F.col("s1"), F.col("count") * 100, 2).alias("mean"),
        "std",
        (F.col("lo") / F.lit(100.0)).cast("double").alias("min"),
        *[rha(F.col(f"q{q}"), F.lit(400), 2).alias(f"p{25 * q}") for q in (1, 2, 3)],
        (F.col("hi") / F.lit(100.0)).cast("double").alias("max"),
    )


def price_checks(items: DataFrame, price: str = "price", freight: str = "freight_value", sigmas: float = 3.0) -> DataFrame:
    """Q12-Q14: zero/negative prices, zero freight, one-sided outliers above
    mean + k * sample std, max and mean price (one aggregate + one filter)."""
    stats = items.agg(F.avg(F.col(price).cast("double")).alias("_mean"), F.stddev_samp(F.col(price).cast("double")).alias("_std"))
    flagged = items.crossJoin(F.broadcast(stats))  # stats: one row
    return flagged.agg(
        F.count_if(F.col(price) <= 0).alias("zero_or_negative_price"),
        F.count_if(F.col(freight) == 0).alias("zero_freight"),
        F.count_if(F.col(price).cast("double") > F.col("_mean") + sigmas * F.col("_std")).alias("price_outliers"),
        F.max(price).cast("double").alias("max_price"),
        rha(F.sum(cents(price)), F.count(price) * 100, 2).alias("avg_price"),
    )


def outlier_rows(items: DataFrame, price: str = "price", sigmas: float = 3.0) -> DataFrame:
    """Q13 rows: items priced above mean + k * sample std."""
    stats = items.agg(F.avg(F.col(price).cast("double")).alias("_mean"), F.stddev_samp(F.col(price).cast("double")).alias("_std"))
    return (
        items.crossJoin(F.broadcast(stats))
        .where(F.col(price).cast("double") > F.col("_mean") + sigmas * F.col("_std"))
        .drop("_mean", "_std")
    )


def date_range(df: DataFrame, column: str) -> DataFrame:
    """Q15: earliest, latest and the span in whole (floored) days."""
    a = df.agg(F.min(column).alias("earliest"), F.max(column).alias("latest"))
    return a.withColumn("span_days", E.floor_days("earliest", "latest"))


def profile_summary(src: Mapping[str, DataFrame], profiled_at: str, as_of_ts: str) -> DataFrame:
    """Q16: the 12-field profiling summary row (one small job per input)."""
    o, i = src["orders"], src["items"]
    dl = date_logic(o, as_of_ts).select("invalid_delivery_dates", "future_orders")
    ri = referential_integrity(
        [("orphan_items", i, "order_id", o, "order_id"), ("orders_no_customer", o, "customer_id", src["customers"], "customer_id")]
    )
    ri_row = ri.agg(
        F.max(F.when(F.col("check_name") == "orphan_items", F.col("orphan_rows"))).alias("orphan_items"),
        F.max(F.when(F.col("check_name") == "orders_no_customer", F.col("orphan_rows"))).alias("orders_no_customer"),
    )
    pc = price_checks(i).select(F.col("zero_or_negative_price").alias("zero_price_items"), "price_outliers")
    counts = None
    for name in ("orders", "items", "customers", "products", "sellers"):
        c = src[name].agg(F.count(F.lit(1)).alias(f"{name}_rows"))
        counts = c if counts is None else counts.crossJoin(c)
    row = counts.crossJoin(dl).crossJoin(ri_row).crossJoin(pc)  # all one-row frames
    return row.select(
        F.lit(profiled_at).alias("profiled_at"),
        "orders_rows",
        "items_rows",
        "customers_rows",
        "products_rows",
        "sellers_rows",
        "invalid_delivery_dates",
        "future_orders",
        "orphan_items",
        "zero_price_items",
        "price_outliers",
        "orders_no_customer",
    )


def staging_summary(stg: Mapping[str, DataFrame], run_ts: str) -> DataFrame:
    """P29/S5: one row with the run's time, the rows of each staged table and the rejected rows."""
    row = stg["stg_orders"].sparkSession.range(1).select(F.lit(run_ts).alias("run_timestamp"))
    for name in ("stg_orders", "stg_items", "stg_customers", "stg_products", "stg_payments"):
        row = row.crossJoin(stg[name].agg(F.count(F.lit(1)).alias(f"{name}_rows")))  # one row each
    return row.crossJoin(stg["stg_rejects"].agg(F.count(F.lit(1)).alias("total_records_rejected")))
