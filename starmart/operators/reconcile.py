"""F8/D6: a load is checked by digests of its days, not by counts of the whole.

A day's digest is the number of its lines, their money and the sum of the lines' hashes: it doesn't depend on the
order or partitioning of the lines, and a line that is lost, doubled or changed shows in it. Both sides
are reduced to one row a day before they meet.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import cents


def digest(lines: DataFrame, number: str, price: str) -> DataFrame:
    """date_key, lines, revenue_cents, freight_cents, hash for each day (a NULL day is one) of staged or fact lines."""
    money = [cents(price).cast("long"), cents("freight_value").cast("long")]
    own = F.xxhash64(F.col("order_id").cast("string"), F.col(number).cast("long"), *money).cast("decimal(20,0)")
    return lines.groupBy("date_key").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(money[0]).alias("revenue_cents"), F.sum(money[1]).alias("freight_cents"), F.sum(own).alias("hash")
    )


def without(lines: DataFrame, waiting: DataFrame, key: Sequence[str]) -> DataFrame:
    """The lines that don't wait in the failure queue (keys are compared null-safely)."""
    w = waiting.select(*[F.col(c).alias(f"_{c}") for c in key]).distinct()
    cond = F.lit(True)
    for c in key:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return lines.join(w, cond, "left_anti")


def compare(source: DataFrame, fact: DataFrame) -> DataFrame:
    """Days whose digests differ: date_key, source_lines, fact_lines, missing_revenue (what the fact lacks), in money units."""
    s = source.select(F.col("date_key").alias("_s"), *[F.col(c).alias(f"s_{c}") for c in ("lines", "revenue_cents", "freight_cents", "hash")])
    f = fact.select(F.col("date_key").alias("_f"), *[F.col(c).alias(f"f_{c}") for c in ("lines", "revenue_cents", "freight_cents", "hash")])
    both = s.join(f, F.col("_s").eqNullSafe(F.col("_f")), "full")
    same = F.lit(True)
    for c in ("lines", "revenue_cents", "freight_cents", "hash"):
        same = same & F.col(f"s_{c}").eqNullSafe(F.col(f"f_{c}"))
    zero = F.lit(0).cast("long")
    lacking = F.coalesce("s_revenue_cents", zero) - F.coalesce("f_revenue_cents", zero)
    return both.where(~same).select(
        F.coalesce("_s", "_f").alias("date_key"), F.coalesce("s_lines", zero).alias("source_lines"), F.coalesce("f_lines", zero).alias("fact_lines"),
        (lacking / F.lit(100)).cast("decimal(18,2)").alias("missing_revenue"),
    )
