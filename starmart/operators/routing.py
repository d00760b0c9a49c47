"""Reject routing: split a frame into kept and rejected rows with a reason."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REJECT_REASON = "reject_reason"


def route(df: DataFrame, reject_if: Column, reason: str, keep_if: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Return ``(kept, rejected)``.

    ``rejected`` holds the rows where ``reject_if`` is true, tagged with
    ``reject_reason``. ``kept`` holds the rows where ``keep_if`` is true, or,
    when ``keep_if`` is omitted, every row that is not rejected (a NULL
    predicate counts as "not rejected"). With an explicit ``keep_if`` a row
    may fall in neither side; ``unrouted`` returns those.
    """
    rej = F.coalesce(reject_if, F.lit(False))
    keep = F.coalesce(keep_if, F.lit(False)) if keep_if is not None else ~rej
    return df.where(keep), df.where(rej).withColumn(REJECT_REASON, F.lit(reason))


def unrouted(df: DataFrame, reject_if: Column, keep_if: Column) -> DataFrame:
    """Rows in neither output of ``route(df, reject_if, reason, keep_if)``."""
    return df.where(~F.coalesce(reject_if, F.lit(False)) & ~F.coalesce(keep_if, F.lit(False)))


def union_rejects(frames: Iterable[DataFrame]) -> DataFrame:
    """Union differently shaped reject sets by column name (missing -> NULL)."""
    frames = list(frames)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
