"""Exact histogram of encoded lengths, and what it answers.

Each document is reduced to its number of token ids where it is read; rows of
equal length are summed before and after one small shuffle. Suffix sums over
the distinct lengths then hold, for every length L: documents and tokens of at
least that length, and the tokens left when every document is cut to L. Totals,
quantiles and truncated totals for any context limit are lookups.

The suffix sums take two levels: sums within ranges of ``RANGE`` lengths, and the
few range totals added up over all ranges (their number is the longest document's length
/ ``RANGE``), so no task needs all lengths in a row.

Defined results: a null or empty text has length 0. Repeated documents count
each. An empty table gives an empty histogram. Ids and further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starmart.llm import encode
from starmart.llm.common import keep, mapped

RANGE = 4096


def encoded_lengths(documents: DataFrame, text_col: str = "text", path: str | None = None) -> DataFrame:
    """Column ``length``: ids of each document's whole text."""
    path = path or encode.vocabulary()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(encode.lengths(batch[text_col], path), pa.int64())], names=["length"])

    return mapped(documents.select(text_col), task, "length long")


def histogram(lengths: DataFrame) -> DataFrame:
    """length, docs, tokens, docs_ge, tokens_ge, docs_le, truncated_tokens for each distinct length.

    ``truncated_tokens``: total when every document is cut to ``length`` tokens;
    ``docs_le`` / the number of documents is the length's quantile.
    """
    # kept, since the ranges' totals and the sums inside them both read it: texts are encoded once
    h = lengths.groupBy("length").agg(F.count(F.lit(1)).alias("docs")).withColumn("tokens", F.col("length") * F.col("docs")).withColumn("r", F.floor(F.col("length") / RANGE))
    h = keep(lengths.sparkSession, h, "lengths")
    ranges = h.groupBy("r").agg(F.sum("docs").alias("rd"), F.sum("tokens").alias("rt"))
    later = W.orderBy(F.desc("r")).rowsBetween(W.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    ranges = ranges.select("r", F.coalesce(F.sum("rd").over(later), zero).alias("ld"), F.coalesce(F.sum("rt").over(later), zero).alias("lt"), F.sum("rd").over(W.partitionBy()).alias("nd"), F.sum("rt").over(W.partitionBy()).alias("nt"))
    inside = W.partitionBy("r").orderBy(F.desc("length")).rowsBetween(W.unboundedPreceding, 0)
    s = h.join(ranges, "r").withColumns({"docs_ge": F.sum("docs").over(inside) + F.col("ld"), "tokens_ge": F.sum("tokens").over(inside) + F.col("lt")})
    return s.select(
        "length", "docs", "tokens", "docs_ge", "tokens_ge",
        (F.col("nd") - F.col("docs_ge") + F.col("docs")).alias("docs_le"),
        (F.col("nt") - F.col("tokens_ge") + F.col("length") * F.col("docs_ge")).alias("truncated_tokens"),
    )


def at_limits(hist: DataFrame, limits: list[int]) -> DataFrame:
    """For each context limit: limit, docs_ge (documents of at least that length), total_tokens and
    truncated_tokens. The first length not below the limit carries the sums; no length is added up again."""
    rows = hist.withColumn("limit", F.explode(F.array(*[F.lit(int(x)).cast("long") for x in sorted(set(limits))])))
    sums = F.struct("docs_ge", "tokens_ge")
    found = rows.groupBy("limit").agg(F.min_by(F.when(F.col("length") >= F.col("limit"), sums), F.when(F.col("length") >= F.col("limit"), F.col("length"))).alias("s"), F.max("tokens_ge").alias("total_tokens"))
    ge, tge = (F.coalesce(F.col(f"s.{c}"), F.lit(0).cast("long")) for c in ("docs_ge", "tokens_ge"))
    return found.select("limit", ge.alias("docs_ge"), "total_tokens", (F.col("total_tokens") - tge + F.col("limit") * ge).alias("truncated_tokens"))


def quantiles(hist: DataFrame, qs: list[float]) -> DataFrame:
    """q, length: the smallest length that at least the share q of the documents doesn't exceed."""
    n = hist.agg(F.max("docs_le").alias("n"))
    rows = hist.crossJoin(F.broadcast(n)).withColumn("q", F.explode(F.array(*[F.lit(float(q)) for q in qs])))
    return rows.where(F.col("docs_le") >= F.col("q") * F.col("n")).groupBy("q").agg(F.min("length").alias("length"))


def report(documents: DataFrame, path: str | None = None) -> DataFrame:
    return histogram(encoded_lengths(documents, path=path))
