"""Connected components of a large graph, as DataFrames.

Alternates the large-star and small-star steps (Kiveris et al., "Connected
Components in MapReduce and Beyond", 2014): each turns every node's
neighbourhood towards its smallest member, with one aggregation and one join, so no
neighbourhood is ever gathered in a task. Nodes with more than a thousandth of all rows, fewer than a
thousand whatever the graph's size, are joined by broadcast, so the rows of a hub stay where they
are read. Each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm.common import keep

HUBS = 1000


def hub_join(rows: DataFrame, facts: DataFrame, key: str | list[str], number: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with ``facts`` (a written table with one row a key), of which ``number`` tells the key's rows. Keys of
    over 1/``HUBS`` of all ``total`` (of all rows with a fact, or more), fewer than ``HUBS``, are broadcast; the others meet in a shuffle."""
    hub = F.col(number) * HUBS > total
    if facts.where(hub).isEmpty():
        return rows.join(facts.drop(number), key)
    hot = F.broadcast(facts.where(hub).drop(number))
    return rows.join(hot, key).unionByName(rows.join(hot, key, "left_anti").join(facts.where(~hub).drop(number), key))


def components(spark: SparkSession, edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(node, comp) for all nodes of ``edges`` (columns a, b; any orderable type): comp is the smallest node
    reached. Loops, repeated edges and rows with nulls are allowed and add nothing."""
    cur = keep(spark, edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = _digest(cur)
    for _ in range(max_rounds):
        total = 2 * before["n"]
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = keep(spark, both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("n")), "low")
        large = keep(spark, hub_join(both.where("v > u"), low, "u", "n", total).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        least = keep(spark, large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")), "least")
        # every smaller neighbour, and the node itself, now point at the smallest one
        small = hub_join(large, least, "u", "n", total).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        new = keep(spark, small, "edges")
        after = _digest(new)
        if after == before:
            return new.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(new.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())
        cur, before = new, after
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _digest(x: DataFrame) -> dict:
    """Number and hash sums of an edge set; equal for equal sets."""
    parts = [F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s"), F.bit_xor(F.hash("u", "v")).alias("x")]
    return x.agg(*parts).head().asDict()
