"""G1: distributed row number / rank / ntile / running sum equal the plain window."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from starmart.operators.ranking import global_scan, with_ntile, with_rank


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        hot = i % 3 == 0  # a third of the rows share one value and one partition
        v = 100 if hot else rnd.randint(0, 400)
        cat = "hot" if hot or rnd.random() < 0.2 else rnd.choice("abcdef")
        rows.append((i, cat, v, rnd.randint(1, 9)))
    return spark.createDataFrame(rows, "k long, cat string, v int, amt int")


def _pairs(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_row_number_and_running_sum_global(skewed):
    w = Window.orderBy(F.desc("v"), "k")
    want = skewed.select("k", F.row_number().over(w).alias("rn"), F.sum("amt").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cs"))
    got = global_scan(skewed, [("v", False), ("k", True)], row_number="rn", running_sums={"cs": F.col("amt")}, num_chunks=7)
    assert _pairs(got, "k", "rn", "cs") == _pairs(want, "k", "rn", "cs")


def test_partitioned_scan_hot_partition(skewed):
    w = Window.partitionBy("cat").orderBy("v", "k")
    want = skewed.select(
        "k",
        F.row_number().over(w).alias("rn"),
        F.sum("amt").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cs"),
        F.sum("amt").over(Window.partitionBy("cat")).alias("tot"),
        F.count("*").over(Window.partitionBy("cat")).alias("n"),
    )
    got = global_scan(
        skewed, [("v", True), ("k", True)], ["cat"], row_number="rn", running_sums={"cs": F.col("amt")},
        partition_count="n", partition_sums={"tot": F.col("amt")}, num_chunks=6,
    )
    assert _pairs(got, "k", "rn", "cs", "tot", "n") == _pairs(want, "k", "rn", "cs", "tot", "n")


def test_rank_of_one_value_over_many_chunks(spark, capfd):
    rows = [(i, 5 if 100 <= i < 900 else i) for i in range(1000)]  # one value spans most chunks
    df = spark.createDataFrame(rows, "k long, v int")
    got = global_scan(df, [("v", False), ("k", True)], row_number=None, rank="r", dense_rank="d", rank_cols=1, num_chunks=200)
    w = Window.orderBy(F.desc("v"))
    want = df.select("k", F.rank().over(w).alias("r"), F.dense_rank().over(w).alias("d"))
    assert _pairs(got, "k", "r", "d") == _pairs(want, "k", "r", "d")
    got.explain()
    assert capfd.readouterr().out.count("Join") <= 2  # rows with the chunk summary, no summary with itself


@pytest.mark.parametrize("dense,chunks", [(False, 5), (True, 5), (False, 23), (True, 23)])
def test_rank_with_heavy_ties(skewed, dense, chunks):
    fn = F.dense_rank if dense else F.rank
    want = skewed.select("k", fn().over(Window.partitionBy("cat").orderBy(F.desc("v"))).alias("r"))
    got = with_rank(skewed, [("v", False)], "r", ["cat"], dense=dense, num_chunks=chunks)
    assert _pairs(got, "k", "r") == _pairs(want, "k", "r")
    want_g = skewed.select("k", fn().over(Window.orderBy("v")).alias("r"))
    got_g = with_rank(skewed, [("v", True)], "r", dense=dense, num_chunks=chunks)
    assert _pairs(got_g, "k", "r") == _pairs(want_g, "k", "r")


@pytest.mark.parametrize("k", [4, 5, 7])
def test_ntile(skewed, k):
    want = skewed.select("k", F.ntile(k).over(Window.orderBy("v", "k")).alias("t"))
    got = with_ntile(skewed, k, [("v", True), ("k", True)], "t", num_chunks=9)
    assert _pairs(got, "k", "t") == _pairs(want, "k", "t")


def test_ntile_fewer_rows_than_tiles(spark):
    df = spark.createDataFrame([(i,) for i in range(3)], "k long")
    got = with_ntile(df, 5, [("k", True)], "t", num_chunks=2)
    assert _pairs(got, "k", "t") == [(0, 1), (1, 2), (2, 3)]


def test_combined_scan_rank_rownumber_running_sum(skewed):
    w = Window.partitionBy("cat").orderBy(F.desc("v"), "k")
    want = skewed.select(
        "k", F.row_number().over(w).alias("rn"), F.rank().over(Window.partitionBy("cat").orderBy(F.desc("v"))).alias("r"),
        F.dense_rank().over(Window.partitionBy("cat").orderBy(F.desc("v"))).alias("d"),
        F.sum("amt").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cs"),
    )
    got = global_scan(skewed, [("v", False), ("k", True)], ["cat"], row_number="rn", running_sums={"cs": F.col("amt")},
                      rank="r", dense_rank="d", rank_cols=1, num_chunks=17)
    assert _pairs(got, "k", "rn", "r", "d", "cs") == _pairs(want, "k", "rn", "r", "d", "cs")


def test_aqe_sized_chunks(spark, skewed):
    """Default chunking: AQE merges adjacent ranges; numbering must still be exact."""
    conf = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2kb",
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1b"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        w = Window.orderBy(F.desc("v"), "k")
        want = skewed.select("k", F.row_number().over(w).alias("rn"), F.rank().over(Window.orderBy(F.desc("v"))).alias("r"),
                             F.sum("amt").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cs"))
        got = global_scan(skewed, [("v", False), ("k", True)], row_number="rn", running_sums={"cs": F.col("amt")},
                          rank="r", rank_cols=1)
        assert _pairs(got, "k", "rn", "r", "cs") == _pairs(want, "k", "rn", "r", "cs")
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_null_partition_and_null_values(spark):
    rows = [(i, None if i % 4 == 0 else "x", None if i % 5 == 0 else i % 3, 1) for i in range(40)]
    df = spark.createDataFrame(rows, "k long, cat string, v int, amt int")
    w = Window.partitionBy("cat").orderBy(F.asc_nulls_first("v"), "k")
    wv = Window.partitionBy("cat").orderBy(F.asc_nulls_first("v"))
    want = df.select("k", F.row_number().over(w).alias("rn"), F.rank().over(wv).alias("r"), F.dense_rank().over(wv).alias("d"))
    got = global_scan(df, [("v", True), ("k", True)], ["cat"], row_number="rn", rank="r", dense_rank="d", rank_cols=1, num_chunks=4)
    assert _pairs(got, "k", "rn", "r", "d") == _pairs(want, "k", "rn", "r", "d")


@pytest.mark.parametrize("chunks", [None, 1, 7])
def test_row_number_only_path(spark, skewed, chunks):
    """Row numbers without a window (sorted chunks), incl. AQE-sized chunks."""
    conf = {"spark.sql.shuffle.partitions": "30", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2kb",
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1b"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        want = skewed.select("k", F.row_number().over(Window.orderBy(F.desc("v"), "k")).alias("rn"),
                             F.ntile(6).over(Window.orderBy(F.desc("v"), "k")).alias("t"))
        got = global_scan(skewed, [("v", False), ("k", True)], row_number="rn", num_chunks=chunks)
        assert _pairs(got, "k", "rn") == _pairs(want, "k", "rn")
        got_t = with_ntile(skewed, 6, [("v", False), ("k", True)], "t", num_chunks=chunks)
        assert _pairs(got_t, "k", "t") == _pairs(want, "k", "t")
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
