"""Property: the chunked global scan equals Spark's plain windows for random
inputs, chunk counts, tie densities and partitionings."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from starmart.operators.ranking import global_scan

rows = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 6), st.integers(-5, 9)), min_size=1, max_size=60
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(data=rows, chunks=st.integers(1, 9), partitioned=st.booleans(), desc=st.booleans())
def test_scan_equals_plain_windows(spark, data, chunks, partitioned, desc):
    df = spark.createDataFrame([(i, c, v, a) for i, (c, v, a) in enumerate(data)], "k long, cat string, v int, amt int")
    P = ["cat"] if partitioned else []
    vcol = F.desc("v") if desc else F.asc("v")
    w = (Window.partitionBy(*P) if P else Window).orderBy(vcol, "k")
    wv = (Window.partitionBy(*P) if P else Window).orderBy(vcol)
    want = df.select(
        "k",
        F.row_number().over(w).alias("rn"),
        F.sum("amt").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cs"),
        F.rank().over(wv).alias("r"),
        F.dense_rank().over(wv).alias("d"),
    )
    got = global_scan(
        df, [("v", not desc), ("k", True)], P, row_number="rn", running_sums={"cs": F.col("amt")},
        rank="r", dense_rank="d", rank_cols=1, num_chunks=chunks,
    )
    key = ["k", "rn", "cs", "r", "d"]
    assert sorted(tuple(r) for r in got.select(*key).collect()) == sorted(tuple(r) for r in want.select(*key).collect())
