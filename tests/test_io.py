"""Sources and sinks: CSV extract with corrupt rows, NaN, reject log, run log."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from starmart import schemas
from starmart.operators import staging as S
from starmart.plans import etl as ETL
from starmart.sources import io


def test_csv_extract_and_coercion(spark):
    d = tempfile.mkdtemp(prefix="starmart-csv-")
    p = os.path.join(d, "orders.csv")
    with open(p, "w") as fh:
        fh.write("order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,order_delivered_carrier_date,"
                 "order_delivered_customer_date,order_estimated_delivery_date\n")
        fh.write("a,c1,delivered,2018-01-01 10:00:00,2018-01-01 11:00:00,,2018-01-03 10:00:00,2018-01-10 00:00:00\n")
        fh.write("b,c2,shipped,31/12/2018,,,,2018-01-10 00:00:00\n")
    df = io.read_csv_extract(spark, p, schemas.RAW_ORDERS_CSV)
    st = S.stage_orders(df.drop(io.CORRUPT))
    assert [r.order_id for r in st.kept.collect()] == ["a"]
    assert [(r.order_id, r.reject_reason) for r in st.rejects.collect()] == [("b", S.R_NULL_PURCHASE)]


def test_nan_to_null(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),)], "x double")
    assert [r.x for r in io.nan_to_null(df).collect()] == [1.0, None]


def test_reject_sink_and_schema(spark):
    d = tempfile.mkdtemp(prefix="starmart-sink-")
    rej = spark.createDataFrame([("o1", "why")], "order_id string, reject_reason string")
    io.write_rejects(rej, d, "r1")
    io.write_rejects(rej, d, "r2")
    got = spark.read.parquet(f"{d}/reject_log")
    assert sorted(r.run_id for r in got.collect()) == ["r1", "r2"]
    paths = schemas.create_warehouse(spark, d + "/wh")
    assert spark.read.parquet(paths["fact_sales"]).schema == spark.createDataFrame([], schemas.FACT_SALES).schema


def test_run_logged(spark):
    with ETL.run_logged(spark, 1, "dim_x") as log:
        log.loaded = spark.range(5)
    r = log.row.first()
    assert (r.status, r.records_loaded, r.target_table) == ("SUCCESS", 5, "dim_x")
    with pytest.raises(ValueError):
        with ETL.run_logged(spark, 2, "dim_y") as log2:
            raise ValueError("boom")
    r2 = log2.row.first()
    assert (r2.status, r2.error_message) == ("FAILED", "boom")
    wm = ETL.last_watermark(log.row.withColumn("last_loaded_ts", F.lit("2018-01-01 00:00:00").cast("timestamp_ntz")), "dim_x")
    assert str(wm.first().watermark) == "2018-01-01 00:00:00"


def test_load_mode_and_calendar_idempotent(spark):
    empty = spark.createDataFrame([], schemas.FACT_SALES)
    assert ETL.load_mode(empty) == "FULL"
    assert ETL.load_mode(spark.range(1)) == "INCREMENTAL"
    assert ETL.load_dim_date_if_empty(spark, spark.range(1), "2020-01-01", "2020-01-31") is None
    assert ETL.load_dim_date_if_empty(spark, spark.createDataFrame([], schemas.DIM_DATE), "2020-01-01", "2020-01-31").count() == 31


def test_bucketed_star_avoids_fact_shuffle(spark):
    from pyspark.sql import functions as F

    from conftest import SF_SMALL
    from starmart.plans.star import FIXTURE_PARAMS as P
    from starmart.plans.star import star_from_fixtures

    star = star_from_fixtures(spark, SF_SMALL, P)
    d = tempfile.mkdtemp(prefix="starmart-bucket-")
    b = ETL.write_star_bucketed(spark, star, d, "t_bucket", 4)
    q = (
        b["fact_sales"].join(b["dim_customer"].where("is_current"), "customer_key")
        .groupBy("customer_key", "customer_state").agg(F.sum("gross_revenue").alias("r"))
    )
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = q._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan
    assert q.count() == star["fact_sales"].select("customer_key").distinct().count()
