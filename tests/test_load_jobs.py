"""The load jobs keep what they have: storage errors, failed runs, members that leave, repeated runs."""

import glob
import os

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from starmart.plans import etl as ETL
from starmart.plans.star import FIXTURE_PARAMS as P
from starmart.plans.star import stage_all
from starmart.sources import fixtures as FX
from starmart.sources.io import read_if_exists


def test_only_a_missing_path_is_a_missing_table(spark, tmp_path):
    assert read_if_exists(spark, str(tmp_path / "none")) is None
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "part-0.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception, match="(?i)parquet|footer"):
        read_if_exists(spark, str(tmp_path / "t")).count()


def test_failed_lines_are_tried_again(spark, tmp_path):
    """An order with one line of an unknown product: its other line loads at once, that one after the product arrives."""
    base = str(tmp_path / "wh")
    src = FX.sources(spark, SF_SMALL)
    stg = stage_all(src, P)
    dims = ETL.load_dimensions(spark, src, stg, P, base, "1")
    half = dict(dims, dim_product=dims["dim_product"].where(F.col("product_key") > 20))
    first = ETL.load_fact(spark, stg, half, base, "2002-01-01", 7)
    assert first["failures"] > 0
    second = ETL.load_fact(spark, stg, dims, base, "2002-01-01", 8)
    assert (second["mode"], second["rows"], second["failures"]) == ("INCREMENTAL", first["failures"], 0)
    assert second["watermark"] == first["watermark"]
    third = ETL.load_fact(spark, stg, dims, base, "2002-01-01", 9)
    assert third["rows"] == 0
    fact = ETL.read_table(spark, base, "fact_sales")
    plan = ETL.batch_days(fact, fact.where(F.col("date_key") < 19960101))._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(fact_year" in plan or "PartitionFilters: [fact_year" in plan


def test_empty_loads(spark, tmp_path):
    """A fact without rows and a run without failures are empty tables, not storage errors."""
    base = str(tmp_path / "wh")
    src = FX.sources(spark, SF_SMALL)
    none = stage_all(dict(src, orders=src["orders"].where(F.lit(False))), P)
    stg = stage_all(src, P)
    dims = ETL.load_dimensions(spark, src, stg, P, base, "1")
    assert ETL.load_fact(spark, none, dims, base, "2002-01-01", 7)["rows"] == 0
    full = ETL.load_fact(spark, stg, dims, base, "2002-01-01", 8)
    assert full["mode"] == "FULL" and full["rows"] > 0
    assert ETL.load_fact(spark, stg, dims, base, "2002-01-01", 9)["rows"] == 0


def test_load_jobs(spark, tmp_path):
    base = str(tmp_path / "wh")
    src = FX.sources(spark, SF_SMALL)
    stg = stage_all(src, P)
    dims = ETL.load_dimensions(spark, src, stg, P, base, "1")
    first = ETL.load_fact(spark, stg, dims, base, "2002-01-01", 7)
    assert first["mode"] == "FULL" and first["rows"] > 0
    again = ETL.load_fact(spark, stg, dims, base, "2002-01-01", 8)
    assert again["mode"] == "INCREMENTAL" and again["rows"] == 0
    fact = ETL.read_table(spark, base, "fact_sales")
    assert fact.count() == first["rows"]

    # rows lie in date order within each file
    for f in glob.glob(f"{base}/fact_sales/load=*/fact_year=*/*.parquet"):
        days = [r.date_key for r in spark.read.parquet(f).coalesce(1).select("date_key").collect()]
        assert days == sorted(days)

    # a member leaves, another arrives: no key changes hands
    gone = src["sellers"].agg(F.max("seller_id")).first()[0]
    later = dict(src, sellers=src["sellers"].where(F.col("seller_id") != gone).unionByName(src["sellers"].limit(1).withColumn("seller_id", F.lit(gone + 1).cast(src["sellers"].schema["seller_id"].dataType))))
    new = ETL.load_dimensions(spark, later, stg, P, base, "2", first_log_id=20)["dim_seller"]
    old = {r.seller_id: r.seller_key for r in dims["dim_seller"].collect()}
    now = {r.seller_id: r.seller_key for r in new.collect()}
    assert all(now[k] == v for k, v in old.items()) and now[gone + 1] not in old.values()

    # a storage error ends the run, is logged, and leaves the files as they are
    files = sorted(glob.glob(f"{base}/fact_sales/**/*.parquet", recursive=True))
    kept = {f: open(f, "rb").read() for f in files}
    for f in files:
        os.chmod(f, 0o644)
        open(f, "wb").write(b"broken")
    for f in glob.glob(f"{base}/fact_sales/**/.*.crc", recursive=True):
        os.unlink(f)
    with pytest.raises(Exception):
        ETL.load_fact(spark, stg, dims, base, "2002-01-01", 9)
    assert sorted(glob.glob(f"{base}/fact_sales/**/*.parquet", recursive=True)) == files
    log = {r.log_id: r for r in ETL.read_table(spark, base, "etl_control_log").collect()}
    assert log[9].status == "FAILED" and log[9].error_message and log[7].status == "SUCCESS"
    for f, content in kept.items():
        open(f, "wb").write(content)
    assert ETL.load_fact(spark, stg, dims, base, "2002-01-01", 10)["rows"] == 0
