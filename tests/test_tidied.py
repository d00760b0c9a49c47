"""What a job leaves on disk: its tables. Shuffle files go with their query, stored frames with their job."""

import glob
import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from starmart.plans import etl as ETL
from starmart.plans import registry_more as RM
from starmart.plans.star import FIXTURE_PARAMS as P
from starmart.plans.star import build_dims, stage_all
from starmart.session import FREE_SHUFFLES, stored, tidied
from starmart.streaming.feeds import FeedLoader, tagged


def shuffle_files(spark):
    dirs = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString()
    return {f for d in dirs for f in glob.glob(f"{d}/**/shuffle_*", recursive=True)}


def stored_frames(spark):
    return set(glob.glob(f"{spark.sparkContext.getCheckpointDir().removeprefix('file:')}/stored-*"))


def kept(spark, before):
    """What is there beyond ``before``; files may go a moment after their query."""
    for _ in range(50):
        now = (shuffle_files(spark) - before[0], stored_frames(spark) - before[1])
        if not any(now):
            break
        time.sleep(0.2)
    return now


def on_disk(spark):
    return shuffle_files(spark), stored_frames(spark)


def source(spark):
    """Orders 1 to 20 with two lines and one payment each, of five customers, four products and three sellers."""
    n = spark.range(1, 21)
    day = F.make_timestamp_ntz(F.lit(2000), F.lit(1), F.col("id").cast("int"), F.lit(0), F.lit(0), F.lit(0))
    orders = n.select(
        F.col("id").alias("order_id"), (F.col("id") % 5).alias("customer_id"), F.lit("delivered").alias("order_status"), day.alias("order_purchase_timestamp"),
        day.alias("order_approved_at"), day.alias("order_delivered_carrier_date"), day.alias("order_delivered_customer_date"), day.alias("order_estimated_delivery_date"),
    )
    lines = n.crossJoin(spark.range(1, 3).select(F.col("id").cast("int").alias("order_item_id")))
    items = lines.select(
        F.col("id").alias("order_id"), "order_item_id", (F.col("id") % 4).alias("product_id"), (F.col("id") % 3).alias("seller_id"), day.alias("shipping_limit_date"),
        F.lit(5).cast("decimal(12,2)").alias("price"), F.lit(1).cast("decimal(12,2)").alias("freight_value"),
    )
    payments = n.select(F.col("id").alias("order_id"), F.lit("card").alias("payment_type"), F.lit(1).alias("payment_installments"), F.lit(12).cast("decimal(12,2)").alias("payment_value"), F.lit(1).alias("payment_seq"))
    return {
        "orders": orders, "items": items, "payments": payments,
        "customers": spark.range(5).select(F.col("id").alias("customer_id"), F.lit("u").alias("customer_unique_id"), F.lit("a town").alias("customer_city"), F.lit("st").alias("customer_state"), F.lit("1").alias("customer_zip_code_prefix")),
        "products": spark.range(4).select(F.col("id").alias("product_id"), F.lit("tools").alias("product_category_name"), *[F.lit("3").alias(f"product_{c}") for c in ("weight_g", "length_cm", "height_cm", "width_cm")]),
        "sellers": spark.range(3).select(F.col("id").alias("seller_id"), F.lit("a town").alias("seller_city"), F.lit("st").alias("seller_state"), F.lit("1").alias("seller_zip_code_prefix")),
        "category_translation": spark.createDataFrame([("tools", "tools")], "product_category_name string, product_category_name_english string"),
    }


def test_a_query_of_a_job_leaves_no_shuffle_files(spark, tmp_path):
    before, was = on_disk(spark), spark.conf.get(FREE_SHUFFLES)
    with tidied(spark):
        rows = spark.range(5000).withColumn("k", F.col("id") % 7)
        rows.repartition(4, "k").groupBy("k").count().write.parquet(str(tmp_path / "n"))
        assert not kept(spark, before)[0]
        counts = rows.groupBy("k").count()
        assert counts.count() == len(counts.collect()) == len(counts.collect()) == 7  # asked again, it is made again
    assert spark.read.parquet(str(tmp_path / "n")).agg(F.sum("count")).first()[0] == 5000
    assert spark.conf.get(FREE_SHUFFLES) == was


def test_stored_frames_go_with_the_innermost_job(spark):
    before = on_disk(spark)
    outside = stored(spark.range(3))
    with tidied(spark):
        a = stored(spark.range(4))
        with tidied(spark):
            assert stored(spark.range(5)).count() == 5
        assert a.count() == 4 and len(stored_frames(spark) - before[1]) == 2
        assert spark.conf.get(FREE_SHUFFLES) == "true"
    assert outside.count() == 3 and len(stored_frames(spark) - before[1]) == 1


def test_a_failed_job_and_jobs_side_by_side(spark):
    before, was = on_disk(spark), spark.conf.get(FREE_SHUFFLES)
    with pytest.raises(RuntimeError), tidied(spark):
        stored(spark.range(2))
        raise RuntimeError
    assert spark.conf.get(FREE_SHUFFLES) == was and not kept(spark, before)[1]
    inside, leave, seen = threading.Event(), threading.Event(), []

    def other():
        with tidied(spark):
            x = stored(spark.range(6))
            inside.set()
            leave.wait(60)
            seen.append(x.count())

    t = threading.Thread(target=other)
    with tidied(spark):
        t.start()
        assert inside.wait(60)
    assert spark.conf.get(FREE_SHUFFLES) == "true"  # the other job goes on, and keeps its frames
    leave.set()
    t.join()
    assert seen == [6] and spark.conf.get(FREE_SHUFFLES) == was and not kept(spark, before)[1]


def test_loads_leave_their_tables_alone(spark, tmp_path):
    """Two dimension loads and three of the fact, the first with a seller unknown: all lines are there, and nothing else."""
    base, src, before = str(tmp_path / "wh"), source(spark), on_disk(spark)
    stg = RM._staged(spark, src, base)
    early = ETL.load_dimensions(spark, dict(src, sellers=src["sellers"].where("seller_id > 0")), stg, P, base, "1", first_log_id=10)
    first = ETL.load_fact(spark, stg, early, base, P.run_date, 19)
    assert (first["rows"], first["failures"]) == (28, 12)
    assert not any(kept(spark, before))
    dims = ETL.load_dimensions(spark, src, stg, P, base, "2", first_log_id=20)
    assert dims["scd2_actions"].collect() == [("unchanged", 5)]
    second = ETL.load_fact(spark, stg, dims, base, P.run_date, 29)
    assert (second["mode"], second["rows"], second["failures"]) == ("INCREMENTAL", 12, 0)
    again = ETL.load_fact(spark, stg, dims, base, P.run_date, 39, full_reload=True)
    assert (again["mode"], again["rows"]) == ("FULL", 40)
    assert not kept(spark, before)[1]
    assert ETL.read_table(spark, base, "fact_sales").select("order_id", "order_item_seq").distinct().count() == 40
    assert ETL.read_table(spark, base, ETL.QUEUE).where("state = 'loaded'").count() == 12


def test_a_feed_leaves_its_tables_alone(spark, tmp_path):
    base, src = str(tmp_path / "wh"), source(spark)
    dims = {k: v.checkpoint(eager=True) for k, v in build_dims(spark, src, stage_all(src, P), P).items()}
    before, load = on_disk(spark), FeedLoader(base, dims, P.run_date)
    for epoch, ids in enumerate(("order_id <= 12", "order_id > 12")):
        load(tagged({k: src[k].where(ids) for k in ("orders", "items", "payments")}), epoch)
    assert not any(kept(spark, before))
    load.close(spark, 9)
    assert not kept(spark, before)[1]
    assert ETL.read_table(spark, base, "fact_sales").count() == 40


def test_tables_and_stored_frames_are_packed_well(spark, tmp_path):
    """Written with a denser codec than Spark's default."""
    base = str(tmp_path / "wh")
    path = ETL.write_snapshot(spark.range(1000), base, "t", "1", pointer=False)
    assert [f for f in os.listdir(path) if f.endswith(".zstd.parquet")]
    with tidied(spark):
        assert all(f.endswith(".zstd.parquet") for f in stored(spark.range(1000)).inputFiles())
