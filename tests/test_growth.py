"""What a load shuffles and stores: lines are looked up while narrow, stay dealt by order, and are kept in columns."""

import datetime as dt
import glob
import os

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from starmart.operators import facts as FA
from starmart.operators import staging as S
from starmart.plans import cube as CU
from starmart.plans import etl as ETL
from starmart.plans import registry_more as RM
from starmart.plans.star import FIXTURE_PARAMS as P
from starmart.plans.star import PRODUCT_ATTRIBUTES, build_dims, fact_of_extract, stage_all
from starmart.plans.warehouse import Warehouse
from starmart.session import stored
from starmart.sources import fixtures as FX
from starmart.streaming.incremental import bucketed_by_order


@pytest.fixture()
def no_broadcast(spark):
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def world(spark):
    src = FX.sources(spark, SF_SMALL)
    dims = {
        "dim_customer": spark.createDataFrame([(0, 7, True)], "customer_id long, customer_key long, is_current boolean"),
        "dim_product": spark.createDataFrame([(0, 8), (0, 9)], "product_id long, product_key long"),
        "dim_seller": spark.createDataFrame([(0, 5)], "seller_id long, seller_key long"),
    }
    return src, stage_all(src, P), dims


def test_a_fact_stays_dealt_by_order(spark, no_broadcast):
    """Grouping the fact by order takes no shuffle; lines are not shuffled again after they met their order."""
    src, stg, dims = world(spark)
    fact = fact_of_extract(src, stg, dims, P).fact
    assert shuffles(fact.groupBy("order_id", "product_key").count()) == shuffles(fact.select("order_id", "product_key"))
    top = fact._jdf.queryExecution().executedPlan().toString().split("hashpartitioning(")
    assert top[1].startswith("order_id")


def test_keys_looked_up_first_give_the_same_fact(spark):
    src, stg, dims = world(spark)
    names = ("dim_customer", "dim_product", "dim_seller")
    plain = FA.build_fact(stg["stg_items"], stg["stg_orders"], stg["stg_payments"], *[dims[n] for n in names], P.run_date)
    early = fact_of_extract(src, stg, dims, P)
    show = lambda df: sorted(map(str, df.select(*sorted(df.columns)).collect()))
    assert show(early.fact) == show(plain.fact)
    assert show(early.failures) == show(plain.failures)


def test_payments_are_shuffled_once(spark, no_broadcast):
    pay = spark.createDataFrame([(1, "a", 1, 2.0, 1), (1, "b", 2, 3.0, 2)], "order_id long, payment_type string, payment_installments int, payment_value double, payment_seq int")
    pay = pay.withColumn("payment_value", F.col("payment_value").cast("decimal(12,2)"))
    assert shuffles(S.stage_payments(pay)) == 1


def test_stored_frames_are_columns(spark):
    df = stored(spark.range(9).select("id", F.lit("x").alias("text")))
    assert "FileScan parquet" in df.select("id")._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["id"] for r in df.collect()) == list(range(9))


def test_a_load_that_must_fail_assembles_nothing(spark, monkeypatch):
    src, stg, dims = world(spark)
    monkeypatch.setattr(FA, "stored", lambda df: pytest.fail("lines were assembled first"))
    with pytest.raises(ValueError, match="gross_revenue"):
        FA.build_fact(stg["stg_items"].drop("gross_revenue"), stg["stg_orders"], stg["stg_payments"], dims["dim_customer"], dims["dim_product"], dims["dim_seller"], P.run_date, materialize=True)


def test_replaced_partitions_are_written_without_a_copy(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    before = set(glob.glob(f"{spark.sparkContext.getCheckpointDir()}/*"))
    rows = spark.range(20).select("id", (F.col("id") % 3).cast("int").alias("month"))
    with wh.begin(1, "t") as tx:
        tx.replace_partitions("t", rows, "month", [0, 1, 2, 3])
    assert sorted(map(tuple, wh.read("t").collect())) == sorted((i, i % 3) for i in range(20))
    made = [f for f in set(glob.glob(f"{spark.sparkContext.getCheckpointDir()}/*")) - before]
    assert not [f for f in made for _ in glob.glob(f"{f}/**/part-*", recursive=True)]
    with pytest.raises(ValueError, match="touched"), wh.begin(2, "t") as tx:
        tx.replace_partitions("t", rows, "month", [0, 1])


def test_a_batch_meets_bucketed_lines_without_shuffling_them(spark, no_broadcast, tmp_path):
    n = os.path.basename(str(tmp_path)).replace("-", "_")
    lines = bucketed_by_order(spark.range(50).select((F.col("id") % 9).alias("order_id"), "id"), f"growth_{n}", str(tmp_path / "lines"))
    batch = spark.createDataFrame([(1,), (4,)], "order_id long")
    plan = lines.join(batch, "order_id", "left_semi")
    assert shuffles(plan) == 1  # the batch's
    assert plan.count() == 12


def test_offending_orders_take_no_second_read(spark, no_broadcast):
    """The rows of an order with one bad delivery go together; a missing id matches no other row."""
    rows = [(1, "2000-01-02", "2000-01-01"), (1, "2000-01-02", "2000-01-05"), (2, "2000-01-02", None), (None, "2000-01-02", "2000-01-01"), (None, "2000-01-02", None)]
    o = spark.createDataFrame([(i, "delivered", p, None, None, d, None) for i, p, d in rows], "order_id long, order_status string, " + ", ".join(f"{c} string" for c in S.ORDER_TS_COLS))
    o = o.withColumns({c: F.col(c).cast("timestamp_ntz") for c in S.ORDER_TS_COLS})
    done = S.stage_orders(o)
    assert sorted((r["order_id"] or 0 for r in done.kept.collect())) == [0, 0, 2]
    assert done.rejects.count() == 2
    assert shuffles(done.kept) == 1


def test_lines_carry_product_attributes_to_the_cube(spark, no_broadcast):
    """The cube of a fact that is a plan counts its lines by order without shuffling them to the products again."""
    src, stg, dims = world(spark)
    held = [(1, 10, "A", "x"), (1, 11, "B", "y"), (2, 12, "C", None)]
    dims["dim_product"] = spark.createDataFrame(held, "product_id long, product_key long, product_category string, price_band string")
    items = spark.createDataFrame([(5, 1), (5, 2), (5, 3), (6, None)], "order_id long, product_id long").withColumn("seller_id", F.lit(0).cast("long"))
    keyed = FA.with_line_keys(items, dims["dim_product"], dims["dim_seller"], PRODUCT_ATTRIBUTES)
    got = {(r["order_id"], r["product_id"]): (r["product_key"], r["product_category"], r["price_band"]) for r in keyed.collect()}
    assert got == {(5, 1): (11, "B", "y"), (5, 2): (12, "C", None), (5, 3): (None, None, None), (6, None): (None, None, None)}
    fb = fact_of_extract(src, stg, dims, P)
    assert not {*PRODUCT_ATTRIBUTES} & {*fb.fact.columns, *fb.failures.columns, *fb.assembled.columns}
    star = {"fact_products": fb.carried, "fact_sales": fb.fact, **dims}
    cells = CU.build(star, tables=["cube_products"])["cube_products"]
    assert shuffles(cells) == shuffles(fb.carried.select("order_id", "date_key", "gross_revenue", *PRODUCT_ATTRIBUTES)) + 1


def test_product_cells_of_a_written_fact(spark, no_broadcast):
    """Lines of a written fact: one shuffle to the products, one by order, one of the cells."""
    fact = spark.createDataFrame([(1, 7, 20000102, 1.0), (1, 8, 20000102, 2.0), (2, 8, 20000203, 4.0)], "order_id long, product_key long, date_key int, gross_revenue double")
    fact = fact.withColumn("gross_revenue", F.col("gross_revenue").cast("decimal(12,2)"))
    product = spark.createDataFrame([(7, "A", "x"), (8, "B", "x")], "product_key long, product_category string, price_band string")
    cells = CU.build({"fact_sales": fact, "dim_product": product}, tables=["cube_products"])["cube_products"]
    got = {(r["month"], r["part"], r["a"]): (float(r["revenue"]), r["orders"]) for r in cells.collect()}
    assert got == {
        (200001, "category", "A"): (1.0, 1), (200001, "category", "B"): (2.0, 1), (200001, "band", "x"): (3.0, 1),
        (200002, "category", "B"): (4.0, 1), (200002, "band", "x"): (4.0, 1),
    }
    assert shuffles(cells) == 4  # lines and products by product, lines by order, cells


def test_bitmaps_are_made_whole_where_their_keys_are(spark, no_broadcast):
    keys = [(200001, k, True, "S") for k in (1, 2, 2, 40000)] + [(200001, None, None, None), (200002, 1, True, "S")]
    grain = spark.createDataFrame(keys, "month int, customer_key long, known boolean, customer_state string")
    made = CU._customers(grain)
    assert shuffles(made) == 1
    n = {(r["month"], r["customer_state"], r["bucket"]): r["n"] for r in made.selectExpr("*", "bitmap_count(customers) as n").collect()}
    assert (n[200001, "S", 1], n[200001, "S", 2], n[200002, "S", 1]) == (2, 1, 1)


def test_orders_and_customers_share_one_grain(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(CU, "stored", lambda df: kept.append(df) or df)
    src, stg, dims = world(spark)
    dims["dim_customer"] = dims["dim_customer"].selectExpr("*", "'S' as customer_state", "'T' as customer_city")
    dims["dim_product"] = dims["dim_product"].selectExpr("*", "'A' as product_category", "'x' as price_band")
    star = {"fact_sales": fact_of_extract(src, stg, dims, P).fact, **dims}
    assert set(CU.build(star)) == set(CU.TABLES) and len(kept) == 1
    assert set(CU.build(star, tables=["cube_orders"])) == {"cube_orders"} and len(kept) == 1


def test_an_incremental_load_takes_the_lines_it_can_meet(spark):
    """Lines of earlier days only where an earlier order is selected: it waits, or shares its id with a new one."""
    staged = spark.createDataFrame([(i, 20000101 + i, f"2000-01-{i + 1:02d}") for i in range(9)] + [(3, 20000109, "2000-01-09")], "order_id long, date_key int, ts string")
    items = staged.select("order_id", "date_key").withColumn("order_item_id", F.lit(1))
    new = staged.where("date_key > 20000107")
    wm = dt.datetime(2000, 1, 7, 5)
    meet = lambda x, o: sorted(map(tuple, x.join(o.select("order_id"), "order_id").collect()))
    for chosen in (new, new.where("order_id <> 3"), new.unionByName(staged.where("order_id = 1"))):
        lines = ETL.lines_since(items, chosen, staged, wm)
        assert meet(lines, chosen) == meet(items, chosen)
    assert ETL.lines_since(items, new.where("order_id <> 3"), staged, wm).count() < items.count()
    most = staged.where("order_id < 6")
    assert meet(ETL.lines_since(items, most, staged, wm), most) == meet(items, most)


def test_stored_dimensions_know_their_size(spark):
    src = FX.sources(spark, SF_SMALL)
    dims = build_dims(spark, src, stage_all(src, P), P)
    for n in ("dim_seller", "dim_product", "dim_customer"):
        assert "FileScan parquet" in dims[n]._jdf.queryExecution().executedPlan().toString()


def test_an_extract_with_other_orders_stages_those_alone(spark, tmp_path):
    src = RM._landed(spark, SF_SMALL)
    first = RM._staged(spark, src, str(tmp_path / "wh"))
    early = dict(src, orders=src["orders"].where("order_purchase_timestamp < timestamp_ntz'1998-01-01'"))
    again = RM._staged(spark, early, str(tmp_path / "wh"), like=first)
    whole = stage_all(early, P)
    for n in ("stg_orders", "stg_items", "stg_payments", "stg_products", "stg_customers"):
        assert again[n].count() == whole[n].count()
        assert (again[n] is first[n]) == (n not in ("stg_orders", "stg_items"))
