"""Tables under one commit log: what dies is never read, failures are one row a line, ids keep their type."""

import os
from dataclasses import replace

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from starmart.operators import dims as D
from starmart.plans import etl as ETL
from starmart.plans.star import FIXTURE_PARAMS as P
from starmart.plans.star import build_dims, stage_all, star_from_tables
from starmart.plans.warehouse import CommitConflict, Warehouse
from starmart.sources import fixtures as FX
from starmart.sources.io import with_arrival


@pytest.fixture(scope="module")
def world(spark):
    src = FX.sources(spark, SF_SMALL)
    stg = {k: v.checkpoint() for k, v in stage_all(src, P).items() if k in ("stg_orders", "stg_items", "stg_payments", "stg_customers", "stg_products")}
    dims = {k: v.checkpoint() for k, v in build_dims(spark, src, stg, P).items()}
    return src, stg, dims


def contents(spark, base):
    wh = Warehouse(spark, base)
    snap = wh.snapshot()
    return {t: sorted(map(str, wh.read(t, snap).collect())) for t in snap.folders if t != "etl_control_log"}


def load(spark, world, base, run, dims=None, **options):
    _, stg, own = world
    return ETL.load_fact(spark, options.pop("stg", stg), dims or own, base, "2002-01-01", run, **options)


def test_a_load_killed_at_any_write_leaves_the_tables_as_they_were(spark, world, tmp_path, monkeypatch):
    base = str(tmp_path / "wh")
    half = dict(world[2], dim_product=world[2]["dim_product"].where("product_key > 20"))
    load(spark, world, base, 1, half)
    before = contents(spark, base)
    assert before["fact_sales"] and before[ETL.QUEUE]
    real_write, real_commit, calls = Warehouse.write, Warehouse.commit, []

    def counted(self, df, path, *a, **k):
        calls.append(path)
        return real_write(self, df, path, *a, **k)

    for n in range(1, 6):
        calls.clear()

        def dying(self, df, path, *a, n=n, **k):
            counted(self, df, path, *a, **k)
            if len(calls) == n:  # after the files are there, before the run goes on
                raise RuntimeError(f"killed at write {n}")

        def never(self, *a):
            raise RuntimeError("killed before the commit")

        monkeypatch.setattr(Warehouse, "write", dying)
        if n == 5:  # all four tables written, and the machine gone
            monkeypatch.setattr(Warehouse, "commit", never)
        with pytest.raises(RuntimeError, match="killed"):
            load(spark, world, base, 10 + n)
        monkeypatch.setattr(Warehouse, "write", real_write)
        monkeypatch.setattr(Warehouse, "commit", real_commit)
        assert contents(spark, base) == before
    log = {r.log_id: r.status for r in ETL.read_table(spark, base, "etl_control_log").collect()}
    assert log == {1: "SUCCESS", 11: "FAILED", 12: "FAILED", 13: "FAILED"}
    # the same load goes through afterwards, and earlier snapshots can still be read
    assert load(spark, world, base, 20)["failures"] == 0
    after = contents(spark, base)
    assert len(after["fact_sales"]) > len(before["fact_sales"]) and all("state='loaded'" in r for r in after[ETL.QUEUE])
    wh = Warehouse(spark, base)
    assert sorted(map(str, wh.read("fact_sales", wh.snapshot(1)).collect())) == before["fact_sales"]


def test_queue_holds_each_line_once(spark, world, tmp_path):
    base = str(tmp_path / "wh")
    half = dict(world[2], dim_product=world[2]["dim_product"].where("product_key > 20"))
    first = load(spark, world, base, 1, half)
    queue = ETL.read_table(spark, base, ETL.QUEUE)
    assert queue.agg(F.sum("lines")).first()[0] == first["failures"] == queue.where("state = 'pending' and attempts = 1").agg(F.sum("lines")).first()[0]
    load(spark, world, base, 2, half)
    again = ETL.read_table(spark, base, ETL.QUEUE)
    assert again.count() == queue.count() and again.select("attempts", "first_run", "last_run").distinct().collect() == [(2, 1, 2)]
    # a product that arrives touches only the months of its lines
    more = dict(world[2], dim_product=world[2]["dim_product"].where("product_key > 19"))
    folders = Warehouse(spark, base).snapshot().folders[ETL.QUEUE]
    load(spark, world, base, 3, more)
    third = ETL.read_table(spark, base, ETL.QUEUE)
    assert third.count() == queue.count() and {r.state for r in third.select("state").distinct().collect()} == {"pending", "loaded"}
    assert set(Warehouse(spark, base).snapshot().folders[ETL.QUEUE].values()) == set(folders.values())
    load(spark, world, base, 4)
    done = Warehouse(spark, base).snapshot().folders[ETL.QUEUE]
    load(spark, world, base, 5)
    assert Warehouse(spark, base).snapshot().folders[ETL.QUEUE] == done  # nothing waits: no file is rewritten
    assert ETL.read_table(spark, base, ETL.QUEUE).where("state <> 'loaded'").count() == 0
    assert ETL.read_table(spark, base, "fact_sales").count() == world[1]["stg_items"].count()


def test_full_reload_and_files_of_bounded_size(spark, world, tmp_path):
    base = str(tmp_path / "wh")
    load(spark, world, base, 1, dict(world[2], dim_seller=world[2]["dim_seller"].limit(3)))
    short = ETL.read_table(spark, base, "fact_sales").count()
    assert load(spark, world, base, 2, full_reload=True, rows_per_file=500)["mode"] == "FULL"
    fact = ETL.read_table(spark, base, "fact_sales")
    assert fact.count() == world[1]["stg_items"].count() > short
    files = fact.groupBy(F.input_file_name().alias("f")).count()
    assert files.agg(F.max("count")).first()[0] <= 500
    assert load(spark, world, base, 3)["rows"] == 0


def test_orders_that_arrive_late(spark, world, tmp_path):
    src, stg, _ = world
    base = str(tmp_path / "wh")
    late = F.col("order_purchase_timestamp") < F.lit("1996-01-01").cast("timestamp_ntz")
    frames = []
    for n, cond in enumerate((~late, late)):
        stg["stg_orders"].where(cond).write.parquet(str(tmp_path / f"landing{n}"))
        frames.append(str(tmp_path / f"landing{n}"))
        both = dict(stg, stg_orders=with_arrival(spark.read.parquet(*frames)))
        out = load(spark, world, base, n + 1, stg=both, watermark_basis="load_time")
    assert out["rows"] > 0 and ETL.read_table(spark, base, "fact_sales").count() == stg["stg_items"].count()
    assert load(spark, world, base, 3, stg=both, watermark_basis="load_time")["rows"] == 0


def test_a_second_commit_on_one_parent_is_found(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    with wh.begin(1, "t") as a:
        a.append("t", spark.range(3))
        with wh.begin(2, "t") as b:
            b.append("t", spark.range(5))
        a.loaded = 3
        with pytest.raises(CommitConflict):
            wh.commit(a.parent, a.folders, a.columns)
        a.parent = wh.snapshot()
        a.folders = {t: dict(f) for t, f in a.parent.folders.items()} | {"t": {**a.parent.folders["t"], a.load: ""}}
    assert wh.read("t").count() == 8


def test_text_ids_and_repeated_members(spark, world, tmp_path):
    base = str(tmp_path / "wh")
    src = dict(world[0])
    for table, ids in {"orders": ["order_id", "customer_id"], "items": ["order_id", "product_id", "seller_id"], "payments": ["order_id"], "customers": ["customer_id"], "products": ["product_id"], "sellers": ["seller_id"]}.items():
        src[table] = src[table].withColumns({c: F.concat(F.lit("x-"), F.col(c).cast("string")) for c in ids})
    src["sellers"] = src["sellers"].unionByName(src["sellers"]).unionByName(src["sellers"].withColumn("seller_city", F.lit("zz")))
    src = {k: v.checkpoint() for k, v in src.items()}
    stg = {k: v.checkpoint() for k, v in stage_all(src, P).items() if k.startswith("stg_") and k not in ("stg_rejects", "stg_null_price")}
    n = world[0]["sellers"].count()
    keys = None
    for run in (1, 2, 3):
        dims = ETL.load_dimensions(spark, src, stg, P, base, str(run), first_log_id=10 * run)
        held = {r.seller_id: r.seller_key for r in dims["dim_seller"].collect()}
        assert len(held) == dims["dim_seller"].count() == n and (keys is None or keys == held)
        keys = held
    assert ETL.read_table(spark, base, "keys_dim_seller").count() == n
    assert ETL.read_table(spark, base, "dim_duplicates").where("dimension = 'dim_seller' and rows = 3 and version = '2'").count() == n
    out = ETL.load_fact(spark, stg, dims, base, "2002-01-01", 99)
    assert out["failures"] == 0 and out["rows"] == world[1]["stg_items"].count()
    star = star_from_tables(spark, base)
    assert dict(star["dim_customer"].dtypes)["customer_id"] == dict(star["fact_sales"].dtypes)["order_id"] == "string"
    assert star["dim_customer"].where("not is_current").count() == 0


def test_ids_loaded_twice_before_keep_their_keys(spark):
    """A dimension that already has an id twice doesn't grow, and no key of it disappears."""
    feed = spark.createDataFrame([("a", "x", "s", "1"), ("b", "y", "s", "2"), ("b", "z", "s", "2"), (None, "n", "s", "3")], "seller_id string, seller_city string, seller_state string, seller_zip_code_prefix string")
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b"), (4, "gone")], "seller_key long, seller_id string").select("seller_key", "seller_id", F.lit("c").alias("seller_city"), F.lit("S").alias("seller_state"), F.lit("9").alias("seller_zip_prefix"), F.lit("2000-01-01").cast("date").alias("etl_load_date"))
    for _ in range(2):
        new = D.build_dim_seller(feed, "2000-02-01", old)
        old = D.keep_absent(new, old, "seller_key").checkpoint()
        got = sorted((r.seller_key, r.seller_id or "-", r.seller_city) for r in old.collect())
        assert [(k, i) for k, i, _ in got if i != "-"] == [(1, "a"), (2, "b"), (3, "b"), (4, "gone")] and got[2][2] == "Y"


def test_a_merge_rewrites_no_closed_version(spark, world, tmp_path):
    base = str(tmp_path / "wh")
    src, stg, _ = world

    def closed():
        return {f: sorted(os.listdir(f"{base}/dim_customer_history/{f}")) for f in Warehouse(spark, base).snapshot().folders["dim_customer_history"]}

    moved = F.col("customer_id") == stg["stg_customers"].agg(F.min("customer_id")).first()[0]
    before, seen = {}, []
    for run, city in enumerate(("First", "Second", "Second", "Third"), start=1):
        feed = stg["stg_customers"].withColumn("customer_city", F.when(moved, city).otherwise(F.col("customer_city")))
        dim = ETL.load_dimensions(spark, src, dict(stg, stg_customers=feed), replace(P, run_date=f"2002-01-0{run}"), base, str(run), first_log_id=10 * run)["dim_customer"]
        now = closed()
        assert before.items() <= now.items()  # the same files, and new ones
        before = now
        seen.append((dim.where("not is_current").count(), dim.where(moved).agg(F.max("record_version")).first()[0]))
        assert dim.select("customer_key").distinct().count() == dim.count()
    assert seen == [(0, 1), (1, 2), (1, 2), (2, 3)]


def test_changed_days_are_reconciled(spark, world, tmp_path):
    base = str(tmp_path / "wh")
    half = dict(world[2], dim_product=world[2]["dim_product"].where("product_key > 20"))
    load(spark, world, base, 1, half)
    assert ETL.verify_load(spark, base, world[1], 1).count() == 0  # waiting lines are accounted for
    load(spark, world, base, 2)
    assert ETL.verify_load(spark, base, world[1], 2).count() == 0
    short = dict(world[1], stg_items=world[1]["stg_items"].where("product_id > 3"))
    doubled = dict(world[1], stg_items=world[1]["stg_items"].unionByName(world[1]["stg_items"].limit(1)))
    assert ETL.verify_load(spark, base, short, 1).where("fact_lines > source_lines and missing_revenue < 0").count() > 0
    assert ETL.verify_load(spark, base, doubled, 1).select(F.col("source_lines") - F.col("fact_lines")).collect() == [(1,)]
