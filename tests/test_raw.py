"""The raw extract: header lines, malformed lines, the order of lines, and the phases run on it."""

import os

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from starmart.__main__ import main
from starmart.operators import staging as S
from starmart.plans import etl as ETL
from starmart.sources import fixtures as FX
from starmart.sources import raw


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)


def test_columns_by_name_and_malformed_lines(spark, tmp_path):
    put(tmp_path, "items.csv", 'price,extra,order_id,order_item_id,product_id,seller_id,shipping_limit_date,freight_value\n1.50,x,o1,1,p,s,2018-01-01 00:00:00,2\nbad,"a,""b""",o2,2,p,s,,\n9,x,o3\n1,x,o4,1,p,s,,3,4\n')
    rows, bad = raw.read_table(spark, f"{tmp_path}/items.csv", raw.RAW["items"])
    assert [(r.order_id, r.order_item_id, r.price and float(r.price), r.freight_value and float(r.freight_value)) for r in rows.collect()] == [("o1", 1, 1.5, 2.0), ("o2", 2, None, None)]
    assert rows.count() == 2 and rows.select("order_id").collect() == [("o1",), ("o2",)]  # whatever columns are asked for
    assert sorted(r.record for r in bad.collect()) == ["1,x,o4,1,p,s,,3,4", "9,x,o3"]
    put(tmp_path, "sellers.csv", "seller_id,seller_city\na,b\n")
    with pytest.raises(raw.MissingColumns, match="seller_state, seller_zip_code_prefix"):
        raw.read_table(spark, f"{tmp_path}/sellers.csv", raw.RAW["sellers"])
    assert rows.schema["price"].dataType.simpleString() == "decimal(12,2)"


def test_keep_first_is_the_first_line(spark, tmp_path):
    head = "customer_id,customer_unique_id,customer_city,customer_state,customer_zip_code_prefix\n"
    put(tmp_path / "customers.csv", "part-1.csv", head + "a,u,zulu,st,01\nb,u,x,st,02\na,u,alpha,st,03\n")
    put(tmp_path / "customers.csv", "part-2.csv", head + "b,u,aaa,st,04\nc,u,y,st,05\n" + "".join(f"d,u,city{9 - k},s,{k}\n" for k in range(9)))
    rows, _ = raw.read_table(spark, f"{tmp_path}/customers.csv", raw.RAW["customers"], "row_order")
    got = {r.customer_id: (r.customer_city, r.customer_zip_code_prefix) for r in S.stage_customers(rows.repartition(3), "2018-01-01").collect()}
    assert got == {"a": ("Zulu", "01"), "b": ("X", "02"), "c": ("Y", "05"), "d": ("City9", "0")}
    assert "row_order" not in S.stage_customers(rows, "2018-01-01").columns


def test_phases_on_csv_equal_those_on_parquet(spark, tmp_path):
    src = FX.sources(spark, SF_SMALL)
    data = str(tmp_path / "extract")
    for name, df in src.items():
        if name == "payments":
            df = df.orderBy("order_id", "payment_seq")
        kept = df.select(*raw.columns_of(raw.RAW[name]))
        stamps = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c, t in kept.dtypes if t.startswith("timestamp")}
        (kept.withColumns(stamps) if stamps else kept).coalesce(1).write.option("header", True).csv(f"{data}/{name}.csv")
    put(f"{data}/sellers.csv", "more.csv", "seller_id,seller_city,seller_state,seller_zip_code_prefix\nbroken\n")
    out, plain = str(tmp_path / "csv"), str(tmp_path / "parquet")
    main(["--data", data, "--csv", "--out", out, "--fixture-params", "--phases", "stage,dims,fact"])
    main(["--data", SF_SMALL, "--out", plain, "--fixture-params", "--phases", "stage,dims,fact"])
    names = [c for c in ETL.read_table(spark, plain, "fact_sales").columns if not c.endswith("_key") or c == "date_key"]

    def fact(base):
        f = ETL.read_table(spark, base, "fact_sales")
        for dim, i in (("customer", "customer_id"), ("product", "product_id"), ("seller", "seller_id")):
            d = ETL.read_table(spark, base, f"dim_{dim}").select(f"{dim}_key", F.col(i).cast("string").alias(i))
            f = f.join(d, f"{dim}_key")
        return sorted(tuple(map(str, r)) for r in f.select(*names, "customer_id", "product_id", "seller_id").collect())

    assert fact(out) == fact(plain) and dict(ETL.read_table(spark, out, "fact_sales").dtypes)["order_id"] == "string"
    lines = spark.read.parquet(f"{out}/reject_log_lines").collect()
    assert [(r.table_name, r.record) for r in lines] == [("sellers", "broken")]
    for base in (out, plain):
        assert spark.read.parquet(f"{base}/staging_summary/v=1").first().stg_items_rows == len(fact(plain))
