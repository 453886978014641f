"""Landing files through bronze and silver to the facts, in several runs."""

import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tidemark.operators.quality import keep_valid, quarantined_rows
from tidemark.plans import entities as e
from tidemark.plans import silver as silver_plans
from tidemark.plans import star
from tidemark.sources import landing, tables
from tidemark.sources.scratch import new_folder
from tidemark.streaming import bronze, facts, silver
from tidemark.workload import inputs


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def run(spark, root, entity, **options):
    bronze.ingest(spark, str(root / "landing"), str(root / "bronze"), str(root / "cp"), entity, **options).awaitTermination()
    return bronze.read_bronze(spark, str(root / "bronze"))


def test_headers_differ_and_columns_arrive_later(spark, tmp_path):
    files = tmp_path / "landing"
    put(files / "Region 4" / "customers_4.csv", "customer_id,city,state,postal_code\n1,TX,Austin,00701\n")
    put(files / "region3" / "customers+3.csv", "ignored\nx\n")
    put(files / "region3" / "customers_3 a+b.csv", '﻿CITY,cust_id,customer_name\r\n"Paris, TX",2,"A \\"B\\""\r\n')
    put(files / "customers_root.csv", "customer_identifier,email_address\n3,e\n")
    put(files / "customers_empty.csv", "")
    put(files / "customers_names_only.csv", "customer_id,city\n")
    put(files / "orders_1.csv", "order_id\n9\n")
    first = run(spark, tmp_path, e.CUSTOMERS)
    assert first.count() == 3
    put(files / "Region 1" / "customers_1.csv", "customer_id,Birth Date\n4,1990\n")
    rows = run(spark, tmp_path, e.CUSTOMERS)
    clean = {r.customer_id: r for r in silver_plans.customers(rows).collect()}
    assert set(clean) == {"1", "2", "3", "4"}
    assert (clean["1"].city, clean["1"].state, clean["1"].postal_code, clean["1"]._region) == ("Austin", "TX", "00701", "4")
    assert (clean["2"].city, clean["2"].customer_name, clean["2"]._region) == ("Paris, TX", 'A "B"', "3")
    assert clean["2"]._source_file.endswith("region3/customers_3 a+b.csv")
    assert (clean["3"]._region, clean["3"].customer_email) == ("global", "e")
    births = {r._source_file.rsplit("/", 1)[1]: r["Birth Date"] for r in rows.collect()}
    assert births["customers_1.csv"] == "1990" and births["customers_4.csv"] is None
    assert rows.filter("_load_timestamp IS NULL").count() == 0


def test_header_job_reads_many_files_of_several_splits(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landing, "SPLIT_BYTES", "512")
    paths = []
    for i in range(12):
        path = tmp_path / f"f{i}.csv"
        put(path, ("a,b" if i % 2 else "b,c") + "\n" + "".join(f"{n},{n}\n" for n in range(300)))
        paths.append(str(path))
    found = landing.headers(spark, paths)
    assert {h: len(p) for h, p in found.items()} == {"a,b": 6, "b,c": 6}
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") != "512"


def test_names_with_glob_characters(spark, tmp_path):
    put(tmp_path / "landing" / "vendors[1]{x}.csv", "vendor_id,vendor_name\nv1,n\n")
    put(tmp_path / "landing" / "vendors1x.csv", "vendor_name,vendor_id\nm,v2\n")
    rows = run(spark, tmp_path, e.VENDORS)
    assert {(r.vendor_id, r.vendor_name) for r in rows.collect()} == {("v1", "n"), ("v2", "m")}


def test_column_names():
    assert landing.column_names('Order_id,"x,y",order_ID,', e.TRANSACTIONS) == ["Order_ID", "x,y", "Order_ID2", "_c3"]


def test_json_arrays_keep_number_text_and_nested_values(spark, tmp_path):
    put(tmp_path / "landing" / "products_1.json", json.dumps(
        [{"product_id": "a", "dims": {"h": 1}}]).replace('"a"', '"a", "upc": 6.40E+11, "weight": 4.50, "categories": "X,Y"'))
    put(tmp_path / "landing" / "Region 2" / "products_2.json", '[\n{"PRODUCT_ID": "b",\n "upc": "123"},\n{"product_id": "c"}\n]')
    rows = run(spark, tmp_path, e.PRODUCTS)
    got = {r.product_id: r for r in rows.collect()}
    assert (got["a"].upc, got["a"].weight, got["a"].dims) == ("6.40E+11", "4.50", '{"h":"1"}')
    assert got["b"].upc == "123" and got["b"]._region == "2"
    clean = {r.product_id: r for r in silver_plans.products(rows).collect()}
    assert clean["a"].upc_cleaned == "640000000000" and clean["a"].categories_list == ["X", "Y"]
    assert clean["c"].categories_list == []


def test_rescue_folds_unknown_columns(spark, tmp_path):
    entity = replace(e.TRANSACTIONS, columns=("Sales",))
    put(tmp_path / "landing" / "transactions_1.csv", "Order_id,Sales,Quantity\n7,$3.5,\n,$1,\n")
    rows = run(spark, tmp_path, entity, evolution="rescue")
    rescued = {r.Sales: r._rescued_data for r in rows.collect()}
    assert rescued == {"$3.5": '{"Order_id":"7"}', "$1": None}
    sold = {r.sales: r for r in silver_plans.transactions(rows).collect()}
    assert sold[3.5].order_id == "7" and sold[3.5].payment_type == "credit_card" and sold[3.5].payment_installments == 0


def test_repeated_batch_adds_nothing_downstream(spark, tmp_path):
    path = tmp_path / "vendors.csv"
    put(path, "vendor_id,vendor_name\nv1,n\nv2,m\n")
    load = bronze.batch_loader(e.VENDORS, str(tmp_path / "bronze"))
    batch = spark.createDataFrame([(str(path),)], "path string")
    for _ in range(2):
        load(batch, 0)
        silver.refine(spark, str(tmp_path / "bronze"), str(tmp_path / "silver"), str(tmp_path / "cp"), e.VENDORS).awaitTermination()
        assert spark.read.parquet(str(tmp_path / "silver")).count() == 2


def test_incomplete_batch_is_replaced(spark, tmp_path):
    path = tmp_path / "vendors.csv"
    put(path, "vendor_id,vendor_name\nv1,n\n")
    load = bronze.batch_loader(e.VENDORS, str(tmp_path / "bronze"))
    batch = spark.createDataFrame([(str(path),)], "path string")
    load(batch, 0)
    (tmp_path / "bronze" / "batch_id=0" / "_SUCCESS").unlink()
    load(batch, 0)
    assert bronze.read_bronze(spark, str(tmp_path / "bronze")).count() == 1


def test_repeated_batch_keeps_its_rows(spark, tmp_path):
    path = tmp_path / "vendors.csv"
    put(path, "vendor_id,vendor_name\nv1,n\n")
    load = bronze.batch_loader(e.VENDORS, str(tmp_path / "bronze"))
    batch = spark.createDataFrame([(str(path),)], "path string")
    load(batch, 0)
    load(batch, 0)
    assert bronze.read_bronze(spark, str(tmp_path / "bronze")).count() == 1
    load(batch.limit(0), 1)
    assert bronze.read_bronze(spark, str(tmp_path / "bronze")).count() == 1


def test_files_are_taken_in_batches(spark, tmp_path):
    for i in range(5):
        put(tmp_path / "landing" / f"vendors_{i}.csv", f"vendor_id,vendor_name\nv{i},n\n")
    rows = run(spark, tmp_path, e.VENDORS, max_files=2)
    assert rows.count() == 5 and rows.select("batch_id").distinct().count() == 3


def test_whole_pipeline_twice(spark, tmp_path):
    files, root = tmp_path / "landing", str(tmp_path / "lake")
    put(files / "customers_1.csv", "customer_id,segment,region\nc1,cons,E\nc2,zzz,E\n")
    put(files / "orders_1.csv", "order_id,customer_id,vendor_id,ship_mode,order_status,order_purchase_date\n"
        "o1,c1,v1,1st Class,delivered,2018-01-05 10:00\no2,c1,v1,Drone,delivered,01/06/2018 10:00\n")
    put(files / "transactions_a.csv", "Order_id,Product_id,Sales,Quantity\no1,p1,$10.00,2\no9,p1,$1,1\no1,,$5,1\n")
    put(files / "returns_1.json", '[{"OrderId":"o1","amount":4.5,"reason":"?Bad?","date_of_return":"01-03-2018","status":"APPRVD"}]')
    put(files / "products.json", '[{"product_id":"p1","product_name":" A ","upc":"1","categories":"X > Y"}]')
    put(files / "vendors.csv", "vendor_id,vendor_name\nv1,V\n,W\n")

    def refresh():
        bronze.ingest_all(spark, str(files), root)
        for name in ("transactions", "returns"):
            silver.refine(spark, f"{root}/bronze/{name}", f"{root}/silver/{name}", f"{root}/checkpoints/silver/{name}",
                          e.ENTITIES[name]).awaitTermination()
        static = {}
        for name in ("orders", "customers"):
            rows = silver_plans.STANDARDISE[name](bronze.read_bronze(spark, f"{root}/bronze/{name}"))
            static[name] = keep_valid(rows, e.ENTITIES[name].rules)
        for name, fact in (("transactions", star.fact_sales), ("returns", star.fact_returns)):
            facts.append_fact(fact, silver.follow_clean(spark, f"{root}/silver/{name}", e.ENTITIES[name]), static["orders"], static["customers"],
                              f"{root}/gold/{name}", f"{root}/checkpoints/gold/{name}").awaitTermination()
        return spark.read.parquet(f"{root}/gold/transactions"), spark.read.parquet(f"{root}/gold/returns")

    sales, returned = refresh()
    assert {(r.order_id, r.sales_amount, r.region_name) for r in sales.collect()} == {("o1", 10.0, "East"), (None, 1.0, None)}
    (back,) = returned.collect()
    assert (back.return_date, back.days_to_return, back.is_approved, back.return_reason) == ("2018-01-03", -2, True, "Bad")
    bad = quarantined_rows(spark.read.parquet(f"{root}/silver/transactions"))
    assert [r.error_reason for r in bad.collect()] == ["valid_product_id"]

    put(files / "Region 2" / "transactions_b.csv", "Sales,Order_ID,Product_ID,profit,coupon\n20,o1,p2,1.5,yes\n")
    sales, _ = refresh()
    assert sales.count() == 3
    assert sales.filter("sales_amount = 20 AND profit = 1.5").count() == 1
    # Nothing new: nothing is added.
    sales, returned = refresh()
    assert (sales.count(), returned.count()) == (3, 1)


def test_tables_are_found_replaced_and_extended(spark):
    tables.ensure_schema(spark, "lake")
    assert spark.catalog.databaseExists("lake")
    df = spark.createDataFrame([(1, "a")], "id int, error_reason string")
    for name in ("silver_orders_quaruntine", "silver_products_quarantine", "silver_orders_clean"):
        tables.replace_table(df, f"lake.{name}")
    found = tables.find_tables(spark, "lake", ["lake.silver_products_quarantine", "lake.missing"])
    names = [f.split(".", 1)[1] for f in found]
    assert names == ["silver_products_quarantine", "silver_orders_quaruntine"]
    assert tables.find_tables(spark, "nowhere") == []
    tables.replace_table(df, "lake.report", ["error_reason", "id"])
    tables.replace_table(df, "lake.report", ["error_reason", "id"])
    tables.extend_table(df, "lake.report", ["error_reason", "id"])
    assert spark.read.table("lake.report").columns == ["error_reason", "id"]
    assert spark.read.table("lake.report").count() == 2
    assert set(tables.read_tables(spark, found)) == set(found)


def test_scratch_folders_come_from_the_session(spark):
    a, b = new_folder(spark, "x"), new_folder(spark, "x")
    assert a != b and a.startswith(spark.conf.get("spark.checkpoint.dir"))


@pytest.mark.parametrize("entity", list(e.ENTITIES.values()), ids=list(e.ENTITIES))
def test_standardise_runs_on_a_stream_schema(spark, entity):
    empty = spark.createDataFrame([], bronze.bronze_schema(entity))
    out = silver_plans.STANDARDISE[entity.name](empty)
    assert len({c.lower() for c in out.columns}) == len(out.columns)
    assert out.filter(F.lit(True)).count() == 0


def test_a_raw_price_is_made_once(spark, tmp_path):
    """Two columns hold it; the text of a decimal is costly."""
    line = (1, 2, 3, 4, 5.0, 12.345, 0.04, 0.0, "R", "F")
    names = "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus"
    spark.createDataFrame([line, (7, None, 3, 1, None, None, None, None, None, None)], names.split()).write.parquet(f"{tmp_path}/lineitem.parquet")
    raw = inputs.raw_transactions(inputs.Tables(spark, str(tmp_path)))
    assert raw._jdf.queryExecution().optimizedPlan().toString().count("cast(l_extendedprice") == 1
    assert {(r.Sales, r.profit) for r in raw.collect()} == {("$12.35", "12.35"), (None, None)}
