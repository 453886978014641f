"""All layers and reports over a small landing folder."""

import json

import pytest
from pyspark.errors import AnalysisException

from tidemark.jobs import Lakehouse, in_report_order


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_lakehouse_from_files_to_reports(spark, tmp_path):
    files = tmp_path / "landing"
    put(files / "Region 1" / "customers_1.csv", "customer_id,customer_name,segment,region,country\nc1,Ann,cons,E,US\nc2,Bob,corp,W,US\n")
    put(files / "customers_2.csv", "cust_id,full_name,customer_segment,region\nc3,Cid,zzz,E\n,Dee,ho,E\n")
    put(files / "orders_1.csv", "order_id,customer_id,vendor_id,ship_mode,order_status,order_purchase_date\n" + "".join(
        f"o{i},c{i % 2 + 1},v1,1st Class,delivered,2018-01-{i + 10} 10:00\n" for i in range(10)))
    put(files / "transactions_1.csv", "Order_ID,Product_ID,Sales,Quantity,payment_type\n" + "".join(
        f"o{i},p{i % 2},$10.00,2,{'cash' if i == 9 else 'voucher'}\n" for i in range(10)))
    put(files / "returns_1.json", json.dumps([
        {"OrderId": f"o{i}", "amount": 400.5, "reason": "Bad", "date_of_return": "2018-01-02", "status": "RJCTD"} for i in range(0, 10, 2)] * 2))
    put(files / "products.json", json.dumps([{"product_id": f"p{i}", "product_name": f"Thing {i}", "upc": "1", "categories": "X > Y"} for i in range(2)]))
    put(files / "vendors.csv", "vendor_id,vendor_name\nv1,Acme\n,Nameless\n")
    lake = Lakehouse(spark, str(files), str(tmp_path / "lake"), "job_silver", "job_gold", buckets=2)
    lake.refresh()
    monthly = in_report_order(lake.table("mv_monthly_revenue_by_region"), "mv_monthly_revenue_by_region").collect()
    assert [(r.region_name, r.order_count, r.total_sales_amount) for r in monthly] == [("East", 5, 50.0), ("West", 4, 40.0)]
    report = {(r.entity_name, r.issue_type): r.rejected_count for r in lake.report_quality().collect()}
    assert report == {("customers", "NULL_CUSTOMER_ID"): 1, ("customers", "INVALID_SEGMENT"): 1,
                      ("transactions", "valid_payment_type"): 1, ("vendors", "valid_vendor_id"): 1}
    (flagged,) = lake.report_risk().collect()
    assert (flagged.customer_id, flagged.anomaly_score, flagged.total_returns) == ("c1", 85, 10)
    assert lake.answer(["Which vendor is Acme?"], 2, model=lambda p: "Acme").count() == 1
    log = lake.answer(["Which vendor is Acme?", "Thing 1"], 2)
    assert log.count() == 3 and log.filter("answer = 'Acme'").count() == 1
    insight = {r.insight_type: json.loads(r.kpi_payload_json) for r in lake.report_insights().collect()}
    assert insight["revenue_performance"]["total_revenue"] == 90.0
    assert insight["vendor_return_rate"]["vendor_count"] == 1

    put(files / "transactions_2.csv", "Order_ID,Product_ID,Sales,Quantity\no1,p1,5,1\n")
    lake.refresh()
    assert lake.table("fact_sales").count() == 10
    assert lake.table("mv_monthly_revenue_by_region").selectExpr("sum(total_sales_amount)").first()[0] == 95.0


def test_lakehouse_starts_empty(spark, tmp_path):
    files = tmp_path / "landing"
    files.mkdir()
    lake = Lakehouse(spark, str(files), str(tmp_path / "lake"), "empty_silver", "empty_gold", buckets=2)
    lake.refresh()
    for name in ("fact_sales", "fact_returns", "dim_customer", "mv_vendor_return_rate"):
        assert lake.table(name).count() == 0
    assert lake.report_quality().count() == 0
    assert lake.report_risk().count() == 0
    put(files / "transactions_1.csv", "Order_ID,Product_ID,Sales,Quantity\no1,p1,5,1\n,p1,5,1\n")
    lake.refresh()
    assert lake.table("fact_sales").count() == 1
    assert lake.report_quality().first().issue_type == "valid_order_id"


def test_broken_view_raises(spark, tmp_path):
    lake = Lakehouse(spark, str(tmp_path), str(tmp_path / "lake"), "broken_silver", "broken_gold")
    rows = str(tmp_path / "rows")
    spark.range(3).write.parquet(rows)
    empty = spark.createDataFrame([], "id long")
    spark.sql("CREATE DATABASE IF NOT EXISTS broken_silver")
    with pytest.raises(AnalysisException):
        lake._publish("broken_silver.v", f"SELECT missing FROM parquet.`{rows}`", empty)
    assert not spark.catalog.tableExists("broken_silver.v")
    lake._publish("broken_silver.v", f"SELECT id FROM parquet.`{rows}-none`", empty)
    assert spark.table("broken_silver.v").count() == 0
