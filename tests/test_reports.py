import json

from pyspark.sql import functions as F

from tidemark.plans import insights, quality_report, retrieval


def test_entity_names():
    names = ["silver_customers_quaruntine", "x.silver_orders_quarantine", "payments_q", "zzz"]
    assert [quality_report.entity_of(n) for n in names] == ["customers", "orders", "transactions", "unknown"]


def test_report_counts_records_and_samples(spark):
    orders = spark.createDataFrame(
        [(f"o{i}", f"mode {i % 7}", "valid_ship_mode") for i in range(20)]
        + [(None, None, "valid_order_id,valid_ship_mode"), (None, "b", "valid_order_id"), (None, "c", "valid_order_id")],
        "order_id string, ship_mode string, error_reason string")
    products = spark.createDataFrame([("p1", None, "u", "valid_upc")], "product_id string, upc string, upc_cleaned string, error_reason string")
    odd = spark.createDataFrame([("z", "size", "bad")], "issue_type string, field string, value string")
    rejects = quality_report.all_rejects({"q.orders_quarantine": orders, "q.products_quarantine": products, "q.odd": odd})
    report = {(r.entity_name, r.issue_type): r for r in quality_report.grouped_report(rejects).collect()}
    modes = report[("orders", "valid_ship_mode")]
    assert modes.rejected_count == 21
    assert modes.sample_trigger_values == [f"mode {i}" for i in range(5)]
    assert modes.source_tables == ["q.orders_quarantine"]
    # Records without an id are told apart by their row hash.
    assert report[("orders", "valid_order_id")].rejected_count == 3
    assert report[("orders", "valid_order_id")].sample_trigger_values == []
    assert report[("unknown", "z")].field_name == "size"
    assert report[("unknown", "z")].sample_trigger_values == ["bad"]

    stored = quality_report.audit_report(quality_report.grouped_report(rejects))
    assert stored.columns == ["entity_name", "field_name", "issue_type", "rejected_count", "sample_trigger_values",
                              "source_tables", "ai_business_impact_explanation", "generated_at"]
    flags = quality_report.text_flags(stored, "ai_business_impact_explanation", "field_name").collect()
    assert all(r.has_risk_language and r.mentions_field for r in flags)


def test_long_field_text_is_not_cut(spark):
    reason = "valid_" + "x" * 3000
    df = spark.createDataFrame([("o", reason)], "order_id string, error_reason string")
    assert quality_report.normalise(df, "orders").first().field_name == "x" * 3000


def test_documents_and_retrieval(spark):
    products = spark.createDataFrame(
        [("p1", "red ring", "A", None, "B1", "M"), ("p2", "blue bolt", None, None, None, None)],
        "product_id string, product_name string, category string, sub_category string, brand string, manufacturer string")
    slow = spark.createDataFrame(
        [("p1", "West", True, 100, 12345678.9), ("p1", "East", False, 100, 1.0), ("p1", "North", False, None, 1.0)],
        "product_id string, region_name string, is_slow_mover boolean, days_since_last_sale int, total_revenue double")
    monthly = spark.createDataFrame([(2018, 1, "East", 5.0, 2.5), (2018, 2, "East", 7.0, 3.5)],
                                    "year int, month_num int, region_name string, total_sales_amount double, avg_order_value double")
    docs = {r.product_id: r for r in retrieval.product_documents(products, slow, monthly).collect()}
    assert docs["p1"].region == "East"
    assert docs["p1"].doc_text == (
        "Product intelligence profile. Product name: red ring. Category: A. Sub-category: unknown. Brand: B1. "
        "Manufacturer: M. Region context: East. Slow mover flag: true. Max days since last sale: 100. "
        "Slow-mover regions sample: East, North, West. Slow-mover revenue sum: 12345680.90. "
        "Region total sales context: 12.00. Region average order value context: 3.00.")
    assert "Slow mover flag: false. Max days since last sale: n/a." in docs["p2"].doc_text
    assert docs["p2"].region == "unknown"

    frame = retrieval.product_documents(products, slow, monthly)
    vendors = spark.createDataFrame([("v1", "Acme")], "vendor_id string, vendor_name string")
    rates = spark.createDataFrame([("v1", "Acme", 12.5, 3.0, 4, 99.0)], "vendor_id string, vendor_name string, return_rate_pct double, "
                                  "avg_days_to_return double, total_returns long, total_revenue double")
    both = retrieval.all_documents(frame, retrieval.vendor_documents(vendors, rates))
    assert both.count() == 3
    asked = spark.createDataFrame([(1, "Vendor name: Acme"), (2, "blue bolt")], "question_id int, question string")
    coded = retrieval.text_vectors(both, "doc_text").select("doc_id", "vector")
    found = retrieval.retrieve(retrieval.text_vectors(asked, "question"), both, coded, 2)
    best = {r.question_id: r.doc_id for r in found.filter("rank = 1").collect()}
    assert best == {1: "vendor::v1", 2: "product::p2"}
    context = retrieval.contexts(found)
    row = context.filter("question_id = 1").first()
    assert row.context.startswith("[Doc 1 | score=0.") and "\n\n[Doc 2 | score=" in row.context
    assert json.loads(row.retrieved_metadata)[0] == {
        "doc_id": "vendor::v1", "doc_type": "vendor", "product_id": None, "vendor_id": "v1", "region": "global"}
    log = retrieval.answers(context, 2, model=lambda p: "Acme" if "Question: Vendor" in p else "").collect()
    assert {r.question: r.answer for r in log} == {"Vendor name: Acme": "Acme", "blue bolt": retrieval.NO_ANSWER}


def test_text_vectors_have_unit_length(spark):
    df = spark.createDataFrame([("one two two",), ("",), ("a\nb\tc",)], "t string")
    rows = retrieval.text_vectors(df, "t").collect()
    assert [round(sum(x * x for x in r.vector), 5) for r in rows] == [1.0, 0.0, 1.0]
    assert {len(r.vector) for r in rows} == {retrieval.DIMENSIONS}


def test_kpi_payloads(spark):
    monthly = spark.createDataFrame([("A", 1.0), ("A", 2.0), ("B", 9.0), ("C", 3.0), ("D", 0.5)], "region_name string, total_sales_amount double")
    revenue = json.loads(insights.payload_json(insights.revenue_kpis(monthly)).first()[0])
    assert revenue["total_revenue"] == 15.5 and revenue["avg_revenue_per_region"] == 3.88
    assert [p["region"] for p in revenue["top_regions"]] == ["B", "A", "C"]
    assert [p["region"] for p in revenue["bottom_regions"]] == ["D", "A", "C"]
    rates = spark.createDataFrame([(f"v{i}", f"V{i}", float(i * 5), i) for i in range(7)] + [("v9", "V9", None, 0)],
                                  "vendor_id string, vendor_name string, return_rate_pct double, total_returns long")
    vendor = json.loads(insights.payload_json(insights.vendor_kpis(rates)).first()[0])
    assert vendor["avg_vendor_return_rate"] == 15.0 and vendor["vendor_count"] == 8
    assert vendor["high_return_rate_vendor_count_ge_20pct"] == 3
    assert [p["vendor_name"] for p in vendor["top_vendor_return_rates"]] == ["V6", "V5", "V4", "V3", "V2"]
    slow = spark.createDataFrame([("a", "East", True, 5.0), ("b", "East", None, 7.0), ("c", "West", True, 9.0)],
                                 "product_name string, region_name string, is_slow_mover boolean, total_revenue double")
    inventory = json.loads(insights.payload_json(insights.slow_inventory_kpis(slow)).first()[0])
    assert inventory["slow_moving_product_count"] == 2 and inventory["total_slow_moving_inventory_value"] == 14.0
    assert [p["region"] for p in inventory["top_regions_by_slow_inventory"]] == ["West", "East"]
    table = insights.business_insights({"r": insights.revenue_kpis(monthly)}, model=lambda p: "Topic ok" if "Topic: r" in p else None)
    assert table.first().executive_summary == "Topic ok"


def test_empty_marts_give_zero_payloads(spark):
    monthly = spark.createDataFrame([], "region_name string, total_sales_amount double")
    revenue = json.loads(insights.payload_json(insights.revenue_kpis(monthly)).first()[0])
    assert revenue == {"total_revenue": 0.0, "avg_revenue_per_region": 0.0, "top_regions": [], "bottom_regions": [], "region_count": 0}


def test_utc_time_does_not_follow_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        stamps = []
        for zone in ("UTC", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            stamps.append(spark.range(1).select(quality_report.utc_now()).first()[0][:13])
        assert stamps[0] == stamps[1]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert spark.range(1).select(F.length(quality_report.utc_now())).first()[0] == 26


def test_record_hash_sees_every_column_but_the_stamps(spark):
    names = [f"c{i}" for i in range(12)]
    rows = [("same",) * 11 + (str(i), f"2024-01-0{i + 1}", [str(i % 2)]) for i in range(3)] + [("same",) * 11 + ("0", "2025-01-01", ["0"])]
    df = spark.createDataFrame(rows, [*names, "_load_timestamp", "list"])
    hashes = [r[0] for r in df.select(quality_report.row_hash(df)).collect()]
    assert len(set(hashes)) == 3 and hashes[0] == hashes[3]


def test_weights_shuffle_texts_and_not_their_words(spark):
    import math

    from tidemark.plans import term_search

    rows = [(1, "red red fish"), (1, "Blue"), (2, "one fish"), (3, None), (None, "red"), (4, "one blue one")]
    docs = spark.createDataFrame(rows, "k int, t string")
    weights, _ = term_search.document_weights(docs, "k", "t")
    found = {(r.k, r.term): float(r.weight) for r in weights.collect()}
    counts = {1: {"red": 2, "fish": 1, "blue": 1}, 2: {"one": 1, "fish": 1}, None: {"red": 1}, 4: {"one": 2, "blue": 1}}
    idf = {term: math.log(len(rows) / sum(term in c for c in counts.values())) for c in counts.values() for term in c}
    raw = {(k, term): (1 + math.log(n)) * idf[term] for k, c in counts.items() if k for term, n in c.items()}
    length = {k: math.sqrt(sum(w * w for (j, _), w in raw.items() if j == k)) for k in counts}
    assert found == {(k, term): round(w / length[k], 9) for (k, term), w in raw.items()}
    plan = weights._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k" in plan and ", term#" not in "".join(x for x in plan.split("\n") if "Exchange hashpartitioning(k" in x)
