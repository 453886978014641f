import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.plans import marts, return_risk, star

TS = dt.datetime
CUSTOMER_DDL = ("customer_id string, customer_email string, customer_name string, segment string, country string, "
                "city string, state string, postal_code string, region string")
ORDER_DDL = ("order_id string, customer_id string, vendor_id string, ship_mode string, order_status string, "
             "order_purchase_date timestamp, order_approved_at timestamp, order_delivered_carrier_date timestamp, "
             "order_delivered_customer_date timestamp, order_estimated_delivery_date timestamp")
TXN_DDL = ("order_id string, product_id string, sales double, quantity int, discount double, profit double, "
           "payment_type string, payment_installments int")


@pytest.fixture(scope="module")
def customers(spark):
    return spark.createDataFrame([
        ("c1", "e", "Ann", "Consumer", "US", "x", "y", "00701", "East"),
        ("c1", "e2", "Ann", "Consumer", "US", "x", "y", "00702", "West"),
        ("c2", None, "Bob", "Corporate", "CA", "x", "y", "1", "East"),
    ], CUSTOMER_DDL)


@pytest.fixture(scope="module")
def orders(spark):
    def order(oid, cid, day):
        return (oid, cid, "v1", "First Class", "delivered", day, None, None, None, None)

    return spark.createDataFrame([
        order("o1", "c1", TS(2018, 1, 5, 10)), order("o2", "c2", TS(2018, 2, 5)),
        order("o2", "c2", TS(2018, 2, 9)), order("o3", "gone", TS(2018, 2, 5))], ORDER_DDL)


@pytest.fixture(scope="module")
def sales(spark, customers, orders):
    transactions = spark.createDataFrame([
        ("o1", "p1", 10.0, 1, 0.0, 1.0, "voucher", 0), ("o1", "p2", 2.5, 3, 0.0, 1.0, "voucher", 0),
        ("o2", "p1", 7.0, 2, 0.0, 1.0, "voucher", 0), ("o3", "p1", 1.0, 1, 0.0, 1.0, "voucher", 0),
        ("o9", "p1", 5.0, 1, 0.0, 1.0, "voucher", 0), (None, "p1", 5.0, 1, 0.0, 1.0, "voucher", 0),
        ("o1", None, 5.0, 1, 0.0, 1.0, "voucher", 0)], TXN_DDL)
    return star.fact_sales(transactions, orders, customers)


def test_dim_date_spine(spark):
    days = star.dim_date(spark)
    assert days.count() == 14975
    row = days.filter("date_key = 20180106").first()
    assert (row.day_of_week, row.week_num, row.month_name, row.quarter, row.is_weekend) == (
        "Saturday", 1, "January", 1, True)


def test_duplicate_customers_and_orders_do_not_repeat_sales(sales):
    rows = {(r.order_id, r.product_id): r for r in sales.collect()}
    assert sales.count() == 5
    assert rows[("o2", "p1")].date_key == 20180209
    assert rows[("o1", "p1")].region_name in ("East", "West")
    unknown = rows[(None, "p1")]
    assert unknown.date_key is None and unknown.customer_id is None and unknown.sales_amount == 5.0
    assert rows[("o3", "p1")].customer_id == "gone" and rows[("o3", "p1")].region_name is None


def test_dimensions_have_one_row_per_key(spark, customers):
    assert star.customer_lookup(customers).count() == 2
    assert star.dim_region(customers).count() == 3
    products = spark.createDataFrame(
        [("p1", "old", "A > B", "2015-01-01 00:00"), ("p1", "new", "A", "2016-01-01 00:00"), (None, "x", "A", None)],
        "product_id string, product_name string, categories string, dateUpdated string")
    for name in set(star.PRODUCT_COLUMNS) - set(products.columns):
        products = products.withColumn(name, F.lit(None).cast("string"))
    (row,) = star.dim_product(products).collect()
    assert (row.product_name, row.category, row.sub_category) == ("new", "A", None)


def test_monthly_totals_equal_fact_totals(spark, sales, customers):
    lookup = star.customer_lookup(customers)
    monthly = marts.monthly_revenue(sales, star.dim_date(spark), lookup)
    assert monthly.agg(F.sum("total_sales_amount")).first()[0] == 19.5
    january = monthly.filter("month_num = 1").first()
    assert (january.order_count, january.total_quantity_sold, january.avg_order_value) == (1, 4, 12.5)


def test_literal_region_join_repeats_sales(spark, sales, customers):
    literal = marts.monthly_revenue_by_region_table(sales, star.dim_date(spark), star.dim_region(customers))
    february = literal.filter("month_num = 2 AND region_name = 'East'")
    assert {(r.country, r.total_sales_amount) for r in february.collect()} == {("US", 7.0), ("CA", 7.0)}


def test_vendor_without_sales_has_no_rate(spark, sales):
    vendors = spark.createDataFrame([("v1", "One"), ("v2", "Two")], "vendor_id string, vendor_name string")
    returns = spark.createDataFrame([("v1", "o1", 3.0, -2), ("v2", "o7", 1.0, None)],
                                    "vendor_id string, order_id string, refund_amount double, days_to_return int")
    rates = {r.vendor_id: r for r in marts.vendor_return_rate(sales, returns, vendors).collect()}
    assert (rates["v1"].total_orders_sold, rates["v1"].return_rate_pct) == (3, 33.33)
    assert rates["v1"].avg_days_to_return == -2.0
    assert rates["v2"].return_rate_pct is None and rates["v2"].total_returns == 1


def test_slow_movers_with_and_without_the_grid(spark, sales, customers):
    products = spark.createDataFrame([("p1", "One"), ("p2", "Two"), ("p3", "Three")], "product_id string, product_name string")
    for name in ("category", "sub_category", "brand"):
        products = products.withColumn(name, F.lit(None).cast("string"))
    days, regions = star.dim_date(spark), star.dim_region(customers)
    as_of = F.lit("2018-02-10").cast("date")
    sold = marts.slow_moving_products(sales, days, products, regions, as_of)
    assert {r.product_id for r in sold.collect()} == {"p1", "p2"}
    assert all(r.is_slow_mover for r in sold.collect())
    grid = marts.slow_moving_products(sales, days, products, regions, as_of, include_unsold=True)
    assert grid.count() == 6
    (none,) = grid.filter("product_id = 'p3' AND region_name = 'East'").collect()
    assert none.total_orders == 0 and none.last_sale_date is None and none.is_slow_mover


RETURN_DDL = ("customer_id string, order_id string, vendor_id string, region_name string, return_reason string, "
              "return_date string, refund_amount double, return_status string, is_approved boolean, days_to_return int")


def returned(customer, n, **change):
    row = {"customer_id": customer, "vendor_id": "v", "region_name": "East", "return_reason": "r",
           "return_date": "2018-05-01", "refund_amount": 10.0, "return_status": "Approved", "is_approved": True,
           "days_to_return": 3} | change
    names = [c.split()[0] for c in RETURN_DDL.split(", ")]
    return [tuple((row | {"order_id": f"{customer}-{i}"})[n] for n in names) for i in range(n)]


def test_risk_rules_and_score(spark):
    rows = (
        returned("heavy", 8, refund_amount=200.0, days_to_return=-1, is_approved=False, return_status="Rejected")
        + returned("calm", 2, return_date="2018-03-01")
        + returned("nulls", 1, days_to_return=None, refund_amount=None, return_date=None)
        + returned("roams", 1, region_name="A") + returned("roams", 1, region_name="B")
        + returned("roams", 1, region_name="C") + returned(None, 1)
    )
    facts = spark.createDataFrame(rows, RETURN_DDL)
    profile = return_risk.profiles(facts)
    people = spark.createDataFrame([("heavy", "H", "East", "Consumer"), ("heavy", "H", "West", "Consumer")],
                                   "customer_id string, customer_name string, region string, segment string")
    scores = return_risk.scored(return_risk.with_customers(profile, people))
    got = {r.customer_id: r for r in scores.collect()}
    assert set(got) == {"heavy", "calm", "nulls", "roams"}
    assert got["heavy"].anomaly_score == 85 and got["heavy"].is_flagged
    assert "rule_multi_region_returns" not in got["heavy"].rules_violated
    assert got["calm"].anomaly_score == 0 and got["calm"].rules_violated == []
    assert (got["calm"].returns_last_30d, got["heavy"].returns_last_7d) == (0, 8)
    assert got["nulls"].anomaly_score == 0 and got["nulls"].total_return_value == 0.0
    assert got["roams"].anomaly_score == 15
    (flagged,) = return_risk.flagged_customers(scores).collect()
    assert len(flagged) == 18 and flagged.total_return_value == 1600.0 and flagged.ai_investigation_brief
    (row,) = return_risk.threshold_sensitivity(scores).collect()
    assert (row.customers_scored, row.flagged, row.flagged_pct, row.additional_cases) == (4, 1, 25.0, 0)
    noted = return_risk.flagged_customers(scores, model=lambda p: "about heavy" if "heavy" in p else None)
    assert noted.first().ai_investigation_brief == "about heavy"


def test_scores_stay_in_range_and_do_not_depend_on_partitions(spark):
    rows = [r for i in range(30) for r in returned(f"c{i}", i % 11 + 1, refund_amount=33.33 * i, days_to_return=i - 9)]
    facts = spark.createDataFrame(rows, RETURN_DDL)
    seen = set()
    for parts in ("2", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        scores = return_risk.scored(return_risk.profiles(facts.repartition(int(parts))))
        seen.add(tuple(sorted(map(str, scores.collect()))))
        assert scores.filter("anomaly_score NOT BETWEEN 0 AND 100").count() == 0
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(seen) == 1


def test_marts_of_stored_sales_count_orders_apart_from_sums(spark):
    rows = [
        ("o1", "c1", 20180101, "East", "v1", "p1", 1.5, 1), ("o1", "c1", 20180101, "East", "v1", "p1", 2.0, 3),
        ("o2", "c1", 20180103, "East", "v1", "p1", None, None), (None, None, 20180104, "West", None, "p1", 4.0, 2),
        ("o3", "c2", None, None, "v2", "p2", 1 / 3, 1), (None, None, None, None, "v3", "p2", 9.0, 1),
    ]
    sales = spark.createDataFrame(
        rows, "order_id string, customer_id string, date_key int, region_name string, vendor_id string, product_id string, sales_amount double, quantity int")
    returns = spark.createDataFrame([("o1", "v1", 1.0, 3)], "order_id string, vendor_id string, refund_amount double, days_to_return int")
    vendors = spark.createDataFrame([(f"v{i}", f"V{i}") for i in range(5)], "vendor_id string, vendor_name string")
    products = spark.createDataFrame([("p1", "n", "a", "b", "c")], "product_id string, product_name string, category string, sub_category string, brand string")
    regions = spark.createDataFrame([("East", "US"), ("West", "US")], "region_name string, country string")
    days, today = star.dim_date(spark, "2018-01-01", "2018-12-31"), F.lit("2018-06-01").cast("date")

    def both(build):
        once, twice = (sorted(map(tuple, build(stored).collect()), key=repr) for stored in (False, True))
        assert once == twice and once
        return build(True)

    both(lambda stored: marts.vendor_return_rate(sales, returns, vendors, stored))
    slow = both(lambda stored: marts.slow_moving_products(sales, days, products, regions, today, stored=stored))
    # No sums are shuffled for a pair of group and order.
    plan = slow._jdf.queryExecution().executedPlan().toString().split("\n")
    assert not [x for x in plan if "Aggregate(keys=[product_id" in x and "order_id" in x and "sum(" in x]
