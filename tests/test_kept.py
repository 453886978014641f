"""Tables kept by key buckets, facts and marts that follow increments, safe refreshes and stored order."""

import json
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.exact import total
from tidemark.operators.ordered import stored_in_order
from tidemark.plans import deltas, marts, star
from tidemark.plans import entities as e
from tidemark.sources import tables
from tidemark.sources.kept import KeptTable, newest
from tidemark.sources.scratch import children
from tidemark.streaming import facts

SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("day", T.IntegerType()), T.StructField("note", T.StringType())])


def kept(spark, path, buckets=8):
    return KeptTable(spark, str(path), SCHEMA, ("id",), newest(["id"], F.col("day").desc_nulls_last()), buckets)


def batch(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_the_newest_row_wins_in_any_order_of_batches(spark, tmp_path):
    rng = random.Random(3)
    rows = [(f"k{rng.randrange(30)}", rng.choice([None, 1, 2, 3]), rng.choice("abc")) for _ in range(200)]
    whole = kept(spark, tmp_path / "whole")
    whole.upsert(batch(spark, rows), 0)
    expected = sorted(map(tuple, whole.read().collect()), key=repr)
    assert len(expected) == len({r[0] for r in rows})
    for r in expected:
        assert (r[1] or 0) == max(x[1] or 0 for x in rows if x[0] == r[0])
    for seed in (1, 2):
        rng.shuffle(rows)
        parts = kept(spark, tmp_path / f"parts{seed}")
        for n in range(4):
            parts.upsert(batch(spark, rows[n::4]), n)
        assert sorted(map(tuple, parts.read().collect()), key=repr) == expected


def test_an_upsert_rewrites_only_the_buckets_it_touches(spark, tmp_path):
    table = kept(spark, tmp_path / "t")
    table.upsert(batch(spark, [(f"k{i}", 1, "a") for i in range(100)]), 0)
    before = set(table.read().inputFiles())
    touched = table.touched(batch(spark, [("k1", 0, "")]))
    assert len(touched) == 1
    table.upsert(batch(spark, [("k1", 2, "b")]), 1)
    after = set(table.read().inputFiles())
    gone = before - after
    assert gone and all(f"bucket={touched[0]}/" in f for f in gone) and len(before & after) == len(before) - len(gone)
    # A look-up reads the one bucket, and the plan names no other folder.
    read = table.matching(batch(spark, [("k1", 0, "")]))
    assert all(f"__bucket={touched[0]}/" in f for f in read.inputFiles())
    assert read.where("id = 'k1'").first().note == "b" and read.count() < 100


def test_a_repeated_batch_changes_nothing_and_a_failed_one_neither(spark, tmp_path):
    table = kept(spark, tmp_path / "t")
    table.upsert(batch(spark, [("a", 1, "x"), ("b", 1, "x")]), 0)
    rows, files = table.read().collect(), table.read().inputFiles()
    table.upsert(batch(spark, [("a", 9, "other")]), 0)
    assert table.read().collect() == rows and table.read().inputFiles() == files
    broken = batch(spark, [("a", 2, "y")]).withColumn("note", F.raise_error(F.lit("broken off")).cast("string"))
    with pytest.raises(PySparkException):
        table.upsert(broken, 1)
    assert table.read().collect() == rows and not table.holds(1)
    table.upsert(batch(spark, [("a", 2, "y")]), 1)
    assert {(r.id, r.note) for r in table.read().collect()} == {("a", "y"), ("b", "x")}
    with pytest.raises(ValueError):
        kept(spark, tmp_path / "t").upsert(batch(spark, [("a", 3, "z")]), -1)
    # Folders that no reader can be on go.
    for n in range(2, 6):
        table.upsert(batch(spark, [("a", n + 1, str(n))]), n)
    assert len(children(spark, f"{tmp_path}/t/lists")) == 2
    assert {(r.id, r.note) for r in table.read().collect()} == {("a", "5"), ("b", "x")}


def test_a_bucket_is_not_written_by_one_task(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table = kept(spark, tmp_path / "t", 1)
        table.upsert(batch(spark, [(f"k{i}", 1, "a") for i in range(100)]), 0)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(table.read().inputFiles()) > 1 and table.read().count() == 100


def test_an_empty_table_and_an_empty_batch(spark, tmp_path):
    table = kept(spark, tmp_path / "t")
    assert table.read().count() == 0 and table.matching(batch(spark, [("a", 1, "")])).count() == 0
    table.upsert(batch(spark, []), 0)
    assert table.read().count() == 0 and table.holds(0)
    table.upsert(batch(spark, [(None, 1, "n"), (None, 2, "m")]), 1)
    assert [r.note for r in table.read().collect()] == ["m"]


# --- facts ---------------------------------------------------------------------------


ORDER = ("order_id", "customer_id", "vendor_id", "ship_mode", "order_status", "order_purchase_date")


def lookups(spark, path):
    return facts.kept_orders(spark, f"{path}/orders", e.ORDERS, 8), facts.kept_customers(spark, f"{path}/customers", e.CUSTOMERS, 8)


def some_orders(spark, kept_table, rows):
    df = spark.createDataFrame(rows, "order_id string, customer_id string, vendor_id string, ship_mode string, order_status string, day string")
    df = df.withColumn("order_purchase_date", F.col("day").cast("timestamp")).drop("day")
    for f in kept_table.schema:
        if f.name not in df.columns:
            df = df.withColumn(f.name, F.lit(None).cast(f.dataType))
    return df


def some_customers(spark, kept_table, rows):
    df = spark.createDataFrame(rows, "customer_id string, region string, country string")
    for f in kept_table.schema:
        if f.name not in df.columns:
            df = df.withColumn(f.name, F.lit(None).cast(f.dataType))
    return df


TXN = "order_id string, product_id string, sales double, quantity int, discount double, profit double, payment_type string, payment_installments int"


def sale(order, product="p1", amount=1.0):
    return (order, product, amount, 1, 0.0, 0.5, "voucher", 1)


def test_facts_of_increments_read_only_touched_buckets(spark, tmp_path):
    orders, customers = lookups(spark, tmp_path)
    customers.upsert(some_customers(spark, customers, [(f"c{i}", "East", "US") for i in range(50)]), 0)
    orders.upsert(some_orders(spark, orders, [(f"o{i}", f"c{i % 50}", "v1", "First Class", "delivered", "2018-01-01") for i in range(200)]), 0)
    new = spark.createDataFrame([sale("o7"), sale("o7", "p2"), sale("none"), sale(None)], TXN)
    found = facts.found_orders(new, orders, customers)
    touched = orders.touched(new.select(F.col("order_id").alias("__id")).where("__id IS NOT NULL"), ["__id"])
    used = {f for f in found.inputFiles() if "/orders/" in f}
    assert used and all(any(f"__bucket={b}/" in f for b in touched) for f in used)
    assert len([f for f in orders.read().inputFiles()]) > len(used)
    assert [r.order_id for r in found.collect()] == ["o7"]
    whole = star.fact_sales(new, orders.read(), customers.read())
    assert sorted(star.sales_rows(new, found).collect(), key=repr) == sorted(whole.collect(), key=repr)


def test_orders_are_dropped_before_the_shuffle_only_if_that_drops_enough(spark, tmp_path):
    orders, customers = lookups(spark, tmp_path)
    customers.upsert(some_customers(spark, customers, [("c1", "East", "US"), ("c2", "West", "CA")]), 0)
    orders.upsert(some_orders(spark, orders, [(f"o{i}", f"c{i % 3}", "v1", "First Class", "delivered", "2018-01-01") for i in range(40)]), 0)
    few = spark.createDataFrame([sale("o1"), sale("none")], TXN)
    many = spark.createDataFrame([sale(f"o{i % 30}", f"p{i}") for i in range(60)] + [sale(None), sale("none")], TXN)
    for rows, dropped in ((few, True), (many, False)):
        found = facts.found_orders(rows, orders, customers)
        assert ("LeftSemi" in found._jdf.queryExecution().optimizedPlan().toString()) == dropped
        whole = star.fact_sales(rows, orders.read(), customers.read())
        assert sorted(star.sales_rows(rows, found).collect(), key=repr) == sorted(whole.collect(), key=repr)


def test_fact_stream_over_two_increments_equals_a_rebuild(spark, tmp_path):
    orders, customers = lookups(spark, tmp_path)
    customers.upsert(some_customers(spark, customers, [("c1", "East", "US"), ("c2", "West", "CA")]), 0)
    orders.upsert(some_orders(spark, orders, [("o1", "c1", "v1", "First Class", "created", "2018-01-01"), ("o2", "c2", "v1", "First Class", "created", "2018-01-02")]), 0)
    schema = spark.createDataFrame([], TXN).schema

    def run():
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        facts.append_kept_fact(star.sales_rows, stream, orders, customers, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
        return sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out").drop(facts.BATCH).collect()), key=repr)

    spark.createDataFrame([sale("o1"), sale("o3")], TXN).write.mode("append").parquet(f"{tmp_path}/in")
    first = run()
    assert len(first) == 2 and run() == first
    # A newer copy of one order, and a late order.
    orders.upsert(some_orders(spark, orders, [("o1", "c2", "v2", "Same Day", "delivered", "2018-03-01"), ("o3", "c1", "v3", "Same Day", "created", "2018-01-01")]), 1)
    spark.createDataFrame([sale("o1", "p9"), sale("o3", "p9")], TXN).write.mode("append").parquet(f"{tmp_path}/in")
    second = run()
    assert len(second) == 4 and set(first) < set(second)
    added = {r[2]: r for r in second if r not in first}
    names = spark.read.parquet(f"{tmp_path}/out").drop(facts.BATCH).columns
    rows = [dict(zip(names, r, strict=True)) for r in second if r not in first]
    assert added and {(r["order_id"], r["vendor_id"], r["region_name"]) for r in rows} == {("o1", "v2", "West"), ("o3", "v3", "East")}


# --- marts by deltas ----------------------------------------------------------------------


def some_facts(spark, seed, n=300):
    rng = random.Random(seed)
    rows = [(
        f"o{(o := rng.randrange(60))}" if rng.random() < 0.95 else None, f"c{o % 7}" if o % 11 else None, 20180100 + o % 28 + 1 if o % 13 else None,
        rng.choice(["East", "West"]) if o % 5 else None, f"v{o % 4}" if o % 9 else None, f"p{rng.randrange(9)}",
        rng.choice([0.01, 1 / 3, 2.5, None]), rng.randrange(9), 0.1, 1e-3,
    ) for _ in range(n)]
    return spark.createDataFrame(
        rows, "order_id string, customer_id string, date_key int, region_name string, vendor_id string, product_id string, "
        "sales_amount double, quantity int, discount double, profit double")


def rows_of(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)


def test_marts_of_three_increments_equal_full_ones(spark, tmp_path):
    sales = some_facts(spark, 5).cache()
    days = star.dim_date(spark, "2018-01-01", "2018-12-31")
    people = spark.createDataFrame([(f"c{i}", "US" if i % 2 else "CA") for i in range(6)], "customer_id string, country string")
    vendors = spark.createDataFrame([(f"v{i}", f"V{i}") for i in range(5)], "vendor_id string, vendor_name string")
    products = spark.createDataFrame([(f"p{i}", "n", "a", "b", "c") for i in range(9)], "product_id string, product_name string, category string, sub_category string, brand string")
    regions = spark.createDataFrame([("East", "US"), ("West", "US")], "region_name string, country string")
    returns = sales.select(
        "order_id", "customer_id", "vendor_id", F.col("sales_amount").alias("refund_amount"), (F.col("quantity") - 3).alias("days_to_return"),
        (F.col("quantity") > 4).alias("is_approved"), F.lit("2018-02-03").alias("return_date"))
    names = people.select("customer_id", *[F.lit("x").alias(c) for c in ("customer_name", "customer_email", "segment", "region")], "country")
    state = deltas.KeptMarts(spark, str(tmp_path), 4)
    today = F.lit("2018-06-01").cast("date")
    for n in range(3):
        # The same orders turn up in every increment.
        state.add_sales(sales.where(F.col("quantity") % 3 == n), days, people, n)
        state.add_returns(returns.where(F.pmod(F.col("days_to_return"), F.lit(3)) == n), n)
        # A repeated batch changes nothing, whatever it brings.
        state.add_sales(sales, days, people, n)
        state.add_returns(returns, n)
    assert rows_of(state.monthly_revenue()) == rows_of(marts.monthly_revenue(sales, days, people))
    assert rows_of(state.vendor_return_rate(vendors)) == rows_of(marts.vendor_return_rate(sales, returns, vendors))
    assert rows_of(state.slow_moving_products(products, regions, today)) == rows_of(marts.slow_moving_products(sales, days, products, regions, today))
    assert rows_of(state.customer_return_history(names)) == rows_of(marts.customer_return_history(returns, names))


def test_a_batch_cut_off_between_its_two_tables_is_taken_in_once(spark, tmp_path):
    groups = deltas.KeptGroups(spark, str(tmp_path), deltas.vendor_sold_groups(), 4)
    first = spark.createDataFrame([("v1", "o1", 1.0), ("v1", "o2", 1.0)], "vendor_id string, order_id string, sales_amount double")
    second = spark.createDataFrame([("v1", "o2", 1.0), ("v1", "o3", 1.0), (None, "o3", 2.0), ("v1", None, 4.0)], first.schema)
    groups.add(first, 0)
    seen, groups.seen = groups.seen, type("Broken", (), {"holds": lambda *a: False, "matching": groups.seen.matching, "upsert": lambda *a: 1 / 0})()
    with pytest.raises(ZeroDivisionError):
        groups.add(second, 1)
    groups.seen = seen
    groups.add(second, 1)
    groups.add(second, 1)
    found = {r.vendor_id: (float(r.revenue), r.orders) for r in groups.read().collect()}
    assert found == {"v1": (8.0, 3), None: (2.0, 1)}
    assert float(first.unionByName(second).agg(total(F.col("sales_amount"))).first()[0]) == 10.0


def test_an_increment_does_not_read_earlier_facts(spark, tmp_path):
    groups = deltas.KeptGroups(spark, f"{tmp_path}/state", deltas.vendor_sold_groups(), 4)
    facts_path = f"{tmp_path}/facts"
    for n in range(2):
        rows = [(f"v{i % 3}", f"o{i}", 1.0) for i in range(n, 20)]
        spark.createDataFrame(rows, "vendor_id string, order_id string, sales_amount double").write.parquet(f"{facts_path}/batch={n}")
    groups.add(spark.read.parquet(f"{facts_path}/batch=0"), 0)
    import shutil
    shutil.move(f"{facts_path}/batch=0", f"{tmp_path}/away")
    groups.add(spark.read.parquet(f"{facts_path}/batch=1"), 1)
    assert {r.vendor_id: r.orders for r in groups.read().collect()} == {"v0": 7, "v1": 7, "v2": 6}


def test_new_pairs_are_written_beside_the_old_ones(spark, tmp_path):
    groups = deltas.KeptGroups(spark, str(tmp_path), deltas.vendor_sold_groups(), 2)
    schema = "vendor_id string, order_id string, sales_amount double"
    for n in range(20):
        before = set(groups.seen.read().inputFiles())
        rows = [("v1", f"o{i}", 1.0) for i in range(n * 5, n * 5 + 10)] + [(None, "o1", 1.0)]
        groups.add(spark.createDataFrame(rows, schema), n)
        after = groups.seen.read()
        if n < 10:
            assert before <= set(after.inputFiles())
        assert after.count() == 5 * n + 11
    # A bucket does not lie in ever more folders.
    assert all(len(found) <= 17 for found in groups.seen._places().values())
    assert {r.vendor_id: (float(r.revenue), r.orders) for r in groups.read().collect()} == {"v1": (200.0, 105), None: (20.0, 1)}


# --- refresh and order ------------------------------------------------------------------------


def test_refresh_keeps_old_rows_until_the_new_ones_are_complete(spark, tmp_path):
    root = f"{tmp_path}/quo`ted path"
    tables.refresh_table(spark.range(5), "refreshed_once", root)
    open_reader = spark.read.table("refreshed_once")
    broken = spark.range(9).withColumn("id", F.when(F.col("id") == 7, F.raise_error(F.lit("x")).cast("long")).otherwise(F.col("id")))
    with pytest.raises(PySparkException):
        tables.refresh_table(broken, "refreshed_once", root)
    assert spark.read.table("refreshed_once").count() == 5
    tables.refresh_table(spark.range(3).withColumn("x", F.lit(1)), "refreshed_once", root, ["x", "id"])
    assert spark.read.table("refreshed_once").columns == ["x", "id"] and spark.read.table("refreshed_once").count() == 3
    assert open_reader.count() == 5
    for n in range(3):
        tables.refresh_table(spark.range(n), "refreshed_once", root)
    assert len(children(spark, root)) == 2 and spark.read.table("refreshed_once").count() == 2
    spark.sql("DROP VIEW refreshed_once")


def test_stored_order_has_gapless_ranks_without_a_single_task(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(50) if rng.random() < 0.9 else None, rng.choice("ab"), n) for n in range(2000)]
    df = spark.createDataFrame(rows, "a int, b string, n int").repartition(7)
    placed = stored_in_order(df, [F.desc("a"), F.asc("b")])
    found = sorted(placed.collect(), key=lambda r: r.report_rank)
    assert [r.report_rank for r in found] == list(range(1, 2001)) and {(r.a, r.b, r.n) for r in found} == set(rows)
    keys = [(r.a is None, -(r.a or 0), r.b) for r in found]
    assert keys == sorted(keys)
    assert "Window" not in placed._jdf.queryExecution().executedPlan().toString()
    again = stored_in_order(df.repartition(3), [F.desc("a"), F.asc("b")]).collect()
    assert {(r.n, r.report_rank) for r in again} == {(r.n, r.report_rank) for r in found}
    assert stored_in_order(df.limit(0), [F.asc("a")]).count() == 0


def test_pages_stay_within_their_size_with_one_hot_value(spark):
    from tidemark.operators.points import paged_points

    rows = [("hot" if n % 3 else f"r{n}", None if n % 10 == 0 else str(n)) for n in range(1000)]
    df = spark.createDataFrame(rows, "region string, v string")
    pages = sorted(paged_points(df, {"region": F.col("region"), "v": F.col("v")}, 64).collect(), key=lambda r: r.page)
    assert [p.page for p in pages] == list(range(1, 17)) and all(p.point_count == 64 for p in pages[:-1]) and pages[-1].point_count == 40
    points = [(p["region"], p.get("v")) for page in pages for p in json.loads(page.points_json)]
    assert sorted(points, key=repr) == sorted(rows, key=repr)
    assert points == sorted(points, key=lambda p: (p[0], p[1] is not None, p[1] or ""))
    assert paged_points(df.limit(0), {"region": F.col("region")}, 5).count() == 0
