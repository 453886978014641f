"""Queries that run streams: landing files to bronze, bronze to silver, silver to facts.

Each writes the whole source table to a fresh folder in the shared checkpoint
folder, streams it, and returns the stored result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import replace

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions import columns as c
from tidemark.operators.exact import money_sum
from tidemark.operators import quality
from tidemark.plans import deltas
from tidemark.plans import entities as e
from tidemark.plans import silver as silver_plans
from tidemark.plans import star
from tidemark.sources.kept import KeptTable
from tidemark.sources.scratch import exists, move, new_folder
from tidemark.streaming import bronze, facts, silver
from tidemark.workload import gold_queries as gold
from tidemark.workload import inputs
from tidemark.workload.inputs import Tables
from tidemark.workload.model_sql import RULES, clean_body, money_total, with_ctes
from tidemark.workload.registry import query
from tidemark.workload.silver_queries import comparable

# Spark names its own output files, so the trial looks for those names.
_CSV_CUSTOMERS = replace(e.CUSTOMERS, file_glob="part-*.csv")
_CSV_TRANSACTIONS = replace(e.TRANSACTIONS, file_glob="part-*.csv")
_JSON_RETURNS = replace(e.RETURNS, file_glob="part-*.txt")


def _csv(df: DataFrame, folder: str) -> None:
    df.write.option("header", True).csv(folder)


def _run(spark: SparkSession, root: str, entity: e.Entity, **options) -> str:
    target = f"{root}/bronze"
    bronze.ingest(spark, f"{root}/landing", target, f"{root}/checkpoint", entity, **options).awaitTermination()
    return target


@query("""SELECT CAST(c_custkey AS VARCHAR) customer_id, c_name customer_name, c_mktsegment segment,
    lpad(CAST(c_custkey AS VARCHAR), 9, '0') postal_code, CAST(c_acctbal AS DECIMAL(18,2))::VARCHAR balance,
    CASE WHEN c_nationkey % 2 = 1 THEN 'b' || c_custkey END "Birth Date",
    CASE WHEN c_nationkey % 2 = 0 THEN '1' ELSE '4' END _region
    FROM customer""")
def bronze_csv_stream(t: Tables) -> DataFrame:
    """Two regions with different headers, the second with a new column and in a second run."""
    root = new_folder(t.spark, "csv")
    key = F.col("c_custkey").cast("string")
    zip_code = F.lpad(key, 9, "0").alias("postal_code")
    balance = F.col("c_acctbal").cast("decimal(18,2)").cast("string").alias("balance")
    first = t.customer.filter("c_nationkey % 2 = 0").select(
        key.alias("CustomerID"), F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("segment"), zip_code, balance)
    second = t.customer.filter("c_nationkey % 2 = 1").select(
        balance, key.alias("customer_identifier"), F.concat(F.lit("b"), key).alias("Birth Date"),
        F.col("c_name").alias("full_name"), F.col("c_mktsegment").alias("CUSTOMER_SEGMENT"), zip_code)
    _csv(first, f"{root}/landing/Region 1")
    _run(t.spark, root, _CSV_CUSTOMERS)
    _csv(second, f"{root}/landing/new/region4")
    rows = bronze.read_bronze(t.spark, _run(t.spark, root, _CSV_CUSTOMERS))
    return rows.select(
        c.merge_variants(rows, ["customer_id", "CustomerID", "customer_identifier"]).alias("customer_id"),
        c.merge_variants(rows, ["customer_name", "full_name"]).alias("customer_name"),
        c.merge_variants(rows, ["segment", "customer_segment"]).alias("segment"),
        "postal_code",
        "balance",
        "Birth Date",
        "_region",
    )


@query(f"""SELECT CAST(l_orderkey AS VARCHAR) order_id, CAST(l_partkey AS VARCHAR) product_id, count(*) AS line_count,
    {money_total('l_extendedprice')} sales, CAST(sum(l_quantity) AS BIGINT) quantity
    FROM lineitem GROUP BY ALL""")
def bronze_rescue_stream(t: Tables) -> DataFrame:
    """Files whose id headers are unknown: the ids are rescued as JSON and recovered in silver."""
    root = new_folder(t.spark, "rescue")
    price = F.concat(F.lit("$"), F.col("l_extendedprice").cast("decimal(18,2)").cast("string"))
    quantity = F.col("l_quantity").cast("int").alias("Quantity")
    known = ["Order_ID", "Product_ID"]
    odd = replace(_CSV_TRANSACTIONS, columns=("Sales", "Quantity"))
    _csv(t.lineitem.select(F.col("l_orderkey").alias("Order_id"), F.col("l_partkey").alias("Product_id"),
                           price.alias("Sales"), quantity), f"{root}/landing")
    rows = bronze.read_bronze(t.spark, _run(t.spark, root, odd, evolution="rescue"))
    sold = silver_plans.transactions(c.with_missing(rows, {n: "string" for n in known}))
    return sold.groupBy("order_id", "product_id").agg(
        F.count("*").alias("line_count"),
        money_sum(F.col("sales")).cast("double").alias("sales"),
        F.sum("quantity").alias("quantity"),
    )


def json_arrays(df: DataFrame) -> DataFrame:
    """Rows as lines that make each written partition one JSON array."""
    return json_lines(df.select(F.to_json(F.struct("*")).alias("value")))


def json_lines(df: DataFrame) -> DataFrame:
    """Lines of objects that make each written partition one JSON array."""

    def bracket(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lead = "["
        for batch in batches:
            if len(batch):
                lines = "," + batch["value"]
                lines.iloc[0] = lead + batch["value"].iloc[0]
                lead = ","
                yield lines.to_frame()
        yield pd.DataFrame({"value": ["]" if lead == "," else "[]"]})

    return df.select("value").mapInPandas(bracket, "value string")


@query(with_ctes(("returned_orders",), """
    SELECT CAST(k AS VARCHAR) order_id, CAST(refund AS VARCHAR) refund_amount, 'r' || k % 3 reason,
           CASE WHEN k % 2 = 0 THEN 'global' ELSE '6' END _region
    FROM returned_orders"""))
def bronze_json_stream(t: Tables) -> DataFrame:
    """Returns as JSON arrays under two sets of names; number text is kept as written."""
    root = new_folder(t.spark, "json")
    key = F.col("l_orderkey")
    reason = F.concat(F.lit("r"), (key % 3).cast("string"))
    rows = inputs._returned_orders(t)
    plain = rows.filter(key % 2 == 0).select(
        key.cast("string").alias("OrderId"), F.col("refund").alias("amount"), reason.alias("reason"))
    regional = rows.filter(key % 2 == 1).select(
        key.cast("string").alias("order_id"), F.col("refund").cast("string").alias("refund_amount"),
        reason.alias("return_reason"))
    json_arrays(plain).write.text(f"{root}/landing/all")
    json_arrays(regional).write.text(f"{root}/landing/Region 6")
    out = bronze.read_bronze(t.spark, _run(t.spark, root, _JSON_RETURNS))
    return out.select(
        c.merge_variants(out, ["OrderId", "order_id"]).alias("order_id"),
        c.merge_variants(out, ["amount", "refund_amount"]).alias("refund_amount"),
        c.merge_variants(out, ["reason", "return_reason"]).alias("reason"),
        "_region",
    )


@query("""SELECT CAST(o_orderkey AS VARCHAR) order_id, CASE WHEN o_custkey % 11 <> 0 THEN CAST(o_custkey AS VARCHAR) END customer_id,
    o_orderpriority ship_mode, o_orderstatus order_status, strftime(o_orderdate, '%m/%d/%Y %H:%M') order_purchase_date,
    CASE WHEN o_orderkey % 3 = 0 THEN 'global' ELSE CAST(o_orderkey % 3 AS VARCHAR) END _region FROM orders""")
def bronze_orders_stream(t: Tables) -> DataFrame:
    """Orders of two regions and of none, taken a few files at a time."""
    root = new_folder(t.spark, "orders")
    key = F.col("o_orderkey")
    rows = t.orders.select(
        key.cast("string").alias("order_id"),
        F.when(F.col("o_custkey") % 11 != 0, F.col("o_custkey").cast("string")).alias("customer_id"),
        F.col("o_orderpriority").alias("Ship_Mode"), F.col("o_orderstatus").alias("order_status"),
        F.date_format("o_orderdate", "MM/dd/yyyy HH:mm").alias("order_purchase_date"), (key % 3).alias("part"))
    for part, folder in ((0, "all"), (1, "Region 1"), (2, "deep/REGION2")):
        _csv(rows.where(F.col("part") == part).drop("part"), f"{root}/landing/{folder}")
    entity = replace(e.ORDERS, file_glob="part-*.csv")
    return bronze.read_bronze(t.spark, _run(t.spark, root, entity, max_files=2)).select(
        "order_id", "customer_id", "ship_mode", "order_status", "order_purchase_date", "_region")


@query("""SELECT CAST(p_partkey AS VARCHAR) product_id, p_name product_name, '0' || p_partkey || '.50' upc,
    '["' || p_brand || '","' || p_type || '"]' categories, CASE WHEN p_size % 4 <> 0 THEN CAST(p_size AS VARCHAR) END sizes FROM part""")
def bronze_products_stream(t: Tables) -> DataFrame:
    """Products as JSON arrays: names in two spellings, numbers as written, a list kept as JSON, and gaps."""
    root = new_folder(t.spark, "products")
    number, name = F.col("p_partkey").cast("string"), F.to_json(F.struct(F.col("p_name").alias("n")))
    name = F.substring(name, F.lit(6), F.length(name) - 6)
    lists = F.concat(F.lit('["'), "p_brand", F.lit('","'), "p_type", F.lit('"]'))
    size = F.when(F.col("p_size") % 4 != 0, F.concat(F.lit(',"sizes":'), F.col("p_size").cast("string"))).otherwise("")

    def written(head: str) -> Column:
        return F.concat(F.lit(head), number, F.lit(',"product_name":'), name, F.lit(',"categories":'), lists, size,
                        F.lit(',"upc":"0'), number, F.lit('.50"}'))

    spelled = F.when(F.col("p_partkey") % 2 == 0, written('{"product_id":')).otherwise(written('{"Product_ID":'))
    json_lines(t.part.select(spelled.alias("value"))).write.text(f"{root}/landing")
    rows = bronze.read_bronze(t.spark, _run(t.spark, root, replace(e.PRODUCTS, file_glob="part-*.txt")))
    return rows.select("product_id", "product_name", "upc", "categories", "sizes")


@query("""SELECT CAST(s_suppkey AS VARCHAR) vendor_id, s_name vendor_name, CASE WHEN s_suppkey % 2 = 0 THEN CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS VARCHAR) END balance, 'global' _region
    FROM supplier""")
def bronze_vendors_stream(t: Tables) -> DataFrame:
    """Vendors, half of them in a file with a column that the entity does not name."""
    root = new_folder(t.spark, "vendors")
    rows = t.supplier.select(F.col("s_suppkey").alias("Vendor_ID"), F.col("s_name").alias("vendor_name"), F.col("s_acctbal").cast("decimal(18,2)").cast("string").alias("balance"))
    even = F.col("Vendor_ID") % 2 == 0
    _csv(rows.where(even), f"{root}/landing/a")
    _csv(rows.where(~even).select("vendor_name", "Vendor_ID"), f"{root}/landing/b")
    out = bronze.read_bronze(t.spark, _run(t.spark, root, replace(e.VENDORS, file_glob="part-*.csv")))
    return out.select("vendor_id", "vendor_name", "balance", "_region")


def _stored(df: DataFrame, spark: SparkSession, purpose: str) -> tuple[str, str]:
    """The frame as a table in a fresh folder; also the folder's root."""
    root = new_folder(spark, purpose)
    df.write.parquet(f"{root}/in")
    return root, f"{root}/in"


@query(with_ctes(("std_transactions",), clean_body("transactions")))
def silver_transactions_stream(t: Tables) -> DataFrame:
    root, source = _stored(inputs.raw_transactions(t), t.spark, "silver")
    silver.refine(t.spark, source, f"{root}/silver", f"{root}/cp", e.TRANSACTIONS).awaitTermination()
    return comparable(quality.clean_rows(t.spark.read.parquet(f"{root}/silver")))


@query(gold.FACT_SALES_SQL)
def fact_sales_stream(t: Tables) -> DataFrame:
    root, source = _stored(inputs.tidy_transactions(t), t.spark, "sales")
    rows = t.spark.readStream.schema(t.spark.read.parquet(source).schema).parquet(source)
    facts.append_fact(
        star.fact_sales, rows, inputs.tidy_orders(t), inputs.tidy_customers(t), f"{root}/out", f"{root}/cp"
    ).awaitTermination()
    return gold.local_stamps(t.spark.read.parquet(f"{root}/out"))


@query(gold.FACT_RETURNS_SQL)
def fact_returns_stream(t: Tables) -> DataFrame:
    root, source = _stored(inputs.tidy_returns(t), t.spark, "returns")
    rows = t.spark.readStream.schema(t.spark.read.parquet(source).schema).parquet(source)
    facts.append_fact(
        star.fact_returns, rows, inputs.tidy_orders(t), inputs.tidy_customers(t), f"{root}/out", f"{root}/cp"
    ).awaitTermination()
    return t.spark.read.parquet(f"{root}/out")


def _passed(entity: str) -> str:
    return " AND ".join(f"coalesce({r}, FALSE)" for r in RULES[entity].values())


@query(with_ctes(("std_transactions", "std_orders", "std_customers", "dim_date"), f"""
    , sold AS (SELECT * FROM std_transactions WHERE {_passed('transactions')}),
    good AS (SELECT * FROM std_orders WHERE {_passed('orders')}),
    people AS (SELECT * FROM std_customers WHERE {_passed('customers')})
    SELECT d.year, d.month_num, c.region region_name, count(DISTINCT o.order_id) order_count,
           {money_total('s.sales')} total_sales_amount
    FROM sold s JOIN good o ON s.order_id = o.order_id JOIN people c ON o.customer_id = c.customer_id
    JOIN dim_date d ON CAST(o.order_purchase_date AS DATE) = d.full_date
    GROUP BY ALL"""))
def lakehouse_monthly_revenue(t: Tables) -> DataFrame:
    """The whole way: raw rows through the silver stream and the fact stream to the mart."""
    root, source = _stored(inputs.raw_transactions(t), t.spark, "lakehouse")
    silver.refine(t.spark, source, f"{root}/silver", f"{root}/cp-silver", e.TRANSACTIONS).awaitTermination()
    orders = _clean(t, "orders")
    customers = _clean(t, "customers")
    rows = silver.follow_clean(t.spark, f"{root}/silver", e.TRANSACTIONS)
    facts.append_fact(
        star.fact_sales, rows, orders, customers, f"{root}/fact_sales", f"{root}/cp-fact"
    ).awaitTermination()
    sales = t.spark.read.parquet(f"{root}/fact_sales")
    days = star.dim_date(t.spark).select("date_key", "year", "month_num")
    return (
        sales.filter("date_key IS NOT NULL AND region_name IS NOT NULL")
        .join(days, "date_key")
        .groupBy("year", "month_num", "region_name")
        .agg(
            F.count_distinct("order_id").alias("order_count"),
            money_sum(F.col("sales_amount")).cast("double").alias("total_sales_amount"),
        )
    )


def _clean(t: Tables, entity: str) -> DataFrame:
    raw = inputs.RAW[entity](t)
    return quality.keep_valid(silver_plans.STANDARDISE[entity](raw), e.ENTITIES[entity].rules)


# --- increments -----------------------------------------------------------------

# The model is small; a bucket of a large table has to fit a task.
BUCKETS = 4


def _old_copies(orders: DataFrame) -> DataFrame:
    """The same orders as they were a day before, with another status, ship mode and vendor."""
    day = F.expr("INTERVAL 1 DAY")
    return orders.withColumns({
        "order_purchase_date": F.col("order_purchase_date") - day,
        "order_status": F.lit("processing"),
        "ship_mode": F.lit("Same Day"),
        "vendor_id": F.lit("0"),
    })


def _kept(t: Tables, root: str) -> tuple[KeptTable, KeptTable]:
    """Look-ups after two increments: odd orders have an older copy in the first, even ones in the second."""
    orders = facts.kept_orders(t.spark, f"{root}/orders", e.ORDERS, BUCKETS)
    customers = facts.kept_customers(t.spark, f"{root}/customers", e.CUSTOMERS, BUCKETS)
    # Both increments read the same orders, which are computed and written once.
    inputs.tidy_orders(t).write.option("compression", "zstd").parquet(f"{root}/good-orders")
    good = t.spark.read.parquet(f"{root}/good-orders")
    odd = F.col("order_id").cast("long") % 2 == 1
    customers.upsert(inputs.tidy_customers(t), 0)
    orders.upsert(_old_copies(good.where(odd)).unionByName(good.where(~odd)), 0, f"{root}/good-orders")
    orders.upsert(good.where(odd).unionByName(_old_copies(good.where(~odd))), 1, f"{root}/good-orders")
    return orders, customers


_LATER = "__later"


def _in_two(rows: DataFrame, second: Column, root: str, run: Callable[[DataFrame], StreamingQuery]) -> None:
    """Stream ``rows`` in two runs, those for which ``second`` holds later; a third run finds nothing new.

    ``rows`` are computed and written once, as two folders; each is moved to the source when its run comes.
    """
    spark, source, staged = rows.sparkSession, f"{root}/in", f"{root}/parts"
    rows.withColumn(_LATER, second).write.partitionBy(_LATER).option("compression", "zstd").parquet(staged)

    def stream() -> None:
        # The parts are plain folders in the source, not partitions.
        read = spark.readStream.schema(rows.schema).option("recursiveFileLookup", "true")
        run(read.parquet(source)).awaitTermination()

    for part in ("false", "true"):
        if exists(spark, f"{staged}/{_LATER}={part}"):
            move(spark, f"{staged}/{_LATER}={part}", f"{source}/{part}")
        else:
            spark.createDataFrame([], rows.schema).write.parquet(f"{source}/{part}")
        stream()
    stream()


def _sales_in_increments(t: Tables) -> str:
    root = new_folder(t.spark, "sales-increments")
    orders, customers = _kept(t, root)
    rows = inputs.tidy_transactions(t)
    _in_two(
        rows, F.coalesce(F.col("quantity") % 2 == 1, F.lit(False)), root,
        lambda stream: facts.append_kept_fact(star.sales_rows, stream, orders, customers, f"{root}/out", f"{root}/cp"),
    )
    return f"{root}/out"


def _returns_in_increments(t: Tables) -> str:
    root = new_folder(t.spark, "returns-increments")
    orders, customers = _kept(t, root)
    rows = inputs.tidy_returns(t)
    _in_two(
        rows, F.coalesce(F.length("return_reason") % 2 == 1, F.lit(False)), root,
        lambda stream: facts.append_kept_fact(star.return_rows, stream, orders, customers, f"{root}/out", f"{root}/cp"),
    )
    return f"{root}/out"


@query(gold.FACT_SALES_SQL)
def fact_sales_increments(t: Tables) -> DataFrame:
    """Sales in two increments over look-ups kept in two upserts; the newest copy of an order counts."""
    return gold.local_stamps(t.spark.read.parquet(_sales_in_increments(t)).drop(facts.BATCH))


@query(gold.FACT_RETURNS_SQL)
def fact_returns_increments(t: Tables) -> DataFrame:
    return t.spark.read.parquet(_returns_in_increments(t)).drop(facts.BATCH)


def _kept_marts(t: Tables, sales: bool, returns: bool) -> deltas.KeptMarts:
    """Marts that took in all facts in two batches each, cut across orders, customers and vendors."""
    root = new_folder(t.spark, "kept-marts")
    kept = deltas.KeptMarts(t.spark, root, BUCKETS)
    if sales:
        days, people = star.dim_date(t.spark), gold.customers(t)
        _in_two(
            gold.all_sales(t).select(*deltas.SALES_COLUMNS), F.coalesce(F.col("quantity") % 2 == 1, F.lit(False)), f"{root}/sales",
            lambda stream: deltas.follow(stream, lambda new, n: kept.add_sales(new, days, people, n), f"{root}/sales/cp"),
        )
    if returns:
        _in_two(
            gold.returns(t).select(*deltas.RETURNS_COLUMNS), F.coalesce(F.col("days_to_return") % 2 == 1, F.lit(False)), f"{root}/returns",
            lambda stream: deltas.follow(stream, kept.add_returns, f"{root}/returns/cp"),
        )
    return kept


@query(with_ctes(("fact_sales", "dim_date"), gold.MONTHLY_BODY))
def monthly_revenue_by_deltas(t: Tables) -> DataFrame:
    return _kept_marts(t, True, False).monthly_revenue()


@query(with_ctes(("fact_returns", "customers"), gold.CUSTOMER_RETURNS_SQL))
def customer_returns_by_deltas(t: Tables) -> DataFrame:
    return _kept_marts(t, False, True).customer_return_history(gold.customers(t))


@query(with_ctes(("fact_sales", "fact_returns", "vendors"), f", {gold.VENDOR_RATE_CTE} SELECT * FROM vendor_rate"))
def vendor_rate_by_deltas(t: Tables) -> DataFrame:
    return _kept_marts(t, True, True).vendor_return_rate(star.dim_vendor(inputs.tidy_vendors(t)))


@query(with_ctes(("fact_sales", "products"), f", {gold.SLOW_CTE} SELECT * FROM slow"))
def slow_products_by_deltas(t: Tables) -> DataFrame:
    return _kept_marts(t, True, False).slow_moving_products(
        star.dim_product(inputs.tidy_products(t)), star.dim_region(inputs.tidy_customers(t)), F.lit(gold.AS_OF).cast("date")
    )
