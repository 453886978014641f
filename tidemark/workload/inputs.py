"""The retail model laid over the driver's tables.

``tidy_*`` frames look like clean silver tables and feed the star schema.
``raw_*`` frames carry the spellings, formats and gaps that the silver plans
repair; which row gets which defect follows from its key. All rows of the
source tables are used.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.quality import keep_valid
from tidemark.plans.entities import ENTITIES
from tidemark.sources.scratch import new_folder

RAW_LOADED = "2024-01-01 00:00:00"


class Tables:
    """The driver's parquet tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._read: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._read[name]

    def stored(self, name: str, build: Callable[[Tables], DataFrame]) -> DataFrame:
        """The table ``name``, written once to the shared folder as a pipeline would keep it.

        For tables that a query uses more than once.
        """
        if name not in self._read:
            path = new_folder(self.spark, name)
            build(self).write.parquet(path)
            self._read[name] = self.spark.read.parquet(path)
        return self._read[name]


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def _switch(key: Column, *cases: Column | str | None) -> Column:
    """Case number ``key``; texts are literals."""
    out = F.lit(None).cast("string")
    chain = None
    for i, value in enumerate(cases):
        value = value if isinstance(value, Column) else F.lit(value).cast("string")
        chain = F.when(key == i, value) if chain is None else chain.when(key == i, value)
    return chain.otherwise(out)


def _lookup(value: Column, pairs: dict[str, str]) -> Column:
    chain = None
    for a, b in pairs.items():
        chain = F.when(value == a, b) if chain is None else chain.when(value == a, b)
    return chain


def modern(day: Column) -> Column:
    """Dates of the tables, 1995 to 2001, moved into the years of the date dimension."""
    return day + F.expr("INTERVAL 15 YEARS")


def places(t: Tables) -> DataFrame:
    """Customers with nation and region."""
    where = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return t.customer.join(where, F.col("c_nationkey") == F.col("n_nationkey"))


# --- tidy model -------------------------------------------------------------


def tidy_customers(t: Tables) -> DataFrame:
    return places(t).select(
        _text("c_custkey").alias("customer_id"),
        F.concat(F.lit("c"), _text("c_custkey"), F.lit("@example.com")).alias("customer_email"),
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("n_name").alias("country"),
        F.concat(F.lit("city "), "n_name").alias("city"),
        F.concat(F.lit("state "), "r_name").alias("state"),
        F.lpad((F.col("c_custkey") % 100000).cast("string"), 5, "0").alias("postal_code"),
        F.col("r_name").alias("region"),
    )


def tidy_vendors(t: Tables) -> DataFrame:
    return t.supplier.select(_text("s_suppkey").alias("vendor_id"), F.col("s_name").alias("vendor_name"))


def tidy_products(t: Tables) -> DataFrame:
    none = F.lit(None).cast("string")
    return t.part.select(
        _text("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.when(F.col("p_size") > 3, F.concat_ws(" > ", "p_type", "p_name"))
        .otherwise(F.col("p_type"))
        .alias("categories"),
        F.col("p_brand").alias("brand"),
        none.alias("colors"),
        _text("p_size").alias("sizes"),
        F.concat(F.lit("64"), _text("p_partkey")).alias("upc"),
        none.alias("weight"),
        none.alias("dimension"),
        F.concat(F.lit("Maker of "), "p_brand").alias("manufacturer"),
        F.lit("2016-01-02 00:00").alias("dateUpdated"),
    )


# Orders of the lowest priority have no ship mode and those without lines no
# vendor, so the silver rules drop them and their sales and returns have no
# order to join.
_TIDY_MODES = {
    "1-URGENT": "First Class",
    "2-HIGH": "Second Class",
    "3-MEDIUM": "Standard Class",
    "4-NOT SPECIFIED": "Same Day",
}
_TIDY_STATUS = {"F": "delivered", "O": "shipped", "P": "processing"}


def order_vendors(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_orderkey").agg(F.min("l_suppkey").alias("vendor_key"))


def tidy_orders(t: Tables) -> DataFrame:
    bought = modern(F.col("o_orderdate")).cast("timestamp")
    later = {"order_approved_at": 1, "order_delivered_carrier_date": 2,
             "order_delivered_customer_date": 5, "order_estimated_delivery_date": 7}
    rows = t.orders.join(order_vendors(t), F.col("o_orderkey") == F.col("l_orderkey"), "left")
    tidy = rows.select(
        _text("o_orderkey").alias("order_id"),
        _text("o_custkey").alias("customer_id"),
        _text("vendor_key").alias("vendor_id"),
        _lookup(F.col("o_orderpriority"), _TIDY_MODES).alias("ship_mode"),
        _lookup(F.col("o_orderstatus"), _TIDY_STATUS).alias("order_status"),
        bought.alias("order_purchase_date"),
        *[(bought + F.expr(f"INTERVAL {d} DAY")).alias(n) for n, d in later.items()],
    )
    return keep_valid(tidy, ENTITIES["orders"].rules)


def tidy_transactions(t: Tables) -> DataFrame:
    # Amounts have parts below a cent, so sums that round row by row go wrong.
    price = F.col("l_extendedprice").cast("decimal(18,4)")
    cost = (F.col("l_quantity") * 900).cast("decimal(18,4)")
    return t.lineitem.select(
        _text("l_orderkey").alias("order_id"),
        _text("l_partkey").alias("product_id"),
        (price + F.col("l_linenumber") * F.lit("0.0011").cast("decimal(5,4)")).cast("double").alias("sales"),
        F.col("l_quantity").cast("int").alias("quantity"),
        (F.col("l_discount").cast("decimal(18,2)") * 100 + F.lit("0.125").cast("decimal(4,3)")).cast("double").alias("discount"),
        (price - cost + F.lit("0.0044").cast("decimal(5,4)")).cast("double").alias("profit"),
        _switch(F.col("l_linenumber") % 3, "credit_card", "debit_card", "voucher").alias("payment_type"),
        F.col("l_linenumber").alias("payment_installments"),
    )


def _returned_orders(t: Tables) -> DataFrame:
    return (
        t.lineitem.filter("l_returnflag = 'R'")
        .groupBy("l_orderkey")
        .agg(
            F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("refund"),
            modern(F.max(F.col("l_shipdate"))).cast("date").alias("day"),
            F.max("l_linestatus").alias("line_status"),
        )
    )


def tidy_returns(t: Tables) -> DataFrame:
    key = F.col("l_orderkey")
    return _returned_orders(t).select(
        key.cast("string").alias("order_id"),
        (F.col("refund") + F.lit("0.0037").cast("decimal(5,4)")).cast("double").alias("refund_amount"),
        F.col("day").alias("return_date"),
        F.when(F.col("line_status") == "O", "Pending")
        .when(key % 4 == 0, "Rejected")
        .otherwise("Approved")
        .alias("return_status"),
        _switch(key % 3, "Damaged", "Wrong item", "Late").alias("return_reason"),
    )


# --- raw model --------------------------------------------------------------


def _lineage(prefix: str, region: Column) -> list[Column]:
    folder = F.when(region == "global", F.lit("")).otherwise(F.concat(F.lit("Region "), region, F.lit("/")))
    return [
        F.concat(F.lit("/landing/"), folder, F.lit(prefix)).alias("_source_file"),
        F.lit(RAW_LOADED).cast("timestamp").alias("_load_timestamp"),
        region.alias("_region"),
    ]


def _region_of(key: Column) -> Column:
    return F.when(key % 7 == 0, F.lit("global")).otherwise((key % 6 + 1).cast("string"))


def raw_customers(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    ident = F.when(k % 11 != 0, k.cast("string"))
    mail = F.concat(F.lit("c"), k.cast("string"), F.lit("@example.com"))
    other = F.when(k % 5 == 0, "xyz").otherwise("Home Office")
    segment = F.coalesce(
        _lookup(F.col("c_mktsegment"), {"BUILDING": "cons", "AUTOMOBILE": "CORPORATE",
                                        "MACHINERY": "ho", "HOUSEHOLD": "Cosumer"}), other)
    area = F.coalesce(
        _lookup(F.col("r_name"), {"AFRICA": "E", "AMERICA": "West", "ASIA": "S", "EUROPE": "North"}),
        F.when(k % 6 == 0, "central").otherwise("Central"))
    region = _region_of(k)
    city, state = F.concat(F.lit("city "), "n_name"), F.concat(F.lit("state "), "r_name")
    swapped = region == "4"
    last = k % 4 == 3
    return places(t).select(
        F.when(k % 4 == 0, ident).alias("customer_id"),
        F.when(k % 4 == 1, ident).alias("CustomerID"),
        F.when(k % 4 == 2, ident).alias("cust_id"),
        F.when(last, ident).alias("customer_identifier"),
        F.when(~last & (k % 5 != 0), mail).alias("customer_email"),
        F.when(last, mail).alias("email_address"),
        F.when(~last, F.col("c_name")).alias("customer_name"),
        F.when(last, F.col("c_name")).alias("full_name"),
        F.when(~last, segment).alias("segment"),
        F.when(last, segment).alias("customer_segment"),
        F.col("n_name").alias("country"),
        F.when(swapped, state).otherwise(city).alias("city"),
        F.when(swapped, city).otherwise(state).alias("state"),
        F.lpad((k % 100000).cast("string"), 5, "0").alias("postal_code"),
        area.alias("region"),
        *_lineage("customers_1.csv", region),
    )


def raw_orders(t: Tables) -> DataFrame:
    """Orders without a column for the estimated delivery date."""
    k = F.col("o_orderkey")
    day = modern(F.col("o_orderdate"))
    rows = t.orders.join(order_vendors(t), F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return rows.select(
        F.when(k % 13 != 0, k.cast("string")).alias("order_id"),
        F.when(k % 17 != 0, _text("o_custkey")).alias("customer_id"),
        _text("vendor_key").alias("vendor_id"),
        _lookup(F.col("o_orderpriority"), {
            "1-URGENT": "1st Class", "2-HIGH": "Second Class", "3-MEDIUM": "Std Class",
            "4-NOT SPECIFIED": "Same Day", "5-LOW": "Drone"}).alias("ship_mode"),
        F.when(k % 10 == 0, "lost")
        .otherwise(_lookup(F.col("o_orderstatus"), _TIDY_STATUS))
        .alias("order_status"),
        _switch(
            k % 3,
            F.date_format(day, "yyyy-MM-dd HH:mm"),
            F.date_format(day, "MM/dd/yyyy HH:mm"),
            F.when(k % 19 == 0, "abc").otherwise(F.date_format(day, "yyyy-MM-dd")),
        ).alias("order_purchase_date"),
        F.date_format(day, "yyyy-MM-dd HH:mm:ss").alias("order_approved_at"),
        F.date_format(day, "MM/dd/yyyy").alias("order_delivered_carrier_date"),
        F.when(k % 2 == 0, F.date_format(day, "yyyy-MM-dd HH:mm")).alias("order_delivered_customer_date"),
        *_lineage("orders_1.csv", _region_of(k)),
    )


def raw_transactions(t: Tables) -> DataFrame:
    p = F.col("l_partkey")
    order, product = _text("l_orderkey"), p.cast("string")
    quantity = F.col("l_quantity").cast("int").cast("string")
    share = F.col("l_discount").cast("decimal(18,2)")
    # Two columns use the price, so its text is made once, in a step of its own.
    rows = t.lineitem.withColumn("__price", F.col("l_extendedprice").cast("decimal(18,2)").cast("string"))
    price = F.col("__price")
    lost_ids, lost_quantity = p % 5 == 0, p % 5 == 1
    rescued = (
        F.when(lost_ids, F.concat(F.lit('{"Order_id":"'), order, F.lit('","Product_id":"'), product, F.lit('"}')))
        .when(lost_quantity, F.concat(F.lit('{"Quantity":"'), quantity, F.lit('"}')))
    )
    return rows.select(
        F.when(~lost_ids, order).alias("Order_ID"),
        F.when(~lost_ids & (p % 37 != 0), product).alias("Product_ID"),
        F.when(p % 23 == 0, "abc").otherwise(F.concat(F.lit("$"), price)).alias("Sales"),
        F.when(~lost_quantity, quantity).alias("Quantity"),
        _switch(
            p % 4,
            F.concat((share * 100).cast("int").cast("string"), F.lit("%")),
            share.cast("string"),
            None,
            F.when(p % 9 == 0, "abc").otherwise(share.cast("string")),
        ).alias("discount"),
        F.when(p % 6 != 0, price).alias("profit"),
        _switch(p % 6, None, "?", "credit_card", "debit_card", "voucher", "cash").alias("payment_type"),
        _switch(F.col("l_linenumber") % 5, None, "?", "NULL", "3", "12").alias("payment_installments"),
        rescued.alias("_rescued_data"),
        *_lineage("transactions_1.csv", _region_of(p)),
    )


def raw_returns(t: Tables) -> DataFrame:
    k = F.col("l_orderkey")
    root = k % 2 == 0
    day = F.col("day")
    reason = _switch(k % 4, "?Damaged? ", " Wrong item", "?", None)
    date = _switch(k % 4, F.date_format(day, "yyyy-MM-dd"), F.date_format(day, "MM-dd-yyyy"), "NULL", "5 Jan")
    status = _switch(k % 5, "APPRVD", "RJCTD", "PENDG", "Approved", "lost")
    amount = F.when(k % 29 != 0, F.col("refund").cast("string"))
    ident = F.when(k % 31 != 0, k.cast("string"))
    return _returned_orders(t).select(
        F.when(~root, ident).alias("order_id"),
        F.when(~root, reason).alias("return_reason"),
        F.when(~root, date).alias("return_date"),
        F.when(~root, F.concat(F.lit("$"), amount)).alias("refund_amount"),
        F.when(~root, status).alias("return_status"),
        F.when(root, ident).alias("OrderId"),
        F.when(root, reason).alias("reason"),
        F.when(root, date).alias("date_of_return"),
        F.when(root, amount).alias("amount"),
        F.when(root, status).alias("status"),
        *_lineage("returns_1.json", _region_of(k)),
    )


def raw_products(t: Tables) -> DataFrame:
    k = F.col("p_partkey")
    mantissa = (F.lit(100) + k % 900).cast("string")
    science = F.concat(F.substring(mantissa, 1, 1), F.lit("."), F.substring(mantissa, 2, 2), F.lit("E+11"))
    digits = F.concat(F.lit("64"), F.lpad(k.cast("string"), 10, "0"))
    none = F.lit(None).cast("string")
    return t.part.select(
        F.when(k % 41 != 0, k.cast("string")).alias("product_id"),
        F.when(k % 31 != 0, F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("product_name"),
        _switch(
            k % 4,
            F.concat_ws(",", "p_type", "p_brand"),
            F.concat_ws(" > ", "p_type", "p_name"),
            None,
            F.col("p_type"),
        ).alias("categories"),
        F.concat(F.lit(" "), "p_brand", F.lit(" ")).alias("brand"),
        none.alias("colors"),
        _text("p_size").alias("sizes"),
        _switch(k % 5, science, digits, "abc", None, digits).alias("upc"),
        none.alias("weight"),
        none.alias("dimension"),
        F.concat(F.lit("Maker of "), "p_brand").alias("manufacturer"),
        F.lit("2015-11-09 01:50:37").alias("dateAdded"),
        _switch(k % 3, "2016-01-02", "bad", None).alias("dateUpdated"),
        _switch(k % 4, "3", "x", None, "-1").alias("product_photos_qty"),
        *_lineage("products.json", F.lit("global")),
    )


def raw_vendors(t: Tables) -> DataFrame:
    k = F.col("s_suppkey")
    return t.supplier.select(
        F.when(k % 9 != 0, k.cast("string")).alias("vendor_id"),
        F.when(k % 7 != 0, F.col("s_name")).alias("vendor_name"),
        *_lineage("vendors.csv", F.lit("global")),
    )


RAW = {
    "customers": raw_customers,
    "orders": raw_orders,
    "transactions": raw_transactions,
    "returns": raw_returns,
    "products": raw_products,
    "vendors": raw_vendors,
}
