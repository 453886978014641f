"""Star schema: dimensions and facts.

The facts are written so that the large side, transactions or returns, is
shuffled once at most. Orders are joined to their customers first, giving one
row for each order with everything the fact needs; Spark then broadcasts that
look-up when its measured size allows and otherwise sorts and merges, splitting
skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import columns as c
from tidemark.operators.joins import lookup_join
from tidemark.operators.keyed import one_per_key

# Bounds of the date dimension.
FIRST_DAY = "2010-01-01"
LAST_DAY = "2050-12-31"

CUSTOMER_COLUMNS = (
    "customer_id", "customer_email", "customer_name", "segment", "country",
    "city", "state", "postal_code", "region",
)
PRODUCT_COLUMNS = (
    "product_id", "product_name", "categories", "brand", "colors", "sizes", "upc",
    "weight", "dimension", "manufacturer",
)


def dim_date(spark: SparkSession, first: str = FIRST_DAY, last: str = LAST_DAY) -> DataFrame:
    """One row for each day between two dates."""
    days = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr("INTERVAL 1 DAY"))
    day = F.col("full_date")
    return spark.range(1).select(F.explode(days).alias("full_date")).select(
        c.day_key(day).alias("date_key"),
        day,
        F.date_format(day, "EEEE").alias("day_of_week"),
        F.dayofmonth(day).alias("day_num"),
        F.weekofyear(day).alias("week_num"),
        F.month(day).alias("month_num"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
    )


def dim_customer(customers: DataFrame) -> DataFrame:
    return customers.select(*CUSTOMER_COLUMNS).filter(F.col("customer_id").isNotNull()).distinct()


def dim_vendor(vendors: DataFrame) -> DataFrame:
    return vendors.select("vendor_id", "vendor_name").filter("vendor_id IS NOT NULL").distinct()


def dim_region(customers: DataFrame) -> DataFrame:
    return (
        customers.select(F.col("region").alias("region_name"), "country")
        .filter("region_name IS NOT NULL")
        .distinct()
    )


def dim_product(products: DataFrame, separator: str = ">") -> DataFrame:
    """One row for each product id, the most recently updated one, with its category levels."""
    recent = F.col("dateUpdated").desc_nulls_last()
    one = one_per_key(
        c.with_missing(products, {"dateUpdated": "string"})
        .select(*PRODUCT_COLUMNS, "dateUpdated")
        .filter("product_id IS NOT NULL"),
        ["product_id"],
        [recent],
    ).drop("dateUpdated")
    path = F.col("categories")
    return one.withColumns(
        {
            "category": c.path_level(path, 0, separator),
            "sub_category": c.path_level(path, 1, separator),
        }
    )


def customer_lookup(customers: DataFrame) -> DataFrame:
    """One row for each customer id, whatever duplicates the customer table holds."""
    rows = customers.select(*CUSTOMER_COLUMNS).filter(F.col("customer_id").isNotNull())
    return one_per_key(rows, ["customer_id"])


def order_lookup(orders: DataFrame, customers: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row for each order id with the region of its customer."""
    regions = customer_lookup(customers).select("customer_id", F.col("region").alias("region_name"))
    rows = orders.select(*columns).filter(F.col("order_id").isNotNull())
    found = lookup_join(rows, regions, "customer_id").select("e.*", "o.region_name")
    recent = F.col("order_purchase_date").desc_nulls_last()
    return one_per_key(found, ["order_id"], [recent])


ORDER_FACT_COLUMNS = (
    "order_id", "customer_id", "vendor_id", "ship_mode", "order_status",
    "order_purchase_date", "order_approved_at", "order_delivered_carrier_date",
    "order_delivered_customer_date", "order_estimated_delivery_date",
)


def fact_sales(transactions: DataFrame, orders: DataFrame, customers: DataFrame) -> DataFrame:
    """One row for each transaction with an order and a product id.

    Order columns, the order id among them, are NULL for an unknown order.
    """
    return sales_rows(transactions, order_lookup(orders, customers, ORDER_FACT_COLUMNS))


def sales_rows(transactions: DataFrame, lookup: DataFrame) -> DataFrame:
    """Sales over a look-up that has one row for each order, with its region."""
    sold = transactions.filter("order_id IS NOT NULL AND product_id IS NOT NULL")
    return lookup_join(sold, lookup, "order_id").select(
        c.day_key(_day("o.order_purchase_date")).alias("date_key"),
        "o.customer_id",
        "e.product_id",
        "o.vendor_id",
        "o.region_name",
        F.col("e.sales").alias("sales_amount"),
        "e.quantity",
        "e.discount",
        "e.profit",
        "e.payment_type",
        "e.payment_installments",
        "o.order_id",
        "o.ship_mode",
        "o.order_status",
        "o.order_approved_at",
        "o.order_delivered_carrier_date",
        "o.order_delivered_customer_date",
        "o.order_estimated_delivery_date",
    )


def fact_returns(returns: DataFrame, orders: DataFrame, customers: DataFrame) -> DataFrame:
    """One row for each return with an order id; days to return may be negative."""
    needed = ("order_id", "customer_id", "vendor_id", "order_purchase_date")
    return return_rows(returns, order_lookup(orders, customers, needed))


def return_rows(returns: DataFrame, lookup: DataFrame) -> DataFrame:
    """Returns over a look-up that has one row for each order, with its region."""
    returned = F.col("e.return_date")
    ordered = _day("o.order_purchase_date")
    rows = returns.filter("order_id IS NOT NULL")
    return lookup_join(rows, lookup, "order_id").select(
        c.day_key(returned).alias("return_date_key"),
        c.day_key(ordered).alias("order_date_key"),
        "o.customer_id",
        "o.vendor_id",
        "o.region_name",
        "e.order_id",
        "e.return_reason",
        returned.cast("string").alias("return_date"),
        "e.refund_amount",
        "e.return_status",
        c.is_true(F.lower("e.return_status") == "approved").alias("is_approved"),
        F.datediff(returned, ordered).alias("days_to_return"),
    )


def _day(name: str) -> Column:
    return F.col(name).cast("date")
