"""Business marts over the star schema.

Facts are grouped before they are joined, so a popular customer, vendor or
product reaches the shuffle as a few partial sums rather than as all its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.exact import amount, as_money, ratio, total
from tidemark.operators.joins import lookup_join

MONTH_KEYS = ("year", "month_num", "month_name", "quarter", "region_name", "country")

# What makes a product slow.
SLOW_UNITS = 5
SLOW_DAYS = 90


def _revenue_measures(sales: Column, profit: Column, discount: Column) -> list[Column]:
    """Measures over exact amounts or their sums."""
    orders = F.count_distinct("order_id")

    def money(value: Column) -> Column:
        return as_money(F.sum(value)).cast("double")

    return [
        orders.alias("order_count"),
        money(sales).alias("total_sales_amount"),
        F.sum("quantity").alias("total_quantity_sold"),
        money(profit).alias("total_profit"),
        money(discount).alias("total_discount"),
        ratio(F.sum(sales), orders, 2).alias("avg_order_value"),
    ]


def _calendar(dim_date: DataFrame) -> DataFrame:
    # No hint: Spark broadcasts the days once it has measured them.
    return dim_date.select("date_key", "year", "month_num", "month_name", "quarter")


def monthly_revenue(fact_sales: DataFrame, dim_date: DataFrame, customers: DataFrame) -> DataFrame:
    """Revenue by month, region and country; the country is that of the sale's customer.

    ``customers`` has one row for each id, so the totals equal the fact totals.
    """
    per_order = (
        fact_sales.filter("date_key IS NOT NULL AND region_name IS NOT NULL")
        .groupBy("order_id", "customer_id", "date_key", "region_name")
        .agg(
            total(F.col("sales_amount")).alias("sales"),
            F.sum("quantity").alias("quantity"),
            total(F.col("profit")).alias("profit"),
            total(F.col("discount")).alias("discount"),
        )
    )
    dated = per_order.join(_calendar(dim_date), "date_key")
    countries = customers.select("customer_id", "country")
    return (
        lookup_join(dated, countries, "customer_id", "inner")
        .select("e.*", "o.country")
        .groupBy(*MONTH_KEYS)
        .agg(*_revenue_measures(F.col("sales"), F.col("profit"), F.col("discount")))
    )


def monthly_revenue_by_region_table(
    fact_sales: DataFrame, dim_date: DataFrame, dim_region: DataFrame
) -> DataFrame:
    """Revenue joined to every (region, country) pair of the sale's region.

    A sale counts once for each country of its region. Use
    :func:`monthly_revenue` for totals that add up.
    """
    per_month = (
        fact_sales.filter("date_key IS NOT NULL AND region_name IS NOT NULL")
        .join(_calendar(dim_date), "date_key")
        .groupBy(*MONTH_KEYS[:-1])
        .agg(*_revenue_measures(*[amount(F.col(n)) for n in ("sales_amount", "profit", "discount")]))
    )
    # The repeat adds whole groups, so it is applied after grouping.
    return per_month.join(dim_region, "region_name").select(
        *MONTH_KEYS,
        "order_count",
        "total_sales_amount",
        "total_quantity_sold",
        "total_profit",
        "total_discount",
        "avg_order_value",
    )


def monthly_revenue_of(groups: DataFrame) -> DataFrame:
    """The mart of the sums and the order count of each month, region and country."""
    return groups.select(
        *MONTH_KEYS,
        F.col("orders").alias("order_count"),
        as_money(F.col("sales")).cast("double").alias("total_sales_amount"),
        F.col("quantity").alias("total_quantity_sold"),
        as_money(F.col("profit")).cast("double").alias("total_profit"),
        as_money(F.col("discount")).cast("double").alias("total_discount"),
        ratio(F.col("sales"), F.col("orders"), 2).alias("avg_order_value"),
    )


def customer_return_history(fact_returns: DataFrame, customers: DataFrame) -> DataFrame:
    per_customer = (
        fact_returns.filter("customer_id IS NOT NULL")
        .groupBy("customer_id")
        .agg(
            F.count("order_id").alias("returns"),
            total(F.col("refund_amount")).alias("refund"),
            F.count("refund_amount").alias("refunds"),
            F.sum("days_to_return").alias("days"),
            F.count("days_to_return").alias("dated"),
            F.count_if("is_approved").alias("approved"),
            F.max(F.try_to_timestamp("return_date").cast("date")).alias("last_return_date"),
        )
    )
    return customer_history_of(per_customer, customers)


def customer_history_of(per_customer: DataFrame, customers: DataFrame) -> DataFrame:
    """The mart of the sums and counts of each customer."""
    measures = per_customer.select(
        "customer_id",
        F.col("returns").alias("total_returns"),
        as_money(F.col("refund")).cast("double").alias("total_refund_value"),
        ratio(F.col("refund"), F.col("refunds"), 2).alias("avg_refund_per_return"),
        ratio(F.col("days"), F.col("dated"), 1).alias("avg_days_to_return"),
        ratio(F.col("approved") * 100, F.col("returns"), 2).alias("approval_rate_pct"),
        "last_return_date",
    )
    names = customers.select(
        "customer_id", "customer_name", "customer_email", "segment", "region", "country"
    )
    return names.join(measures, "customer_id")


def _with_orders(rows: DataFrame, keys: list[str], measures: list[Column], stored: bool) -> DataFrame:
    """Groups with their measures and ``orders``, the number of distinct orders.

    One pass over the rows shuffles the sums of every pair of group and order.
    ``stored`` rows are read twice instead, so the pairs carry no sums and the
    sums go straight into their groups.
    """
    if not stored:
        return rows.groupBy(*keys).agg(F.count_distinct("order_id").alias("orders"), *measures)
    sums = rows.groupBy(*keys).agg(*measures)
    pairs = rows.where("order_id IS NOT NULL").select(*keys, "order_id").distinct()
    counts = pairs.groupBy(*keys).agg(F.count("*").alias("orders"))
    both = sums.withColumn("orders", F.lit(0).cast("long")).unionByName(counts, allowMissingColumns=True)
    # A group has one row of sums and one count at most.
    return both.groupBy(*keys).agg(*[F.max(n).alias(n) for n in both.columns if n not in keys])


def vendor_return_rate(
    fact_sales: DataFrame, fact_returns: DataFrame, dim_vendor: DataFrame, stored: bool = False
) -> DataFrame:
    """Sales and returns of each vendor. The rate is NULL for a vendor without sales.

    ``stored`` says that the sales are a table, cheap to read twice.
    """
    sold = _with_orders(fact_sales, ["vendor_id"], [total(F.col("sales_amount")).alias("revenue")], stored)
    back = fact_returns.groupBy("vendor_id").agg(
        F.count("order_id").alias("returns"),
        total(F.col("refund_amount")).alias("refund"),
        F.sum("days_to_return").alias("days"),
        F.count("days_to_return").alias("dated"),
    )
    return vendor_rate_of(sold, back, dim_vendor)


def vendor_rate_of(sold: DataFrame, back: DataFrame, dim_vendor: DataFrame) -> DataFrame:
    """The mart of the sums and counts of each vendor's sales and returns."""
    sold = sold.select(
        "vendor_id",
        F.col("orders").alias("total_orders_sold"),
        as_money(F.col("revenue")).cast("double").alias("total_revenue"),
    )
    back = back.select(
        "vendor_id",
        F.col("returns").alias("total_returns"),
        as_money(F.col("refund")).cast("double").alias("total_refund_value"),
        ratio(F.col("days"), F.col("dated"), 1).alias("avg_days_to_return"),
    )

    def zero(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0))

    return (
        dim_vendor.join(sold, "vendor_id", "left")
        .join(back, "vendor_id", "left")
        .select(
            "vendor_id",
            "vendor_name",
            zero("total_orders_sold").alias("total_orders_sold"),
            zero("total_revenue").alias("total_revenue"),
            zero("total_returns").alias("total_returns"),
            zero("total_refund_value").alias("total_refund_value"),
            ratio(zero("total_returns") * 100, F.col("total_orders_sold"), 2).alias(
                "return_rate_pct"
            ),
            zero("avg_days_to_return").alias("avg_days_to_return"),
        )
    )


def slow_moving_products(
    fact_sales: DataFrame,
    dim_date: DataFrame,
    dim_product: DataFrame,
    dim_region: DataFrame,
    as_of: Column | None = None,
    include_unsold: bool = False,
    stored: bool = False,
) -> DataFrame:
    """Products by region with few units or no recent sale.

    Pairs that never sold are left out unless ``include_unsold`` asks for the
    whole grid of products and regions. ``stored`` says that the sales are a
    table, cheap to read twice.
    """
    placed = fact_sales.filter("date_key IS NOT NULL AND region_name IS NOT NULL")
    dated = placed.join(dim_date.select("date_key", "full_date"), "date_key")
    measures = [
        F.sum("quantity").alias("units"),
        total(F.col("sales_amount")).alias("revenue"),
        F.max("full_date").alias("last_sale_date"),
    ]
    sold = _with_orders(dated, ["product_id", "region_name"], measures, stored)
    return slow_products_of(sold, dim_product, dim_region, as_of, include_unsold)


def slow_products_of(
    sold: DataFrame,
    dim_product: DataFrame,
    dim_region: DataFrame,
    as_of: Column | None = None,
    include_unsold: bool = False,
) -> DataFrame:
    """The mart of the sums and counts of each product and region."""
    today = F.current_date() if as_of is None else as_of
    sold = sold.select(
        "product_id",
        "region_name",
        F.col("orders").alias("total_orders"),
        F.col("units").alias("total_units_sold"),
        as_money(F.col("revenue")).cast("double").alias("total_revenue"),
        "last_sale_date",
    )
    product = dim_product.select("product_id", "product_name", "category", "sub_category", "brand")
    regions = _region_list(dim_region)
    if include_unsold:
        grid = product.withColumn("region_name", F.explode(regions))
        rows = grid.join(sold, ["product_id", "region_name"], "left")
    else:
        known = sold.filter("total_orders > 0").filter(F.array_contains(regions, F.col("region_name")))
        rows = product.join(known, "product_id")
    units = F.coalesce("total_units_sold", F.lit(0))
    idle = F.datediff(today, F.col("last_sale_date"))
    return rows.select(
        "product_id",
        "product_name",
        "category",
        "sub_category",
        "brand",
        "region_name",
        F.coalesce("total_orders", F.lit(0)).alias("total_orders"),
        units.alias("total_units_sold"),
        F.coalesce("total_revenue", F.lit(0.0)).alias("total_revenue"),
        "last_sale_date",
        idle.alias("days_since_last_sale"),
        ((units < SLOW_UNITS) | F.coalesce(idle > SLOW_DAYS, F.lit(False))).alias("is_slow_mover"),
    )


def _region_list(dim_region: DataFrame) -> Column:
    # The customer rule allows five region names, so the list stays that short
    # and needs neither a join nor a shuffle of the sales by region.
    return dim_region.agg(F.array_sort(F.collect_set("region_name"))).scalar()
