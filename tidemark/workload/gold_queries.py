"""Queries over the star schema and its marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans import marts, star
from tidemark.workload import inputs
from tidemark.workload.inputs import Tables
from tidemark.workload.model_sql import divide, money_total, with_ctes
from tidemark.workload.registry import query

AS_OF = "2017-01-01"


def all_sales(t: Tables) -> DataFrame:
    return star.fact_sales(
        inputs.tidy_transactions(t), inputs.tidy_orders(t), inputs.tidy_customers(t)
    )


def returns(t: Tables) -> DataFrame:
    return star.fact_returns(inputs.tidy_returns(t), inputs.tidy_orders(t), inputs.tidy_customers(t))


def customers(t: Tables) -> DataFrame:
    return star.customer_lookup(inputs.tidy_customers(t))


def local_stamps(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the driver's own tables have them."""
    zoned = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in zoned}) if zoned else df


@query(with_ctes(("dim_date", "sales_in", "good_orders", "returns_in"), """
    , bought AS (SELECT CAST(bought AS DATE) AS on_day, count(*) AS n FROM good_orders GROUP BY 1),
    back AS (SELECT return_date on_day, count(*) n FROM returns_in GROUP BY 1)
    SELECT d.*, CAST(coalesce(b.n, 0) AS BIGINT) orders_placed, CAST(coalesce(r.n, 0) AS BIGINT) returns_made
    FROM dim_date d LEFT JOIN bought b ON b.on_day = d.full_date LEFT JOIN back r ON r.on_day = d.full_date"""))
def dim_date_roles(t: Tables) -> DataFrame:
    """The date dimension in its two roles: order day and return day."""

    def per_day(df: DataFrame, day: str, name: str) -> DataFrame:
        return df.groupBy(F.col(day).cast("date").alias("full_date")).agg(F.count("*").alias(name))

    placed = per_day(inputs.tidy_orders(t), "order_purchase_date", "orders_placed")
    made = per_day(inputs.tidy_returns(t), "return_date", "returns_made")
    days = star.dim_date(t.spark).join(placed, "full_date", "left").join(made, "full_date", "left")
    return days.fillna(0, ["orders_placed", "returns_made"])


@query(with_ctes(("customers",), "SELECT DISTINCT * FROM customers"))
def dim_customer(t: Tables) -> DataFrame:
    return star.dim_customer(inputs.tidy_customers(t))


@query(with_ctes(("vendors",), "SELECT DISTINCT * FROM vendors"))
def dim_vendor(t: Tables) -> DataFrame:
    return star.dim_vendor(inputs.tidy_vendors(t))


@query(with_ctes(("customers",), "SELECT DISTINCT region region_name, country FROM customers"))
def dim_region(t: Tables) -> DataFrame:
    return star.dim_region(inputs.tidy_customers(t))


@query(with_ctes(("products",), "SELECT * FROM products"))
def dim_product(t: Tables) -> DataFrame:
    return star.dim_product(inputs.tidy_products(t))


FACT_SALES_SQL = with_ctes(("fact_sales",), "SELECT * EXCLUDE (bought_on, country) FROM fact_sales")
FACT_RETURNS_SQL = with_ctes(("fact_returns",), "SELECT * FROM fact_returns")


@query(FACT_SALES_SQL)
def fact_sales(t: Tables) -> DataFrame:
    return local_stamps(all_sales(t))


@query(FACT_RETURNS_SQL)
def fact_returns(t: Tables) -> DataFrame:
    return returns(t)


_MEASURES = f"""
    count(DISTINCT order_id) order_count,
    {money_total('sales_amount')} total_sales_amount,
    CAST(sum(quantity) AS BIGINT) total_quantity_sold,
    {money_total('profit')} total_profit,
    {money_total('discount')} total_discount,
    {divide("sum(CAST(sales_amount AS DECIMAL(28,6))) * 1000000", 'count(DISTINCT order_id)', 2, 6)} avg_order_value"""
_MONTH = "d.year, d.month_num, d.month_name, d.quarter"

MONTHLY_BODY = f"""
    SELECT {_MONTH}, region_name, country, {_MEASURES}
    FROM fact_sales f JOIN dim_date d ON f.date_key = d.date_key
    GROUP BY ALL"""


@query(with_ctes(("fact_sales", "dim_date"), MONTHLY_BODY))
def mv_monthly_revenue_by_region(t: Tables) -> DataFrame:
    return marts.monthly_revenue(all_sales(t), star.dim_date(t.spark), customers(t))


@query(with_ctes(("fact_sales", "dim_date"), f"""
    , dim_region AS (SELECT DISTINCT region region_name, country FROM customers)
    SELECT {_MONTH}, r.region_name, r.country, {_MEASURES}
    FROM fact_sales f JOIN dim_date d ON f.date_key = d.date_key
    JOIN dim_region r ON f.region_name = r.region_name
    GROUP BY ALL"""))
def mv_monthly_revenue_by_region_literal(t: Tables) -> DataFrame:
    return marts.monthly_revenue_by_region_table(
        all_sales(t), star.dim_date(t.spark), star.dim_region(inputs.tidy_customers(t))
    )


CUSTOMER_RETURNS_SQL = f"""
    SELECT f.customer_id, c.customer_name, c.customer_email, c.segment, c.region, c.country,
           count(f.order_id) total_returns, {money_total('refund_amount')} total_refund_value,
           {divide("sum(CAST(refund_amount AS DECIMAL(28,6))) * 1000000", 'count(refund_amount)', 2, 6)} avg_refund_per_return,
           {divide('sum(days_to_return)', 'count(days_to_return)', 1)} avg_days_to_return,
           {divide('count(*) FILTER (is_approved) * 100', 'count(f.order_id)', 2)} approval_rate_pct,
           max(CAST(return_date AS DATE)) last_return_date
    FROM fact_returns f JOIN customers c ON f.customer_id = c.customer_id
    GROUP BY ALL"""


@query(with_ctes(("fact_returns", "customers"), CUSTOMER_RETURNS_SQL))
def mv_customer_return_history(t: Tables) -> DataFrame:
    return marts.customer_return_history(returns(t), customers(t))


VENDOR_RATE_CTE = f"""
    sold AS (SELECT vendor_id, count(DISTINCT order_id) n, {money_total('sales_amount')} revenue
             FROM fact_sales GROUP BY vendor_id),
    back AS (SELECT vendor_id, count(order_id) n, {money_total('refund_amount')} refund,
                    {divide('sum(days_to_return)', 'count(days_to_return)', 1)} AS days_back
             FROM fact_returns GROUP BY vendor_id),
    vendor_rate AS (
      SELECT v.vendor_id, v.vendor_name, coalesce(s.n, 0) total_orders_sold,
             coalesce(s.revenue, 0) total_revenue, coalesce(b.n, 0) total_returns,
             coalesce(b.refund, 0) total_refund_value,
             CASE WHEN s.n > 0 THEN {divide('coalesce(b.n, 0) * 100', 's.n', 2)} END return_rate_pct,
             coalesce(b.days_back, 0) avg_days_to_return
      FROM vendors v LEFT JOIN sold s ON v.vendor_id = s.vendor_id LEFT JOIN back b ON v.vendor_id = b.vendor_id)"""


@query(with_ctes(("fact_sales", "fact_returns", "vendors"), f", {VENDOR_RATE_CTE} SELECT * FROM vendor_rate"))
def mv_vendor_return_rate(t: Tables) -> DataFrame:
    return marts.vendor_return_rate(all_sales(t), returns(t), star.dim_vendor(inputs.tidy_vendors(t)))


SLOW_CTE = f"""
    product_sales AS (
      SELECT product_id, region_name, count(DISTINCT order_id) total_orders,
             CAST(sum(quantity) AS BIGINT) units, {money_total('sales_amount')} revenue, max(bought_on) last_day
      FROM fact_sales WHERE date_key IS NOT NULL GROUP BY product_id, region_name),
    slow AS (
      SELECT p.product_id, p.product_name, p.category, p.sub_category, p.brand, s.region_name,
             s.total_orders, s.units total_units_sold, s.revenue total_revenue, s.last_day last_sale_date,
             CAST(date_diff('day', s.last_day, DATE '{AS_OF}') AS INTEGER) days_since_last_sale,
             s.units < 5 OR date_diff('day', s.last_day, DATE '{AS_OF}') > 90 is_slow_mover
      FROM products p JOIN product_sales s ON p.product_id = s.product_id)"""


def slow_movers(t: Tables, include_unsold: bool = False, sales: DataFrame | None = None) -> DataFrame:
    return marts.slow_moving_products(
        all_sales(t) if sales is None else sales,
        star.dim_date(t.spark),
        star.dim_product(inputs.tidy_products(t)),
        star.dim_region(inputs.tidy_customers(t)),
        F.lit(AS_OF).cast("date"),
        include_unsold,
        stored=sales is not None,
    )


@query(with_ctes(("fact_sales", "products"), f", {SLOW_CTE} SELECT * FROM slow"))
def mv_slow_moving_products(t: Tables) -> DataFrame:
    return slow_movers(t)


@query(with_ctes(("fact_sales", "products"), f""", {SLOW_CTE},
    regions AS (SELECT DISTINCT region region_name FROM customers)
    SELECT p.product_id, p.product_name, p.category, p.sub_category, p.brand, r.region_name,
           coalesce(s.total_orders, 0) total_orders, coalesce(s.total_units_sold, 0) total_units_sold,
           coalesce(s.total_revenue, 0) total_revenue, s.last_sale_date, s.days_since_last_sale,
           coalesce(s.is_slow_mover, TRUE) is_slow_mover
    FROM products p CROSS JOIN regions r
    LEFT JOIN slow s ON p.product_id = s.product_id AND r.region_name = s.region_name"""))
def mv_slow_moving_products_grid(t: Tables) -> DataFrame:
    return slow_movers(t, include_unsold=True)
