"""DuckDB text of the model in :mod:`tidemark.workload.inputs`, as named CTEs.

Written from the description of the model, apart from the Spark code, so that
the two check each other.
"""

from __future__ import annotations


def day_key(expr: str) -> str:
    return f"CAST(strftime({expr}, '%Y%m%d') AS INTEGER)"


def cents(expr: str) -> str:
    """Money as a whole number of cents."""
    return f"CAST(CAST({expr} AS DECIMAL(18,2)) * 100 AS HUGEINT)"


def money_total(expr: str) -> str:
    """Summed to six places, rounded to cents once."""
    return f"CAST(round(sum(CAST({expr} AS DECIMAL(28,6))), 2) AS DOUBLE)"


def divide(top: str, bottom: str, digits: int, top_scale: int = 0) -> str:
    """Whole numbers divided and rounded half away from zero. ``top`` carries ``top_scale`` digits."""
    up, down = 10 ** max(digits - top_scale, 0), 10 ** max(top_scale - digits, 0)
    num = f"(CAST({top} AS HUGEINT) * {up})"
    den = f"(CAST({bottom} AS HUGEINT) * {down})"
    whole = f"(sign({num}) * ((2 * abs({num}) + {den}) // (2 * NULLIF({den}, 0))))"
    return f"(CAST({whole} AS DOUBLE) / {10 ** digits}.0::DOUBLE)"


def _region_of(k: str) -> str:
    return f"CASE WHEN {k} % 7 = 0 THEN 'global' ELSE CAST({k} % 6 + 1 AS VARCHAR) END"


def _source(region: str, name: str) -> str:
    return (
        f"'/landing/' || CASE WHEN {region} = 'global' THEN '' "
        f"ELSE 'Region ' || {region} || '/' END || '{name}'"
    )


CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def _cte(name: str, needs: tuple[str, ...], sql: str) -> None:
    CTES[name] = (needs, sql)


_cte("places", (), """
    SELECT c.*, n.n_name, r.r_name
    FROM customer c JOIN nation n ON c_nationkey = n_nationkey
    JOIN region r ON n_regionkey = r_regionkey""")
_cte("customers", ("places",), """
    SELECT CAST(c_custkey AS VARCHAR) customer_id, 'c' || c_custkey || '@example.com' customer_email,
           c_name customer_name, c_mktsegment segment, n_name country, 'city ' || n_name city,
           'state ' || r_name state, lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') postal_code,
           r_name region
    FROM places""")
_cte("vendors", (), "SELECT CAST(s_suppkey AS VARCHAR) vendor_id, s_name vendor_name FROM supplier")
_cte("products", (), """
    SELECT CAST(p_partkey AS VARCHAR) product_id, p_name product_name,
           CASE WHEN p_size > 3 THEN p_type || ' > ' || p_name ELSE p_type END categories,
           p_brand brand, CAST(NULL AS VARCHAR) colors, CAST(p_size AS VARCHAR) sizes,
           '64' || p_partkey upc, CAST(NULL AS VARCHAR) weight, CAST(NULL AS VARCHAR) dimension,
           'Maker of ' || p_brand manufacturer,
           p_type category, CASE WHEN p_size > 3 THEN p_name END sub_category
    FROM part""")
_cte("order_vendors", (), """
    SELECT l_orderkey, CAST(min(l_suppkey) AS VARCHAR) vendor_id FROM lineitem GROUP BY l_orderkey""")
_cte("good_orders", ("order_vendors",), """
    SELECT CAST(o_orderkey AS VARCHAR) order_id, CAST(o_custkey AS VARCHAR) customer_id, vendor_id,
           CASE o_orderpriority WHEN '1-URGENT' THEN 'First Class' WHEN '2-HIGH' THEN 'Second Class'
                WHEN '3-MEDIUM' THEN 'Standard Class' ELSE 'Same Day' END ship_mode,
           CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'processing' END order_status,
           o_orderdate + INTERVAL 15 YEAR bought
    FROM orders JOIN order_vendors ON o_orderkey = l_orderkey
    WHERE o_orderpriority <> '5-LOW'""")
_cte("sales_in", (), """
    SELECT CAST(l_orderkey AS VARCHAR) order_id, CAST(l_partkey AS VARCHAR) product_id,
           CAST(CAST(l_extendedprice AS DECIMAL(18,4)) + CAST(l_linenumber AS DECIMAL(18,4)) * 0.0011 AS DOUBLE) sales,
           CAST(l_quantity AS INTEGER) quantity,
           CAST(CAST(l_discount AS DECIMAL(18,2)) * 100 + 0.125 AS DOUBLE) discount,
           CAST(CAST(l_extendedprice AS DECIMAL(18,4)) - CAST(l_quantity * 900 AS DECIMAL(18,4)) + 0.0044 AS DOUBLE) profit,
           CASE l_linenumber % 3 WHEN 0 THEN 'credit_card' WHEN 1 THEN 'debit_card' ELSE 'voucher' END payment_type,
           l_linenumber payment_installments
    FROM lineitem""")
_cte("returned_orders", (), """
    SELECT l_orderkey k, sum(CAST(l_extendedprice AS DECIMAL(18,2))) refund,
           CAST(max(l_shipdate) + INTERVAL 15 YEAR AS DATE) AS back_on, max(l_linestatus) line_status
    FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey""")
_cte("returns_in", ("returned_orders",), """
    SELECT CAST(k AS VARCHAR) order_id, CAST(CAST(refund AS DECIMAL(18,4)) + 0.0037 AS DOUBLE) refund_amount, back_on AS return_date,
           CASE WHEN line_status = 'O' THEN 'Pending' WHEN k % 4 = 0 THEN 'Rejected' ELSE 'Approved' END return_status,
           CASE k % 3 WHEN 0 THEN 'Damaged' WHEN 1 THEN 'Wrong item' ELSE 'Late' END return_reason
    FROM returned_orders""")
_cte("fact_sales", ("sales_in", "good_orders", "customers"), f"""
    SELECT {day_key('o.bought')} date_key, o.customer_id, s.product_id, o.vendor_id, c.region region_name,
           s.sales sales_amount, s.quantity, s.discount, s.profit, s.payment_type, s.payment_installments,
           o.order_id, o.ship_mode, o.order_status,
           o.bought + INTERVAL 1 DAY order_approved_at,
           o.bought + INTERVAL 2 DAY order_delivered_carrier_date,
           o.bought + INTERVAL 5 DAY order_delivered_customer_date,
           o.bought + INTERVAL 7 DAY order_estimated_delivery_date,
           CAST(o.bought AS DATE) AS bought_on, c.country
    FROM sales_in s LEFT JOIN good_orders o ON s.order_id = o.order_id
    LEFT JOIN customers c ON o.customer_id = c.customer_id""")
_cte("fact_returns", ("returns_in", "good_orders", "customers"), f"""
    SELECT {day_key('r.return_date')} return_date_key, {day_key('o.bought')} order_date_key,
           o.customer_id, o.vendor_id, c.region region_name, r.order_id, r.return_reason,
           CAST(r.return_date AS VARCHAR) return_date, r.refund_amount, r.return_status,
           r.return_status = 'Approved' is_approved,
           CAST(date_diff('day', CAST(o.bought AS DATE), r.return_date) AS INTEGER) days_to_return
    FROM returns_in r LEFT JOIN good_orders o ON r.order_id = o.order_id
    LEFT JOIN customers c ON o.customer_id = c.customer_id""")
_cte("spine", (), """
    SELECT CAST(d AS DATE) full_date FROM
    generate_series(DATE '2010-01-01', DATE '2050-12-31', INTERVAL 1 DAY) g(d)""")
_cte("dim_date", ("spine",), f"""
    SELECT {day_key('full_date')} date_key, full_date, dayname(full_date) day_of_week,
           CAST(day(full_date) AS INTEGER) day_num, CAST(weekofyear(full_date) AS INTEGER) week_num,
           CAST(month(full_date) AS INTEGER) month_num, monthname(full_date) month_name,
           CAST(quarter(full_date) AS INTEGER) AS quarter, CAST(year(full_date) AS INTEGER) AS year,
           isodow(full_date) >= 6 is_weekend
    FROM spine""")


def with_ctes(needs: tuple[str, ...], body: str) -> str:
    """``body`` preceded by the CTEs it needs and those they need."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name not in order:
            for n in CTES[name][0]:
                visit(n)
            order.append(name)

    for n in needs:
        visit(n)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][1]})" for n in order) + "\n" + body


# --- raw entities --------------------------------------------------------------

_cte("raw_customers", ("places",), f"""
    SELECT c_custkey k, c_name, n_name, r_name, c_custkey % 4 = 3 AS late_names,
           CASE WHEN c_custkey % 11 <> 0 THEN CAST(c_custkey AS VARCHAR) END id,
           'c' || c_custkey || '@example.com' mail,
           CASE c_mktsegment WHEN 'BUILDING' THEN 'cons' WHEN 'AUTOMOBILE' THEN 'CORPORATE'
                WHEN 'MACHINERY' THEN 'ho' WHEN 'HOUSEHOLD' THEN 'Cosumer'
                ELSE CASE WHEN c_custkey % 5 = 0 THEN 'xyz' ELSE 'Home Office' END END segment_text,
           CASE r_name WHEN 'AFRICA' THEN 'E' WHEN 'AMERICA' THEN 'West' WHEN 'ASIA' THEN 'S'
                WHEN 'EUROPE' THEN 'North'
                ELSE CASE WHEN c_custkey % 6 = 0 THEN 'central' ELSE 'Central' END END region_text,
           {_region_of('c_custkey')} file_region
    FROM places""")
_cte("std_customers", ("raw_customers",), f"""
    SELECT id customer_id,
           CASE WHEN late_names OR k % 5 <> 0 THEN mail END customer_email,
           c_name customer_name,
           CASE WHEN lower(segment_text) IN ('consumer', 'cons', 'cosumer') THEN 'Consumer'
                WHEN lower(segment_text) IN ('corporate', 'corp') THEN 'Corporate'
                WHEN lower(segment_text) IN ('home office', 'ho') THEN 'Home Office' END segment,
           n_name country, 'city ' || n_name city, 'state ' || r_name state,
           lpad(CAST(k % 100000 AS VARCHAR), 5, '0') postal_code,
           CASE region_text WHEN 'E' THEN 'East' WHEN 'W' THEN 'West' WHEN 'West' THEN 'West'
                WHEN 'S' THEN 'South' WHEN 'North' THEN 'North' WHEN 'Central' THEN 'Central' END region,
           {_source('file_region', 'customers_1.csv')} _source_file, file_region _region
    FROM raw_customers""")
_cte("raw_orders", ("order_vendors",), f"""
    SELECT o_orderkey k, o_orderdate + INTERVAL 15 YEAR AS bought, vendor_id,
           CASE WHEN o_orderkey % 13 <> 0 THEN CAST(o_orderkey AS VARCHAR) END order_id,
           CASE WHEN o_orderkey % 17 <> 0 THEN CAST(o_custkey AS VARCHAR) END customer_id,
           CASE o_orderpriority WHEN '1-URGENT' THEN '1st Class' WHEN '2-HIGH' THEN 'Second Class'
                WHEN '3-MEDIUM' THEN 'Std Class' WHEN '4-NOT SPECIFIED' THEN 'Same Day' ELSE 'Drone' END ship_mode,
           CASE WHEN o_orderkey % 10 = 0 THEN 'lost' WHEN o_orderstatus = 'F' THEN 'delivered'
                WHEN o_orderstatus = 'O' THEN 'shipped' ELSE 'processing' END order_status,
           CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate + INTERVAL 15 YEAR, '%Y-%m-%d %H:%M')
                WHEN 1 THEN strftime(o_orderdate + INTERVAL 15 YEAR, '%m/%d/%Y %H:%M')
                ELSE CASE WHEN o_orderkey % 19 = 0 THEN 'abc'
                     ELSE strftime(o_orderdate + INTERVAL 15 YEAR, '%Y-%m-%d') END END bought_text,
           {_region_of('o_orderkey')} file_region
    FROM orders LEFT JOIN order_vendors ON o_orderkey = l_orderkey""")
_cte("std_orders", ("raw_orders",), f"""
    SELECT order_id, customer_id, vendor_id,
           CASE ship_mode WHEN '1st Class' THEN 'First Class' WHEN 'Std Class' THEN 'Standard Class'
                ELSE ship_mode END ship_mode, order_status,
           coalesce(try_strptime(bought_text, '%Y-%m-%d %H:%M'), try_strptime(bought_text, '%m/%d/%Y %H:%M'),
                    try_strptime(bought_text, '%Y-%m-%d')) order_purchase_date,
           bought order_approved_at, date_trunc('day', bought) order_delivered_carrier_date,
           CASE WHEN k % 2 = 0 THEN bought END order_delivered_customer_date,
           CAST(NULL AS TIMESTAMP) order_estimated_delivery_date,
           {_source('file_region', 'orders_1.csv')} _source_file, file_region _region
    FROM raw_orders""")
_cte("raw_transactions", (), f"""
    SELECT l_partkey p, l_linenumber n, CAST(l_orderkey AS VARCHAR) full_order,
           CAST(l_partkey AS VARCHAR) full_product, CAST(l_quantity AS INTEGER) full_quantity,
           CAST(l_discount AS DECIMAL(18,2)) share, CAST(l_extendedprice AS DECIMAL(18,2)) price,
           l_partkey % 5 = 0 AS lost_ids,
           CASE l_partkey % 6 WHEN 1 THEN '?' WHEN 2 THEN 'credit_card' WHEN 3 THEN 'debit_card'
                WHEN 4 THEN 'voucher' WHEN 5 THEN 'cash' END pay,
           {_region_of('l_partkey')} file_region
    FROM lineitem""")
_cte("std_transactions", ("raw_transactions",), f"""
    SELECT full_order order_id,
           CASE WHEN lost_ids OR p % 37 <> 0 THEN full_product END product_id,
           CASE WHEN p % 23 <> 0 THEN CAST(price AS DOUBLE) END sales,
           full_quantity quantity,
           CASE p % 4 WHEN 0 THEN CAST(CAST(share * 100 AS INTEGER) AS DOUBLE)
                WHEN 1 THEN CAST(share AS DOUBLE) * 100.0::DOUBLE
                WHEN 3 THEN CASE WHEN p % 9 <> 0 THEN CAST(share AS DOUBLE) * 100.0::DOUBLE END END discount,
           CASE WHEN p % 6 <> 0 THEN CAST(price AS DOUBLE) ELSE 0.0::DOUBLE END profit,
           CASE WHEN pay IS NULL OR pay = '?' THEN 'credit_card' ELSE pay END payment_type,
           CAST(CASE n % 5 WHEN 3 THEN 3 WHEN 4 THEN 12 ELSE 0 END AS INTEGER) payment_installments,
           CASE WHEN lost_ids THEN '{{"Order_id":"' || full_order || '","Product_id":"' || full_product || '"}}'
                WHEN p % 5 = 1 THEN '{{"Quantity":"' || full_quantity || '"}}' END _rescued_data,
           {_source('file_region', 'transactions_1.csv')} source_file, file_region region
    FROM raw_transactions""")
_cte("std_returns", ("returned_orders",), f"""
    SELECT CASE WHEN k % 31 <> 0 THEN CAST(k AS VARCHAR) END order_id,
           CASE WHEN k % 29 <> 0 THEN CAST(refund AS DOUBLE) END refund_amount,
           CASE WHEN k % 4 < 2 THEN back_on END return_date,
           CASE k % 5 WHEN 0 THEN 'Approved' WHEN 1 THEN 'Rejected' WHEN 2 THEN 'Pending'
                WHEN 3 THEN 'Approved' ELSE 'lost' END return_status,
           CASE k % 4 WHEN 0 THEN 'Damaged' WHEN 1 THEN 'Wrong item' WHEN 2 THEN '' END return_reason,
           {_region_of('k')} region
    FROM returned_orders""")
_cte("raw_products", (), """
    SELECT *, p_partkey k, CAST(100 + p_partkey % 900 AS VARCHAR) mantissa,
           '64' || lpad(CAST(p_partkey AS VARCHAR), 10, '0') digits,
           CASE p_partkey % 4 WHEN 0 THEN p_type || ',' || p_brand WHEN 1 THEN p_type || ' > ' || p_name
                WHEN 3 THEN p_type END categories
    FROM part""")
_cte("std_products", ("raw_products",), """
    SELECT CASE WHEN k % 41 <> 0 THEN CAST(k AS VARCHAR) END product_id,
           CASE WHEN k % 31 <> 0 THEN p_name END product_name, categories, p_brand brand,
           CAST(NULL AS VARCHAR) colors, CAST(p_size AS VARCHAR) sizes,
           CASE k % 5 WHEN 0 THEN mantissa[1:1] || '.' || mantissa[2:3] || 'E+11' WHEN 1 THEN digits
                WHEN 2 THEN 'abc' WHEN 4 THEN digits END upc,
           CAST(NULL AS VARCHAR) weight, CAST(NULL AS VARCHAR) dimension, 'Maker of ' || p_brand manufacturer,
           '2015-11-09 01:50' "dateAdded",
           CASE WHEN k % 3 = 0 THEN '2016-01-02 00:00' END "dateUpdated",
           CAST(CASE k % 4 WHEN 0 THEN 3 WHEN 3 THEN -1 ELSE 0 END AS INTEGER) product_photos_qty,
           coalesce(array_to_string(string_split(categories, ','), '|'), '') categories_list,
           CASE k % 5 WHEN 0 THEN mantissa || '000000000' WHEN 1 THEN digits WHEN 4 THEN digits END upc_cleaned,
           '/landing/products.json' _source_file, 'global' _region
    FROM raw_products""")
_cte("std_vendors", (), """
    SELECT CASE WHEN s_suppkey % 9 <> 0 THEN CAST(s_suppkey AS VARCHAR) END vendor_id,
           CASE WHEN s_suppkey % 7 <> 0 THEN s_name END vendor_name,
           '/landing/vendors.csv' _source_file, 'global' _region
    FROM supplier""")

# Rules in SQL, in the order their names are listed for a rejected row.
RULES = {
    "customers": {
        "valid_customer_id": "customer_id IS NOT NULL",
        "valid_segment": "segment IN ('Consumer', 'Corporate', 'Home Office')",
        "valid_region": "region IN ('East', 'West', 'South', 'North', 'Central')",
    },
    "orders": {
        "valid_order_id": "order_id IS NOT NULL",
        "valid_customer_id": "customer_id IS NOT NULL",
        "valid_vendor_id": "vendor_id IS NOT NULL",
        "valid_ship_mode": "ship_mode IN ('First Class', 'Second Class', 'Standard Class', 'Same Day')",
        "valid_order_purchase_date": "order_purchase_date IS NOT NULL",
        "valid_order_status": "order_status IN ('delivered', 'shipped', 'unavailable', 'canceled', "
                              "'processing', 'invoiced', 'created')",
    },
    "transactions": {
        "valid_order_id": "order_id IS NOT NULL",
        "valid_product_id": "product_id IS NOT NULL",
        "valid_sales": "sales IS NOT NULL",
        "valid_payment_type": "payment_type IN ('credit_card', 'debit_card', 'voucher')",
    },
    "returns": {
        "valid_order_id": "order_id IS NOT NULL",
        "valid_return_reason": "return_reason IS NOT NULL AND return_reason <> ''",
        "valid_return_status": "return_status IN ('Pending', 'Rejected', 'Approved')",
        "valid_refund_amount": "refund_amount IS NOT NULL",
    },
    "products": {
        "valid_product_id": "product_id IS NOT NULL",
        "valid_product_name": "product_name IS NOT NULL",
        "valid_upc": "upc IS NOT NULL",
        "valid_product_photos_qty": "product_photos_qty >= 0",
    },
    "vendors": {
        "valid_vendor_id": "vendor_id IS NOT NULL",
        "valid_vendor_name": "vendor_name IS NOT NULL",
    },
}


def clean_body(entity: str) -> str:
    passed = " AND ".join(f"coalesce({r}, FALSE)" for r in RULES[entity].values())
    return f"SELECT * FROM std_{entity} WHERE {passed}"


def quarantine_body(entity: str) -> str:
    names = ", ".join(
        f"CASE WHEN NOT coalesce({r}, FALSE) THEN '{n}' END" for n, r in RULES[entity].items()
    )
    return (
        f"SELECT *, concat_ws(',', {names}) error_reason FROM std_{entity} "
        f"WHERE concat_ws(',', {names}) <> ''"
    )


for _entity in RULES:
    _cte(f"quarantine_{_entity}", (f"std_{_entity}",), quarantine_body(_entity))
