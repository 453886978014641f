"""Raw entity rows to standardised rows.

Every function takes and returns a DataFrame and adds no shuffle, so it runs
the same over a table and over a stream. Columns a source lacks read as NULL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import columns as c
from tidemark.plans import entities as e


def declared(df: DataFrame, entity: e.Entity) -> DataFrame:
    """The entity's columns and lineage, back-filled where the source lacks them."""
    wanted = {n: "string" for n in entity.columns} | e.LINEAGE
    return c.with_missing(df, wanted)


def customers(raw: DataFrame) -> DataFrame:
    df = declared(raw, e.CUSTOMERS)
    segment = c.merge_variants(df, ["segment", "customer_segment"])
    swapped = F.col("_region") == e.SWAPPED_REGION
    city, state = c.swap_when(swapped, F.col("city"), F.col("state"))
    ids = ["customer_id", "CustomerID", "cust_id", "customer_identifier"]
    return df.select(
        c.merge_variants(df, ids).alias("customer_id"),
        c.merge_variants(df, ["customer_email", "email_address"]).alias("customer_email"),
        c.merge_variants(df, ["customer_name", "full_name"]).alias("customer_name"),
        c.map_values(segment, e.SEGMENTS, ignore_case=True).alias("segment"),
        "country",
        city.alias("city"),
        state.alias("state"),
        "postal_code",
        c.map_values(F.col("region"), e.REGIONS).alias("region"),
        "_source_file",
        "_load_timestamp",
        "_region",
    )


def orders(raw: DataFrame) -> DataFrame:
    df = declared(raw, e.ORDERS)
    stamps = {n: c.parse_timestamp(F.col(n)) for n in e.ORDER_STAMPS}
    mode = c.map_values(F.col("ship_mode"), e.SHIP_MODES, keep_unknown=True)
    return df.withColumns({**stamps, "ship_mode": mode})


def transactions(raw: DataFrame) -> DataFrame:
    df = declared(raw, e.TRANSACTIONS)
    rescued = F.col(e.RESCUED)
    clean = {
        "order_id": c.recover(F.col("Order_ID"), rescued, "Order_id"),
        "product_id": c.recover(F.col("Product_ID"), rescued, "Product_id"),
        "sales": c.money(F.col("Sales")),
        "quantity": c.recover(F.col("Quantity"), rescued, "Quantity").try_cast("int"),
        "discount": c.percent(F.col("discount")),
        "profit": c.double_or(F.col("profit"), 0.0),
        "payment_type": c.text_or(F.col("payment_type"), "credit_card", "?"),
        "payment_installments": _installments(),
    }
    replaced = {n.lower() for n in clean}
    others = [F.col(f"`{n}`") for n in df.columns if n.lower() not in replaced]
    out = df.select(*[x.alias(n) for n, x in clean.items()], *others)
    return c.public_lineage(out, e.PUBLIC_LINEAGE)


def _installments():
    raw = F.col("payment_installments")
    known = c.null_if(raw, "?", "NULL")
    return F.when(known.isNull(), F.lit(0)).otherwise(known.try_cast("int"))


def returns(raw: DataFrame) -> DataFrame:
    df = declared(raw, e.RETURNS)

    def either(root_name: str, regional_name: str):
        return c.merge_variants(df, [root_name, regional_name])

    day = c.null_if(either("date_of_return", "return_date"), "NULL")
    return df.select(
        either("OrderId", "order_id").alias("order_id"),
        c.money(either("amount", "refund_amount")).alias("refund_amount"),
        c.parse_day(day).alias("return_date"),
        c.map_values(
            either("status", "return_status"), e.RETURN_STATUSES, keep_unknown=True
        ).alias("return_status"),
        c.strip_marks(either("reason", "return_reason")).alias("return_reason"),
        e.RESCUED,
        F.col("_load_timestamp").alias("load_timestamp"),
        F.col("_region").alias("region"),
    )


def products(raw: DataFrame) -> DataFrame:
    df = declared(raw, e.PRODUCTS)
    return df.withColumns(
        {
            "dateAdded": c.reformat_stamp(F.col("dateAdded")),
            "dateUpdated": c.reformat_stamp(F.col("dateUpdated")),
            "categories_list": c.split_list(F.col("categories")),
            "upc_cleaned": c.plain_digits(F.col("upc")),
            "product_photos_qty": c.int_or(F.col("product_photos_qty"), 0),
            "brand": F.trim("brand"),
            "product_name": F.trim("product_name"),
        }
    )


def vendors(raw: DataFrame) -> DataFrame:
    return declared(raw, e.VENDORS)


STANDARDISE: dict[str, Callable[[DataFrame], DataFrame]] = {
    "customers": customers,
    "orders": orders,
    "transactions": transactions,
    "returns": returns,
    "products": products,
    "vendors": vendors,
}
