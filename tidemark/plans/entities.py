"""What is known in advance about each raw entity: files, columns and rules."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Entity:
    name: str
    file_format: str
    file_glob: str
    columns: tuple[str, ...]
    rules: dict[str, str] = field(default_factory=dict)
    # Checks of which a rejected row names only the first broken one.
    first_failure: tuple[tuple[str, str], ...] = ()


# File patterns, declared raw columns and rule predicates.
_CUSTOMER_RULES = {
    "valid_customer_id": "customer_id IS NOT NULL",
    "valid_segment": "segment IN ('Consumer', 'Corporate', 'Home Office')",
    "valid_region": "region IN ('East', 'West', 'South', 'North', 'Central')",
}

CUSTOMERS = Entity(
    "customers",
    "csv",
    "customers_*.csv",
    (
        "customer_id", "CustomerID", "cust_id", "customer_identifier",
        "customer_email", "email_address",
        "customer_name", "full_name",
        "segment", "customer_segment",
        "country", "city", "state", "postal_code", "region",
    ),
    _CUSTOMER_RULES,
    (
        ("NULL_CUSTOMER_ID", _CUSTOMER_RULES["valid_customer_id"]),
        ("INVALID_SEGMENT", _CUSTOMER_RULES["valid_segment"]),
        ("INVALID_REGION", _CUSTOMER_RULES["valid_region"]),
    ),
)

ORDERS = Entity(
    "orders",
    "csv",
    "orders_*.csv",
    (
        "order_id", "customer_id", "vendor_id", "ship_mode", "order_status",
        "order_purchase_date", "order_approved_at", "order_delivered_carrier_date",
        "order_delivered_customer_date", "order_estimated_delivery_date",
    ),
    {
        "valid_order_id": "order_id IS NOT NULL",
        "valid_customer_id": "customer_id IS NOT NULL",
        "valid_vendor_id": "vendor_id IS NOT NULL",
        "valid_ship_mode":
            "ship_mode IN ('First Class', 'Second Class', 'Standard Class', 'Same Day')",
        "valid_order_purchase_date": "order_purchase_date IS NOT NULL",
        "valid_order_status":
            "order_status IN ('delivered', 'shipped', 'unavailable', 'canceled', "
            "'processing', 'invoiced', 'created')",
    },
)

ORDER_STAMPS = ORDERS.columns[5:]

TRANSACTIONS = Entity(
    "transactions",
    "csv",
    "transactions_*.csv",
    (
        "Order_ID", "Product_ID", "Sales", "Quantity", "discount", "profit",
        "payment_type", "payment_installments",
    ),
    {
        "valid_order_id": "order_id IS NOT NULL",
        "valid_product_id": "product_id IS NOT NULL",
        "valid_sales": "sales IS NOT NULL",
        "valid_payment_type": "payment_type IN ('credit_card', 'debit_card', 'voucher')",
    },
)

RETURNS = Entity(
    "returns",
    "json",
    "returns_*.json",
    (
        "order_id", "return_reason", "return_date", "refund_amount", "return_status",
        "OrderId", "reason", "date_of_return", "amount", "status",
    ),
    {
        "valid_order_id": "order_id IS NOT NULL",
        "valid_return_reason": "return_reason IS NOT NULL AND return_reason != ''",
        "valid_return_status": "return_status IN ('Pending', 'Rejected', 'Approved')",
        "valid_refund_amount": "refund_amount IS NOT NULL",
    },
)

PRODUCTS = Entity(
    "products",
    "json",
    "products*.json",
    (
        "product_id", "product_name", "categories", "brand", "colors", "sizes", "upc",
        "weight", "dimension", "manufacturer", "dateAdded", "dateUpdated",
        "product_photos_qty",
    ),
    {
        "valid_product_id": "product_id IS NOT NULL",
        "valid_product_name": "product_name IS NOT NULL",
        "valid_upc": "upc IS NOT NULL",
        "valid_product_photos_qty": "product_photos_qty >= 0",
    },
)

VENDORS = Entity(
    "vendors",
    "csv",
    "vendors*.csv",
    ("vendor_id", "vendor_name"),
    {
        "valid_vendor_id": "vendor_id IS NOT NULL",
        "valid_vendor_name": "vendor_name IS NOT NULL",
    },
)

ENTITIES = {e.name: e for e in (CUSTOMERS, ORDERS, TRANSACTIONS, RETURNS, PRODUCTS, VENDORS)}

# Spellings seen in the files and the terms they stand for.
SEGMENTS = {
    "Consumer": ("consumer", "cons", "cosumer"),
    "Corporate": ("corporate", "corp"),
    "Home Office": ("home office", "ho"),
}
REGIONS = {
    "East": ("E", "East"),
    "West": ("W", "West"),
    "South": ("S", "South"),
    "North": ("N", "North"),
    "Central": ("Central",),
}
SHIP_MODES = {
    "First Class": ("1st Class",),
    "Second Class": ("2nd Class",),
    "Standard Class": ("Std Class",),
}
RETURN_STATUSES = {"Approved": ("APPRVD",), "Rejected": ("RJCTD",), "Pending": ("PENDG",)}
SWAPPED_REGION = "4"

RESCUED = "_rescued_data"
LINEAGE = {
    "_source_file": "string",
    "_load_timestamp": "timestamp",
    "_region": "string",
    RESCUED: "string",
}
PUBLIC_LINEAGE = {
    "_source_file": "source_file",
    "_load_timestamp": "load_timestamp",
    "_region": "region",
}
