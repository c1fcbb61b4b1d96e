"""The nine marketplace tables: schemas, keys and length limits, as data.

Schemas describe the reference-format CSV files (string ids).  Keys and length
limits drive the quality rules in ``operators.quality``.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, I, D, TS = T.StringType(), T.IntegerType(), T.DoubleType(), T.TimestampNTZType()


def _schema(*fields):
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


SCHEMAS: dict[str, T.StructType] = {
    "geolocation": _schema(
        ("geolocation_zip_code_prefix", S), ("geolocation_lat", D), ("geolocation_lng", D),
        ("geolocation_city", S), ("geolocation_state", S)),
    "customers": _schema(
        ("customer_id", S), ("customer_unique_id", S), ("customer_zip_code_prefix", S),
        ("customer_city", S), ("customer_state", S)),
    "orders": _schema(
        ("order_id", S), ("customer_id", S), ("order_status", S),
        ("order_purchase_timestamp", TS), ("order_approved_at", TS),
        ("order_delivered_carrier_date", TS), ("order_delivered_customer_date", TS),
        ("order_estimated_delivery_date", TS)),
    "sellers": _schema(
        ("seller_id", S), ("seller_zip_code_prefix", S), ("seller_city", S), ("seller_state", S)),
    "prodcategory": _schema(
        ("product_category_name", S), ("product_category_name_english", S)),
    "products": _schema(
        ("product_id", S), ("product_category_name", S), ("product_name_lenght", I),
        ("product_description_lenght", I), ("product_photos_qty", I), ("product_weight_g", D),
        ("product_length_cm", D), ("product_height_cm", D), ("product_width_cm", D)),
    "order_items": _schema(
        ("order_id", S), ("order_item_id", I), ("product_id", S), ("seller_id", S),
        ("shipping_limit_date", TS), ("price", D), ("freight_value", D)),
    "order_payments": _schema(
        ("order_id", S), ("payment_sequential", I), ("payment_type", S),
        ("payment_installments", I), ("payment_value", D)),
    "order_reviews": _schema(
        ("review_id", S), ("order_id", S), ("review_score", I), ("review_comment_title", S),
        ("review_comment_message", S), ("review_creation_date", TS),
        ("review_answer_timestamp", TS)),
}

# File naming of a raw export (fixed values): one "<prefix><table>_dataset.csv" per
# table, and the category translation table under its own name.
CATEGORY_FILE = "product_category_name_translation.csv"


def csv_file_names(prefix: str = "") -> dict[str, str]:
    """Raw CSV file name per table; ``prefix`` is the export's file-name prefix."""
    return {t: CATEGORY_FILE if t == "prodcategory" else f"{prefix}{t}_dataset.csv"
            for t in SCHEMAS}


# Primary keys (fixed values).  Items and payments are keyed by all their columns.
PRIMARY_KEYS: dict[str, tuple[str, ...]] = {
    "geolocation": ("geolocation_zip_code_prefix",),
    "customers": ("customer_id",),
    "orders": ("order_id",),
    "sellers": ("seller_id",),
    "prodcategory": ("product_category_name",),
    "products": ("product_id",),
    "order_items": ("order_id", "order_item_id", "product_id", "seller_id",
                    "shipping_limit_date", "price", "freight_value"),
    "order_payments": ("order_id", "payment_sequential", "payment_type",
                       "payment_installments", "payment_value"),
    "order_reviews": ("review_id", "order_id"),
}

# Foreign keys: (child table, child column, parent table, parent column) (fixed values).
FOREIGN_KEYS: tuple[tuple[str, str, str, str], ...] = (
    ("customers", "customer_zip_code_prefix", "geolocation", "geolocation_zip_code_prefix"),
    ("orders", "customer_id", "customers", "customer_id"),
    ("sellers", "seller_zip_code_prefix", "geolocation", "geolocation_zip_code_prefix"),
    ("products", "product_category_name", "prodcategory", "product_category_name"),
    ("order_items", "order_id", "orders", "order_id"),
    ("order_items", "product_id", "products", "product_id"),
    ("order_items", "seller_id", "sellers", "seller_id"),
    ("order_payments", "order_id", "orders", "order_id"),
    ("order_reviews", "order_id", "orders", "order_id"),
)

# VARCHAR(n) limits per text column (fixed values).
MAX_LENGTHS: dict[str, dict[str, int]] = {
    "geolocation": {"geolocation_zip_code_prefix": 10, "geolocation_city": 50,
                    "geolocation_state": 10},
    "customers": {"customer_id": 50, "customer_unique_id": 50, "customer_zip_code_prefix": 10,
                  "customer_city": 50, "customer_state": 10},
    "orders": {"order_id": 50, "customer_id": 50, "order_status": 20},
    "sellers": {"seller_id": 50, "seller_zip_code_prefix": 10, "seller_city": 50,
                "seller_state": 10},
    "prodcategory": {"product_category_name": 100, "product_category_name_english": 100},
    "products": {"product_id": 50, "product_category_name": 100},
    "order_items": {"order_id": 50, "product_id": 50, "seller_id": 50},
    "order_payments": {"order_id": 50, "payment_type": 20},
    "order_reviews": {"review_id": 50, "order_id": 50, "review_comment_title": 100,
                      "review_comment_message": 500},
}

# Amounts that are summed exactly.
MONEY_COLUMNS: tuple[str, ...] = ("price", "freight_value", "payment_value")

# Parents before children: the order tables are loaded in.
LOAD_ORDER: tuple[str, ...] = (
    "geolocation", "customers", "prodcategory", "products", "orders", "sellers",
    "order_items", "order_payments", "order_reviews",
)
