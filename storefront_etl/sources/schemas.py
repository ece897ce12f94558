"""Raw extract layouts: every raw column is text.

Only columns that the transforms read are listed; real extracts may carry
more, so readers select these columns by header name rather than by
position.  The source spelling ``lenght`` is kept on purpose.
"""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType

RAW_COLUMNS: dict[str, tuple[str, ...]] = {
    "customers": (
        "customer_id", "customer_unique_id", "customer_zip_code_prefix",
        "customer_city", "customer_state",
    ),
    "geolocation": (
        "geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng",
        "geolocation_city", "geolocation_state",
    ),
    "order_items": (
        "order_id", "order_item_id", "product_id", "seller_id",
        "shipping_limit_date", "price", "freight_value",
    ),
    "order_payments": (
        "order_id", "payment_sequential", "payment_type",
        "payment_installments", "payment_value",
    ),
    "orders": (
        "order_id", "customer_id", "order_status", "order_purchase_timestamp",
        "order_approved_at", "order_delivered_carrier_date",
        "order_delivered_customer_date", "order_estimated_delivery_date",
    ),
    "products": (
        "product_id", "product_category_name", "product_name_lenght",
        "product_description_lenght", "product_photos_qty", "product_weight_g",
        "product_length_cm", "product_height_cm", "product_width_cm",
    ),
    "sellers": ("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"),
    "product_category": ("product_category_name", "product_category_name_english"),
    "postcode_ranges": ("locality", "postcode_range"),
}


def all_string_schema(columns: tuple[str, ...] | list[str]) -> StructType:
    """StructType with every column nullable text (for streams, which need one)."""
    return StructType([StructField(c, StringType(), True) for c in columns])
