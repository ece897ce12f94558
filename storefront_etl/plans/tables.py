"""The per-table transforms: all-string raw DataFrame -> typed table.

Each function is DataFrame -> DataFrame and builds one narrow projection
(plus, for the three location tables, one lookup — broadcast whenever the
dimension passes the size check, as a postcode dimension always does), so a
table is produced in a single scan with no shuffle.  Output columns and order follow
the original job; behaviour differences are documented per function.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storefront_etl.functions.casts import lenient_cast, lenient_int
from storefront_etl.operators.lookup import EXPAND, PreparedLookup, lookup_dimension, prepare_lookup

POSTCODE_KEY = "cep_prefix"
POSTCODE_VALUE = "locality"


def postcode_lookup(postcodes: DataFrame, on_multiple: str = EXPAND, **lookup_options) -> PreparedLookup:
    """The (locality, cep_prefix) dimension prepared and measured once, for
    sharing between the customers, geolocation and sellers transforms."""
    return prepare_lookup(
        postcodes, dim_key=POSTCODE_KEY, dim_value=POSTCODE_VALUE, on_multiple=on_multiple,
        **lookup_options,
    )


def _city_lookup(
    raw: DataFrame,
    postcodes: DataFrame | PreparedLookup,
    zip_col: str,
    city_col: str,
    fallback,
    on_multiple: str | None,
    **lookup_options,
) -> DataFrame:
    """``postcodes`` is the raw dimension or a shared :func:`postcode_lookup`
    (whose own fan-out mode and size decision then apply; giving other
    options with it is an error)."""
    if on_multiple is not None:
        lookup_options["on_multiple"] = on_multiple
    return lookup_dimension(
        raw,
        postcodes,
        key=zip_col,
        dim_key=POSTCODE_KEY,
        dim_value=POSTCODE_VALUE,
        out=city_col,
        fallback=fallback,
        value_transform=F.lower,
        **lookup_options,
    )


def transform_customers(
    raw: DataFrame, postcodes: DataFrame | PreparedLookup, on_multiple: str | None = None, **lookup_options
) -> DataFrame:
    """City from the postcode dimension (lowercased), no fallback: an
    unmatched prefix gives a NULL city.  State lowercased, before the lookup
    repeats rows."""
    looked_up = _city_lookup(
        raw.withColumn("customer_state", F.lower("customer_state")), postcodes, "customer_zip_code_prefix", "customer_city", None,
        on_multiple, **lookup_options,
    )
    return looked_up.select(
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
    )


def transform_geolocation(
    raw: DataFrame, postcodes: DataFrame | PreparedLookup, on_multiple: str | None = None, **lookup_options
) -> DataFrame:
    """Coordinates to DOUBLE; city from the dimension, else the raw city
    exactly as written (no lowercasing).  State lowercased."""
    looked_up = _city_lookup(
        raw, postcodes, "geolocation_zip_code_prefix", "geolocation_city",
        F.col("geolocation_city"), on_multiple, **lookup_options,
    )
    return looked_up.select(
        "geolocation_zip_code_prefix",
        lenient_cast("geolocation_lat", "double").alias("geolocation_lat"),
        lenient_cast("geolocation_lng", "double").alias("geolocation_lng"),
        "geolocation_city",
        F.lower("geolocation_state").alias("geolocation_state"),
    )


def transform_sellers(
    raw: DataFrame, postcodes: DataFrame | PreparedLookup, on_multiple: str | None = None, **lookup_options
) -> DataFrame:
    """City from the dimension, else the raw city lowercased.  State lowercased."""
    looked_up = _city_lookup(
        raw, postcodes, "seller_zip_code_prefix", "seller_city",
        F.lower(F.col("seller_city")), on_multiple, **lookup_options,
    )
    return looked_up.select(
        "seller_id",
        "seller_zip_code_prefix",
        "seller_city",
        F.lower("seller_state").alias("seller_state"),
    )


def transform_order_items(raw: DataFrame) -> DataFrame:
    """Shipping limit to TIMESTAMP, money to FLOAT; ids stay text."""
    return raw.select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        lenient_cast("shipping_limit_date", "timestamp").alias("shipping_limit_date"),
        lenient_cast("price", "float").alias("price"),
        lenient_cast("freight_value", "float").alias("freight_value"),
    )


def transform_order_payments(raw: DataFrame) -> DataFrame:
    """Sequence and instalments to INT (truncating), value to FLOAT."""
    return raw.select(
        "order_id",
        lenient_int("payment_sequential").alias("payment_sequential"),
        "payment_type",
        lenient_int("payment_installments").alias("payment_installments"),
        lenient_cast("payment_value", "float").alias("payment_value"),
    )


ORDER_TIMESTAMPS = (
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
)


def transform_orders(raw: DataFrame) -> DataFrame:
    """Four event columns to TIMESTAMP, estimated delivery to DATE."""
    return raw.select(
        "order_id",
        "customer_id",
        "order_status",
        *[lenient_cast(c, "timestamp").alias(c) for c in ORDER_TIMESTAMPS],
        lenient_cast("order_estimated_delivery_date", "date").alias("order_estimated_delivery_date"),
    )


PRODUCT_INT_COLUMNS = (
    "product_name_lenght",
    "product_description_lenght",
    "product_photos_qty",
    "product_weight_g",
    "product_length_cm",
    "product_height_cm",
    "product_width_cm",
)


def transform_products(raw: DataFrame) -> DataFrame:
    """Category lowercased; seven measures to INT (truncating)."""
    return raw.select(
        "product_id",
        F.lower("product_category_name").alias("product_category_name"),
        *[lenient_int(c).alias(c) for c in PRODUCT_INT_COLUMNS],
    )
