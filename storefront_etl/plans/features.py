"""Feature step over five tables: region, category group, units, calendar.

Every feature is a native expression appended in one projection per table;
no Python worker is involved and the features fuse with the table scan in a
single whole-stage-codegen stage.  Output column names are parameters
(the original job hard-coded two of them).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storefront_etl.functions.calendar import LAST, day_of_week_name, month_name
from storefront_etl.functions.labels import category_group, region_of_state
from storefront_etl.functions.units import PRODUCT_UNITS, convert_units


# (input column, output column) of the features that the original job named itself.
REGION_COLUMNS = {"customers": ("customer_state", "customer_region"), "sellers": ("seller_state", "seller_region")}
CATEGORY_COLUMNS = ("product_category_name", "sub_product_category")


def add_region(df: DataFrame, state_col: str, out: str) -> DataFrame:
    return df.withColumn(out, region_of_state(state_col))


def add_category_group(df: DataFrame, category_col: str, out: str) -> DataFrame:
    return df.withColumn(out, category_group(category_col))


def add_order_calendar(
    orders: DataFrame,
    purchase_col: str = "order_purchase_timestamp",
    approved_col: str = "order_approved_at",
    delivered_col: str = "order_delivered_customer_date",
    prefix: str = "order",
    null_name: str | None = LAST,
) -> DataFrame:
    """Weekday number/name, month number/name, delivery days, hour, processing days.

    Column order follows the original script: weekday, weekday name, month,
    month name, delivery days, hour, processing days.
    """
    purchase = F.col(purchase_col)
    weekday = F.dayofweek(purchase)
    month = F.month(purchase)
    return orders.withColumns({
        f"{prefix}_day_of_week": weekday,
        f"{prefix}_name_day_of_week": day_of_week_name(weekday, null_name),
        f"{prefix}_month": month,
        f"{prefix}_name_month": month_name(month, null_name),
        f"{prefix}_delivery_days": F.datediff(F.col(delivered_col), purchase),
        f"{prefix}_hour": F.hour(purchase),
        f"{prefix}_processing_days": F.datediff(F.col(approved_col), purchase),
    })


@dataclass(frozen=True)
class FeatureTables:
    customers: DataFrame
    sellers: DataFrame
    products: DataFrame
    product_category: DataFrame
    orders: DataFrame


def create_new_features(
    customers: DataFrame,
    sellers: DataFrame,
    products: DataFrame,
    product_category: DataFrame,
    orders: DataFrame,
) -> FeatureTables:
    """All features of the pipeline.  Unlike the original script (which
    computed the category group and then saved the untransformed table),
    the returned category table carries ``sub_product_category``."""
    return FeatureTables(
        customers=add_region(customers, *REGION_COLUMNS["customers"]),
        sellers=add_region(sellers, *REGION_COLUMNS["sellers"]),
        products=convert_units(products, PRODUCT_UNITS),
        product_category=add_category_group(product_category, *CATEGORY_COLUMNS),
        orders=add_order_calendar(orders),
    )
