"""Driver query catalogue: every operator applied to the shared test tables.

Each query runs the real operator or table transform on a stand-in extract
built by :mod:`storefront_etl.plans.standins` from whole test tables.
``QUERIES[name](spark, sf_dir)`` returns a DataFrame; ``ORACLE_SQL[name]`` is
the same computation in DuckDB SQL over the raw tables (views named like the
parquet files).  Column names match one-to-one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storefront_etl.functions.calendar import LAST, with_day_diff, with_day_of_week, with_hour, with_month
from storefront_etl.functions.casts import lenient_cast, lenient_int
from storefront_etl.functions.sql import register_functions
from storefront_etl.functions.units import PRODUCT_UNITS, convert_units
from storefront_etl.operators.fill import fill_missing_by_union
from storefront_etl.operators.lookup import (
    FIRST,
    lookup_dimension,
)
from storefront_etl.operators.postcode import expand_postcode_ranges
from storefront_etl.operators.prefix_cover import lookup_range, prefix_cover
from storefront_etl.operators.profile import distinct_values, null_profile, preview, profile_columns
from storefront_etl.operators.rejects import read_csv_checked, typed_and_rejected
from storefront_etl.operators.sketches import append_profile, distinct_error, read_profile
from storefront_etl.plans.features import add_category_group, add_order_calendar, add_region, create_new_features
from storefront_etl.plans.jobs import PipelinePaths, prepare_postcodes, run_pipeline, write_postcodes
from storefront_etl.plans.standins import (
    CATEGORIES,
    SQL_CUSTOMERS_RAW,
    SQL_FULL_CODE_CUSTOMERS,
    SQL_FULL_CODE_RANGES,
    SQL_GEO_JOINED,
    SQL_ORDER_FEATURES,
    SQL_ORDER_ITEMS_RAW,
    SQL_ORDERS_TYPED,
    SQL_ORDERS_WITH_SHIP,
    SQL_PRODUCTS_RAW,
    SQL_REPEATED_CEPS,
    SQL_SKEWED_CUSTOMERS_RAW,
    SQL_SUPPLIER_RANGES,
    SQL_SELLERS_RAW,
    SQL_CEPS,
    as_text,
    category_dictionary_raw,
    customers_raw,
    full_code_customers,
    full_code_ranges,
    geo_select,
    geolocation_raw,
    nation_ranges,
    order_items_raw,
    orders_raw,
    orders_with_ship,
    payments_raw,
    pick,
    postcodes,
    products_raw,
    repeated_postcodes,
    sellers_raw,
    skewed_customers_raw,
    sql_category,
    sql_customers,
    sql_day_diff,
    sql_day_name,
    sql_expand,
    sql_lenient_int,
    sql_month_name,
    sql_payments_raw,
    sql_pick,
    sql_region,
    sql_strict_int,
    supplier_ranges,
    table,
    write_standin_extracts,
)
from storefront_etl.plans.tables import (
    transform_customers,
    transform_geolocation,
    transform_order_items,
    transform_order_payments,
    transform_orders,
    transform_products,
    transform_sellers,
)
from storefront_etl.sources.csv import read_category_dictionary, read_csv_strings, read_reviews, write_csv
from storefront_etl.sources.parquet import register_views, scratch_path, write_tables
from storefront_etl.sources.publish import publish_tables

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}


def _register(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


# ---------------------------------------------------------------------------
# The queries
# ---------------------------------------------------------------------------
@_register("postcode_expand", sql_expand(SQL_SUPPLIER_RANGES))
def q_postcode_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Range text -> one row per 5-digit prefix (string, no leading zeros)."""
    return expand_postcode_ranges(supplier_ranges(table(spark, sf_dir, "supplier")))


@_register("lookup_no_fallback", sql_customers(SQL_CUSTOMERS_RAW))
def q_lookup_no_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers table: city from the postcode dimension, fan-out kept, NULL on miss."""
    raw = customers_raw(table(spark, sf_dir, "customer"))
    return transform_customers(raw, postcodes(spark, sf_dir))


@_register("lookup_first", sql_customers(SQL_CUSTOMERS_RAW, first=True))
def q_lookup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers table with one row per customer (smallest locality per prefix)."""
    raw = customers_raw(table(spark, sf_dir, "customer"))
    return transform_customers(raw, postcodes(spark, sf_dir), on_multiple=FIRST)


@_register("lookup_salted", sql_customers(SQL_SKEWED_CUSTOMERS_RAW, SQL_REPEATED_CEPS))
def q_lookup_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers table through the non-broadcast path: a third of the rows in
    one postcode, one dimension key repeated for every supplier, and a budget
    per task that cuts both into grids."""
    raw = skewed_customers_raw(table(spark, sf_dir, "customer"))
    return transform_customers(raw, repeated_postcodes(spark, sf_dir), broadcast_max_rows=0, rows_per_salt=40)


# Keys above 2^31 on both sides: an order line number space shifted past INT.
_BIG = 5_000_000_000
_SQL_BIGINT_LOOKUP = f"""
SELECT o_orderkey + {_BIG} AS order_key, o_custkey + {_BIG} AS customer_key, c_name AS customer_name
FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_custkey % 5 <> 0"""


def _bigint_lookup(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    facts = table(spark, sf_dir, "orders").select(
        (F.col("o_orderkey") + F.lit(_BIG)).alias("order_key"), (F.col("o_custkey") + F.lit(_BIG)).alias("customer_key")
    )
    # Every fifth customer's key is NULL in the dimension: its orders find nothing.
    dim = table(spark, sf_dir, "customer").select(
        F.when(F.col("c_custkey") % 5 != 0, F.col("c_custkey") + F.lit(_BIG)).alias("key.of"), F.col("c_name").alias("name.of")
    )
    return lookup_dimension(
        facts, dim, key="customer_key", dim_key="key.of", dim_value="name.of", out="customer_name", **options
    )


@_register("lookup_bigint_key", _SQL_BIGINT_LOOKUP)
def q_lookup_bigint_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BIGINT keys beyond INT, columns with dots in their names, broadcast path."""
    return _bigint_lookup(spark, sf_dir)


@_register("lookup_bigint_salted", _SQL_BIGINT_LOOKUP)
def q_lookup_bigint_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through the non-broadcast path, its busiest keys cut up."""
    return _bigint_lookup(spark, sf_dir, broadcast_max_rows=0, rows_per_salt=20)


@_register("lookup_fallback_raw", f"SELECT {geo_select('coalesce(city_lookup, city_original)')} FROM ({SQL_GEO_JOINED}) j")
def q_lookup_fallback_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Geolocation table: coordinates to DOUBLE, city falls back to the raw text."""
    raw = geolocation_raw(table(spark, sf_dir, "customer"))
    return transform_geolocation(raw, postcodes(spark, sf_dir))


@_register("union_halves", f"""
SELECT {geo_select('city_lookup')} FROM ({SQL_GEO_JOINED}) j WHERE city_lookup IS NOT NULL
UNION ALL
SELECT {geo_select('city_original')} FROM ({SQL_GEO_JOINED}) j WHERE city_lookup IS NULL""")
def q_union_halves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Geolocation fallback in the original split / overwrite / UNION ALL form."""
    raw = geolocation_raw(table(spark, sf_dir, "customer")).withColumn(
        "city_original", F.col("geolocation_city")
    )
    joined = lookup_dimension(
        raw, postcodes(spark, sf_dir), key="geolocation_zip_code_prefix",
        dim_key="cep_prefix", dim_value="locality", out="geolocation_city",
        value_transform=F.lower,
    )
    filled = fill_missing_by_union(joined, "geolocation_city", F.col("city_original"))
    return filled.select(
        "geolocation_zip_code_prefix",
        lenient_cast("geolocation_lat", "double").alias("geolocation_lat"),
        lenient_cast("geolocation_lng", "double").alias("geolocation_lng"),
        "geolocation_city",
        F.lower("geolocation_state").alias("geolocation_state"),
    )


@_register("lookup_fallback_lower", f"""
SELECT s.seller_id, s.seller_zip_code_prefix,
       coalesce(lower(p.locality), lower(s.seller_city)) AS seller_city,
       lower(s.seller_state) AS seller_state,
       {sql_region('lower(s.seller_state)')} AS seller_region
FROM ({SQL_SELLERS_RAW}) s LEFT JOIN ({SQL_CEPS}) p
  ON {sql_lenient_int('s.seller_zip_code_prefix')} = {sql_lenient_int('p.cep_prefix')}""")
def q_lookup_fallback_lower(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sellers table: city falls back to the lowercased raw text; region label."""
    raw = sellers_raw(table(spark, sf_dir, "supplier"))
    sellers = transform_sellers(raw, postcodes(spark, sf_dir))
    return add_region(sellers, "seller_state", "seller_region")


@_register("region_label", f"""
SELECT *, {sql_region('customer_state')} AS customer_region
FROM ({sql_customers(SQL_CUSTOMERS_RAW)}) c""")
def q_region_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Final customers table: lookup + region label ('sul' for unknown/NULL)."""
    customers = q_lookup_no_fallback(spark, sf_dir)
    return add_region(customers, "customer_state", "customer_region")


@_register("category_group", f"""
SELECT {sql_pick(CATEGORIES, 'p_partkey')} AS product_category_name,
       p_type AS product_category_name_english,
       {sql_category(sql_pick(CATEGORIES, 'p_partkey'))} AS sub_product_category
FROM part""")
def q_category_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category dictionary + group label ('outros' for unknown/NULL/other case)."""
    part = table(spark, sf_dir, "part")
    dictionary = part.select(
        pick(CATEGORIES, F.col("p_partkey")).alias("product_category_name"),
        F.col("p_type").alias("product_category_name_english"),
    )
    return add_category_group(dictionary, "product_category_name", "sub_product_category")


_PRODUCT_INTS = (
    "product_name_lenght", "product_description_lenght", "product_photos_qty",
    "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
)


@_register("unit_convert", f"""
SELECT *, product_weight_g / 1000 AS product_weight_kg, product_length_cm / 100 AS product_length_m, product_height_cm / 100 AS product_height_m, product_width_cm / 100 AS product_width_m
FROM (SELECT product_id, lower(product_category_name) AS product_category_name,
             {', '.join(f'{sql_lenient_int(c)} AS {c}' for c in _PRODUCT_INTS)}
      FROM ({SQL_PRODUCTS_RAW}) r) t""")
def q_unit_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Final products table: lenient INT measures + g->kg and cm->m (DOUBLE)."""
    products = transform_products(products_raw(table(spark, sf_dir, "part")))
    return convert_units(products, PRODUCT_UNITS)


@_register("day_name", f"""
SELECT event_id, CAST(dayofweek(ts) + 1 AS INTEGER) AS order_day_of_week,
       {sql_day_name('ts')} AS order_name_day_of_week
FROM events""")
def q_day_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekday number (1 = Sunday) and English name of each event time."""
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    return with_day_of_week(events, "ts", "order_day_of_week", "order_name_day_of_week").drop("ts")


@_register("month_name", f"""
SELECT o_orderkey, CAST(month(o_orderdate) AS INTEGER) AS order_month,
       {sql_month_name('o_orderdate')} AS order_name_month
FROM orders""")
def q_month_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month number and English name of each order date."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return with_month(orders, "o_orderdate", "order_month", "order_name_month").drop("o_orderdate")


@_register("null_date_names", f"""
SELECT o_orderkey,
       CAST(dayofweek(first_ship) + 1 AS INTEGER) AS ship_day_of_week,
       {sql_day_name('first_ship')} AS ship_name_day_of_week,
       CAST(month(first_ship) AS INTEGER) AS ship_month,
       {sql_month_name('first_ship')} AS ship_name_month
FROM ({SQL_ORDERS_WITH_SHIP}) ow""")
def q_null_date_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders without items have no ship date: numbers NULL, names 'saturday'/'december'."""
    df = orders_with_ship(spark, sf_dir).select("o_orderkey", "first_ship")
    named = with_day_of_week(df, "first_ship", "ship_day_of_week", "ship_name_day_of_week", LAST)
    return with_month(named, "first_ship", "ship_month", "ship_name_month", LAST).drop("first_ship")


@_register("hour_of_day", "SELECT event_id, CAST(hour(ts) AS INTEGER) AS event_hour FROM events")
def q_hour_of_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hour of day of each event time."""
    return with_hour(table(spark, sf_dir, "events").select("event_id", "ts"), "ts", "event_hour").drop("ts")


@_register("day_diff", f"""
SELECT o_orderkey, {sql_day_diff('first_ship', 'o_orderdate')} AS ship_days
FROM ({SQL_ORDERS_WITH_SHIP}) ow""")
def q_day_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar days order date -> first shipment (NULL without items; may be negative)."""
    df = orders_with_ship(spark, sf_dir).select("o_orderkey", "first_ship", "o_orderdate")
    return with_day_diff(df, "first_ship", "o_orderdate", "ship_days").select("o_orderkey", "ship_days")


@_register("cast_money", f"""
SELECT order_id, order_item_id, product_id, seller_id,
       TRY_CAST(shipping_limit_date AS TIMESTAMP) AS shipping_limit_date,
       TRY_CAST(price AS FLOAT) AS price,
       TRY_CAST(freight_value AS FLOAT) AS freight_value
FROM ({SQL_ORDER_ITEMS_RAW}) r""")
def q_cast_money(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order items table: TIMESTAMP and FLOAT columns from text, junk -> NULL."""
    return transform_order_items(order_items_raw(table(spark, sf_dir, "lineitem")))


@_register("cast_coordinates", """
SELECT s_suppkey,
       TRY_CAST(CASE WHEN s_suppkey % 7 = 0 THEN ' ' || CAST(s_acctbal AS VARCHAR) || ' '
                     WHEN s_suppkey % 11 = 0 THEN 'abc'
                     ELSE CAST(s_acctbal AS VARCHAR) END AS DOUBLE) AS coordinate
FROM supplier""")
def q_cast_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text -> DOUBLE with padding and junk (padding accepted, junk -> NULL)."""
    supplier = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    text = (
        F.when(F.pmod(k, F.lit(7)) == 0, F.concat(F.lit(" "), as_text("s_acctbal"), F.lit(" ")))
        .when(F.pmod(k, F.lit(11)) == 0, F.lit("abc"))
        .otherwise(as_text("s_acctbal"))
    )
    return supplier.select("s_suppkey", lenient_cast(text, "double").alias("coordinate"))


@_register("cast_int_lenient", f"""
SELECT order_id,
       {sql_lenient_int('payment_sequential')} AS payment_sequential,
       payment_type,
       {sql_lenient_int('payment_installments')} AS payment_installments,
       TRY_CAST(payment_value AS FLOAT) AS payment_value
FROM ({sql_payments_raw()}) r""")
def q_cast_int_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments table: old truncating INT semantics under ANSI ('650.0' -> 650)."""
    return transform_order_payments(payments_raw(table(spark, sf_dir, "orders")))


@_register("cast_date", SQL_ORDERS_TYPED)
def q_cast_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders table: four TIMESTAMP columns and one DATE column from text."""
    return transform_orders(orders_raw(spark, sf_dir))


@_register("order_features", SQL_ORDER_FEATURES)
def q_order_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: final orders table (typed) with all calendar features."""
    return add_order_calendar(transform_orders(orders_raw(spark, sf_dir)))


@_register("csv_roundtrip_text", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text FROM documents")
def q_csv_roundtrip_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Free text with quotes, commas and line breaks survives CSV write + read by file splits."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = scratch_path(spark, "csv-roundtrip-text")
    write_csv(docs, path)
    return read_reviews(spark, path, columns=("doc_id", "text"))


@_register("csv_all_strings", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment
FROM customer""")
def q_csv_all_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header CSV with an explicit separator read back with every column as text."""
    customer = table(spark, sf_dir, "customer")
    path = scratch_path(spark, "csv-all-strings")
    customer.write.mode("overwrite").option("header", True).option("sep", ";").csv(path)
    return read_csv_strings(spark, path, columns=customer.columns, sep=";")


@_register("parquet_overwrite", "SELECT * FROM orders")
def q_parquet_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overwrite a Parquet table twice; the read-back equals the source once."""
    orders = table(spark, sf_dir, "orders")
    out = scratch_path(spark, "parquet-overwrite")
    write_tables({"orders": orders}, out)
    paths = write_tables({"orders": orders}, out)
    return spark.read.parquet(paths["orders"])


@_register("sql_view", f"""
SELECT *, amount / total_amount AS share FROM (
  SELECT payment_type AS kind, count(*) AS payments, CAST(sum(payment_sequential) AS BIGINT) AS steps,
         CAST(sum(amount) AS BIGINT) AS amount, CAST(sum(sum(amount)) OVER () AS BIGINT) AS total_amount
  FROM (SELECT payment_type, {sql_lenient_int('payment_sequential')} AS payment_sequential,
               CAST(floor(coalesce(TRY_CAST(payment_value AS FLOAT), 0)) AS BIGINT) AS amount FROM ({sql_payments_raw()}) raw) typed
  WHERE payment_type IS NOT NULL GROUP BY payment_type) q""")
def q_sql_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL text over a registered temp view: the payments table by kind, with
    star, aliases and derived columns.  The view goes when the plan is made."""
    payments = transform_order_payments(payments_raw(table(spark, sf_dir, "orders")))
    view = f"payments_{uuid.uuid4().hex}"
    register_views(spark, {view: payments})
    try:
        return spark.sql(f"""
            SELECT *, amount / total_amount AS share FROM (
              SELECT payment_type AS kind, count(*) AS payments, CAST(sum(payment_sequential) AS BIGINT) AS steps,
                     sum(CAST(floor(coalesce(payment_value, 0)) AS BIGINT)) AS amount,
                     sum(sum(CAST(floor(coalesce(payment_value, 0)) AS BIGINT))) OVER () AS total_amount
              FROM {view} WHERE payment_type IS NOT NULL GROUP BY payment_type) q""")
    finally:
        spark.catalog.dropTempView(view)


@_register("null_profile", f"""
SELECT count(CASE WHEN order_id IS NULL THEN 1 END) AS order_id,
       count(CASE WHEN payment_sequential IS NULL THEN 1 END) AS payment_sequential,
       count(CASE WHEN payment_type IS NULL THEN 1 END) AS payment_type,
       count(CASE WHEN payment_installments IS NULL THEN 1 END) AS payment_installments,
       count(CASE WHEN payment_value IS NULL OR isnan(payment_value) THEN 1 END) AS payment_value
FROM (SELECT order_id, {sql_lenient_int('payment_sequential')} AS payment_sequential, payment_type,
             {sql_lenient_int('payment_installments')} AS payment_installments,
             TRY_CAST(payment_value AS FLOAT) AS payment_value
      FROM ({sql_payments_raw('NaN')}) r) t""")
def q_null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing (NULL, or NaN for floats) per column of the payments table."""
    payments = transform_order_payments(payments_raw(table(spark, sf_dir, "orders"), bad_value="NaN"))
    return null_profile(payments)


_FEATURE_TYPES = (
    ("order_id", "string"), ("customer_id", "string"), ("order_status", "string"),
    ("order_purchase_timestamp", "timestamp"), ("order_approved_at", "timestamp"),
    ("order_delivered_carrier_date", "timestamp"), ("order_delivered_customer_date", "timestamp"),
    ("order_estimated_delivery_date", "date"), ("order_day_of_week", "int"),
    ("order_name_day_of_week", "string"), ("order_month", "int"), ("order_name_month", "string"),
    ("order_delivery_days", "int"), ("order_hour", "int"), ("order_processing_days", "int"),
)


@_register("profile_columns", "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS column_name, '{t}' AS data_type, count(*) AS row_count,
       count(*) - count({c}) AS null_count, count(DISTINCT {c}) AS distinct_count
FROM ({SQL_ORDER_FEATURES}) f""" for c, t in _FEATURE_TYPES))
def q_profile_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-column type, rows, missing and exact distinct counts of the orders table."""
    return profile_columns(q_order_features(spark, sf_dir))


@_register("distinct_values", "SELECT DISTINCT o_orderstatus FROM orders")
def q_distinct_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct order statuses (partial distinct per partition, one shuffle)."""
    return distinct_values(table(spark, sf_dir, "orders"), "o_orderstatus")


@_register("like_prefix", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'red%'")
def q_like_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix filter pushed into the Parquet scan."""
    part = table(spark, sf_dir, "part")
    return part.where(F.col("p_name").like("red%")).select("p_partkey", "p_name")


@_register("limit_preview", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5")
def q_limit_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The preview feature itself: first 5 orders by key (top-n, no full sort)."""
    return preview(table(spark, sf_dir, "orders"), 5, order_by="o_orderkey")


# ---------------------------------------------------------------------------
# Whole jobs
# ---------------------------------------------------------------------------
def _written_extracts(spark: SparkSession, sf_dir: str) -> tuple[str, dict[str, str]]:
    base = scratch_path(spark, "job")
    return base, write_standin_extracts(spark, sf_dir, f"{base}/raw")


@_register("job_postcodes", sql_expand(SQL_SUPPLIER_RANGES))
def q_job_postcodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The postcode job: range CSV (with NULL, junk and reversed ranges) -> Parquet of prefixes."""
    base = scratch_path(spark, "job-postcodes")
    write_csv(supplier_ranges(table(spark, sf_dir, "supplier")), f"{base}/ranges.csv")
    return spark.read.parquet(prepare_postcodes(spark, f"{base}/ranges.csv", f"{base}/prefixes.parquet"))


# Job table -> query whose SQL gives its rows (order_reviews: whole texts).
_JOB_SQL = {
    "customers": "region_label", "geolocation": "lookup_fallback_raw", "sellers": "lookup_fallback_lower",
    "order_items": "cast_money", "order_payments": "cast_int_lenient", "orders": "order_features",
    "products": "unit_convert", "product_category": "category_group",
}
_JOB_COLUMNS = {
    "customers": "customer_id customer_unique_id customer_zip_code_prefix customer_city customer_state customer_region",
    "geolocation": "geolocation_zip_code_prefix geolocation_lat geolocation_lng geolocation_city geolocation_state",
    "sellers": "seller_id seller_zip_code_prefix seller_city seller_state seller_region",
    "order_items": "order_id order_item_id product_id seller_id shipping_limit_date price freight_value",
    "order_payments": "order_id payment_sequential payment_type payment_installments payment_value",
    "orders": " ".join(c for c, _ in _FEATURE_TYPES),
    "products": "product_id product_category_name product_name_lenght product_photos_qty product_weight_kg",
    "product_category": "product_category_name product_category_name_english sub_product_category",
    "order_reviews": "review_id order_id review_score review_comment_message review_creation_date",
}
_SQL_REVIEWS = """
SELECT CAST(doc_id AS VARCHAR) AS review_id, CAST((doc_id * 7) % 1000 AS VARCHAR) AS order_id, CAST(doc_id % 5 + 1 AS VARCHAR) AS review_score,
       NULLIF(text, '') AS review_comment_message, '2018-01-18 00:00:00' AS review_creation_date
FROM documents"""


@_register("job_nine_tables", "\nUNION ALL\n".join(
    f"""SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS row_count,
       count(*) - count({c}) AS null_count, count(DISTINCT {c}) AS distinct_count
FROM ({ORACLE_SQL[_JOB_SQL[t]] if t in _JOB_SQL else _SQL_REVIEWS}) q"""
    for t, columns in _JOB_COLUMNS.items() for c in columns.split()))
def q_job_nine_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole batch job, CSV extracts to nine Parquet tables, and a profile of what it wrote."""
    base, raw = _written_extracts(spark, sf_dir)
    ceps = prepare_postcodes(spark, raw["postcode_ranges"], f"{base}/prefixes.parquet")
    paths = PipelinePaths(**{k: v for k, v in raw.items() if k != "postcode_ranges"}, postcodes=ceps)
    written = run_pipeline(spark, paths, f"{base}/out")
    parts = [
        profile_columns(spark.read.parquet(written[t]).select(*columns.split()))
        .select(F.lit(t).alias("table_name"), "column_name", "row_count", "null_count", "distinct_count")
        for t, columns in _JOB_COLUMNS.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@_register("category_dictionary_bom", f"""
SELECT {sql_pick(CATEGORIES, 'p_partkey')} AS product_category_name, p_type AS product_category_name_english FROM part""")
def q_category_dictionary_bom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dictionary CSV whose files begin with a byte-order mark."""
    dictionary = category_dictionary_raw(table(spark, sf_dir, "part"))
    path = scratch_path(spark, "dictionary")
    names = dictionary.columns
    # The header's first name carries the mark, in every file.
    marked = dictionary.select(F.col(names[0]).alias("\ufeff" + names[0]), names[1])
    marked.write.option("header", True).csv(path)
    return read_category_dictionary(spark, path)


_SQL_FEATURES = "\nUNION ALL\n".join(
    f"""SELECT '{t}' AS table_name, '{c}' AS feature, CAST({e} AS VARCHAR) AS value, count(*) AS n
FROM ({ORACLE_SQL[_JOB_SQL[t]]}) q GROUP BY 3""" for t, c, e in (
        ("customers", "customer_region", "customer_region"), ("sellers", "seller_region", "seller_region"),
        ("product_category", "sub_product_category", "sub_product_category"),
        ("products", "product_weight_kg", "CAST(floor(product_weight_kg) AS BIGINT)"),
        *(("orders", c, c) for c, _ in _FEATURE_TYPES[8:])))


@_register("create_new_features", _SQL_FEATURES)
def q_create_new_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature step over its five tables: how often each feature has each value."""
    made = create_new_features(
        customers=q_lookup_no_fallback(spark, sf_dir),
        sellers=transform_sellers(sellers_raw(table(spark, sf_dir, "supplier")), postcodes(spark, sf_dir)),
        products=transform_products(products_raw(table(spark, sf_dir, "part"))),
        product_category=category_dictionary_raw(table(spark, sf_dir, "part")),
        orders=transform_orders(orders_raw(spark, sf_dir)),
    )
    wanted = {
        "customers": ["customer_region"], "sellers": ["seller_region"], "product_category": ["sub_product_category"],
        "products": ["product_weight_kg"], "orders": [c for c, _ in _FEATURE_TYPES[8:]],
    }
    parts = []
    for name, columns in wanted.items():
        df = getattr(made, name)
        if name == "products":
            df = df.withColumn("product_weight_kg", F.floor("product_weight_kg"))
        pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in columns])
        parts.append(df.select(F.lit(name).alias("table_name"), F.inline(pairs)))
    return reduce(DataFrame.unionByName, parts).groupBy("table_name", "feature", "value").agg(F.count(F.lit(1)).alias("n"))


@_register("range_full_code", f"""
SELECT customer_id, customer_zip_code, lower(coalesce(locality, c.customer_city)) AS customer_city
FROM ({SQL_FULL_CODE_CUSTOMERS}) c LEFT JOIN ({SQL_FULL_CODE_RANGES}) r
  ON TRY_CAST(replace(customer_zip_code, '-', '') AS BIGINT) BETWEEN lo AND hi""")
def q_range_full_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City by the ranges of full postcodes that hold the customer's (overlaps repeat it), without expanding them."""
    customers = full_code_customers(table(spark, sf_dir, "customer"))
    ranges = full_code_ranges(table(spark, sf_dir, "supplier"))
    return lookup_range(
        customers, ranges, key="customer_zip_code", out="customer_city",
        fallback=F.lower(F.col("customer_city")), value_transform=F.lower,
    )


@_register("range_cover", f"""
SELECT locality, CAST(sum(codes) AS BIGINT) AS codes FROM (SELECT locality, hi - lo + 1 AS codes FROM ({SQL_FULL_CODE_RANGES}) r) GROUP BY locality""")
def q_range_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The decimal blocks of every supplier's range: together they hold as many codes as the range."""
    cover = prefix_cover(full_code_ranges(table(spark, sf_dir, "supplier")))
    return cover.groupBy(F.col("value").alias("locality")).agg(F.sum(F.pow(F.lit(10), "level").cast("long")).alias("codes"))


_PUBLISHED = ("customers", "order_payments", "products")


@_register("publish_metrics", "\nUNION ALL\n".join(
    f"""SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count
FROM ({ORACLE_SQL[_JOB_SQL[t]]}) q"""
    for t in _PUBLISHED for c in _JOB_COLUMNS[t].split()))
def q_publish_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three tables published twice as one set; what the newest manifest says of their rows and missing values."""
    tables = {
        "customers": lambda: add_region(q_lookup_no_fallback(spark, sf_dir), "customer_state", "customer_region"),
        "order_payments": lambda: q_cast_int_lenient(spark, sf_dir),
        "products": lambda: q_unit_convert(spark, sf_dir),
    }
    chosen = {t: (lambda t=t: tables[t]().select(*_JOB_COLUMNS[t].split())) for t in _PUBLISHED}
    root = scratch_path(spark, "published")
    for _ in range(2):
        newest = publish_tables(spark, chosen, root)
    rows = [(t, c, m["rows"], n) for t, m in newest.metrics.items() for c, n in m["missing"].items()]
    return spark.createDataFrame(rows, "table_name string, column_name string, row_count long, null_count long")


@_register("postcode_rejects", f"""
SELECT count(*) AS ranges, count(CASE WHEN lo IS NULL OR hi IS NULL THEN 1 END) AS rejected
FROM (SELECT {sql_strict_int("split_part(split_part(postcode_range, ' a ', 1), '-', 1)")} AS lo,
             {sql_strict_int("split_part(split_part(postcode_range, ' a ', 2), '-', 1)")} AS hi FROM ({SQL_SUPPLIER_RANGES}) r) b""")
def q_postcode_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges read and left out by the postcode job, counted by the scan that writes its table."""
    base = scratch_path(spark, "postcode-rejects")
    write_csv(supplier_ranges(table(spark, sf_dir, "supplier")), f"{base}/ranges.csv")
    counts = write_postcodes(spark, f"{base}/ranges.csv", f"{base}/prefixes.parquet")
    return spark.createDataFrame([(counts["ranges"], counts["rejected"])], "ranges long, rejected long")


_PAYMENT_TYPES = (("order_id", "string"), ("payment_sequential", "int"), ("payment_type", "string"), ("payment_installments", "int"), ("payment_value", "float"))


@_register("profile_merged", "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS column_name, '{t}' AS data_type, CAST(2 AS BIGINT) AS loads, count(*) AS row_count, count(*) - count({c}) AS null_count,
       {f'CAST(min({c}) AS DOUBLE)' if t != 'string' else 'CAST(NULL AS DOUBLE)'} AS smallest,
       {f'CAST(max({c}) AS DOUBLE)' if t != 'string' else 'CAST(NULL AS DOUBLE)'} AS largest, TRUE AS distinct_within_error
FROM ({ORACLE_SQL['cast_int_lenient']}) p""" for c, t in _PAYMENT_TYPES))
def q_profile_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The payments table in two loads: their states merged, and the sketched distinct counts held against exact ones."""
    payments = q_cast_int_lenient(spark, sf_dir)
    path = scratch_path(spark, "profile-states")
    half = F.pmod(F.xxhash64("order_id"), F.lit(2))
    for load in (0, 1):
        append_profile(payments.where(half == load), path, f"load {load}")
    exact = profile_columns(payments).select("column_name", F.col("distinct_count").alias("exact"))
    within = F.abs(F.col("distinct_count") - F.col("exact")) <= distinct_error() * F.col("exact")
    merged = read_profile(spark, path).join(exact, "column_name").withColumn("distinct_within_error", within)
    return merged.select("column_name", "data_type", "loads", "row_count", "null_count", "smallest", "largest", "distinct_within_error")


# Payment lines as text: every 29th order has a field too many, every 31st one too few.
_PAYMENT_COLUMNS = tuple(c for c, _ in _PAYMENT_TYPES)
_PAYMENT_CASTS = {"payment_sequential": "int", "payment_installments": "int", "payment_value": "float"}
_SQL_REASON = "concat_ws(',', " + ", ".join(
    f"CASE WHEN trim({c}) <> '' AND {sql_lenient_int(c) if t == 'int' else f'TRY_CAST({c} AS FLOAT)'} IS NULL THEN '{c}' END"
    for c, t in _PAYMENT_CASTS.items()) + ")"


@_register("reject_channel", f"""
SELECT reason, count(*) AS n, CAST(sum(CASE WHEN reason = 'typed' THEN coalesce({sql_lenient_int('payment_installments')}, 0) ELSE 0 END) AS BIGINT) AS installments
FROM (SELECT *, CASE WHEN CAST(order_id AS BIGINT) % 29 = 0 OR CAST(order_id AS BIGINT) % 31 = 0 THEN 'fields'
                     ELSE coalesce(nullif({_SQL_REASON}, ''), 'typed') END AS reason FROM ({sql_payments_raw()}) r) q
GROUP BY reason""")
def q_reject_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payment lines typed or rejected by reason; lines with a wrong number of fields among them."""
    raw = payments_raw(table(spark, sf_dir, "orders"))
    order = F.col("order_id").cast("bigint")
    fields = [F.coalesce(F.col(c), F.lit("")) for c in _PAYMENT_COLUMNS]
    line = (
        F.when(order % 29 == 0, F.concat_ws(",", *fields, F.lit("extra"))).when(order % 31 == 0, F.concat_ws(",", *fields[:-1])).otherwise(F.concat_ws(",", *fields))
    )
    path = scratch_path(spark, "payment-lines")
    raw.select(line.alias("value")).write.text(path)
    typed, rejected = typed_and_rejected(read_csv_checked(spark, path, _PAYMENT_COLUMNS, header=False), _PAYMENT_CASTS)
    counts = typed.select(F.lit("typed").alias("reason"), F.coalesce("payment_installments", F.lit(0)).alias("installments"))
    return counts.unionByName(rejected.select("reason", F.lit(0).alias("installments"))).groupBy("reason").agg(
        F.count(F.lit(1)).alias("n"), F.sum("installments").alias("installments"))


@_register("sql_functions", f"""
SELECT c.customer_id, {sql_region('c.customer_state')} AS customer_region, {sql_lenient_int('c.customer_zip_code_prefix')} AS zip, p.localities
FROM (SELECT * FROM ({SQL_CUSTOMERS_RAW}) r) c
LEFT JOIN (SELECT CAST(cep_prefix AS INTEGER) AS prefix, count(*) AS localities FROM ({SQL_CEPS}) e GROUP BY 1) p
  ON p.prefix = {sql_lenient_int('c.customer_zip_code_prefix')}""")
def q_sql_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In SQL text only: lenient keys, region labels and range expansion by the library's SQL functions."""
    mark = f"etl_{uuid.uuid4().hex}_"
    views = {f"{mark}customers": customers_raw(table(spark, sf_dir, "customer")), f"{mark}ranges": nation_ranges(table(spark, sf_dir, "nation"))}
    register_views(spark, views)
    functions = register_functions(spark, mark)
    try:
        return spark.sql(f"""
            SELECT c.customer_id, {mark}region_of_state(c.customer_state) AS customer_region, {mark}lenient_int(c.customer_zip_code_prefix) AS zip, p.localities
            FROM {mark}customers c LEFT JOIN (
              SELECT e.cep_prefix, count(*) AS localities FROM {mark}ranges r, LATERAL {mark}postcode_prefixes(r.postcode_range) e GROUP BY e.cep_prefix) p
            ON p.cep_prefix = {mark}lenient_int(c.customer_zip_code_prefix)""")
    finally:
        for view in views:
            spark.catalog.dropTempView(view)
        for name in functions:
            spark.sql(f"DROP TEMPORARY FUNCTION {name}")


FLAGSHIP = "order_features"
