"""Stand-in extracts derived from the shared test tables, with SQL twins.

The raw retail extracts are not distributed, so every driver query and the
whole-job benchmark run on all-string extracts derived from the TPC-H-like
tables (customer -> customers / geolocation, supplier -> sellers, lineitem
-> order items, orders -> orders / payments, part -> products / category
dictionary, nation -> postcode ranges, documents -> free-text reviews).
Each Spark builder has a DuckDB SQL twin producing the same rows, used by
the oracle SQL of ``queries.py``.  Builders read whole tables; modulo
arithmetic only *derives* values (junk text, NULLs, reversed ranges), it
never filters rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storefront_etl.functions.labels import (
    CATEGORY_GROUPS,
    CATEGORY_OTHER,
    REGION_GROUPS,
    REGION_SOUTH_STATES,
)
from storefront_etl.operators.postcode import expand_postcode_ranges
from storefront_etl.sources.csv import write_csv


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole test table (``<sf_dir>/<name>.parquet``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def as_text(c: Column | str) -> Column:
    """Column rendered as text (the extracts are all-string)."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("string")


def pad5(c: Column) -> Column:
    """5-digit postcode prefix text with leading zeros."""
    return F.lpad(as_text(c), 5, "0")


# ---------------------------------------------------------------------------
# SQL fragments (DuckDB) mirroring the Spark column builders
# ---------------------------------------------------------------------------
# Integer part of an optionally signed decimal number: the oracle's form of
# lenient_int (equal on text whose integer part has at least one digit and
# no control-character padding, which covers every stand-in extract).
LENIENT_INT_PATTERN = r"^([+-]?[0-9]+)([.][0-9]*)?$"


def sql_lenient_int(e: str) -> str:
    return f"TRY_CAST(NULLIF(regexp_extract(trim({e}), '{LENIENT_INT_PATTERN}', 1), '') AS INTEGER)"


def sql_strict_int(e: str) -> str:
    """Oracle form of strict_int (space trimming covers every stand-in)."""
    return f"(CASE WHEN regexp_matches(trim({e}), '^[+-]?[0-9]+$') THEN TRY_CAST(trim({e}) AS INTEGER) END)"


def sql_pad5(e: str) -> str:
    return f"lpad(CAST({e} AS VARCHAR), 5, '0')"


def sql_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


# States of the stand-in extracts: the 27 region-mapped codes upper-cased,
# one unknown code and (past the end of the list) NULL.
STATES = tuple(s.upper() for _, group in REGION_GROUPS for s in group) + tuple(
    s.upper() for s in REGION_SOUTH_STATES
) + ("XX",)

# Categories of the stand-in extracts: every mapped and 'other' category, a
# few unmapped ones, one upper-cased name (exact match fails) and NULL.
CATEGORIES = tuple(c for _, group in CATEGORY_GROUPS for c in group) + CATEGORY_OTHER + (
    "automotivo", "bebes", "pet_shop", "PCS",
)


def pick(values: tuple[str, ...], key: Column) -> Column:
    """values[key % (n+1)] (0-based) or NULL for the last residue."""
    idx = (F.pmod(key, F.lit(len(values) + 1)) + 1).cast("int")
    return F.when(idx <= len(values), F.element_at(F.array(*[F.lit(v) for v in values]), idx))


def sql_pick(values: tuple[str, ...], key: str) -> str:
    return f"{sql_list(values)}[CAST(({key}) % {len(values) + 1} AS INTEGER) + 1]"


# ---------------------------------------------------------------------------
# Stand-in extracts (Spark) and their SQL twins
# ---------------------------------------------------------------------------
def nation_ranges(nation: DataFrame) -> DataFrame:
    """25 ranges, 150 prefixes wide, 100 apart: neighbours overlap (fan-out)."""
    k = F.col("n_nationkey")
    return nation.select(
        F.col("n_name").alias("locality"),
        F.concat(pad5(k * 100), F.lit("-000 a "), pad5(k * 100 + 149), F.lit("-999")).alias(
            "postcode_range"
        ),
    )


SQL_NATION_RANGES = f"""
SELECT n_name AS locality,
       {sql_pad5('n_nationkey * 100')} || '-000 a ' || {sql_pad5('n_nationkey * 100 + 149')} || '-999' AS postcode_range
FROM nation"""


def supplier_ranges(supplier: DataFrame) -> DataFrame:
    """One range per supplier (grows with the data), some NULL, junk or reversed."""
    k = F.col("s_suppkey")
    lo = F.pmod(k * 389, F.lit(99000))
    hi = lo + F.pmod(k, F.lit(40))
    forward = F.concat(pad5(lo), F.lit("-000 a "), pad5(hi), F.lit("-999"))
    backward = F.concat(pad5(hi), F.lit("-000 a "), pad5(lo), F.lit("-999"))
    rng = (
        F.when(F.pmod(k, F.lit(17)) == 0, F.lit(None).cast("string"))
        .when(F.pmod(k, F.lit(19)) == 0, F.lit("x a y"))
        .when(F.pmod(k, F.lit(13)) == 0, backward)
        .otherwise(forward)
    )
    return supplier.select(F.col("s_name").alias("locality"), rng.alias("postcode_range"))


_SQL_LO = "((s_suppkey * 389) % 99000)"
_SQL_HI = f"({_SQL_LO} + s_suppkey % 40)"
SQL_SUPPLIER_RANGES = f"""
SELECT s_name AS locality,
       CASE WHEN s_suppkey % 17 = 0 THEN NULL
            WHEN s_suppkey % 19 = 0 THEN 'x a y'
            WHEN s_suppkey % 13 = 0 THEN {sql_pad5(_SQL_HI)} || '-000 a ' || {sql_pad5(_SQL_LO)} || '-999'
            ELSE {sql_pad5(_SQL_LO)} || '-000 a ' || {sql_pad5(_SQL_HI)} || '-999' END AS postcode_range
FROM supplier"""


def sql_expand(ranges_sql: str) -> str:
    lo = sql_strict_int("split_part(split_part(postcode_range, ' a ', 1), '-', 1)")
    hi = sql_strict_int("split_part(split_part(postcode_range, ' a ', 2), '-', 1)")
    return f"""
SELECT locality, CAST(CAST(p AS INTEGER) AS VARCHAR) AS cep_prefix
FROM (SELECT locality, unnest(generate_series(lo, hi)) AS p
      FROM (SELECT locality, {lo} AS lo, {hi} AS hi FROM ({ranges_sql}) r) b
      WHERE lo IS NOT NULL AND hi IS NOT NULL AND hi >= lo) e"""


def postcodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expand_postcode_ranges(nation_ranges(table(spark, sf_dir, "nation")))


SQL_CEPS = sql_expand(SQL_NATION_RANGES)


def customers_raw(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    zip_code = F.when(F.pmod(k, F.lit(97)) == 0, F.lit("abc")).otherwise(
        pad5(F.pmod(k * 7, F.lit(2600)))
    )
    return customer.select(
        as_text(k).alias("customer_id"),
        F.col("c_name").alias("customer_unique_id"),
        zip_code.alias("customer_zip_code_prefix"),
        F.col("c_name").alias("customer_city"),
        pick(STATES, k).alias("customer_state"),
    )


SQL_CUSTOMERS_RAW = f"""
SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
       c_name AS customer_unique_id,
       CASE WHEN c_custkey % 97 = 0 THEN 'abc' ELSE {sql_pad5('(c_custkey * 7) % 2600')} END AS customer_zip_code_prefix,
       c_name AS customer_city,
       {sql_pick(STATES, 'c_custkey')} AS customer_state
FROM customer"""


# A third of the customers in one postcode, and 2 % in one whose dimension rows
# are repeated once per supplier: hot keys on both sides of a lookup.
HOT_ZIP, REPEATED_ZIP = "01005", "02007"


def skewed_customers_raw(customer: DataFrame) -> DataFrame:
    k = F.col("customer_id").cast("bigint")
    zip_code = (
        F.when(F.pmod(k, F.lit(3)) == 0, F.lit(HOT_ZIP))
        .when(F.pmod(k, F.lit(50)) == 1, F.lit(REPEATED_ZIP))
        .otherwise(F.col("customer_zip_code_prefix"))
    )
    return customers_raw(customer).withColumn("customer_zip_code_prefix", zip_code)


SQL_SKEWED_CUSTOMERS_RAW = f"""
SELECT customer_id, customer_unique_id,
       CASE WHEN CAST(customer_id AS BIGINT) % 3 = 0 THEN '01005' WHEN CAST(customer_id AS BIGINT) % 50 = 1 THEN '02007'
            ELSE customer_zip_code_prefix END AS customer_zip_code_prefix,
       customer_city, customer_state
FROM ({SQL_CUSTOMERS_RAW}) raw"""


def repeated_postcodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    repeated = table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("locality"), F.lit(REPEATED_ZIP).cast("int").cast("string").alias("cep_prefix")
    )
    return postcodes(spark, sf_dir).unionByName(repeated)


SQL_REPEATED_CEPS = f"SELECT locality, cep_prefix FROM ({SQL_CEPS}) c UNION ALL SELECT s_name, '2007' FROM supplier"


def code8(c: Column) -> Column:
    """A full postcode 'NNNNN-NNN' of a number."""
    digits = F.lpad(as_text(c), 8, "0")
    return F.concat(F.left(digits, F.lit(5)), F.lit("-"), F.right(digits, F.lit(3)))


def sql_code8(e: str) -> str:
    digits = f"lpad(CAST({e} AS VARCHAR), 8, '0')"
    return f"left({digits}, 5) || '-' || right({digits}, 3)"


def full_code_customers(customer: DataFrame) -> DataFrame:
    """Customers with full postcodes, a third of them with the same one, some with junk."""
    k = F.col("c_custkey")
    code = (
        F.when(F.pmod(k, F.lit(97)) == 0, F.lit("abc")).when(F.pmod(k, F.lit(3)) == 0, F.lit("00123456"))
        .otherwise(code8(F.pmod(k * 7919, F.lit(30_000_000))))
    )
    return customer.select(as_text(k).alias("customer_id"), code.alias("customer_zip_code"), F.col("c_name").alias("customer_city"))


SQL_FULL_CODE_CUSTOMERS = f"""
SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
       CASE WHEN c_custkey % 97 = 0 THEN 'abc' WHEN c_custkey % 3 = 0 THEN '00123456'
            ELSE {sql_code8('(c_custkey * 7919) % 30000000')} END AS customer_zip_code, c_name AS customer_city
FROM customer"""


def full_code_ranges(supplier: DataFrame) -> DataFrame:
    """A range of full postcodes per supplier: widths up to 2.3 million, overlapping, some NULL, junk or reversed."""
    k = F.col("s_suppkey")
    lo = F.pmod(k * 104_729, F.lit(30_000_000))
    hi = lo + F.pmod(k * k * 31, F.lit(2_300_000))
    rng = (
        F.when(F.pmod(k, F.lit(17)) == 0, F.lit(None).cast("string")).when(F.pmod(k, F.lit(19)) == 0, F.lit("x a y"))
        .when(F.pmod(k, F.lit(13)) == 0, F.concat(code8(hi + 1), F.lit(" a "), code8(lo))).otherwise(F.concat(code8(lo), F.lit(" a "), code8(hi)))
    )
    return supplier.select(F.col("s_name").alias("locality"), rng.alias("postcode_range"))


# The well-formed ranges, as numbers.
SQL_FULL_CODE_RANGES = """
SELECT s_name AS locality, (s_suppkey * 104729) % 30000000 AS lo, (s_suppkey * 104729) % 30000000 + (s_suppkey * s_suppkey * 31) % 2300000 AS hi
FROM supplier WHERE s_suppkey % 17 <> 0 AND s_suppkey % 19 <> 0 AND s_suppkey % 13 <> 0"""


def geolocation_raw(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    zip_code = F.when(
        F.pmod(k, F.lit(89)) == 0, F.concat(F.lit(" "), as_text(F.pmod(k, F.lit(2600))), F.lit(".0 "))
    ).otherwise(pad5(F.pmod(k * 11, F.lit(2600))))
    lat = F.when(F.pmod(k, F.lit(101)) == 0, F.lit("n/a")).otherwise(as_text("c_acctbal"))
    return customer.select(
        zip_code.alias("geolocation_zip_code_prefix"),
        lat.alias("geolocation_lat"),
        as_text(F.col("c_nationkey") - 50).alias("geolocation_lng"),
        F.col("c_name").alias("geolocation_city"),
        pick(STATES, k).alias("geolocation_state"),
    )


SQL_GEOLOCATION_RAW = f"""
SELECT CASE WHEN c_custkey % 89 = 0 THEN ' ' || CAST(c_custkey % 2600 AS VARCHAR) || '.0 '
            ELSE {sql_pad5('(c_custkey * 11) % 2600')} END AS geolocation_zip_code_prefix,
       CASE WHEN c_custkey % 101 = 0 THEN 'n/a' ELSE CAST(c_acctbal AS VARCHAR) END AS geolocation_lat,
       CAST(c_nationkey - 50 AS VARCHAR) AS geolocation_lng,
       c_name AS geolocation_city,
       {sql_pick(STATES, 'c_custkey')} AS geolocation_state
FROM customer"""


def sellers_raw(supplier: DataFrame) -> DataFrame:
    k = F.col("s_suppkey")
    return supplier.select(
        as_text(k).alias("seller_id"),
        pad5(F.pmod(k * 13, F.lit(2600))).alias("seller_zip_code_prefix"),
        F.col("s_name").alias("seller_city"),
        pick(STATES, k).alias("seller_state"),
    )


SQL_SELLERS_RAW = f"""
SELECT CAST(s_suppkey AS VARCHAR) AS seller_id,
       {sql_pad5('(s_suppkey * 13) % 2600')} AS seller_zip_code_prefix,
       s_name AS seller_city,
       {sql_pick(STATES, 's_suppkey')} AS seller_state
FROM supplier"""


def order_items_raw(lineitem: DataFrame) -> DataFrame:
    k = F.col("l_orderkey")
    ship = F.when(F.pmod(k, F.lit(53)) == 0, F.lit("2001-02-30 10:00:00")).otherwise(as_text("l_shipdate"))
    price = F.when(F.pmod(k, F.lit(59)) == 0, F.lit("n/a")).otherwise(as_text("l_extendedprice"))
    return lineitem.select(
        as_text(k).alias("order_id"),
        as_text("l_linenumber").alias("order_item_id"),
        as_text("l_partkey").alias("product_id"),
        as_text("l_suppkey").alias("seller_id"),
        ship.alias("shipping_limit_date"),
        price.alias("price"),
        as_text("l_discount").alias("freight_value"),
    )


SQL_ORDER_ITEMS_RAW = """
SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
       CAST(l_linenumber AS VARCHAR) AS order_item_id,
       CAST(l_partkey AS VARCHAR) AS product_id,
       CAST(l_suppkey AS VARCHAR) AS seller_id,
       CASE WHEN l_orderkey % 53 = 0 THEN '2001-02-30 10:00:00' ELSE CAST(l_shipdate AS VARCHAR) END AS shipping_limit_date,
       CASE WHEN l_orderkey % 59 = 0 THEN 'n/a' ELSE CAST(l_extendedprice AS VARCHAR) END AS price,
       CAST(l_discount AS VARCHAR) AS freight_value
FROM lineitem"""


def payments_raw(orders: DataFrame, bad_value: str = "n/a") -> DataFrame:
    k = F.col("o_orderkey")
    variant = F.pmod(k, F.lit(8))
    seq = (
        F.when(variant == 0, as_text(F.pmod(k, F.lit(5)) + 1))
        .when(variant == 1, as_text("o_totalprice"))
        .when(variant == 2, F.concat(F.lit(" "), as_text("o_custkey"), F.lit(" ")))
        .when(variant == 3, F.concat(F.lit("+"), as_text(F.pmod("o_custkey", F.lit(100)))))
        .when(variant == 4, F.lit("abc"))
        .when(variant == 5, F.lit(""))
        .when(variant == 6, F.lit("1e2"))
        .otherwise(F.concat(F.lit("-"), as_text("o_custkey"), F.lit(".9")))
    )
    inst = F.pmod(F.col("o_custkey"), F.lit(12))
    installments = F.when(F.pmod(k, F.lit(3)) == 0, F.concat(as_text(inst), F.lit(".0"))).otherwise(as_text(inst))
    value = F.when(F.pmod(k, F.lit(23)) == 0, F.lit(bad_value)).otherwise(as_text("o_totalprice"))
    return orders.select(
        as_text(k).alias("order_id"),
        seq.alias("payment_sequential"),
        F.col("o_orderpriority").alias("payment_type"),
        installments.alias("payment_installments"),
        value.alias("payment_value"),
    )


def sql_payments_raw(bad_value: str = "n/a") -> str:
    return f"""
SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
       CASE o_orderkey % 8
            WHEN 0 THEN CAST(o_orderkey % 5 + 1 AS VARCHAR)
            WHEN 1 THEN CAST(o_totalprice AS VARCHAR)
            WHEN 2 THEN ' ' || CAST(o_custkey AS VARCHAR) || ' '
            WHEN 3 THEN '+' || CAST(o_custkey % 100 AS VARCHAR)
            WHEN 4 THEN 'abc'
            WHEN 5 THEN ''
            WHEN 6 THEN '1e2'
            ELSE '-' || CAST(o_custkey AS VARCHAR) || '.9' END AS payment_sequential,
       o_orderpriority AS payment_type,
       CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_custkey % 12 AS VARCHAR) || '.0'
            ELSE CAST(o_custkey % 12 AS VARCHAR) END AS payment_installments,
       CASE WHEN o_orderkey % 23 = 0 THEN '{bad_value}' ELSE CAST(o_totalprice AS VARCHAR) END AS payment_value
FROM orders"""


def ship_dates(lineitem: DataFrame) -> DataFrame:
    """First/last ship date per order (partial aggregation before the shuffle)."""
    return lineitem.groupBy("l_orderkey").agg(
        F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship")
    )


SQL_SHIP_DATES = """
SELECT l_orderkey, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
FROM lineitem GROUP BY l_orderkey"""


def orders_with_ship(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    ships = ship_dates(table(spark, sf_dir, "lineitem"))
    return orders.join(ships, orders["o_orderkey"] == ships["l_orderkey"], "left")


SQL_ORDERS_WITH_SHIP = f"""
SELECT * FROM orders o LEFT JOIN ({SQL_SHIP_DATES}) s ON o.o_orderkey = s.l_orderkey"""


def orders_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = orders_with_ship(spark, sf_dir)
    k = F.col("o_orderkey")
    purchase = F.col("o_orderdate") + F.make_dt_interval(
        hours=F.pmod(k, F.lit(24)).cast("int"), mins=F.pmod(k, F.lit(60)).cast("int")
    )
    approved = purchase + F.make_dt_interval(
        days=F.pmod(k, F.lit(3)).cast("int"), hours=F.lit(5)
    )
    delivered = F.col("last_ship") + F.make_dt_interval(hours=F.pmod(k, F.lit(20)).cast("int"))
    estimated = F.when(F.pmod(k, F.lit(31)) == 0, F.lit("2001-02-30")).otherwise(
        as_text(F.date_add(F.to_date("o_orderdate"), 30))
    )
    return df.select(
        as_text(k).alias("order_id"),
        as_text("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        as_text(purchase).alias("order_purchase_timestamp"),
        F.when(F.pmod(k, F.lit(29)) == 0, F.lit("")).otherwise(as_text(approved)).alias("order_approved_at"),
        as_text("first_ship").alias("order_delivered_carrier_date"),
        as_text(delivered).alias("order_delivered_customer_date"),
        estimated.alias("order_estimated_delivery_date"),
    )


_SQL_PURCHASE = "(o_orderdate + to_hours(o_orderkey % 24) + to_minutes(o_orderkey % 60))"
SQL_ORDERS_RAW = f"""
SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
       CAST(o_custkey AS VARCHAR) AS customer_id,
       o_orderstatus AS order_status,
       CAST({_SQL_PURCHASE} AS VARCHAR) AS order_purchase_timestamp,
       CASE WHEN o_orderkey % 29 = 0 THEN ''
            ELSE CAST({_SQL_PURCHASE} + to_days(CAST(o_orderkey % 3 AS INTEGER)) + to_hours(5) AS VARCHAR) END
            AS order_approved_at,
       CAST(first_ship AS VARCHAR) AS order_delivered_carrier_date,
       CAST(last_ship + to_hours(o_orderkey % 20) AS VARCHAR) AS order_delivered_customer_date,
       CASE WHEN o_orderkey % 31 = 0 THEN '2001-02-30'
            ELSE CAST(CAST(o_orderdate AS DATE) + 30 AS VARCHAR) END AS order_estimated_delivery_date
FROM ({SQL_ORDERS_WITH_SHIP}) ow"""


def products_raw(part: DataFrame) -> DataFrame:
    k = F.col("p_partkey")
    category = pick(CATEGORIES, k)
    category = F.when(F.pmod(k, F.lit(2)) == 0, F.upper(category)).otherwise(category)
    height = F.when(F.pmod(k, F.lit(17)) == 0, F.lit("n/a")).otherwise(as_text(F.col("p_size") * 2))
    return part.select(
        as_text(k).alias("product_id"),
        category.alias("product_category_name"),
        as_text(F.length("p_name")).alias("product_name_lenght"),
        as_text(F.length("p_type") * 10).alias("product_description_lenght"),
        as_text(F.pmod("p_size", F.lit(5))).alias("product_photos_qty"),
        as_text("p_retailprice").alias("product_weight_g"),
        as_text("p_size").alias("product_length_cm"),
        height.alias("product_height_cm"),
        F.concat(as_text(F.col("p_size") + 10), F.lit(".5")).alias("product_width_cm"),
    )


SQL_PRODUCTS_RAW = f"""
SELECT CAST(p_partkey AS VARCHAR) AS product_id,
       CASE WHEN p_partkey % 2 = 0 THEN upper({sql_pick(CATEGORIES, 'p_partkey')})
            ELSE {sql_pick(CATEGORIES, 'p_partkey')} END AS product_category_name,
       CAST(length(p_name) AS VARCHAR) AS product_name_lenght,
       CAST(length(p_type) * 10 AS VARCHAR) AS product_description_lenght,
       CAST(p_size % 5 AS VARCHAR) AS product_photos_qty,
       CAST(p_retailprice AS VARCHAR) AS product_weight_g,
       CAST(p_size AS VARCHAR) AS product_length_cm,
       CASE WHEN p_partkey % 17 = 0 THEN 'n/a' ELSE CAST(p_size * 2 AS VARCHAR) END AS product_height_cm,
       CAST(p_size + 10 AS VARCHAR) || '.5' AS product_width_cm
FROM part"""


# ---------------------------------------------------------------------------
# SQL for the typed tables (twins of plans.tables)
# ---------------------------------------------------------------------------
def sql_customers(raw_sql: str, ceps_sql: str = SQL_CEPS, first: bool = False) -> str:
    ceps = ceps_sql
    if first:
        ceps = f"SELECT min(locality) AS locality, cep_prefix FROM ({ceps_sql}) x GROUP BY cep_prefix"
    return f"""
SELECT c.customer_id, c.customer_unique_id, c.customer_zip_code_prefix,
       lower(p.locality) AS customer_city, lower(c.customer_state) AS customer_state
FROM ({raw_sql}) c LEFT JOIN ({ceps}) p
  ON {sql_lenient_int('c.customer_zip_code_prefix')} = {sql_lenient_int('p.cep_prefix')}"""


# Fixed values, written out so that the oracle does not share the code's lists.
SQL_REGION = """
CASE
  WHEN {value} IN ('ac', 'am', 'ro', 'rr', 'ap', 'to', 'pa')
    THEN 'norte'
  WHEN {value} IN ('ma', 'pi', 'ce', 'rn', 'pb', 'pe', 'al', 'ba', 'se')
    THEN 'nordeste'
  WHEN {value} IN ('mt', 'ms', 'df', 'go')
    THEN 'centro-oeste'
  WHEN {value} IN ('mg', 'sp', 'es', 'rj')
    THEN 'sudeste'
  ELSE 'sul' END"""
SQL_CATEGORY = """
CASE
  WHEN {value} IN ('pcs', 'pc_gamer', 'tablets_impressao_imagem', 'telefonia_fixa', 'telefonia',
    'informatica_acessorios', 'eletronicos', 'audio', 'consoles_games', 'dvds_blu_ray')
    THEN 'eletronicos e tecnologia'
  WHEN {value} IN ('fashion_roupa_masculina', 'fashion_roupa_feminina', 'fashion_roupa_infanto_juvenil',
    'fashion_underwear_e_moda_praia', 'fashion_bolsas_e_acessorios', 'fashion_calcados', 'fashion_esporte')
    THEN 'moda e acessorios'
  WHEN {value} IN ('moveis_decoracao', 'moveis_colchao_e_estofado',
    'moveis_cozinha_area_de_servico_jantar_e_jardim', 'moveis_quarto', 'moveis_sala', 'utilidades_domesticas',
    'cama_mesa_banho', 'casa_construcao', 'casa_conforto', 'casa_conforto_2')
    THEN 'casa e decoracao'
  WHEN {value} IN ('livros_tecnicos', 'livros_importados', 'livros_interesse_geral')
    THEN 'livros e educacao'
  WHEN {value} IN ('beleza_saude', 'fraldas_higiene', 'perfumaria')
    THEN 'beleza e saude'
  WHEN {value} IN ('brinquedos', 'jogos', 'instrumentos_musicais')
    THEN 'brinquedos e jogos'
  WHEN {value} IN ('alimentos_bebidas', 'bebidas', 'alimentos')
    THEN 'alimentos_e_bebidas'
  WHEN {value} IN ('artigos_de_festas', 'artigos_de_natal')
    THEN 'artigos para festas'
  WHEN {value} IN ('artes', 'cine_foto', 'artes_e_artesanato')
    THEN 'arte e artesanato'
  WHEN {value} IN ('construcao_ferramentas_construcao', 'construcao_ferramentas_seguranca',
    'construcao_ferramentas_jardim', 'construcao_ferramentas_iluminacao', 'construcao_ferramentas_ferramentas')
    THEN 'ferramentas e construcao'
  WHEN {value} IN ('esporte_lazer')
    THEN 'esporte e lazer'
  ELSE 'outros' END"""


def sql_region(state: str) -> str:
    return SQL_REGION.format(value=state)


def sql_category(cat: str) -> str:
    return SQL_CATEGORY.format(value=cat)


SQL_GEO_JOINED = f"""
SELECT g.geolocation_zip_code_prefix, g.geolocation_lat, g.geolocation_lng,
       lower(p.locality) AS city_lookup, g.geolocation_city AS city_original, g.geolocation_state
FROM ({SQL_GEOLOCATION_RAW}) g LEFT JOIN ({SQL_CEPS}) p
  ON {sql_lenient_int('g.geolocation_zip_code_prefix')} = {sql_lenient_int('p.cep_prefix')}"""


def geo_select(city: str) -> str:
    return f"""geolocation_zip_code_prefix,
       TRY_CAST(geolocation_lat AS DOUBLE) AS geolocation_lat,
       TRY_CAST(geolocation_lng AS DOUBLE) AS geolocation_lng,
       {city} AS geolocation_city,
       lower(geolocation_state) AS geolocation_state"""


SQL_ORDERS_TYPED = f"""
SELECT order_id, customer_id, order_status,
       TRY_CAST(order_purchase_timestamp AS TIMESTAMP) AS order_purchase_timestamp,
       TRY_CAST(order_approved_at AS TIMESTAMP) AS order_approved_at,
       TRY_CAST(order_delivered_carrier_date AS TIMESTAMP) AS order_delivered_carrier_date,
       TRY_CAST(order_delivered_customer_date AS TIMESTAMP) AS order_delivered_customer_date,
       TRY_CAST(order_estimated_delivery_date AS DATE) AS order_estimated_delivery_date
FROM ({SQL_ORDERS_RAW}) r"""


def sql_day_name(ts: str) -> str:
    return f"CASE WHEN {ts} IS NULL THEN 'saturday' ELSE lower(dayname({ts})) END"


def sql_month_name(ts: str) -> str:
    return f"CASE WHEN {ts} IS NULL THEN 'december' ELSE lower(monthname({ts})) END"


def sql_day_diff(end: str, start: str) -> str:
    return f"CAST(date_diff('day', CAST({start} AS DATE), CAST({end} AS DATE)) AS INTEGER)"


SQL_ORDER_FEATURES = f"""
SELECT *,
       CAST(dayofweek(order_purchase_timestamp) + 1 AS INTEGER) AS order_day_of_week,
       {sql_day_name('order_purchase_timestamp')} AS order_name_day_of_week,
       CAST(month(order_purchase_timestamp) AS INTEGER) AS order_month,
       {sql_month_name('order_purchase_timestamp')} AS order_name_month,
       {sql_day_diff('order_delivered_customer_date', 'order_purchase_timestamp')} AS order_delivery_days,
       CAST(hour(order_purchase_timestamp) AS INTEGER) AS order_hour,
       {sql_day_diff('order_approved_at', 'order_purchase_timestamp')} AS order_processing_days
FROM ({SQL_ORDERS_TYPED}) t"""


# ---------------------------------------------------------------------------
# Whole-job inputs: the stand-in extracts written as CSV files
# ---------------------------------------------------------------------------
def reviews_raw(documents: DataFrame) -> DataFrame:
    """Free-text review extract: quotes, commas and line breaks in messages."""
    k = F.col("doc_id")
    return documents.select(
        as_text(k).alias("review_id"),
        as_text(F.pmod(k * 7, F.lit(1000))).alias("order_id"),
        as_text(F.pmod(k, F.lit(5)) + 1).alias("review_score"),
        F.col("text").alias("review_comment_message"),
        F.lit("2018-01-18 00:00:00").alias("review_creation_date"),
    )


def category_dictionary_raw(part: DataFrame) -> DataFrame:
    return part.select(
        pick(CATEGORIES, F.col("p_partkey")).alias("product_category_name"),
        F.col("p_type").alias("product_category_name_english"),
    )


def standin_extracts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The nine raw extracts of the job plus the postcode ranges, all text."""
    customer = table(spark, sf_dir, "customer")
    return {
        "postcode_ranges": nation_ranges(table(spark, sf_dir, "nation")),
        "customers": customers_raw(customer),
        "geolocation": geolocation_raw(customer),
        "order_items": order_items_raw(table(spark, sf_dir, "lineitem")),
        "order_payments": payments_raw(table(spark, sf_dir, "orders")),
        "order_reviews": reviews_raw(table(spark, sf_dir, "documents")),
        "orders": orders_raw(spark, sf_dir),
        "products": products_raw(table(spark, sf_dir, "part")),
        "sellers": sellers_raw(table(spark, sf_dir, "supplier")),
        "product_category": category_dictionary_raw(table(spark, sf_dir, "part")),
    }


def write_standin_extracts(spark: SparkSession, sf_dir: str, out_dir: str) -> dict[str, str]:
    """Write each stand-in extract as a header CSV directory; return the paths."""
    paths = {}
    for name, df in standin_extracts(spark, sf_dir).items():
        path = f"{out_dir.rstrip('/')}/{name}.csv"
        write_csv(df, path)
        paths[name] = path
    return paths
