"""Every registered query against its DuckDB oracle (the driver's gate), sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from storefront_etl.plans.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents".split()


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, "nan") if math.isnan(v) else (2, f"{v:.6g}")
    if hasattr(v, "isoformat"):
        return (3, v.isoformat())
    return (4, str(v))


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_oracle():
    """Of the library's own catalogue; optional training-data queries are tested with their subpackage."""
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    rel = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in rel.description]
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _canon(rows, df.columns) == _canon(orows, ocols)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "order_name_day_of_week" in df.columns


@pytest.mark.parametrize("name", ["cast_int_lenient", "cast_money", "cast_date", "lookup_no_fallback",
                                  "postcode_expand", "unit_convert"])
def test_query_independent_of_ansi_mode(spark, con, name):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        df = entry.queries()[name](spark, SF)
        rows = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    rel = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in rel.description]
    assert _canon(rows, df.columns) == _canon(rel.fetchall(), ocols)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_columns_are_unique_and_named_like_the_oracle(spark, con, name):
    cols = entry.queries()[name](spark, SF).columns
    assert len(cols) == len(set(cols))
    described = [r[0] for r in con.execute(f"DESCRIBE {entry.oracle_sql()[name]}").fetchall()]
    assert sorted(described) == sorted(cols)
