"""Column profiling: missing counts, distinct values, per-column review.

All profiles are aggregations that Spark runs as partial (map-side) plus
final hash aggregates, so a hot value or a huge table never sends more than
one partial row per partition and group through the shuffle.  Nothing is
collected: each function returns a DataFrame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegralType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

from storefront_etl.operators._types import comparable, ref


def _is_floating(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (FloatType, DoubleType))


def missing_condition(df: DataFrame, name: str) -> Column:
    """NULL, or NaN for float/double columns (isnan on text would raise)."""
    c = ref(name)
    return (c.isNull() | F.isnan(c)) if _is_floating(df, name) else c.isNull()


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row, one column per input column: number of missing values."""
    names = list(columns) if columns is not None else df.columns
    return df.select(
        [F.count(F.when(missing_condition(df, n), F.lit(1))).alias(n) for n in names]
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The distinct values of one column (NULL included once)."""
    return df.select(ref(column)).distinct()


def profile_columns(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    approx_distinct: bool = False,
) -> DataFrame:
    """Long table: column_name, data_type, row_count, null_count, distinct_count.

    One pass over the data.  Exact counts come from one aggregate over (column,
    value), where a value of 16 bytes or more counts by its MD5 digest, so no
    long text is shuffled.  (Columns of arrays, structs and maps are counted by
    ``COUNT(DISTINCT)`` instead.)  ``approx_distinct=True`` uses HyperLogLog++.
    """
    names = list(columns) if columns is not None else df.columns
    if not approx_distinct and names and all(isinstance(df.schema[n].dataType, PLAIN) for n in names):
        return _counted_values(df, names)
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, n in enumerate(names):
        aggs.append(F.count(F.when(missing_condition(df, n), F.lit(1))).alias(f"__n{i}"))
        value = comparable(df, n)  # maps are counted by their JSON text
        distinct = F.approx_count_distinct(value) if approx_distinct else F.count_distinct(value)
        aggs.append(distinct.alias(f"__d{i}"))
    totals = df.agg(*aggs)
    rows = F.array(*[
        F.struct(
            F.lit(n).alias("column_name"),
            F.lit(df.schema[n].dataType.simpleString()).alias("data_type"),
            F.col("__rows").alias("row_count"),
            F.col(f"__n{i}").alias("null_count"),
            F.col(f"__d{i}").cast("long").alias("distinct_count"),
        )
        for i, n in enumerate(names)
    ])
    return totals.select(F.inline(rows))


# Types whose values have one short text each.
PLAIN = (StringType, BinaryType, BooleanType, DateType, TimestampType, TimestampNTZType, DecimalType, FloatType, DoubleType, IntegralType)
# Longer texts are counted by their MD5 digest.
DIGEST_BYTES = 16


def value_digest(df: DataFrame, name: str) -> Column:
    """A value in at most ``DIGEST_BYTES`` bytes: equal for equal values of the column, different for others."""
    c, kind = ref(name), df.schema[name].dataType
    if isinstance(kind, (FloatType, DoubleType)):
        text = F.when(c == 0, F.lit("0.0")).otherwise(c.cast("string")).cast("binary")  # one zero
    elif isinstance(kind, TimestampType):
        text = F.unix_micros(c).cast("string").cast("binary")
    else:
        text = c if isinstance(kind, BinaryType) else c.cast("string").cast("binary")
    return F.when(F.octet_length(text) >= DIGEST_BYTES, F.unhex(F.md5(text))).otherwise(text)


def _counted_values(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Exact profile from one aggregate over (column, value digest): narrow keys, combined in each task first."""
    values = df.select(F.posexplode(F.array(*[value_digest(df, n) for n in names])).alias("at", "value"))
    counted = values.groupBy("at", "value").agg(F.count(F.lit(1)).alias("n"))
    floating = [k for k, n in enumerate(names) if _is_floating(df, n)]
    missing = F.col("value").isNull()
    if floating:
        missing = missing | (F.col("at").isin(floating) & (F.col("value") == F.lit("NaN").cast("binary")))
    found = counted.groupBy("at").agg(
        F.sum("n").alias("row_count"), F.coalesce(F.sum(F.when(missing, F.col("n"))), F.lit(0)).alias("null_count"), F.count("value").alias("distinct_count")
    )
    about = F.inline(F.array(*[
        F.struct(F.lit(k).alias("at"), F.lit(n).alias("column_name"), F.lit(df.schema[n].dataType.simpleString()).alias("data_type")) for k, n in enumerate(names)
    ]))
    # An empty table has no values: its columns are there with zeros.
    known = df.sparkSession.range(1).select(about)
    zero = {c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("row_count", "null_count", "distinct_count")}
    return known.join(found, "at", "left").select("column_name", "data_type", *zero.values())


def preview(df: DataFrame, n: int = 5, order_by: Sequence[str] | str | None = None) -> DataFrame:
    """First ``n`` rows; with ``order_by`` a deterministic top-n (no full sort)."""
    if order_by is None:
        return df.limit(n)
    keys = [order_by] if isinstance(order_by, str) else list(order_by)
    return df.orderBy(*keys).limit(n)
