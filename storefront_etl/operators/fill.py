"""Conditional fill of missing values.

``fill_missing`` is the one-pass form (``coalesce``).  ``fill_missing_by_union``
keeps the source job's original operator: split into NULL / NOT NULL halves,
overwrite the column in the NULL half, ``UNION ALL`` the halves back
(positional).  Both give the same multiset of rows; the union form reads its
input twice and loses row order, so pipelines use ``fill_missing``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storefront_etl.operators._types import ref

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return ref(c) if isinstance(c, str) else c


def fill_missing(df: DataFrame, column: str, fallback: ColumnOrName) -> DataFrame:
    """column := coalesce(column, fallback)."""
    return df.withColumn(column, F.coalesce(ref(column), _col(fallback)))


def fill_missing_by_union(df: DataFrame, column: str, fallback: ColumnOrName) -> DataFrame:
    """Split/overwrite/UNION ALL form of :func:`fill_missing` (same multiset)."""
    present = df.where(ref(column).isNotNull())
    missing = df.where(ref(column).isNull()).withColumn(column, _col(fallback))
    return present.union(missing)
