"""Unit conversion by constant division (g -> kg, cm -> m)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Divisors used by the product feature step.
GRAMS_PER_KG = 1000
CM_PER_M = 100

PRODUCT_UNITS: dict[str, tuple[str, int]] = {
    "product_weight_g": ("product_weight_kg", GRAMS_PER_KG),
    "product_length_cm": ("product_length_m", CM_PER_M),
    "product_height_cm": ("product_height_m", CM_PER_M),
    "product_width_cm": ("product_width_m", CM_PER_M),
}


def convert_units(df: DataFrame, conversions: Mapping[str, tuple[str, int | float]]) -> DataFrame:
    """Add ``dst = src / divisor`` for each ``src -> (dst, divisor)``.

    ``/`` is true division, so integer sources give DOUBLE results; NULL
    stays NULL.  All new columns are added in one projection.
    """
    return df.withColumns(
        {dst: F.col(src) / F.lit(divisor) for src, (dst, divisor) in conversions.items()}
    )
