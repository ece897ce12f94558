"""Spark-first data preparation for online-retail order extracts.

Every public function takes and returns DataFrames (or returns a Column);
none collects data to the driver, registers a Python UDF or changes the
session configuration.  The layout is:

* ``functions`` – Column builders: lenient casts, label maps, calendar names.
* ``operators`` – DataFrame operators: postcode-range expansion, dimension
  lookup with fallback and fan-out control, missing-value fill, profiling.
* ``sources``   – all-string CSV readers, Parquet/CSV writers, view registry.
* ``plans``     – the nine table transforms, the feature step and the jobs.
* ``streaming`` – the same stateless table transforms over file streams.
"""

from storefront_etl.functions.casts import lenient_cast, lenient_int, strict_int
from storefront_etl.functions.calendar import (
    day_of_week_name,
    month_name,
    with_day_diff,
    with_day_of_week,
    with_hour,
    with_month,
)
from storefront_etl.functions.labels import (
    CATEGORY_GROUPS,
    REGION_GROUPS,
    category_group,
    map_labels,
    region_of_state,
)
from storefront_etl.functions.units import convert_units
from storefront_etl.operators.fill import fill_missing, fill_missing_by_union
from storefront_etl.operators.lookup import (
    PreparedLookup,
    fits_broadcast,
    lookup_dimension,
    prepare_lookup,
)
from storefront_etl.operators.postcode import expand_postcode_ranges
from storefront_etl.operators.prefix_cover import lookup_range, prefix_cover
from storefront_etl.operators.profile import (
    distinct_values,
    null_profile,
    preview,
    profile_columns,
)

__all__ = [
    "CATEGORY_GROUPS",
    "PreparedLookup",
    "REGION_GROUPS",
    "category_group",
    "convert_units",
    "day_of_week_name",
    "distinct_values",
    "expand_postcode_ranges",
    "fill_missing",
    "fill_missing_by_union",
    "fits_broadcast",
    "lenient_cast",
    "lenient_int",
    "lookup_dimension",
    "lookup_range",
    "map_labels",
    "month_name",
    "null_profile",
    "prefix_cover",
    "prepare_lookup",
    "preview",
    "profile_columns",
    "region_of_state",
    "strict_int",
    "with_day_diff",
    "with_day_of_week",
    "with_hour",
    "with_month",
]
