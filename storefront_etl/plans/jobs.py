"""The two batch jobs and their command line.

* ``prepare_postcodes``: postcode-range CSV -> (locality, cep_prefix) Parquet.
* ``run_pipeline``: nine raw extracts + the postcode Parquet -> nine tables.

Usage (``spark-submit`` or plain ``python``)::

    python -m storefront_etl.plans.jobs postcodes <ranges.csv> <out.parquet>
    python -m storefront_etl.plans.jobs pipeline <customers> <geolocation> \
        <order_items> <order_payments> <order_reviews> <orders> <products> \
        <sellers> <product_category> <postcodes.parquet> <output_dir>

The session is taken as configured by the cluster; nothing is overridden.
"""

from __future__ import annotations

import logging
import sys
import uuid
from collections.abc import Callable
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from storefront_etl.operators.lookup import EXPAND, PreparedLookup
from storefront_etl.operators.postcode import SKIP, expand_postcode_ranges, malformed_range
from storefront_etl.functions.units import PRODUCT_UNITS, convert_units
from storefront_etl.plans.features import (
    CATEGORY_COLUMNS,
    REGION_COLUMNS,
    add_category_group,
    add_order_calendar,
    add_region,
)
from storefront_etl.plans.tables import (
    postcode_lookup,
    transform_customers,
    transform_geolocation,
    transform_order_items,
    transform_order_payments,
    transform_orders,
    transform_products,
    transform_sellers,
)
from storefront_etl.sources.csv import read_category_dictionary, read_csv_strings, read_reviews
from storefront_etl.sources.parquet import write_parquet
from storefront_etl.sources.publish import _describe as _describe_jobs  # noqa: F401
from storefront_etl.sources.publish import publish_tables, replace_tables
from storefront_etl.sources.schemas import RAW_COLUMNS

log = logging.getLogger(__name__)

# Independent table writes submitted at once (driver threads).
DEFAULT_CONCURRENT_TABLES = 4


def postcode_ranges(spark: SparkSession, ranges_csv: str) -> DataFrame:
    return read_csv_strings(spark, ranges_csv, columns=RAW_COLUMNS["postcode_ranges"])


def postcode_table(spark: SparkSession, ranges_csv: str, on_invalid: str = SKIP) -> DataFrame:
    return expand_postcode_ranges(postcode_ranges(spark, ranges_csv), on_invalid=on_invalid)


def prepare_postcodes(spark: SparkSession, ranges_csv: str, out_path: str, on_invalid: str = SKIP) -> str:
    """Write the prefixes; ranges that are skipped as NULL or malformed are counted by the same scan and logged."""
    counts = write_postcodes(spark, ranges_csv, out_path, on_invalid)
    if counts["rejected"]:
        log.warning("%d postcode ranges of %s are NULL or malformed and gave no rows", counts["rejected"], ranges_csv)
    log.info("%d postcode ranges read, prefixes written to %s", counts["ranges"], out_path)
    return out_path


def write_postcodes(spark: SparkSession, ranges_csv: str, out_path: str, on_invalid: str = SKIP) -> dict[str, int]:
    """Write the prefixes; how many ``ranges`` were read and ``rejected`` (left out by ``on_invalid='skip'``), counted on the way."""
    found = Observation(f"postcodes-{uuid.uuid4().hex}")
    rejected = F.count(F.when(malformed_range("postcode_range"), F.lit(1)))
    ranges = postcode_ranges(spark, ranges_csv).observe(found, F.count(F.lit(1)).alias("ranges"), rejected.alias("rejected"))
    write_parquet(expand_postcode_ranges(ranges, on_invalid=on_invalid), out_path)
    return dict(found.get)


def rejected_ranges(spark: SparkSession, ranges_csv: str) -> int:
    """Ranges that ``on_invalid='skip'`` leaves out, without writing any (one scan of the extract)."""
    return postcode_ranges(spark, ranges_csv).where(malformed_range("postcode_range")).count()


@dataclass(frozen=True)
class PipelinePaths:
    customers: str
    geolocation: str
    order_items: str
    order_payments: str
    order_reviews: str
    orders: str
    products: str
    sellers: str
    product_category: str
    postcodes: str


def table_builders(
    spark: SparkSession,
    paths: PipelinePaths,
    on_multiple: str = EXPAND,
    raw_reviews: bool = False,
) -> dict[str, Callable[[], DataFrame]]:
    """One zero-argument builder per output table (building reads CSV
    headers, so it is deferred to the caller).  The postcode dimension is
    prepared and measured once, here, and shared by the three lookups."""

    def raw(name: str, path: str) -> DataFrame:
        return read_csv_strings(spark, path, columns=RAW_COLUMNS[name])

    shared = postcode_lookup(spark.read.parquet(paths.postcodes), on_multiple)

    def postcodes() -> PreparedLookup:
        return shared

    return {
        "customers": lambda: add_region(
            transform_customers(raw("customers", paths.customers), postcodes()), *REGION_COLUMNS["customers"]),
        "geolocation": lambda: transform_geolocation(raw("geolocation", paths.geolocation), postcodes()),
        "order_items": lambda: transform_order_items(raw("order_items", paths.order_items)),
        "order_payments": lambda: transform_order_payments(raw("order_payments", paths.order_payments)),
        "order_reviews": lambda: read_reviews(spark, paths.order_reviews, raw=raw_reviews),
        "orders": lambda: add_order_calendar(transform_orders(raw("orders", paths.orders))),
        "products": lambda: convert_units(transform_products(raw("products", paths.products)), PRODUCT_UNITS),
        "sellers": lambda: add_region(
            transform_sellers(raw("sellers", paths.sellers), postcodes()), *REGION_COLUMNS["sellers"]),
        "product_category": lambda: add_category_group(
            read_category_dictionary(spark, paths.product_category), *CATEGORY_COLUMNS),
    }


def build_tables(
    spark: SparkSession,
    paths: PipelinePaths,
    on_multiple: str = EXPAND,
    raw_reviews: bool = False,
) -> dict[str, DataFrame]:
    """The nine output tables as lazy DataFrames (same as the feature step
    :func:`create_new_features` applied to the seven transforms)."""
    return {name: build() for name, build in table_builders(spark, paths, on_multiple, raw_reviews).items()}


def run_pipeline(
    spark: SparkSession,
    paths: PipelinePaths,
    output_dir: str,
    on_multiple: str = EXPAND,
    raw_reviews: bool = False,
    max_concurrent: int = DEFAULT_CONCURRENT_TABLES,
    versioned: bool = False,
) -> dict[str, str]:
    """Build and write the nine tables under ``output_dir``; their paths.

    The tables are independent, so up to ``max_concurrent`` of them are
    built and written at once from driver threads; Spark interleaves their
    tasks, which keeps executors busy while one table's job is in its tail.
    Each table is still a single pass.  A failure is raised after the other
    writes have finished, and leaves the tables of the last run as they were:
    all nine are written aside first, then renamed to
    ``<output_dir>/<name>.parquet``, or with ``versioned`` published as one
    set that readers find by its manifest (:mod:`storefront_etl.sources.publish`).
    """
    builders = table_builders(spark, paths, on_multiple, raw_reviews)
    write = publish_tables if versioned else replace_tables
    written = write(spark, builders, output_dir, max_concurrent)
    for name, counts in written.metrics.items():
        log.info("table %s: %d rows, missing values %s", name, counts["rows"], counts["missing"])
    return written.paths


def main(argv: list[str] | None = None) -> int:
    args = list(sys.argv[1:] if argv is None else argv)
    n_paths = len(fields(PipelinePaths))
    if args[:1] == ["postcodes"] and len(args) == 3:
        spark = SparkSession.builder.appName("storefront-etl-postcodes").getOrCreate()
        prepare_postcodes(spark, args[1], args[2])
        return 0
    if args[:1] == ["pipeline"] and len(args) == n_paths + 2:
        spark = SparkSession.builder.appName("storefront-etl-pipeline").getOrCreate()
        run_pipeline(spark, PipelinePaths(*args[1:-1]), args[-1])
        return 0
    raise ValueError(
        "usage: postcodes <ranges.csv> <out.parquet> | "
        f"pipeline <{n_paths} input paths> <output_dir>"
    )


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO)
    sys.exit(main())
