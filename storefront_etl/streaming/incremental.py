"""``start_table_stream``: CSV extract folder -> typed Parquet table, incrementally."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from storefront_etl.functions.units import PRODUCT_UNITS, convert_units
from storefront_etl.operators.lookup import PreparedLookup
from storefront_etl.plans.features import add_category_group, add_order_calendar, add_region
from storefront_etl.plans.tables import (
    transform_customers,
    transform_geolocation,
    transform_order_items,
    transform_order_payments,
    transform_orders,
    transform_products,
    transform_sellers,
)
from storefront_etl.sources.csv import ESCAPE, QUOTE
from storefront_etl.sources.schemas import RAW_COLUMNS, all_string_schema

# Default checkpoint, next to the data it belongs to (names with _ are no data files).
CHECKPOINT_FOLDER = "_checkpoint"

Transform = Callable[[DataFrame, "DataFrame | PreparedLookup | None"], DataFrame]

# Table name -> (needs the postcode dimension, transform incl. its features).
STREAM_TABLES: dict[str, tuple[bool, Transform]] = {
    "customers": (True, lambda raw, dim: add_region(
        transform_customers(raw, dim), "customer_state", "customer_region")),
    "geolocation": (True, lambda raw, dim: transform_geolocation(raw, dim)),
    "sellers": (True, lambda raw, dim: add_region(
        transform_sellers(raw, dim), "seller_state", "seller_region")),
    "order_items": (False, lambda raw, _: transform_order_items(raw)),
    "order_payments": (False, lambda raw, _: transform_order_payments(raw)),
    "orders": (False, lambda raw, _: add_order_calendar(transform_orders(raw))),
    "products": (False, lambda raw, _: convert_units(transform_products(raw), PRODUCT_UNITS)),
    "product_category": (False, lambda raw, _: add_category_group(
        raw, "product_category_name", "sub_product_category")),
    "order_reviews": (False, lambda raw, _: raw),
}
# Free-text extracts need RFC-4180 multi-line records.
MULTI_LINE_TABLES = frozenset({"order_reviews"})


def read_extract_stream(
    spark: SparkSession,
    source_dir: str,
    columns: Sequence[str],
    sep: str = ",",
    max_files_per_trigger: int | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Header CSV files appearing in ``source_dir`` as an all-string stream.

    A stream needs its schema up front: ``columns`` is the full header of the
    extract files, in file order.
    """
    reader = (
        spark.readStream.schema(all_string_schema(list(columns)))
        .option("header", True)
        .option("sep", sep)
        .option("quote", QUOTE)
        .option("escape", ESCAPE)
        .option("multiLine", multi_line)
        .option("enforceSchema", False)
    )
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(source_dir)


def start_table_stream(
    spark: SparkSession,
    table: str,
    source_dir: str,
    output_path: str,
    postcodes: DataFrame | PreparedLookup | None = None,
    columns: Sequence[str] | None = None,
    checkpoint: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Start the incremental version of one table transform.

    ``available_now=True`` processes every file present and stops (batch
    catch-up with stream bookkeeping); ``False`` keeps polling the folder.
    ``postcodes`` is the raw dimension or a :func:`postcode_lookup` prepared
    (and size-checked) once; the dimension is static, joined to each
    micro-batch, and must be small enough to broadcast.

    ``checkpoint`` defaults to a folder inside ``output_path`` (readers skip
    it): it must stay the same from run to run, since the sink's log and the
    source's progress belong together.  A new checkpoint for an output that
    already has batches would drop the first files of the new run.
    """
    if table not in STREAM_TABLES:
        raise ValueError(f"no streaming transform for table {table!r}")
    needs_dim, transform = STREAM_TABLES[table]
    if needs_dim and postcodes is None:
        raise ValueError(f"table {table!r} needs the postcode dimension")
    if columns is None:
        if table not in RAW_COLUMNS:
            raise ValueError(f"pass the full header of the {table!r} extract as columns=")
        columns = RAW_COLUMNS[table]
    raw = read_extract_stream(spark, source_dir, columns, multi_line=table in MULTI_LINE_TABLES)
    out = transform(raw, postcodes)
    writer = (
        out.writeStream.format("parquet")
        .outputMode("append")
        .option("path", output_path)
        .option("checkpointLocation", checkpoint or f"{output_path.rstrip('/')}/{CHECKPOINT_FOLDER}")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
