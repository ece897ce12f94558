"""Incremental execution of the (stateless) table transforms over file streams.

The original job is batch only.  Every table transform here is a per-row
projection plus, for three tables, a lookup against a static dimension, so
the same DataFrame -> DataFrame functions run unchanged on a Structured
Streaming source: new extract files arriving in a folder are typed, looked
up and appended to the Parquet table, with exactly-once file sink commits
and a checkpoint that stays with the output from run to run.  No state store,
watermark or window is involved.
"""

from storefront_etl.streaming.incremental import STREAM_TABLES, start_table_stream

__all__ = ["STREAM_TABLES", "start_table_stream"]
