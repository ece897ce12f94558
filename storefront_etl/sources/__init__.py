"""Sources and sinks: all-string CSV readers, CSV/Parquet writers, views."""
