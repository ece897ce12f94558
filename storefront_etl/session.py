"""Local session for tests, tools and the benchmark (never used by the library).

Library functions take the caller's session as configured; only local runs
build one here.  The UI stays off; the checkpoint folder is only set when the
environment names none.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, event_log_dir: str | None = None
) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("storefront-etl-local")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
    )
    if event_log_dir:
        # Stage/task metrics for offline analysis (tools/eventlog_summary.py).
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="storefront-etl-ckpt-"))
    return spark
