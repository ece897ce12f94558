"""Parquet sinks/sources, the SQL view registry and the shared scratch area."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Collection, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
_local_root: str | None = None


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local-mode session without one (tests) gets a local folder, one
    per process; the session itself is not changed.  On a cluster a
    driver-local folder would be invisible to the executors, so a missing
    setting is an error there.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    master = ""
    try:
        sc = spark.sparkContext
        master = sc.master
        root = root or sc.getCheckpointDir()
    except Exception:  # Spark Connect has no SparkContext
        sc = None
    if not root:
        if sc is None or not master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
        global _local_root
        root = _local_root = _local_root or tempfile.mkdtemp(prefix="storefront-etl-")
    return root.rstrip("/")


_given: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under :func:`scratch_root`."""
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    _given.append(path)
    return path


def given_scratch() -> list[str]:
    """The scratch paths that this process has been given and not dropped."""
    return list(_given)


def drop_scratch(spark: SparkSession, only: Collection[str] | None = None) -> int:
    """Delete what this process has put under its scratch paths (or those in ``only``); how many there were.

    For the end of an application, or of a step of it whose result is written:
    DataFrames that still read scratch tables fail afterwards.  Goes through Spark's file systems, so it works for any
    shared folder.
    """
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    root, dropped = scratch_root(spark) + "/", 0
    for name in [n for n in _given if n.startswith(root)]:
        if only is not None and name not in only:
            continue
        _given.remove(name)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        dropped += bool(path.getFileSystem(conf).delete(path, True))
    return dropped


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_tables(
    tables: Mapping[str, DataFrame],
    output_dir: str,
    mode: str = "overwrite",
    max_concurrent: int = 4,
) -> dict[str, str]:
    """Write each table to ``<output_dir>/<name>.parquet``; return the paths.

    The tables are independent, so up to ``max_concurrent`` writes are
    submitted at once from driver threads (Spark interleaves their tasks);
    each is still one pass over its own plan.  Spark's commit protocol makes
    a retried task (lost executor) replace its own attempt, so a job that
    survives executor loss leaves complete tables.  A failure is raised
    after the other writes have finished.
    """
    out = output_dir.rstrip("/")
    paths = {name: f"{out}/{name}.parquet" for name in tables}
    with ThreadPoolExecutor(max_workers=max(1, max_concurrent)) as pool:
        futures = [pool.submit(write_parquet, df, paths[name], mode) for name, df in tables.items()]
        errors = [f.exception() for f in futures if f.exception() is not None]
    if errors:
        raise errors[0]
    return paths


def register_views(spark: SparkSession, tables: Mapping[str, DataFrame]) -> None:
    """Register each DataFrame as a session temp view for ``spark.sql``."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
