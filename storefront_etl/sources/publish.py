"""A set of tables that readers see as one: staged writes, a manifest last.

``publish_tables`` writes every table into a fresh version folder; only when
all are complete does a manifest name that folder.  Readers resolve the newest
manifest, so they see all old tables or all new ones, and a failed table
leaves the old set as it was::

    <root>/versions/<id>/<table>.parquet
    <root>/manifests/<number>.json

A manifest is written aside and renamed to the next free number, without
overwriting: of two publishers that finish at once one gets an error.  (This
needs a file system whose rename is atomic and does not overwrite, as HDFS
and local disks have.)

``replace_tables`` keeps the plain layout ``<root>/<table>.parquet`` for
readers that know nothing of manifests: all tables are staged first and then
renamed into place, so that only renames stand between the old set and the
new one.

Row and missing-value counts of each table come from the write itself
(``DataFrame.observe``): no second scan.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from storefront_etl.operators.profile import missing_condition

Table = DataFrame | Callable[[], DataFrame]


@dataclass(frozen=True)
class Published:
    """A complete set: its number, each table's path, and (rows, missing values by column)."""

    number: int
    paths: dict[str, str]
    metrics: dict[str, dict]


class _Files:
    """The few file operations needed, through Spark's file systems."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark.sparkContext._jvm
        self._path = self._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def names(self, folder: str) -> list[str]:
        path = self._path(folder)
        return [s.getPath().getName() for s in self._fs.listStatus(path)] if self._fs.exists(path) else []

    def write(self, path: str, text: str) -> None:
        out = self._fs.create(self._path(path), False)
        out.write(bytearray(text.encode()))
        out.close()

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def make(self, folder: str) -> None:
        self._fs.mkdirs(self._path(folder))

    def move(self, source: str, target: str) -> bool:
        return not self._fs.exists(self._path(target)) and self._fs.rename(self._path(source), self._path(target))

    def drop(self, path: str) -> bool:
        return self._fs.delete(self._path(path), True)


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``df`` that counts its rows and missing values by column while it is used once."""
    found = Observation(f"{name}-{uuid.uuid4().hex}")
    missing = [F.count(F.when(missing_condition(df, c), F.lit(1))).alias(f"missing_{k}") for k, c in enumerate(df.columns)]
    return df.observe(found, F.count(F.lit(1)).alias("rows"), *missing), found


def staged(spark: SparkSession, tables: Mapping[str, Table], folder: str, max_concurrent: int, describe: str) -> dict[str, dict]:
    """Every table written under ``folder``; their counts.  On a failure the folder goes, and the first error is raised."""

    def write(name: str) -> dict:
        _describe(spark, f"{describe} {name}")
        table = tables[name]
        df, found = observed(table() if callable(table) else table, name)
        df.write.parquet(f"{folder}/{name}.parquet")
        counts = found.get
        return {"rows": counts["rows"], "missing": {c: counts[f"missing_{k}"] for k, c in enumerate(df.columns)}}

    with ThreadPoolExecutor(max_workers=max(1, max_concurrent)) as pool:
        futures = {name: pool.submit(write, name) for name in tables}
    errors = [f.exception() for f in futures.values() if f.exception() is not None]
    if errors:
        _Files(spark, folder).drop(folder)
        raise errors[0]
    return {name: f.result() for name, f in futures.items()}


def _describe(spark: SparkSession, text: str) -> None:
    """Label this thread's Spark jobs (a thread-local property, not config)."""
    try:
        spark.sparkContext.setJobDescription(text)
    except Exception:  # Spark Connect has no SparkContext
        pass


def _numbers(files: _Files, root: str) -> list[int]:
    return sorted(int(n.removesuffix(".json")) for n in files.names(f"{root}/manifests") if n.removesuffix(".json").isdigit())


def publish_tables(spark: SparkSession, tables: Mapping[str, Table], root: str, max_concurrent: int = 4) -> Published:
    """Write all tables (DataFrames, or functions that make them) and make them the newest set under ``root``."""
    root = root.rstrip("/")
    files, version = _Files(spark, root), uuid.uuid4().hex
    metrics = staged(spark, tables, f"{root}/versions/{version}", max_concurrent, "publish")
    files.make(f"{root}/manifests")
    number = (_numbers(files, root) or [0])[-1] + 1
    aside = f"{root}/manifests/.{version}"
    files.write(aside, json.dumps({"version": version, "tables": metrics}))
    if not files.move(aside, f"{root}/manifests/{number}.json"):
        files.drop(aside)
        files.drop(f"{root}/versions/{version}")
        raise RuntimeError(f"another set of tables was published under {root} as number {number}")
    return published(spark, root, number)


def published(spark: SparkSession, root: str, number: int | None = None) -> Published:
    """The newest complete set under ``root``, or the one with a given number."""
    root = root.rstrip("/")
    files = _Files(spark, root)
    known = _numbers(files, root)
    if not known or (number is not None and number not in known):
        raise FileNotFoundError(f"no published tables under {root}" + (f" with number {number}" if number is not None else ""))
    number = known[-1] if number is None else number
    manifest = json.loads(files.read(f"{root}/manifests/{number}.json"))
    paths = {name: f"{root}/versions/{manifest['version']}/{name}.parquet" for name in manifest["tables"]}
    return Published(number, paths, manifest["tables"])


def read_published(spark: SparkSession, root: str, number: int | None = None) -> dict[str, DataFrame]:
    """The tables of one set (all of the same one, whatever is published meanwhile)."""
    return {name: spark.read.parquet(path) for name, path in published(spark, root, number).paths.items()}


def drop_old_versions(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Delete all but the newest ``keep`` sets; how many went.  Readers of a deleted set fail."""
    if keep < 1:
        raise ValueError("keep must be at least 1")
    root = root.rstrip("/")
    files = _Files(spark, root)
    old = _numbers(files, root)[:-keep]
    for number in old:
        version = json.loads(files.read(f"{root}/manifests/{number}.json"))["version"]
        files.drop(f"{root}/manifests/{number}.json")  # first: no reader may find it any more
        files.drop(f"{root}/versions/{version}")
    return len(old)


def replace_tables(spark: SparkSession, tables: Mapping[str, Table], root: str, max_concurrent: int = 4) -> Published:
    """Write all tables aside, then rename them to ``<root>/<name>.parquet``; a failed table leaves all old ones."""
    root = root.rstrip("/")
    files = _Files(spark, root)
    folder = f"{root}/.staged-{uuid.uuid4().hex}"
    metrics = staged(spark, tables, folder, max_concurrent, "write")
    paths = {name: f"{root}/{name}.parquet" for name in tables}
    for name, path in paths.items():
        files.drop(path)
        if not files.move(f"{folder}/{name}.parquet", path):
            raise RuntimeError(f"{path} could not be replaced; the new tables are in {folder}")
    files.drop(folder)
    return Published(0, paths, metrics)
