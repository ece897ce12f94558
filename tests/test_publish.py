"""Sets of tables: readers see all old ones or all new ones; counts come from the write."""

import logging

import pytest
from pyspark.sql import functions as F

from storefront_etl.plans import jobs
from storefront_etl.sources.publish import drop_old_versions, publish_tables, published, read_published, replace_tables


def tables(spark, value, broken=False):
    """Two tables; the second one fails while it is written if ``broken``."""
    bad = F.raise_error(F.lit("no such luck")).cast("int") if broken else F.lit(value)
    return {
        "one": spark.range(5).select("id", F.lit(value).alias("value"), F.when(F.col("id") > 2, F.lit(float("nan"))).alias("x.y")),
        "two": lambda: spark.range(3).select("id", bad.alias("value")),
    }


def values(frames):
    return {name: sorted({r["value"] for r in df.collect()}) for name, df in frames.items()}


def test_a_failed_table_leaves_the_published_set(spark, tmp_path):
    root = str(tmp_path / "set")
    with pytest.raises(FileNotFoundError, match="no published tables"):
        published(spark, root)
    first = publish_tables(spark, tables(spark, 1), root)
    assert first.number == 1 and first.metrics["one"] == {"rows": 5, "missing": {"id": 0, "value": 0, "x.y": 5}}
    before = read_published(spark, root)
    with pytest.raises(Exception, match="no such luck"):
        publish_tables(spark, tables(spark, 2, broken=True), root)
    assert published(spark, root) == first and values(read_published(spark, root)) == {"one": [1], "two": [1]}
    assert len(list((tmp_path / "set" / "versions").iterdir())) == 1  # what was staged is gone
    second = publish_tables(spark, tables(spark, 3), root)
    assert second.number == 2 and values(read_published(spark, root)) == {"one": [3], "two": [3]}
    # A reader that began before goes on with its set, until it is dropped.
    assert values(before) == values(read_published(spark, root, 1)) == {"one": [1], "two": [1]}
    assert drop_old_versions(spark, root, keep=1) == 1 and drop_old_versions(spark, root) == 0
    with pytest.raises(FileNotFoundError, match="number 1"):
        published(spark, root, 1)
    assert values(read_published(spark, root)) == {"one": [3], "two": [3]}


def test_two_publishers_at_once(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "set")
    publish_tables(spark, tables(spark, 1), root)
    from storefront_etl.sources import publish

    real = publish._numbers
    seen = []

    def stale(files, at):
        seen.append(at)
        return [] if len(seen) == 1 else real(files, at)  # as if the other had not been there yet

    monkeypatch.setattr(publish, "_numbers", stale)
    with pytest.raises(RuntimeError, match="another set"):
        publish_tables(spark, tables(spark, 2), root)
    assert values(read_published(spark, root)) == {"one": [1], "two": [1]}


def test_a_failed_table_leaves_the_plain_tables(spark, tmp_path):
    root = str(tmp_path / "plain")
    got = replace_tables(spark, tables(spark, 1), root)
    assert got.metrics["two"]["rows"] == 3
    with pytest.raises(Exception, match="no such luck"):
        replace_tables(spark, tables(spark, 2, broken=True), root)
    assert sorted(p.name for p in (tmp_path / "plain").iterdir()) == ["one.parquet", "two.parquet"]
    read = lambda: values({n: spark.read.parquet(p) for n, p in got.paths.items()})
    assert read() == {"one": [1], "two": [1]}
    replace_tables(spark, tables(spark, 2), root)
    assert read() == {"one": [2], "two": [2]}


def test_postcodes_are_counted_by_the_scan_that_writes_them(spark, tmp_path, caplog):
    path = tmp_path / "ranges.csv"
    path.write_text("locality,postcode_range\nA,01000-000 a 01003-999\nB,x a y\nC,\nD,01003-000 a 01000-999\n")
    scans = []
    real = jobs.postcode_ranges
    jobs.postcode_ranges, restore = (lambda *a: scans.append(1) or real(*a)), real
    try:
        with caplog.at_level(logging.WARNING):
            jobs.prepare_postcodes(spark, str(path), str(tmp_path / "out"))
    finally:
        jobs.postcode_ranges = restore
    assert len(scans) == 1 and "2 postcode ranges" in caplog.text
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4
