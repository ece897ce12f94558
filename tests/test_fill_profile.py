import datetime as dt
import math

from pyspark.sql import functions as F

from storefront_etl.operators.fill import fill_missing, fill_missing_by_union
from storefront_etl.operators.profile import distinct_values, null_profile, preview, profile_columns


def test_coalesce_equals_split_union(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "a", "y"), (3, None, "z"), (3, None, "z")],
                               "id int, city string, orig string")
    one = fill_missing(df, "city", "orig")
    two = fill_missing_by_union(df, "city", F.col("orig"))
    assert one.exceptAll(two).count() == 0 and two.exceptAll(one).count() == 0


def test_null_profile_counts_nan_and_handles_text_and_timestamps(spark):
    df = spark.createDataFrame(
        [(float("nan"), "abc", dt.datetime(2017, 1, 1)), (None, None, None), (1.0, "x", None)],
        "f double, t string, ts timestamp")
    row = null_profile(df).first()
    assert (row.f, row.t, row.ts) == (2, 1, 2)


def test_profile_columns(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "a")], "k int, v string")
    rows = {r.column_name: r for r in profile_columns(df).collect()}
    assert rows["k"].data_type == "int" and rows["k"].distinct_count == 2
    assert rows["v"].null_count == 1 and rows["v"].distinct_count == 1
    assert rows["v"].row_count == 3
    approx = {r.column_name: r.distinct_count for r in profile_columns(df, approx_distinct=True).collect()}
    assert approx == {"k": 2, "v": 1}


def test_distinct_and_preview(spark):
    df = spark.createDataFrame([(3, "b"), (1, "a"), (2, "a")], "k int, v string")
    assert sorted(r.v for r in distinct_values(df, "v").collect()) == ["a", "b"]
    assert [r.k for r in preview(df, 2, order_by="k").collect()] == [1, 2]
    assert preview(df, 2).count() == 2
    assert not math.isnan(1.0)


def test_profiles_accept_awkward_header_names(spark):
    df = spark.createDataFrame([("1", None), ("1", "x")], "`a.b` string, `c d` string")
    assert tuple(null_profile(df).first()) == (0, 1)
    rows = {r.column_name: r.distinct_count for r in profile_columns(df).collect()}
    assert rows == {"a.b": 1, "c d": 1}
    assert distinct_values(df, "a.b").count() == 1


def test_profile_accepts_map_columns(spark):
    df = spark.createDataFrame([({"a": 1},), ({"a": 1},), (None,)], "m map<string,int>")
    row = profile_columns(df).first()
    assert (row.column_name, row.null_count, row.distinct_count) == ("m", 1, 1)
