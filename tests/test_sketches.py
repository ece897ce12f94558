"""Mergeable profiles: two loads' states give the profile of their union, within the stated errors."""

import pytest
from pyspark.sql import functions as F

from storefront_etl.operators.profile import profile_columns
from storefront_etl.operators.sketches import append_profile, distinct_error, merged_profile, profile_state, read_profile


def frame(spark, lo, hi):
    k = F.col("id")
    return spark.range(lo, hi).select(
        k, F.when(k % 5 == 0, None).otherwise(F.concat(F.lit("long text " * 30), (k % 3000).cast("string"))).alias("text"),
        F.when(k % 7 == 0, F.lit(float("nan"))).otherwise((k % 1000) / 4).alias("a.b"), F.create_map(F.lit("k"), k % 11).alias("m"),
        F.array(k % 13).alias("list"), F.when(k % 2 == 0, F.lit(0.0)).otherwise(F.lit(-0.0)).alias("zero"), (k % 2 == 0).alias("flag"),
        F.lit(None).cast("decimal(9,2)").alias("nothing"), F.date_add(F.lit("2020-01-01"), (k % 100).cast("int")).alias("day"),
    )


def test_two_loads_make_the_profile_of_their_union(spark, tmp_path):
    path = str(tmp_path / "states")
    loads = [frame(spark, 0, 30_000), frame(spark, 20_000, 50_000)]
    for k, df in enumerate(loads):
        append_profile(df, path, f"load {k}")
    got = {r["column_name"]: r for r in read_profile(spark, path, [0.25, 0.5]).collect()}
    exact = {r["column_name"]: r for r in profile_columns(loads[0].unionByName(loads[1])).collect()}
    assert set(got) == set(exact)
    for name, want in exact.items():
        r = got[name]
        assert (r["data_type"], r["loads"], r["row_count"], r["null_count"]) == (want["data_type"], 2, want["row_count"], want["null_count"]), name
        assert abs(r["distinct_count"] - want["distinct_count"]) <= distinct_error() * want["distinct_count"], name
    assert (got["id"]["smallest"], got["id"]["largest"]) == (0, 49_999)
    rank = spark.range(0, 30_000).union(spark.range(20_000, 50_000)).where(F.col("id") <= got["id"]["quantiles"][1]).count() / 60_000
    assert abs(rank - 0.5) < 0.02
    assert got["text"]["quantiles"] is None and got["nothing"]["quantiles"] is None and got["nothing"]["distinct_count"] == 0
    # One load alone, and all columns' states in one aggregate without Expand.
    one = {r["column_name"]: r["row_count"] for r in merged_profile(profile_state(loads[0], "x", ["id", "text"])).collect()}
    assert one == {"id": 30_000, "text": 30_000}
    assert "Expand" not in profile_state(loads[0], "x")._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("lg_k", [10, 14])
def test_distinct_error_holds(spark, lg_k):
    df = spark.range(200_000).select((F.col("id") * 7919).alias("v"))
    got = merged_profile(profile_state(df, "x", lg_k=lg_k)).first()["distinct_count"]
    assert abs(got - 200_000) <= distinct_error(lg_k) * 200_000


def test_empty_load(spark):
    got = merged_profile(profile_state(frame(spark, 0, 0), "none")).collect()
    assert {(r["row_count"], r["null_count"], r["distinct_count"], r["quantiles"]) for r in got} == {(0, 0, 0, None)}
