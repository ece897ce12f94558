"""

    python tools/ab_bench.py [sf_dir]

Each pair computes the same rows two ways and is timed through the noop
sink (best of 3 after one warm-up).  The Python UDF variants exist only here,
as the comparison baseline; the library never uses them.
"""

from __future__ import annotations

import json
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql.types import StringType  # noqa: E402

from storefront_etl.functions.calendar import DAY_NAMES, MONTH_NAMES, day_of_week_name, month_name  # noqa: E402
from storefront_etl.functions.labels import REGION_GROUPS, region_of_state  # noqa: E402
from storefront_etl.operators.fill import fill_missing, fill_missing_by_union  # noqa: E402
from storefront_etl.operators.lookup import lookup_dimension  # noqa: E402
from storefront_etl.operators.postcode import range_bounds  # noqa: E402
from storefront_etl.plans import standins as q  # noqa: E402
from storefront_etl.session import local_session  # noqa: E402


def best(df, n=3) -> float:
    df.write.format("noop").mode("overwrite").save()
    times = []
    for _ in range(n):
        t0 = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - t0)
    return round(min(times), 4)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, 8)
    out = {"sf_dir": sf_dir}

    # 1. native label/date names vs row-at-a-time Python UDF (lineitem).
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    states = [s for _, g in REGION_GROUPS for s in g]
    base = lineitem.select(
        F.col("l_shipdate").alias("ts"),
        F.element_at(F.array(*[F.lit(s) for s in states]), (F.pmod("l_orderkey", F.lit(len(states))) + 1).cast("int")).alias("st"),
    )
    native = base.select(
        day_of_week_name(F.dayofweek("ts")).alias("d"), month_name(F.month("ts")).alias("m"),
        region_of_state("st").alias("r"))

    def _day(n):
        return DAY_NAMES[n - 1] if n is not None and 1 <= n <= 7 else "saturday"

    def _month(n):
        return MONTH_NAMES[n - 1] if n is not None and 1 <= n <= 12 else "december"

    lookup = {s: label for label, g in REGION_GROUPS for s in g}

    def _region(s):
        return lookup.get(s, "sul")

    day_udf, month_udf, region_udf = (F.udf(f, StringType()) for f in (_day, _month, _region))
    python = base.select(
        day_udf(F.dayofweek("ts")).alias("d"), month_udf(F.month("ts")).alias("m"),
        region_udf("st").alias("r"))
    assert native.exceptAll(python).count() == 0
    out["labels_native_sec"] = best(native)
    out["labels_python_udf_sec"] = best(python)

    # 2. coalesce fallback vs split + union (geolocation stand-in on customer).
    raw = q.geolocation_raw(spark.read.parquet(f"{sf_dir}/customer.parquet")).withColumn(
        "orig", F.col("geolocation_city"))
    joined = lookup_dimension(raw, q.postcodes(spark, sf_dir), key="geolocation_zip_code_prefix",
                              dim_key="cep_prefix", dim_value="locality", out="geolocation_city",
                              value_transform=F.lower)
    one = fill_missing(joined, "geolocation_city", "orig")
    two = fill_missing_by_union(joined, "geolocation_city", F.col("orig"))
    out["fallback_coalesce_sec"] = best(one)
    out["fallback_split_union_sec"] = best(two)

    # 3. expanded keys + broadcast hash join vs BETWEEN (nested-loop) join.
    customers = q.customers_raw(spark.read.parquet(f"{sf_dir}/customer.parquet"))
    ranges = q.nation_ranges(spark.read.parquet(f"{sf_dir}/nation.parquet"))
    expanded = lookup_dimension(customers, q.postcodes(spark, sf_dir), key="customer_zip_code_prefix",
                                dim_key="cep_prefix", dim_value="locality", out="city")
    lo, hi = range_bounds("postcode_range")
    bounded = ranges.select("locality", lo.alias("lo"), hi.alias("hi"))
    from storefront_etl.functions.casts import lenient_int
    keyed = customers.withColumn("k", lenient_int("customer_zip_code_prefix"))
    between = keyed.join(bounded, (keyed["k"] >= bounded["lo"]) & (keyed["k"] <= bounded["hi"]), "left") \
        .withColumnRenamed("locality", "city").drop("k", "lo", "hi")
    assert expanded.count() == between.count()
    out["range_expanded_hash_join_sec"] = best(expanded)
    out["range_between_nested_loop_sec"] = best(between)

    # 4. same, with a range table that grows with the data (supplier ranges,
    #    lineitem keys): cost O(facts + prefixes) against O(facts x ranges).
    facts = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", q.pad5(F.pmod(F.col("l_orderkey") * 7, F.lit(99000))).alias("zip"))
    sranges = q.supplier_ranges(spark.read.parquet(f"{sf_dir}/supplier.parquet"))
    expanded2 = lookup_dimension(facts, q.expand_postcode_ranges(sranges), key="zip",
                                 dim_key="cep_prefix", dim_value="locality", out="city")
    sb = sranges.select("locality", lo.alias("lo"), hi.alias("hi")).where("lo IS NOT NULL AND hi >= lo")
    fk = facts.withColumn("k", lenient_int("zip"))
    between2 = fk.join(sb, (fk["k"] >= sb["lo"]) & (fk["k"] <= sb["hi"]), "left") \
        .withColumnRenamed("locality", "city").drop("k", "lo", "hi")
    assert expanded2.count() == between2.count()
    out["growing_ranges_expanded_hash_join_sec"] = best(expanded2)
    out["growing_ranges_between_nested_loop_sec"] = best(between2)
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()
