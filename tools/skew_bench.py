"""Hot-key A/B for the non-broadcast lookup path.

    python tools/skew_bench.py [sf_dir]

Facts: lineitem with a third of all rows on one zip prefix (the rest spread);
dimension: the supplier-derived postcode ranges, forced off the broadcast
path.  Compares the salted sort-merge join with a plain sort-merge join,
with and without AQE's skew-join splitting.  Reports wall time and the
largest task of each variant's stages via ``SKEW_EVENT_LOG=<folder>`` and
``tools/eventlog_summary.py`` (max/median task time = the critical path a
large cluster would wait on).
"""

from __future__ import annotations

import json
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from storefront_etl.operators.lookup import lookup_dimension, prepare_dimension  # noqa: E402
from storefront_etl.plans import standins as q  # noqa: E402
from storefront_etl.session import local_session  # noqa: E402


def timed(df, label: str | None = None) -> float:
    df.write.format("noop").mode("overwrite").save()
    if label:
        df.sparkSession.sparkContext.setJobDescription(label)
    t0 = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    elapsed = round(time.perf_counter() - t0, 3)
    if label:
        df.sparkSession.sparkContext.setJobDescription(None)
    return elapsed


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    import os

    spark = local_session(8, 32, event_log_dir=os.environ.get("SKEW_EVENT_LOG"))
    k = F.col("l_orderkey")
    facts = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_partkey",
        F.when(F.pmod(k, F.lit(3)) == 0, F.lit("01003"))
        .otherwise(q.pad5(F.pmod(k * 7, F.lit(99000)))).alias("zip"),
    )
    ranges = q.supplier_ranges(spark.read.parquet(f"{sf_dir}/supplier.parquet"))
    dim = q.expand_postcode_ranges(ranges)
    out = {"sf_dir": sf_dir, "fact_rows": facts.count()}

    salted = lookup_dimension(facts, dim, key="zip", dim_key="cep_prefix", dim_value="locality",
                              out="city", broadcast_max_rows=0, rows_per_salt=50_000)
    out["salted_smj_sec"] = timed(salted, "salted")

    pairs = prepare_dimension(dim, "cep_prefix", "locality")
    from storefront_etl.functions.casts import lenient_int
    plain = facts.withColumn("__lookup_key", lenient_int("zip")).join(
        pairs.hint("merge"), "__lookup_key", "left")
    out["plain_smj_aqe_skew_sec"] = timed(plain, "plain-aqe-skew")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    out["plain_smj_no_skew_handling_sec"] = timed(plain, "plain-no-skew-handling")
    spark.conf.unset("spark.sql.adaptive.skewJoin.enabled")
    assert salted.count() == plain.count()
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()
