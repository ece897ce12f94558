"""Derive an N-times larger copy of a test-data directory for scaling runs.

    python tools/scale_up.py /root/testdata/sf0.1 OUT_DIR [copies=10] [files=32]

Each copy offsets every key by copy * (max key + 1), so joins keep their
shape (an order's lines stay with it); region and nation stay as they are.
Tables are written as multi-file Parquet directories so scans parallelise.
Only for timing runs: correctness is checked on the given tables.
"""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from storefront_etl.session import local_session  # noqa: E402

KEYS = {
    "customer": ["c_custkey"],
    "supplier": ["s_suppkey"],
    "part": ["p_partkey"],
    "orders": ["o_orderkey", "o_custkey"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey"],
    "events": ["event_id"],
    "documents": ["doc_id"],
}
# Key domains shared across tables: each key column is offset by its domain size.
DOMAIN = {
    "c_custkey": ("customer", "c_custkey"), "o_custkey": ("customer", "c_custkey"),
    "s_suppkey": ("supplier", "s_suppkey"), "l_suppkey": ("supplier", "s_suppkey"),
    "p_partkey": ("part", "p_partkey"), "l_partkey": ("part", "p_partkey"),
    "o_orderkey": ("orders", "o_orderkey"), "l_orderkey": ("orders", "o_orderkey"),
    "event_id": ("events", "event_id"), "doc_id": ("documents", "doc_id"),
}


def main() -> None:
    src, out = sys.argv[1], sys.argv[2]
    copies = int(sys.argv[3]) if len(sys.argv) > 3 else 10
    files = int(sys.argv[4]) if len(sys.argv) > 4 else 32
    spark = local_session(8, files)
    read = lambda t: spark.read.parquet(f"{src}/{t}.parquet")
    span = {name: read(t).agg(F.max(c)).first()[0] + 1 for name, (t, c) in DOMAIN.items()}
    for t in ("region", "nation"):
        read(t).write.mode("overwrite").parquet(f"{out}/{t}.parquet")
    for t, keys in KEYS.items():
        df = read(t).withColumn("__copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
        df = df.withColumns({k: F.col(k) + F.col("__copy") * F.lit(span[k]) for k in keys}).drop("__copy")
        df.repartition(files).write.mode("overwrite").parquet(f"{out}/{t}.parquet")
    spark.stop()


if __name__ == "__main__":
    main()
