"""Sharding by a two-pass external shuffle (operator 4).

Pass one scatters the records uniformly into buckets that fit in memory,
by a seeded hash of the record; pass two puts each bucket in a fixed order
and shuffles it with a seeded Fisher-Yates shuffle.  The buckets, one after
the other, are a random order of the whole table, which is dealt out to the
shards in turn: position p goes to shard p mod n, slot p div n.  So the law
is ``rows``: the shards' row counts differ by at most one.

The hash takes the id and the text's checksum, so equal texts (a group of
copies that holds a third of all rows, say) scatter like all others.  Rows
equal in both cannot be told apart by content: buckets that they overfill are
dealt to pieces by the rows' places in the input, once.

Defined results: a null text has size 1 and checksum 0 and stays null; an
empty table gives no rows; rows that repeat get slots of their own; extra
columns pass through, also under the names that are used inside; only columns
named like an added one (``ADDED``) are replaced by it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storefront_etl.llm.common import fresh_name, plain_names, prefix_sums, quoted, scatter_partitions, stored, table

SHARDS = 8
# Columns of the result that replace those of the input with the same name.
ADDED = ("size", "text_crc32", "shard", "slot")
SEED = 4
# Text bytes of a bucket, held at once by a task (some three times that with Arrow's copies).
BUCKET_BYTES = 8 << 20
ROW_BYTES = 64
# Overfilled buckets whose list (two numbers each) may be broadcast.
BROADCAST_BUCKETS = 1_000_000


def record_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def text_crc32(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def external_shuffle(docs: DataFrame, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES, shards: int = SHARDS) -> DataFrame:
    """All of ``docs`` in random order: columns ``size``, ``text_crc32``, ``shard`` and ``slot`` are added.

    A clashing column of ``docs`` is replaced by the added one.
    """
    keep = [c for c in docs.columns if c.lower() not in ADDED]
    sized = docs.select(*[quoted(c) for c in keep], record_size(F.col("text")).alias("size"), text_crc32(F.col("text")).alias("text_crc32"))
    home = F.xxhash64(F.lit(seed), "doc_id", "text_crc32", "size")
    # Slim rows, read from the texts once: how full each bucket gets.
    slim = stored(sized.select(home.alias("home"), (F.col("size") + ROW_BYTES).alias("bytes")), "shard-sizes")
    n_buckets = scatter_partitions(slim.agg(F.sum("bytes")).first()[0] or 0, bucket_bytes, 1)
    counted = stored(
        slim.groupBy(F.pmod("home", F.lit(n_buckets)).alias("bucket")).agg(F.count(F.lit(1)).alias("rows"), F.sum("bytes").alias("bytes")), "shard-buckets"
    )
    names, plain = sized.columns, plain_names(sized)
    kept = plain.columns
    bucket, piece = fresh_name(kept, "bucket"), fresh_name(kept, "piece")
    scattered = plain.withColumn(bucket, F.pmod(home, F.lit(n_buckets)))
    # Buckets overfilled by rows that no hash of their content can part, or by single long records: none in ordinary
    # data.  Their rows are dealt to pieces by place, and stored, so that the count and the shuffle see the same pieces.
    over = counted.where(F.col("bytes") > 4 * bucket_bytes).select(F.col("bucket").alias(bucket), F.ceil(F.col("bytes") / bucket_bytes).alias("pieces"))
    whole = scattered.withColumn(piece, F.lit(0).cast("long"))
    sums = counted.select("bucket", F.lit(0).cast("long").alias("piece"), "rows")
    n_over = over.count()
    if n_over:
        known = F.broadcast(over) if n_over <= BROADCAST_BUCKETS else over
        pieces = fresh_name(kept, "pieces")
        place = F.xxhash64(F.lit(seed), F.monotonically_increasing_id())
        cut = scattered.join(known.withColumnRenamed("pieces", pieces), bucket).withColumn(piece, F.pmod(place, F.col(pieces))).drop(pieces)
        cut = stored(cut.select(*[quoted(c) for c in whole.columns]), "shard-pieces")
        whole = whole.join(known.select(bucket), bucket, "left_anti").select(*[quoted(c) for c in whole.columns]).unionByName(cut)
        of_pieces = cut.groupBy(F.col(bucket).alias("bucket"), F.col(piece).alias("piece")).agg(F.count(F.lit(1)).alias("rows"))
        sums = sums.join(over.select(F.col(bucket).alias("bucket")), "bucket", "left_anti").unionByName(of_pieces)
    # One row per bucket: where it starts in the whole order.
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = prefix_sums(stored(sums, "shard-rows"), [], [F.col("bucket"), F.col("piece")], {"upto": F.col("rows")}, parts, "shard-order")
    starts = stored(ordered.select(F.col("bucket").alias(bucket), F.col("piece").alias(piece), (F.col("upto") - F.col("rows")).alias("before")), "shard-starts")
    kinds = T.StructType([*plain.schema.fields, T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType())])

    def shuffled(key: tuple, rows: pa.Table, start: pa.Table) -> pa.Table:
        """One bucket: a fixed order first, so that a rerun shuffles the same sequence."""
        rows = rows.sort_by([("doc_id", "ascending"), ("text_crc32", "ascending"), ("size", "ascending")])
        rng = np.random.Generator(np.random.PCG64([seed, key[0].as_py(), key[1].as_py()]))
        position = np.arange(rows.num_rows) + start.column("before")[0].as_py()
        rows = rows.select(kept).take(pa.array(fisher_yates(rows.num_rows, rng)))
        return rows.append_column("shard", pa.array(position % shards, pa.int32())).append_column("slot", pa.array(position // shards, pa.int64()))

    return whole.groupBy(bucket, piece).cogroup(starts.groupBy(bucket, piece)).applyInArrow(shuffled, kinds).toDF(*names, "shard", "slot")


def fisher_yates(n: int, rng: np.random.Generator) -> list[int]:
    """A random order of n places."""
    order, last = list(range(n)), range(n - 1, 0, -1)
    for i, j in zip(last, rng.integers(0, np.arange(n, 1, -1)).tolist(), strict=True):
        order[i], order[j] = order[j], order[i]
    return order


def write_shards(shuffled: DataFrame, path: str) -> None:
    """The shards as folders ``shard=0`` .. of Parquet files, each file in slot order."""
    shuffled.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op4_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    shuffled = external_shuffle(table(spark, sf_dir, "documents"))
    return shuffled.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
