"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storefront_etl.llm.common import stored

MAX_ROUNDS = 60


def settled(links: DataFrame) -> bool:
    """Are the (a, b) links stars already: every a under one b only, and no b under another node?"""
    ends = links.select(F.col("a").alias("node"), "b").unionByName(links.select(F.col("b").alias("node"), F.lit(None).cast(links.schema["b"].dataType).alias("b")))
    nodes = ends.groupBy("node").agg(F.min("b").alias("low"), F.max("b").alias("high"), F.count(F.when(F.col("b").isNull(), 1)).alias("over"))
    return nodes.where("low < high or (low is not null and over > 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(a, b) links -> (node, root): every linked node and the smallest node it reaches.

    Each round hangs a node's larger neighbours, then its smaller ones, under
    the smallest one it sees, until only stars are left (rounds grow with the
    logarithm of the longest chain).  A node with very many links is a plain
    minimum, combined before the shuffle, and one side of a join that Spark
    may split; nothing is gathered.  No step makes more links than it takes,
    so one ``distinct`` a round is enough.
    """
    now = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    for _ in range(MAX_ROUNDS):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # Links whose larger end is a local minimum's neighbour are now all (node, smaller node).
        small_least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(small_least, "a")
        now = stored(
            joined.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
            .unionByName(small_least.select("a", F.col("m").alias("b")))
            .distinct(),
            "star",
        )
        if settled(now):
            break
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
