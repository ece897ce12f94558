"""Mixing sources to target weights by systematic sampling (operator 1).

Every source gets a target in words; a document's expected copies are its
source's target over its source's size.  Within a source the documents stand
from the largest to the smallest, the expected copies are summed up from one
random offset, and a document is emitted once per integer boundary that its
own step crosses.  So a document comes ``floor`` or ``ceil`` of its expected
copies times, and (as the sizes fall along the order) the words taken differ
from the target by less than the source's largest document.

Targets: the sources in code-point order (null last) weigh ``weights``,
repeating; ``share`` times all words is dealt by weight, but no source gets
more than ``max_repeat`` times its size.  With sources sorted by size over
weight, the level is the largest ``(budget - sizes so far) / (weights left)``;
a source's target is its weight times the level, or its ceiling.

Defined results: a null or empty text has size 0 and is taken with 0 words;
a source of size 0 has target 0; null sources form one source of their own;
rows that repeat count as documents of their own (rows with equal size and id
are ordered by a text hash, beyond that they are interchangeable); an empty
table gives an empty result.  Extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from storefront_etl.llm.common import WORD, fresh_name, prefix_sums, quoted, stored, table

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_REPEAT = 2
SEED = "mix-1"
# Random offsets are multiples of 2**-20, so that adding them to a count of copies stays exact.
OFFSET_BITS = 20


def word_count(text: Column) -> Column:
    """Number of words; null counts none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, max_repeat: int = MAX_REPEAT
) -> DataFrame:
    """(source, source_size) -> also target: one row per source."""
    n = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, min(n, sources.count() // 10_000 + 1))
    by_name = [F.col("source").isNull(), F.col("source")]
    ranked = prefix_sums(sources, [], by_name, {"rank": F.lit(1)}, parts, "mix-ranked")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), F.pmod(F.col("rank") - 1, F.lit(len(weights))).cast("int") + 1)
    ceiling = ranked.withColumn("weight", weight).withColumn("ceiling", F.lit(max_repeat) * F.col("source_size"))
    by_fill = [F.col("ceiling") / F.col("weight"), F.col("rank")]
    summed = stored(
        prefix_sums(ceiling, [], by_fill, {"ceilings": F.col("ceiling"), "weights": F.col("weight")}, parts, "mix-levels"),
        "mix-targets",
    )
    total = summed.agg(F.sum("source_size"), F.sum("weight")).first()
    budget, all_weights = share * (total[0] or 0), total[1] or 0
    level = summed.agg(
        F.max((F.lit(budget) - F.col("ceilings") + F.col("ceiling")) / (F.lit(all_weights) - F.col("weights") + F.col("weight")))
    ).first()[0]
    return summed.select(
        "source", "source_size",
        F.least(F.col("ceiling").cast("double"), F.lit(float(level or 0.0)) * F.col("weight")).alias("target"),
    )


def random_offset(source: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on the source and the seed only."""
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(F.concat(F.lit("/"), source), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, OFFSET_BITS // 4), 16, 10).cast("double") / F.lit(float(1 << OFFSET_BITS))


def mix_sizes(
    sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, max_repeat: int = MAX_REPEAT, seed: str = SEED
) -> DataFrame:
    """Rows with ``source``, ``size`` and ``doc_id`` -> also source_size, target and ``copies``."""
    n = int(sized.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sources = stored(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    targets = source_targets(sources, weights, share, max_repeat)
    order = [F.col("size").desc(), F.col("doc_id").asc_nulls_last(), F.col("tie")]
    numbered = prefix_sums(sized, ["source"], order, {"place": F.lit(1).cast("long")}, n, "mix-order")
    tagged = targets.withColumnsRenamed({"source": "its_source"})
    # One row per source: Spark may broadcast it or split the hot source's side of the join.
    dealt = numbered.join(tagged, numbered.source.eqNullSafe(tagged.its_source)).drop("its_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    start = random_offset(F.col("source"), seed)
    crossed = F.floor(start + F.col("place") * rate) - F.floor(start + (F.col("place") - 1) * rate)
    return dealt.withColumn("copies", F.least(crossed, F.ceil(rate)).cast("int"))


def row_key() -> Column:
    """Equal for equal (doc_id, source, text), nulls included."""
    return F.xxhash64(F.col("text"), F.col("source"), F.col("doc_id"))


def slim(docs: DataFrame) -> DataFrame:
    """What the sampling needs of each document, written once: the text is read one time and never shuffled."""
    return stored(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), row_key().alias("tie")), "mix-sizes")


def mix_sources(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with each row emitted ``copies`` times (its columns unchanged).

    Rows with equal id, source and text are interchangeable: they share the
    sum of their copies evenly, whatever their number.
    """
    tie, here, n = (fresh_name(docs.columns, c) for c in ("mix_tie", "mix_here", "mix_n"))
    shares = mix_sizes(slim(docs), **options).groupBy("tie").agg(F.sum("copies").alias("sum"), F.count(F.lit(1)).alias("rows"))
    shares = shares.where("sum > 0").select(F.col("tie").alias(tie), F.struct("sum", "rows").alias(here))
    place = F.row_number().over(Window.partitionBy(tie).orderBy(tie))
    total, rows = F.col(here)["sum"], F.col(here)["rows"]
    counted = docs.withColumn(tie, row_key()).join(shares, tie).withColumn(
        n, (F.floor(total / rows) + F.when(place <= total % rows, 1).otherwise(0)).cast("int")
    )
    repeated = F.explode(F.sequence(F.lit(1), F.col(n)))
    return counted.where(F.col(n) > 0).withColumn(n, repeated).select(*[quoted(c) for c in docs.columns])


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sizes(slim(table(spark, sf_dir, "documents")))
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source", "copies"
    )


# The same rows in SQL: levels and steps by window functions over whole groups.
SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source IS NULL, source) - 1 AS r FROM sized GROUP BY source),
weighed AS (SELECT *, [3, 1, 2][CAST(r % 3 AS INTEGER) + 1] AS weight, 2 * source_size AS ceiling FROM sources),
levels AS (
  SELECT (1.5 * sum(source_size) OVER () - (sum(ceiling) OVER fill - ceiling))
         / (sum(weight) OVER () - (sum(weight) OVER fill - weight)) AS level
  FROM weighed WINDOW fill AS (ORDER BY ceiling / weight, r ROWS UNBOUNDED PRECEDING)),
targets AS (
  SELECT source, source_size, least(CAST(ceiling AS DOUBLE), (SELECT max(CAST(level AS DOUBLE)) FROM levels) * weight) AS target,
         CAST(('0x' || substr(md5('mix-1' || coalesce('/' || source, '')), 1, 5)) AS INTEGER) / 1048576.0::DOUBLE AS start
  FROM weighed),
placed AS (
  SELECT s.*, t.source_size, t.target, t.start, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
         row_number() OVER (PARTITION BY s.source ORDER BY s.size DESC, s.doc_id) AS place
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
dealt AS (
  SELECT *, CAST(least(floor(start + place * rate) - floor(start + (place - 1) * rate), ceil(rate)) AS INTEGER) AS copies FROM placed)
SELECT doc_id, size, source_size, target, size * copies AS taken, source, copies FROM dealt"""
