"""Line dedup by a log-template tree (operator 6), in DataFrame operations only.

Every line with a word is parsed along a tree of fixed depth: by its number of
words, then by its first ``DEPTH`` words, where a word with a digit counts as
the variable ``<*>``.  Below that depth the leaf generalises the rest, and may
hold any number of templates.  A word is counted at its place in the leaf, by
the different texts that have it there.  Words of a template are more frequent
than the values of its variable fields, so a line's templates are its words
with at least some frequency, the others variable: one for each frequency that
leaves ``CONSTANT_SHARE`` of the words constant.  Other lines of the leaf
neither hide a template nor add to it, however many there are.

A template recurs if lines of ``MIN_DOCS`` different texts have it; lines with
a recurring template are dropped.  Texts are counted, not rows: copies of a
document don't turn its lines into templates.  Nor do near copies: a text with
``COPY_SHARE`` of its words in lines that recur is a copy of others rather
than a document with boilerplate, and is no evidence.  It still loses the
lines that recur in others.

At scale: the first pass keeps slim rows and counts leaves with
pre-aggregation; only lines in leaves with enough texts are looked at again,
by a join with one row per leaf.  What is counted afterwards are different
lines (of one leaf), their places and words, never whole leaves: nothing is
gathered by leaf or template.  Joins have a stored table on either side, so
that Spark may split a hot key.  Lines are put together again per document by
a sort merge join with the dropped places, one row per document.

Defined results: a null text has no lines and stays null; lines without a word
stay; a text may end up empty, its row stays; rows that repeat are cut alike;
an empty table gives no rows; extra columns pass through, clashing names are
kept apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storefront_etl.llm.common import WORD, fresh_name, quoted, stored, table

DEPTH = 3
MIN_DOCS = 10
CONSTANT_SHARE = 0.6
COPY_SHARE = 0.7
VARIABLE = "<*>"


def masked(word: Column) -> Column:
    return F.when(word.rlike("[0-9]"), F.lit(VARIABLE)).otherwise(word)


def row_key() -> Column:
    return F.xxhash64(F.col("text"), F.col("doc_id"))


def parsed_lines(docs: DataFrame) -> DataFrame:
    """(row, content, place, words, leaf) of every line with a word; place counts from 0."""
    lines = docs.where("text is not null").select(
        row_key().alias("row"), F.xxhash64("text").alias("content"), F.posexplode(F.split("text", "\n", -1)).alias("place", "line")
    )
    words = lines.withColumn("words", F.regexp_extract_all("line", F.lit(WORD), F.lit(0))).where(F.size("words") > 0)
    path = [masked(F.get("words", F.lit(k))) for k in range(DEPTH)]
    return words.select("row", "content", "place", "words", F.xxhash64(F.size("words"), *path).alias("leaf"))


def least_constants(words: Column) -> Column:
    """Words of a line that must be constant."""
    return F.ceil(F.lit(CONSTANT_SHARE) * words).cast("int")


def line_templates(lines: DataFrame, min_docs: int) -> DataFrame:
    """Recurring leaves' lines (leaf, content, words, variant) -> (variant, template): the templates that each different line has."""
    variants = stored(lines.select("leaf", "variant", "words").distinct(), "template-variants")
    # How many texts have a word at a place of a leaf.
    seen = lines.select("leaf", "content", F.posexplode("words").alias("at", "word")).where(F.col("word") != VARIABLE).distinct()
    often = stored(seen.groupBy("leaf", "at", "word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_docs), "template-words")
    placed = variants.select("leaf", "variant", F.size("words").alias("size"), F.posexplode("words").alias("at", "word"))
    found = placed.join(often, ["leaf", "at", "word"]).groupBy("leaf", "variant", "size").agg(F.sort_array(F.collect_list(F.struct("n", "at", "word")), asc=False).alias("frequent"))
    enough = found.where(F.size("frequent") >= least_constants(F.col("size")))
    # The frequencies that leave enough words; each makes a template of the words that have it.
    counts = F.transform("frequent", lambda w: w["n"])
    least = F.array_distinct(F.slice(counts, least_constants(F.col("size")), F.size("frequent")))
    each = enough.select("leaf", "variant", "frequent", F.explode(least).alias("least"))
    words = F.array_sort(F.transform(F.filter("frequent", lambda w: w["n"] >= F.col("least")), lambda w: F.struct(w["at"], w["word"])))
    return each.select("variant", F.xxhash64("leaf", words).alias("template"))


def recurring_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(row, place) of the lines that have a template which recurs across documents."""
    slim = stored(parsed_lines(docs).select("leaf", "content", "row", "place", F.size("words").alias("size")), "template-places")
    leaves = stored(
        slim.select("leaf", "content").distinct().groupBy("leaf").agg(F.count(F.lit(1)).alias("texts")).where(F.col("texts") >= min_docs).select("leaf"),
        "template-leaves",
    )
    words = F.transform("words", masked)
    lines = stored(
        parsed_lines(docs).join(leaves, "leaf").select("leaf", "row", "content", "place", words.alias("words"), F.xxhash64("leaf", words).alias("variant")),
        "template-lines",
    )
    templates = stored(line_templates(lines, min_docs), "templates")
    texts = stored(lines.select("variant", "content").distinct(), "template-texts")
    pairs = stored(templates.join(texts, "variant").select("template", "content").distinct(), "template-pairs")

    def recurring(evidence: DataFrame, name: str) -> DataFrame:
        """The variants with a template that enough texts of the evidence have."""
        again = stored(evidence.groupBy("template").agg(F.count(F.lit(1)).alias("texts")).where(F.col("texts") >= min_docs).select("template"), f"{name}-templates")
        return stored(templates.join(again, "template").select("variant").distinct(), f"{name}-variants")

    places = lines.select("variant", "content", "place", F.size("words").alias("size"))
    in_recurring = places.join(recurring(pairs, "template-first"), "variant").select("content", "place", "size").distinct()
    covered = stored(in_recurring.groupBy("content").agg(F.sum("size").alias("covered")), "template-covered")
    sizes = slim.select("content", "place", "size").distinct().groupBy("content").agg(F.sum("size").alias("total"))
    copies = stored(sizes.join(covered, "content").where(F.col("covered") >= COPY_SHARE * F.col("total")).select("content"), "template-copies")
    final = recurring(pairs.join(copies, "content", "left_anti"), "template-last")
    return lines.select("variant", "row", "place").join(final, "variant").select("row", "place")


def drop_recurring_lines(docs: DataFrame, min_docs: int = MIN_DOCS, counts: bool = False) -> DataFrame:
    """``docs`` without the lines of recurring templates (with ``n_lines`` and ``n_dropped`` if ``counts``)."""
    row, gone = fresh_name(docs.columns, "template_row"), fresh_name(docs.columns, "template_gone")
    dropped = stored(
        recurring_lines(docs, min_docs).groupBy("row").agg(F.collect_set("place").alias(gone)).withColumnRenamed("row", row), "template-dropped"
    )
    # The same plan at every size: both sides by row (one small row per cut document on the right).
    joined = docs.withColumn(row, row_key()).join(dropped.hint("merge"), row, "left")
    lines = F.split("text", "\n", -1)
    kept = F.array_join(F.filter(lines, lambda line, k: ~F.array_contains(F.col(gone), k)), "\n")
    text = F.when(F.col(gone).isNull(), F.col("text")).otherwise(kept)
    columns = [text.alias(c) if c.lower() == "text" else quoted(c) for c in docs.columns]
    if counts:
        columns += [
            F.coalesce(F.size(F.when(F.col("text").isNotNull(), lines)), F.lit(0)).cast("long").alias("n_lines"),
            F.coalesce(F.size(gone), F.lit(0)).cast("long").alias("n_dropped"),
        ]
    return joined.select(*columns)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_recurring_lines(docs, counts=True).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


SQL = r"""
WITH docs AS (SELECT doc_id, md5(text) AS content, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
lines AS (SELECT doc_id, content, ls[p] AS line, p FROM (SELECT doc_id, content, ls, unnest(range(1, CAST(len(ls) AS BIGINT) + 1)) AS p FROM docs)),
parsed AS (
  SELECT doc_id, content, p, list_transform(regexp_extract_all(line, '[^\x20\x09-\x0D]+'),
         lambda w : CASE WHEN regexp_matches(w, '[0-9]') THEN '<*>' ELSE w END) AS ws FROM lines),
pathed AS (SELECT *, {'n': len(ws), 'a': ws[1], 'b': ws[2], 'c': ws[3]} AS leaf FROM parsed WHERE len(ws) > 0),
variants AS (SELECT leaf, ws, row_number() OVER () AS variant FROM (SELECT DISTINCT leaf, ws FROM pathed)),
texts AS (SELECT DISTINCT variant, content FROM pathed JOIN variants USING (leaf, ws)),
words AS (SELECT leaf, variant, len(ws) AS size, q, ws[q] AS w FROM (SELECT *, unnest(range(1, CAST(len(ws) AS BIGINT) + 1)) AS q FROM variants)),
often AS (SELECT leaf, q, w, count(DISTINCT content) AS n FROM words JOIN texts USING (variant) WHERE w <> '<*>' GROUP BY leaf, q, w HAVING count(DISTINCT content) >= 10),
frequent AS (
  SELECT leaf, variant, any_value(size) AS size, list({'n': n, 'q': q, 'w': w} ORDER BY n DESC) AS f
  FROM words JOIN often USING (leaf, q, w) GROUP BY leaf, variant HAVING count(*) >= ceil(0.6::DOUBLE * any_value(size))),
each AS (
  SELECT leaf, variant, f, unnest(list_distinct(list_transform(f[CAST(ceil(0.6::DOUBLE * size) AS BIGINT):], lambda x : x.n))) AS least FROM frequent),
templates AS (
  SELECT variant, md5(CAST({'leaf': leaf, 'f': list_sort(list_transform(list_filter(f, lambda x : x.n >= least), lambda x : {'q': x.q, 'w': x.w}))} AS VARCHAR)) AS template
  FROM each),
pairs AS (SELECT DISTINCT template, content FROM templates JOIN texts USING (variant)),
first_variants AS (
  SELECT DISTINCT variant FROM templates WHERE template IN (SELECT template FROM pairs GROUP BY template HAVING count(*) >= 10)),
numbered AS (SELECT doc_id, content, p, len(ws) AS size, variant FROM pathed JOIN variants USING (leaf, ws)),
sizes AS (
  SELECT content, sum(size) AS total, coalesce(sum(size) FILTER (variant IN (SELECT variant FROM first_variants)), 0) AS covered
  FROM (SELECT DISTINCT content, p, size, variant FROM numbered) GROUP BY content),
evidence AS (SELECT template, content FROM pairs JOIN sizes USING (content) WHERE covered < 0.7::DOUBLE * total),
final_variants AS (
  SELECT DISTINCT variant FROM templates WHERE template IN (SELECT template FROM evidence GROUP BY template HAVING count(*) >= 10)),
dropped AS (SELECT doc_id, list(p) AS ps FROM numbered WHERE variant IN (SELECT variant FROM final_variants) GROUP BY doc_id)
SELECT a.doc_id, CAST(coalesce(len(string_split(a.text, chr(10))), 0) AS BIGINT) AS n_lines,
       CAST(coalesce(len(ps), 0) AS BIGINT) AS n_dropped,
       sha256(CASE WHEN ps IS NULL THEN coalesce(a.text, '') ELSE array_to_string(list_transform(
         list_filter(range(1, CAST(len(string_split(a.text, chr(10))) AS BIGINT) + 1), lambda k : NOT list_contains(ps, k)),
         lambda k : string_split(a.text, chr(10))[k]), chr(10)) END) AS kept_sha256
FROM documents a LEFT JOIN dropped d ON a.doc_id = d.doc_id"""
