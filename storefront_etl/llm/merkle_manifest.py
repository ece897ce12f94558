"""Merkle manifest of a dataset, placed by bitmap ranks (operator 12).

Every row is a leaf; the leaves of one language form a tree, the languages'
subroots form the tree on top, and its root stands for the whole dataset.

*Places.*  A leaf's place among its language's leaves is the rank of its
doc_id.  Each task turns its ids into 64-bit words of a bitmap (one row per
word that holds an id, so sparse ids cost no empty words), the words are
merged by OR, and a running popcount over the words is their directory.  A
rank is the directory's entry plus the popcount of the word below the id's
bit: no leaf is sorted.  A bit can't hold two rows: rows of words in which an
id repeats (or the null id does) are numbered by running sums over their own
range partitions, so an id of a third of all rows spreads over many tasks.

*Levels.*  The nodes at places ``256 b .. 256 b + 255`` meet in a slot array
(key: tree and b), which is reduced by eight levels at once; the arrays'
digests are the next slots, until one node is left.  Going down again each
array gets the siblings above it and adds its own, so a leaf's proof and its
recomputed root are made where its array is.

A node is the SHA-256, in hex, of its children's hex digests one after the
other; a last child without a neighbour is hashed alone.  A leaf is the
SHA-256 of doc_id, source, lang, n_chars and text, each ``-`` if null, else
its UTF-8 length, ``:`` and the value.

Defined results: the null language is a tree of its own and comes first; null
ids come before all others; rows with one id follow each other by leaf
digest, rows that repeat as a whole are leaves of their own; empty and null
texts are different leaves; an empty table gives no rows; extra columns are
ignored.  Ids must be whole numbers (another type is an error).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storefront_etl.llm.common import prefix_sums, quoted, stored, table

LEVELS = 8
SLOTS = 1 << LEVELS
TAMPERED = 7
WORD_BITS = 6
# The word that null ids share; it comes before every id's word.
NULL_WORD = -(1 << 62)


def framed(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(n_chars: Column) -> Column:
    fields = [quoted("doc_id"), quoted("source"), quoted("lang"), n_chars, quoted("text")]
    return F.sha2(F.concat(*[framed(f) for f in fields]).cast("binary"), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """(tree, doc_id, leaf, tampered): the leaf digests; ``tampered`` only where n_chars is changed."""
    if docs.schema["doc_id"].dataType.typeName() not in ("byte", "short", "integer", "long"):
        raise ValueError(f"doc_id must be a whole number, not {docs.schema['doc_id'].dataType.simpleString()}")
    struck = F.crc32(quoted("doc_id").cast("string").cast("binary")) % TAMPERED == 0
    one_more = quoted("n_chars").cast("decimal(20,0)") + 1
    return docs.select(
        # Null first, then by UTF-8 bytes.
        F.coalesce(F.concat(F.lit("="), quoted("lang")), F.lit("")).alias("tree"),
        quoted("doc_id").cast("long").alias("doc_id"),
        leaf_digest(quoted("n_chars")).alias("leaf"),
        F.when(struck, leaf_digest(one_more)).alias("tampered"),
    )


# ---------------------------------------------------------------------------
# Places by bitmap ranks
# ---------------------------------------------------------------------------
def word_of(doc_id: Column) -> Column:
    return F.coalesce(F.shiftright(doc_id, WORD_BITS), F.lit(NULL_WORD))


def bit_of(doc_id: Column) -> Column:
    """The id's bit in its word."""
    return shifted(1, doc_id)


def bits_below(doc_id: Column) -> Column:
    """All bits below the id's own."""
    return F.bitwise_not(shifted(-1, doc_id))


def shifted(value: int, doc_id: Column) -> Column:
    low = F.coalesce(doc_id.bitwiseAND(F.lit((1 << WORD_BITS) - 1)), F.lit(0)).cast("int")
    return F.call_function("shiftleft", F.lit(value).cast("long"), low)


def bitmap_directory(rows: DataFrame, partitions: int) -> DataFrame:
    """(tree, word, bits, before, crowded, n): the merged bitmap words with the rows before each.

    ``n`` is the tree's number of rows; ``crowded`` words hold more rows than bits.
    """
    words = stored(
        rows.groupBy("tree", word_of(F.col("doc_id")).alias("word")).agg(F.bit_or(bit_of(F.col("doc_id"))).alias("bits"), F.count(F.lit(1)).alias("held")),
        "manifest-bitmaps",
    )
    totals = stored(words.groupBy("tree").agg(F.sum("held").alias("n")), "manifest-totals")
    counted = prefix_sums(words, ["tree"], [F.col("word")], {"upto": F.col("held")}, partitions, "manifest-directory")
    return counted.join(totals, "tree").select(
        "tree", "word", "bits", (F.col("upto") - F.col("held")).alias("before"), (F.col("held") > F.bit_count("bits")).alias("crowded"), "n"
    )


def ranked(rows: DataFrame, partitions: int) -> DataFrame:
    """``rows`` (tree, doc_id, leaf, ...) with ``slot``, their place in the tree from 0, and ``n``, the tree's rows."""
    directory = stored(bitmap_directory(rows, partitions), "manifest-ranks")
    found = rows.withColumn("word", word_of(F.col("doc_id"))).join(directory, ["tree", "word"])
    below = F.bit_count(F.col("bits").bitwiseAND(bits_below(F.col("doc_id"))))
    columns = [*rows.columns, "slot", "n"]
    single = found.where(~F.col("crowded")).withColumn("slot", F.col("before") + below).select(*columns)
    if directory.where("crowded").isEmpty():
        return single
    crowded = found.where("crowded").select(*rows.columns, "word", "before", "n")
    numbered = prefix_sums(
        crowded, ["tree", "word"], [F.col("doc_id").asc_nulls_first(), F.col("leaf")], {"upto": F.lit(1)}, partitions, "manifest-repeats"
    )
    return single.unionByName(numbered.withColumn("slot", F.col("before") + F.col("upto") - 1).select(*columns))


# ---------------------------------------------------------------------------
# Slot arrays
# ---------------------------------------------------------------------------
def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def depth(n: int) -> int:
    """Levels until one of n nodes is left."""
    return max(0, n - 1).bit_length()


def array_levels(nodes: list[str], n: int) -> list[list[str]]:
    """A slot array's nodes and the levels above them, up to its own digest (``n``: nodes of the tree at its level)."""
    levels = [nodes]
    for _ in range(min(LEVELS, depth(n))):
        now = levels[-1]
        levels.append([digest("".join(now[k : k + 2])) for k in range(0, len(now), 2)])
    return levels


def steps(levels: list[list[str]], slot: int) -> list[str]:
    """What is hashed with a slot's node on its way up: ``<`` and the left sibling, ``>`` and the right one, ``=`` for none."""
    found = []
    for now in levels[:-1]:
        other = slot ^ 1
        found.append("=" if other >= len(now) else ("<" if other < slot else ">") + now[other])
        slot >>= 1
    return found


def folded(node: str, path: list[str]) -> str:
    """The root that a node and its siblings lead to."""
    for step in path:
        node = digest(node if step == "=" else step[1:] + node if step[0] == "<" else node + step[1:])
    return node


def slot_arrays(nodes: DataFrame, name: str, *carried: str) -> DataFrame:
    """(tree, slot, n, digest, carried) -> (tree, array, n, slots): one row per ``SLOTS`` places, in their order."""
    gathered = nodes.groupBy("tree", F.floor(F.col("slot") / SLOTS).cast("long").alias("array")).agg(
        F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("slot", "digest", *carried))).alias("slots")
    )
    return stored(gathered, name)


def reduced(arrays: DataFrame) -> DataFrame:
    """Slot arrays -> (tree, slot, n, digest): the nodes that they become, ``n`` of them in the tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            found = []
            for n, slots in zip(part.column("n").to_pylist(), part.column("slots"), strict=True):
                found.append((array_levels(slots.values.field("digest").to_pylist(), n)[-1][0], -(-n // SLOTS)))
            yield pa.RecordBatch.from_arrays(
                [part.column("tree"), part.column("array"), pa.array([f[1] for f in found], pa.int64()), pa.array([f[0] for f in found], pa.string())],
                ["tree", "slot", "n", "digest"],
            )

    return arrays.select("tree", "array", "n", "slots").mapInArrow(run, "tree string, slot long, n long, digest string")


def climbed(arrays: DataFrame, most: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """All rounds' slot arrays from ``arrays`` up, and the last nodes (tree, digest); ``most``: the largest tree's leaves."""
    rounds, roots = [arrays], None
    while True:
        nodes = stored(reduced(rounds[-1]), f"{name}-nodes")
        here = nodes.where("n = 1").select("tree", "digest")
        roots = here if roots is None else roots.unionByName(here)
        most = -(-most // SLOTS)
        if most <= 1:
            return rounds, roots
        rounds.append(slot_arrays(nodes.where("n > 1"), f"{name}-arrays"))


def with_path(arrays: DataFrame, above: DataFrame) -> DataFrame:
    """Slot arrays with ``path``, the siblings above their digest (``above``: tree, slot, path)."""
    return arrays.join(above.withColumnRenamed("slot", "array"), ["tree", "array"])


def descended(rounds: list[DataFrame], over_root: DataFrame, name: str) -> DataFrame:
    """``path`` for every array of the lowest round: (tree, slot, path); ``over_root``: (tree, path) above the trees' last nodes."""
    above = over_root.select("tree", F.lit(0).cast("long").alias("slot"), "path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for k, (tree, n, path) in enumerate(zip(*[part.column(c).to_pylist() for c in ("tree", "n", "path")], strict=True)):
                slots = part.column("slots")[k].values
                levels = array_levels(slots.field("digest").to_pylist(), n)
                paths = [steps(levels, i) + path for i in range(len(levels[0]))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([tree] * len(paths), pa.string()), slots.field("slot"), pa.array(paths, pa.list_(pa.string()))], ["tree", "slot", "path"]
                )

    for arrays in rounds[:0:-1]:
        # Trees that end below this round have no array in it: their last node is under `over_root` itself.
        ended = above.join(arrays.select("tree").distinct(), "tree", "left_anti")
        lower = with_path(arrays, above).select("tree", "n", "slots", "path").mapInArrow(run, "tree string, slot long, path array<string>")
        above = stored(lower.unionByName(ended), f"{name}-paths")
    return above


RESULT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def dataset_manifest(docs: DataFrame) -> DataFrame:
    """One row per document: its leaf, subroot and root, the digest of its proof, and the check of its tampered self."""
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = stored(leaves(docs), "manifest-leaves")
    placed = ranked(rows, partitions).withColumnRenamed("leaf", "digest")
    bottom = slot_arrays(placed, "manifest-slots", "doc_id", "tampered")
    most = bottom.agg(F.max("n")).first()[0]
    if most is None:
        return spark.createDataFrame([], RESULT)
    rounds, subroots = climbed(bottom, most, "manifest")
    # The tree on top: the subroots in the order of their languages.
    ordered = stored(prefix_sums(subroots, [], [F.col("tree")], {"upto": F.lit(1)}, partitions, "manifest-subroots"), "manifest-subroots-placed")
    trees = ordered.count()
    top = ordered.select(
        F.lit("").alias("tree"), (F.col("upto") - 1).alias("slot"), F.lit(trees).cast("long").alias("n"), "digest", F.col("tree").alias("name")
    )
    top_rounds, top_root = climbed(slot_arrays(top, "manifest-top", "name"), trees, "manifest-top")
    root = top_root.first()["digest"]
    nothing = spark.createDataFrame([("", [])], "tree string, path array<string>")
    top_paths = with_path(top_rounds[0], descended(top_rounds, nothing, "manifest-top"))

    def subroot_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for k, (n, path) in enumerate(zip(part.column("n").to_pylist(), part.column("path").to_pylist(), strict=True)):
                slots = part.column("slots")[k].values
                levels = array_levels(slots.field("digest").to_pylist(), n)
                paths = [steps(levels, i) + path for i in range(len(levels[0]))]
                yield pa.RecordBatch.from_arrays(
                    [slots.field("name"), pa.array(paths, pa.list_(pa.string())), slots.field("digest")], ["tree", "path", "subroot"]
                )

    over = stored(
        top_paths.select("n", "slots", "path").mapInArrow(subroot_paths, "tree string, path array<string>, subroot string"), "manifest-subroot-paths"
    )
    arrays = with_path(bottom, descended(rounds, over.select("tree", "path"), "manifest")).join(over.select("tree", "subroot"), "tree")

    def verdicts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for k, (n, path, subroot) in enumerate(zip(*[part.column(c).to_pylist() for c in ("n", "path", "subroot")], strict=True)):
                slots = part.column("slots")[k].values
                own, tampered = slots.field("digest").to_pylist(), slots.field("tampered").to_pylist()
                levels = array_levels(own, n)
                proofs, recomputed = [], []
                for i, (node, changed) in enumerate(zip(own, tampered, strict=True)):
                    way = steps(levels, i) + path
                    proofs.append(digest("".join(s[1:] for s in way)))
                    recomputed.append(folded(changed or node, way))
                size = len(own)
                yield pa.RecordBatch.from_arrays(
                    [slots.field("doc_id"), slots.field("digest"), pa.array([subroot] * size, pa.string()), pa.array([root] * size, pa.string()),
                     pa.array(proofs, pa.string()), pa.array(recomputed, pa.string()), pa.array([r == root for r in recomputed], pa.bool_())],
                    [f.split()[0] for f in RESULT.split(", ")],
                )

    return arrays.select("n", "slots", "path", "subroot").mapInArrow(verdicts, RESULT)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dataset_manifest(table(spark, sf_dir, "documents"))


# crc32 of a string's bytes, which DuckDB lacks: by its table of 256 entries (column ``t`` of ``crc``).
SQL_CRC_TABLE = """
SELECT list(c ORDER BY i) AS t FROM (
  SELECT i, list_reduce([CAST(i AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x : CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c
  FROM range(256) r(i))"""


def sql_crc32(text: str) -> str:
    return (
        f"xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(regexp_extract_all(hex(encode({text})), '..'), "
        "lambda b : CAST('0x' || b AS BIGINT))), lambda c, b : xor(t[(xor(c, b) & 255) + 1], c >> 8)))"
    )


def _sql_framed(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen({text}) || ':' || {text} END"


def _sql_leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_sql_framed(v) for v in ("doc_id", "source", "lang", n_chars, "text")) + ")"


_SQL_STEP = "CASE WHEN s.d IS NULL THEN '=' WHEN s.slot % 2 = 0 THEN '<' || s.d ELSE '>' || s.d END"
_SQL_ABOVE = "SELECT g, lvl + 1, slot // 2, sha256(string_agg(d, '' ORDER BY slot)), (any_value(n) + 1) // 2"

SQL = f"""
WITH RECURSIVE crc AS ({SQL_CRC_TABLE}),
leaves AS (
  SELECT doc_id, coalesce('=' || lang, '') AS g, {_sql_leaf('n_chars')} AS leaf,
         CASE WHEN {sql_crc32('CAST(doc_id AS VARCHAR)')} % 7 = 0 THEN {_sql_leaf('(n_chars + 1)')} END AS tampered
  FROM documents, crc),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS slot, count(*) OVER (PARTITION BY g) AS n FROM leaves),
nodes AS (
  SELECT g, 0 AS lvl, slot, leaf AS d, n FROM placed
  UNION ALL
  {_SQL_ABOVE} FROM nodes WHERE n > 1 GROUP BY g, lvl, slot // 2),
subroots AS (
  SELECT g AS name, d, row_number() OVER (ORDER BY g) - 1 AS slot, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS g, 0 AS lvl, slot, d, n FROM subroots
  UNION ALL
  {_SQL_ABOVE} FROM tops WHERE n > 1 GROUP BY g, lvl, slot // 2),
root AS (SELECT d AS root FROM tops WHERE n = 1),
heights AS (SELECT g, max(lvl) AS h FROM nodes GROUP BY g),
over_root AS (
  SELECT u.name AS g, u.d AS subroot, list({_SQL_STEP} ORDER BY l) FILTER (l IS NOT NULL) AS path
  FROM (SELECT name, d, slot, unnest(CASE WHEN n = 1 THEN [NULL] ELSE range(0, (SELECT max(lvl) FROM tops)) END) AS l FROM subroots) u
  LEFT JOIN tops s ON s.lvl = l AND s.slot = xor(u.slot >> l, 1) GROUP BY u.name, u.d),
ways AS (
  SELECT doc_id, leaf, tampered, p.g, p.slot, list({_SQL_STEP} ORDER BY l) FILTER (l IS NOT NULL) AS path
  FROM (SELECT *, unnest(CASE WHEN h = 0 THEN [NULL] ELSE range(0, h) END) AS l FROM placed JOIN heights USING (g)) p
  LEFT JOIN nodes s ON s.g = p.g AND s.lvl = l AND s.slot = xor(p.slot >> l, 1) GROUP BY ALL),
full_ways AS (
  SELECT w.*, subroot, root, list_concat(coalesce(w.path, []), coalesce(o.path, [])) AS way FROM ways w JOIN over_root o USING (g), root),
done AS (
  SELECT *, list_reduce(list_concat([coalesce(tampered, leaf)], way), lambda a, s : CASE WHEN s = '=' THEN sha256(a)
           WHEN s[1] = '<' THEN sha256(s[2:] || a) ELSE sha256(a || s[2:]) END) AS folded_root FROM full_ways)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(way, lambda s : s[2:]), '')) AS proof_sha256, folded_root,
       folded_root = root AS verified
FROM done"""
