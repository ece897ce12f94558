"""N-gram Jaccard join in size-banded tiles with bitmap signatures (operator 2).

A document's set holds its distinct 5-word shingles (64-bit hashes); with
fewer words, the whole sequence is the one element.  Two documents link when
``100 * |A & B| >= 75 * |A | B|``.  Equal sets are one class from the start
(a *node*), so copies never become pairs.

*Tiles.*  Sorted by any common order, two sets that link share one of their
first ``n - ceil(0.75 n) + 1`` elements.  A tile is one such shared element and
one size band: bands step by 1.34, so linked sets are at most one band apart,
and each set stands in the tiles of its own band and, by those elements that can
be the first one shared with a set of that size (:func:`partner_caps`), of the next.  The order is
by hash, with the elements that a bounded sample shows to be frequent last:
they are then rarely tile keys.  The sample steers only how much work there
is; every order gives the same links.  Tiles with the same smallest node are
merged, since near copies share very many elements.

*Bitmaps.*  Each set has a bitmap of 2 to 4 bits per element (its hashes'
low bits).  Bits of A that B lacks are elements of A that B lacks, so
``min(|A| - |bitsA \\ bitsB|, |B| - |bitsB \\ bitsA|)`` bounds the overlap
from above, and most pairs end there.  The rest meet their sorted arrays.

*Large groups.*  Round one compares the sets of a tile to the tile's
smallest node only (a number of pairs in proportion to the tile), if an element
of the tile can be the first one that the two share, and links
become components.  Round two compares, in each tile whose other sets are still
in several components, the pairs from different ones (a link of the smallest node
that round one left out is between other sets of the tile of its first shared element), in blocks of
two chunks of at most about ``BLOCK`` sets (the tile's largest component against the others only).
Bitmaps first name the sets of a block that may link with another component at all;
only those meet again, with their arrays, and all possible pairs are tested where the block is,
the likeliest first.  A pair is left out only if both sets are in one component already, so components are exact,
and a group of near copies costs its size, not its square.  No pairs are shuffled, and the number of steps is fixed.

*Link counts.*  The links of round one and two are enough for components
(:func:`keep_one` needs no more), but not all links.  :func:`link_counts` finds
all: every link lies inside one component, so the sets of each component meet
each other once, in blocks of two bounded chunks (only those of the same or the
next size band can link).  A block's overlaps are one matrix product, and only
a count per set leaves it, no pairs.

Defined results: null, empty and wordless texts have an empty set, link with
nothing and are their own component; rows that repeat (equal text) are one
class; a null doc_id never is the smallest unless all are null; an empty table
gives no rows; extra columns are ignored by the join and kept by
:func:`keep_one`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from storefront_etl.llm.common import (
    Words,
    as_long,
    fresh_name,
    mixed,
    per_batch,
    quoted,
    stored,
    table,
    window_hashes,
)
from storefront_etl.llm.graph import components

WIDTH = 5
SIMILARITY = 75  # percent
BAND_STEP = 1.34
# Sets of a chunk in round two, and elements, but for a few sets.
BLOCK, BLOCK_ELEMENTS, BLOCK_LEAST = 512, 1 << 20, 8
# Sample that finds frequent shingles: about this many documents; frequent from this many of them on; at most so many kept.
SAMPLE_DOCS = 4000
FREQUENT_IN = 8
FREQUENT_KEPT = 1 << 16
# Classes whose ids may be broadcast to pick their texts (8 bytes each); beyond, the texts are shuffled.
BROADCAST_IDS = 4_000_000
SALTS = 64
KEY_BITS = 48
# Link counts: a component of more sets or elements than one chunk has is cut, at first into PARTS chunks of CHUNK sets or more.
CHUNK, CHUNK_MOST, PARTS = 128, 1024, 16
CHUNK_ELEMENTS = 1 << 20
# Shingles that are columns of one matrix product.
COLUMNS = 2048


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words = Words(texts, lower=True)
    hashes = words.hashes()
    fives = window_hashes(hashes, WIDTH)
    for lo, hi in zip(words.first[:-1], words.first[1:], strict=True):
        if hi - lo >= WIDTH:
            yield np.unique(fives[lo : hi - WIDTH + 1])
        elif hi > lo:
            yield window_hashes(hashes[lo:hi], hi - lo) + np.uint64(hi - lo)
        else:
            yield hashes[:0]


def node_of(found: np.ndarray) -> int:
    """Identity of a set (never 0 for one that has elements)."""
    total = mixed(found).sum(dtype=np.uint64) ^ np.uint64(len(found) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    return int(mixed(np.array([total], dtype=np.uint64)).view(np.int64)[0]) or 1


def bitmap(found: np.ndarray) -> bytes:
    size = max(64, 1 << (2 * len(found) - 1).bit_length())
    bits = np.zeros(size, dtype=bool)
    bits[(found & np.uint64(size - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def prefix_length(n: int, similarity: int = SIMILARITY) -> int:
    return n - -(-similarity * n // 100) + 1


def partner_caps(n: int, length: int, similarity: int = SIMILARITY) -> np.ndarray:
    """For each of a set's first ``length`` elements: the largest set that it can link with if that element is the first they share.

    Behind place i are ``n - i`` elements, so a link needs ``(100 + similarity) * (n - i) >= similarity * (n + m)``.
    """
    return (100 + similarity) * (n - np.arange(length, dtype=np.int64)) // similarity - n


def folded(bits: np.ndarray, size: int) -> np.ndarray:
    """Bitmaps (rows of 64-bit words) brought to ``size`` words: hashes keep their low bits."""
    while bits.shape[-1] > size:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] | bits[..., half:]
    return bits


def overlap_bound(n: np.ndarray, m: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """From sizes and bitmaps (last axis): the most elements that the sets can share."""
    return np.minimum(
        n - np.bitwise_count(a & ~b).sum(axis=-1, dtype=np.int64), m - np.bitwise_count(b & ~a).sum(axis=-1, dtype=np.int64)
    )


def may_link(n: np.ndarray, m: np.ndarray, a: np.ndarray, b: np.ndarray, similarity: int = SIMILARITY) -> np.ndarray:
    """Can the sets overlap enough?"""
    size = min(a.shape[-1], b.shape[-1])
    return links(n, m, overlap_bound(n, m, folded(a, size), folded(b, size)), similarity)


def links(n, m, overlap, similarity: int = SIMILARITY):
    return 100 * overlap >= similarity * (n + m - overlap)


def document_sets(docs: DataFrame) -> DataFrame:
    """(row, doc_id, n, node, bits, content) of every document; ``row`` is equal for equal (doc_id, text), ``content`` for equal texts."""

    def sets(part: pa.RecordBatch) -> pa.RecordBatch:
        sizes, nodes, bits = [], [], []
        for found in shingle_sets(part.column("text")):
            sizes.append(len(found))
            nodes.append(node_of(found) if len(found) else 0)
            bits.append(bitmap(found) if len(found) else None)
        return pa.RecordBatch.from_arrays(
            [part.column("row"), part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.array(bits, pa.binary()),
             part.column("content")],
            ["row", "doc_id", "n", "node", "bits", "content"],
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    read = docs.select(row_key().alias("row"), "doc_id", "text", F.xxhash64("text").alias("content"))
    return per_batch(read, "text", sets, f"row long, doc_id {kind}, n long, node long, bits binary, content long")


def row_key() -> Column:
    return F.xxhash64(F.col("text"), F.col("doc_id"))


def frequent_shingles(docs: DataFrame, n_docs: int) -> np.ndarray:
    """Shingles that a bounded sample of documents shows often (they only go last in the order)."""
    every = max(1, n_docs // SAMPLE_DOCS)

    def shingles(part: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([as_long(np.concatenate([np.zeros(0, np.uint64), *shingle_sets(part.column("text"))]))], ["shingle"])

    sample = docs.where(F.pmod(F.xxhash64(F.col("text")), F.lit(every)) == 0).select("text").distinct()
    often = (
        per_batch(sample, "text", shingles, "shingle long").groupBy("shingle").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") >= FREQUENT_IN)
        .orderBy(F.col("c").desc(), "shingle").limit(FREQUENT_KEPT).select("shingle").collect()
    )
    return np.sort(np.array([r[0] for r in often], dtype=np.int64).view(np.uint64))


def postings(docs: DataFrame, frequent: np.ndarray, similarity: int) -> DataFrame:
    """(key, salt, node, size): the first elements of every set in the common order, each set once per task.

    ``size`` holds the set's size and, from bit 32 on, the element's :func:`partner_caps`.
    """
    seen: set[int] = set()

    def post(part: pa.RecordBatch) -> pa.RecordBatch:
        keys, salts, nodes = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        sizes = [np.zeros(0, np.int64)]
        for found in shingle_sets(part.column("text")):
            if not len(found):
                continue
            node = node_of(found)
            if node in seen:
                continue
            seen.add(node)
            length = prefix_length(len(found), similarity)
            often = np.isin(found, frequent, assume_unique=True) if len(frequent) else np.zeros(len(found), dtype=bool)
            # 0 for keys that are few; a frequent key's tiles are built in SALTS parts first.
            chosen, salt = found[~often][:length], np.zeros(length, dtype=np.int32)
            if len(chosen) < length:
                salt[len(chosen) :] = 1 + node % SALTS
                chosen = np.concatenate([chosen, found[often][: length - len(chosen)]])
            keys.append((chosen >> np.uint64(64 - KEY_BITS)).astype(np.int64))
            salts.append(salt)
            nodes.append(np.full(length, node, dtype=np.int64))
            sizes.append(partner_caps(len(found), length, similarity) << 32 | len(found))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (keys, salts, nodes, sizes)], ["key", "salt", "node", "size"])

    return per_batch(docs.select("text"), "text", post, "key long, salt int, node long, size long")


def attach_bits(pairs: DataFrame, nodes: DataFrame, side: str) -> DataFrame:
    other = nodes.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("bits").alias(f"bits_{side}"))
    return pairs.join(other, side)


def bounded(pairs: DataFrame, nodes: DataFrame, similarity: int) -> DataFrame:
    """The (a, b) pairs whose bitmaps leave a link possible."""
    both = attach_bits(attach_bits(pairs, nodes, "b"), nodes, "a")
    both = both.where((F.lit(100) * F.least("n_a", "n_b")) >= F.lit(similarity) * F.greatest("n_a", "n_b"))

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            n, m = part.column("n_a").to_numpy(), part.column("n_b").to_numpy()
            keep = np.zeros(part.num_rows, dtype=bool)
            for i, (x, y) in enumerate(zip(part.column("bits_a"), part.column("bits_b"), strict=True)):
                keep[i] = may_link(n[i], m[i], np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), similarity)
            yield part.select(["a", "b"]).filter(pa.array(keep))

    return both.select("a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(test, "a long, b long")


def sorted_arrays(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, shingles) of the wanted nodes, from one text of each (``wanted``: node, row)."""

    def arrays(part: pa.RecordBatch) -> pa.RecordBatch:
        found = list(shingle_sets(part.column("text")))
        return pa.RecordBatch.from_arrays(
            [part.column("node"), pa.array([x.tobytes() for x in found], pa.binary())], ["node", "shingles"]
        )

    few = wanted.count() <= BROADCAST_IDS
    texts = docs.select(row_key().alias("row"), "text").join(F.broadcast(wanted) if few else wanted, "row")
    return per_batch(texts, "text", arrays, "node long, shingles binary").dropDuplicates(["node"])


def arrays_of(ids: DataFrame, docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """:func:`sorted_arrays` of these nodes, stored."""
    return stored(sorted_arrays(docs, stored(nodes.select("node", "row").join(ids.distinct(), "node"), "jaccard-wanted")), "jaccard-arrays")


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """How many elements two sorted arrays have in common."""
    both = np.sort(np.concatenate([a, b]), kind="stable")
    return int((both[1:] == both[:-1]).sum())


def verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, similarity: int) -> DataFrame:
    """The stored (a, b) pairs that link, by exact intersection of their sorted arrays."""
    found = arrays_of(pairs.select(F.explode(F.array("a", "b")).alias("node")), docs, nodes)
    # b first: a set is b in few pairs, but may be a in very many.
    sides = pairs.join(found.select(F.col("node").alias("b"), F.col("shingles").alias("set_b")), "b").join(
        found.select(F.col("node").alias("a"), F.col("shingles").alias("set_a")), "a"
    )

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            keep = np.zeros(part.num_rows, dtype=bool)
            for i, (x, y) in enumerate(zip(part.column("set_a"), part.column("set_b"), strict=True)):
                a, b = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                keep[i] = links(len(a), len(b), shared(a, b), similarity)
            yield part.select(["a", "b"]).filter(pa.array(keep))

    return stored(sides.select("a", "b", "set_a", "set_b").mapInArrow(test, "a long, b long"), "jaccard-verified")


def same_block(group: dict[str, np.ndarray], similarity: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each place of a block's rows, which rise by (n, node): the places behind it of the sets that it may link with, and how near they seem.

    A block's rows are one chunk of a tile against itself, or two chunks
    (sides 0 and 1).  Only sets of different ``start`` components are paired.
    """
    start, n, bits, side = (group[c] for c in ("start", "n", "bits", "side"))
    one_chunk = bool((side == 0).all())
    lengths = np.array([len(x) for x in bits])
    maps = {}  # by size: places and bitmaps
    for size in np.unique(lengths):
        mine = np.flatnonzero(lengths == size)
        maps[int(size)] = mine, np.stack([np.frombuffer(bits[k], np.uint64) for k in mine])
    for size, (mine, a) in maps.items():
        for p, k in enumerate(mine):
            for other in (size, 2 * size):
                if other not in maps:
                    continue
                theirs, b = maps[other]
                # Sizes rise, so the partners that can link at all are a run.
                hi = np.searchsorted(n[theirs], n[k] * 100 // similarity, side="right")
                lo = np.searchsorted(theirs, k, side="right")
                if lo >= hi:
                    continue
                run = theirs[lo:hi]
                fit = start[run] != start[k]
                if not one_chunk:
                    fit &= side[run] != side[k]
                if not fit.any():
                    continue
                run = run[fit]
                bound = overlap_bound(n[k], n[run], a[p], folded(b[lo:hi][fit], size // 8))
                may = links(n[k], n[run], bound, similarity)
                if may.any():
                    yield k, run[may], (bound / (n[k] + n[run]))[may]


def per_block(rows: DataFrame, columns: list[str], f: Callable[[dict[str, np.ndarray]], dict[str, np.ndarray]], schema: str) -> DataFrame:
    """``f`` over each block of several components; rows are sorted by block in each partition, and within a block by (n, node) here."""
    binary = {c for c in columns if rows.schema[c].dataType.typeName() == "binary"}
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = {c: np.zeros(0, object if c in binary else np.int64) for c in columns}

        def groups(batch: dict[str, np.ndarray], final: bool) -> Iterator[dict[str, np.ndarray]]:
            nonlocal rest
            batch = {c: np.concatenate([rest[c], batch[c]]) for c in columns}
            change = np.flatnonzero(batch["block"][1:] != batch["block"][:-1]) + 1
            edges = [0, *change.tolist(), len(batch["block"])]
            rest = {c: batch[c][len(batch["block"]) if final else edges[-2] :] for c in columns}
            for lo, hi in zip(edges[:-1], edges[1:] if final else edges[1:-1], strict=False):
                order = lo + np.lexsort((batch["node"][lo:hi], batch["n"][lo:hi]))
                if (batch["start"][lo:hi] != batch["start"][lo]).any():
                    yield {c: batch[c][order] for c in columns}

        def answer(parts: Iterator[dict[str, np.ndarray]]) -> Iterator[pa.RecordBatch]:
            for out in map(f, parts):
                yield pa.RecordBatch.from_arrays([pa.array(out[c], pa.binary() if c in binary else pa.int64()) for c in names], names)

        for part in batches:
            yield from answer(groups({c: part.column(c).to_numpy(zero_copy_only=False) for c in columns}, False))
        if len(rest["block"]):
            yield from answer(groups({c: rest[c][:0] for c in columns}, True))

    return rows.select(*columns).mapInArrow(run, schema)


def block_candidates(rows: DataFrame, similarity: int) -> DataFrame:
    """Of the rows of :func:`tile_blocks`, sorted by block in each partition, those whose bitmaps allow a link with another component in their block."""

    def candidates(group: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        keep = np.zeros(len(group["node"]), dtype=bool)
        for k, run, _ in same_block(group, similarity):
            keep[k] = keep[run] = True
        return {c: v[keep] for c, v in group.items()}

    columns = ["block", "side", "node", "start", "n", "bits"]
    return per_block(rows, columns, candidates, "block long, side long, node long, start long, n long, bits binary")


def block_links(rows: DataFrame, similarity: int) -> DataFrame:
    """Rows of :func:`block_candidates` with ``shingles`` -> (a, b, start_a, start_b): links that join all components which a block's links join.

    A pair is left out only if links of this block have joined its components
    already; the likeliest pairs are tested first, so a block gives fewer
    links than it has sets, and near copies cost few tests.
    """

    def joins(group: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        found = [(np.full(len(run), k), run, near) for k, run, near in same_block(group, similarity)]
        out = []
        if found:
            left, right, near = (np.concatenate(x) for x in zip(*found, strict=True))
            _, label = np.unique(group["start"], return_inverse=True)
            sets = [np.frombuffer(x, np.uint64) for x in group["shingles"]]
            for i in np.lexsort((right, left, -near)):
                a, b = left[i], right[i]
                if label[a] != label[b] and links(len(sets[a]), len(sets[b]), shared(sets[a], sets[b]), similarity):
                    label[label == label[a]] = label[b]
                    out.append((a, b))
        a, b = np.array(out, dtype=np.int64).reshape(-1, 2).T
        return {"a": group["node"][a], "b": group["node"][b], "start_a": group["start"][a], "start_b": group["start"][b]}

    columns = ["block", "side", "node", "start", "n", "bits", "shingles"]
    return per_block(rows, columns, joins, "a long, b long, start_a long, start_b long")


def set_links(docs: DataFrame, sets: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """(a, b): links between nodes that join all that belong together."""
    return set_roots(docs, sets, similarity)[0]


def set_roots(docs: DataFrame, sets: DataFrame, similarity: int = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """:func:`set_links`, and their components as (node, root)."""
    filled = sets.where("n > 0")
    nodes = stored(
        filled.groupBy("node").agg(F.max("n").alias("n"), F.min("row").alias("row"), F.max("bits").alias("bits")), "jaccard-nodes"
    )
    frequent = frequent_shingles(docs, nodes.count())
    posts = postings(docs, frequent, similarity)
    part, tile = Window.partitionBy("key", "salt"), Window.partitionBy("key", "salt", "band")
    shared = (
        posts.withColumn("lo", F.min("node").over(part)).withColumn("hi", F.max("node").over(part))
        .where("lo < hi or salt > 0").select("key", "salt", "node", "size").distinct()
    )
    # In the next band's tiles an element counts only if it can be the first one shared with a set of that band.
    own, most = band_of(set_size("size")), band_of(partner_cap("size"))
    banded = shared.select("*", F.explode(F.when(most > own, F.array(own, own + 1)).otherwise(F.array(own))).alias("band"))
    # All of a key that is not salted is in one task already, so its tiles need no further shuffle.
    tiled = stored(
        banded.withColumn("lead", F.min(F.struct("node", "size")).over(tile)).withColumn("hi", F.max("node").over(tile))
        .where("lead.node < hi or salt > 0")
        .select(F.when(F.col("salt") > 0, F.col("key")).alias("key"), "band", "node", "size", F.col("lead.node").alias("leader"), F.col("lead.size").alias("lead_size")),
        "jaccard-tiles",
    )
    salted = tiled.where("key is not null").select("key", "band", "node", "size")
    leaders = salted.groupBy("key", "band").agg(F.min(F.struct("node", "size")).alias("lead"), F.max("node").alias("hi")).where("lead.node < hi").select(
        "key", "band", F.col("lead.node").alias("leader"), F.col("lead.size").alias("lead_size")
    )
    near = (set_size("size") <= partner_cap("lead_size")) & (set_size("lead_size") <= partner_cap("size"))
    columns = ["leader", "band", "node", near.alias("near")]
    # Tiles are merged by their smallest node: near copies share many keys, and mostly that node.
    tiles = stored(
        tiled.where("key is null").select(*columns).unionByName(salted.join(leaders, ["key", "band"]).select(*columns))
        .groupBy("leader", "band", "node").agg(F.max("near").alias("near")).withColumn("tile", F.xxhash64("leader", "band")),
        "jaccard-members",
    )
    # A leader meets the sets that a tile's element can be the first one shared with: any other link of it has an
    # earlier element, whose tile has this leader too, or a smaller one, and then round two compares the pair.
    star = tiles.where("node <> leader and near").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    found = verified(stored(bounded(star, nodes, similarity), "jaccard-bounded"), docs, nodes, similarity)
    roots = stored(components(found), "jaccard-roots")
    # Round two: tiles that still hold several components.  Their leaders need not be met again.
    rows = stored(tile_blocks(tiles.where("node <> leader").join(roots, "node", "left").withColumn("start", F.coalesce("root", "node")).drop("root"), nodes), "jaccard-rows")
    n_parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def by_block(df: DataFrame) -> DataFrame:
        return df.repartition(n_parts, "block").sortWithinPartitions("block")

    candidates = stored(block_candidates(by_block(rows), similarity), "jaccard-blocks")
    if candidates.isEmpty():
        return found, roots
    arrays = arrays_of(candidates.select("node"), docs, nodes)
    new = stored(block_links(by_block(candidates.join(arrays, "node")), similarity), "jaccard-links")
    if new.isEmpty():
        return found, roots
    # The components of round one that round two joins; a root's row is in both tables, and then the same.
    moved = stored(components(new.select(F.col("start_a").alias("a"), F.col("start_b").alias("b"))), "jaccard-moved")
    last = moved.select(F.col("node").alias("root"), F.col("root").alias("last"))
    roots = roots.join(last, "root", "left").select("node", F.coalesce("last", "root").alias("root")).unionByName(moved).distinct()
    return found.unionByName(new.select("a", "b")), stored(roots, "jaccard-roots")


def set_size(size: str) -> Column:
    return F.col(size).bitwiseAND(F.lit(0xFFFFFFFF))


def partner_cap(size: str) -> Column:
    return F.shiftright(size, 32)


def band_of(n: Column) -> Column:
    """Size band: bands step by ``BAND_STEP``."""
    return F.floor(F.log(F.greatest(n, F.lit(1))) / F.lit(float(np.log(BAND_STEP)))).cast("int")


def tile_blocks(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """(tile, band, node, start) -> rows (block, side, node, start, n, bits) of the pairs of chunks to compare.

    Only tiles with several components count.  A tile's largest component
    needs no comparison with itself: its chunks meet only those of the other
    components, which meet all.
    """
    sizes = members.groupBy("tile", "band", "start").agg(F.count(F.lit(1)).alias("size"))
    # A tile's sets are of its band or the one below.
    chunk_sets = F.least(F.lit(BLOCK), F.greatest(F.lit(BLOCK_LEAST), F.floor(BLOCK_ELEMENTS / F.pow(F.lit(BAND_STEP), F.col("band") + 1))))
    mixed_tiles = sizes.groupBy("tile", "band").agg(
        F.max(F.struct("size", "start")).alias("bulk"), F.sum("size").alias("all"), F.count(F.lit(1)).alias("parts")
    ).where("parts > 1").select(
        "tile", F.col("bulk.start").alias("bulk"),
        F.ceil((F.col("all") - F.col("bulk.size")) / chunk_sets).alias("others"), F.ceil(F.col("bulk.size") / chunk_sets).alias("bulks"),
    )
    chunk = F.xxhash64("node", "tile")
    is_bulk = F.col("start") == F.col("bulk")
    placed = members.join(mixed_tiles, "tile").withColumn(
        "chunk", F.when(is_bulk, F.col("others") + F.pmod(chunk, "bulks")).otherwise(F.pmod(chunk, "others"))
    )
    # Chunk c meets chunk m as first side if c <= m, as second else.
    meets = F.sequence(F.lit(0).cast("long"), F.when(is_bulk, F.col("others") - 1).otherwise(F.col("others") + F.col("bulks") - 1))
    paired = placed.select("*", F.explode(meets).alias("meets"))
    return paired.select(
        F.xxhash64("tile", F.least("chunk", "meets"), F.greatest("chunk", "meets")).alias("block"),
        F.when(F.col("chunk") <= F.col("meets"), 0).otherwise(1).cast("long").alias("side"), "node", "start",
    ).join(nodes.select("node", "n", "bits"), "node")


def overlaps(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Shared elements of every set in ``left`` (indices) with every one in ``right``, by products of 0/1 matrices."""
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, column, copies = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    # An element of one set only is in no overlap.
    shared = copies[column] > 1
    owner, column = owner[shared], (np.cumsum(copies > 1) - 1)[column[shared]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(left), len(right)), dtype=np.int64)
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, [lo, lo + COLUMNS])
        part = np.zeros((len(sets), COLUMNS), dtype=np.float32)
        part[owner[a:b], column[a:b] - lo] = 1
        out += (part[left] @ part[right].T).astype(np.int64)  # at most COLUMNS, so exact
    return out


def block_counts(sets: list[np.ndarray], texts: np.ndarray, side: np.ndarray, alone: bool, similarity: int) -> np.ndarray:
    """Per set of a block, the texts of the sets that it links with: all others (``alone``), or those of the other side."""
    left = np.arange(len(sets)) if alone else np.flatnonzero(side == 0)
    right = left if alone else np.flatnonzero(side == 1)
    counts = np.zeros(len(sets), dtype=np.int64)
    if not len(left) or not len(right):
        return counts
    n = np.array([len(x) for x in sets], dtype=np.int64)
    linked = links(n[left][:, None], n[right][None, :], overlaps(sets, left, right), similarity)
    if alone:
        np.fill_diagonal(linked, False)
        return linked @ texts
    counts[left], counts[right] = linked @ texts[right], linked.T @ texts[left]
    return counts


def link_blocks(members: DataFrame) -> DataFrame:
    """(root, node, n, ...) -> the rows once for each ``block`` they are compared in, with ``side`` and ``alone``.

    A component that fits in one chunk is one block.  A larger one is cut by
    size band and hash: a chunk meets itself, the others of its band and those
    of the next one, each pair of chunks in one block.
    """
    size = [F.count(F.lit(1)).alias("sets"), F.sum("n").alias("elements")]
    large = members.groupBy("root").agg(*size).where((F.col("sets") > CHUNK) | (F.col("elements") > CHUNK_ELEMENTS)).select("root")
    # Each large component has over CHUNK sets or CHUNK_ELEMENTS elements, so there are few of them.
    large = stored(large, "jaccard-large")
    few = large.count() <= BROADCAST_IDS
    # The band of a size: a link's larger set has at most 4/3 of the smaller one's elements, and is at most one band up.
    banded = members.withColumn("band", band_of(F.col("n")))
    bands = banded.join(F.broadcast(large) if few else large, "root").groupBy("root", "band").agg(*size).select(
        "root", "band",
        F.greatest(
            F.ceil(F.col("sets") / CHUNK_MOST), F.least(F.lit(PARTS), F.ceil(F.col("sets") / CHUNK)), F.ceil(F.col("elements") / CHUNK_ELEMENTS)
        ).cast("long").alias("chunks"),
    )
    cuts = stored(bands.groupBy("root").agg(F.map_from_entries(F.collect_list(F.struct("band", "chunks"))).alias("cuts")), "jaccard-cuts")
    placed = banded.join(F.broadcast(cuts) if few else cuts, "root", "left")

    def chunks(step: int) -> Column:
        return F.coalesce(F.try_element_at("cuts", F.col("band") + step), F.lit(0).cast("long"))

    def upto(n: Column) -> Column:
        return F.when(n > 0, F.sequence(F.lit(0).cast("long"), F.greatest(n, F.lit(1)) - 1)).otherwise(F.array().cast("array<bigint>"))

    def block(band: Column, kind: int, a: Column, b: Column, side: Column, alone: Column) -> Column:
        return F.struct(
            F.xxhash64("root", band, F.lit(kind), a, b).alias("block"), side.cast("int").alias("side"), alone.alias("alone")
        )

    placed = placed.withColumn("chunk", F.pmod(F.xxhash64("node", "root"), F.greatest(chunks(0), F.lit(1).cast("long"))))
    chunk, band, no = F.col("chunk"), F.col("band"), F.lit(False)
    zero = F.lit(0).cast("long")
    whole = F.array(block(F.lit(0), 0, zero, zero, zero, F.lit(True)))
    same = F.transform(upto(chunks(0)), lambda m: block(band, 1, F.least(chunk, m), F.greatest(chunk, m), F.when(chunk > m, 1).otherwise(0), chunk == m))
    up = F.transform(upto(chunks(1)), lambda m: block(band, 2, chunk, m, F.lit(0), no))
    down = F.transform(upto(chunks(-1)), lambda m: block(band - 1, 2, m, chunk, F.lit(1), no))
    meets = F.when(F.col("cuts").isNull(), whole).otherwise(F.concat(same, up, down))
    return placed.select(*members.columns, F.explode(meets).alias("meets")).select(*members.columns, "meets.*")


def link_counts(docs: DataFrame, sets: DataFrame, roots: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """(node, links): how many texts of other sets each node links with, for every node in a component of several (exact)."""
    wanted = stored(
        sets.where("n > 0").groupBy("node").agg(F.max("n").alias("n"), F.min("row").alias("row")).join(roots, "node"), "jaccard-linked"
    )
    texts = sets.where("n > 0").select("node", "content").distinct().groupBy("node").agg(F.count(F.lit(1)).alias("texts"))
    members = wanted.select("node", "root", "n").join(texts, "node").join(sorted_arrays(docs, wanted.select("node", "row")), "node")
    blocks = link_blocks(stored(members.select("root", "node", "n", "texts", "shingles"), "jaccard-members-sets"))

    def count(group: pa.Table) -> pa.Table:
        found = [np.frombuffer(x.as_buffer(), np.uint64) for x in group.column("shingles")]
        texts, side = group.column("texts").to_numpy(), group.column("side").to_numpy()
        counts = block_counts(found, texts, side, group.column("alone")[0].as_py(), similarity)
        return pa.table({"node": group.column("node"), "links": pa.array(counts)})

    counted = blocks.select("block", "side", "alone", "node", "texts", "shingles").groupBy("block").applyInArrow(count, "node long, links long")
    return counted.groupBy("node").agg(F.sum("links").alias("links"))


def component_rows(sets: DataFrame, roots: DataFrame) -> DataFrame:
    """(row, doc_id, n_shingles, node, root, component_id): one row per document."""
    smallest = sets.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("least"))
    classes = stored(smallest.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "least"), "jaccard-classes")
    named = classes.join(classes.groupBy("root").agg(F.min("least").alias("component_id")), "root").drop("least")
    return sets.drop("bits", "content").join(named, "node", "left").select(
        "row", "doc_id", F.col("n").alias("n_shingles"), "node", F.coalesce("root", F.lit(0)).alias("root"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def jaccard_components(docs: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """(row, doc_id, n_shingles, node, root, component_id, links): one row per document.

    ``links`` is the number of other different texts that the document's text
    links with, equal sets included (0 without words).
    """
    sets = stored(document_sets(docs), "jaccard-sets")
    roots = set_roots(docs, sets, similarity)[1]
    others = link_counts(docs, sets, roots, similarity)
    own = sets.where("n > 0").select("node", "content").distinct().groupBy("node").agg((F.count(F.lit(1)) - 1).alias("own"))
    degree = stored(
        own.join(others, "node", "left").select("node", (F.col("own") + F.coalesce("links", F.lit(0))).alias("links")).where("links > 0"),
        "jaccard-degree",
    )
    rows = component_rows(sets, roots)
    return rows.join(degree, "node", "left").select(*rows.columns, F.coalesce("links", F.lit(0)).cast("long").alias("links"))


def keep_one(docs: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """``docs`` with one document of each component: the smallest doc_id; documents without words all stay."""
    row, place = fresh_name(docs.columns, "jaccard_row"), fresh_name(docs.columns, "jaccard_place")
    sets = stored(document_sets(docs), "jaccard-sets")
    found = stored(component_rows(sets, set_roots(docs, sets, similarity)[1]), "jaccard-documents")
    filled = found.where("n_shingles > 0")
    best = filled.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("best"))
    stay = best.select(F.col("best.row").alias(row), F.lit(True).alias(place)).unionByName(
        found.where("n_shingles = 0").select(F.col("row").alias(row), F.lit(False).alias(place)).distinct()
    )
    kept = docs.withColumn(row, row_key()).join(stay, row)
    # Rows equal in id and text are one document here; of those, one stays.
    number = F.row_number().over(Window.partitionBy(row).orderBy(row))
    return kept.withColumn(place, F.when(F.col(place), number).otherwise(F.lit(1))).where(F.col(place) == 1).select(*[quoted(c) for c in docs.columns])


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "links")
