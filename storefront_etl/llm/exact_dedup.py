"""Exact dedup by Patricia-trie owners (operator 8).

Texts are equal when they are identical after lower-casing A-Z.  Every task
first merges its own equal texts (so a group of copies that holds a third of
all rows reaches the shuffle as one row per task), then the distinct texts go
to partitions by length and content hash.  A partition inserts the full byte
strings into compressed radix tries; a terminal node stores the identifier of
the row that owns the text and the number of rows.  A trie that outgrows its
budget spills its largest subtree: those texts leave the task as rows, are
written to the shared folder, and meet in a later round with more partitions
and another hash.  So a task's memory is bounded and no local file is needed.

The owner is the largest doc_id (``keep="largest"``, as the query asks) or the
smallest.  Owners join back to the documents by the text's SHA-256, one row
per text on their side, so Spark may split a hot text's documents.

Defined results: null counts as the empty text (equal to other empty ones); a
null doc_id never owns unless all are null; of rows that repeat with the same
id and text exactly one is kept; an empty table gives no rows; extra columns
are ignored by the query and kept by :func:`drop_copies`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from storefront_etl.llm.common import LOWER_AZ, fresh_name, per_batch, quoted, slices, stored, table

# Bytes of text that a task's trie may hold, and that a round aims at per partition.
TRIE_BYTES = 64 << 20
PARTITION_BYTES = 24 << 20
# Bytes of distinct texts that a task merges before it sends them on.
MERGE_BYTES = 16 << 20
ROUNDS = 30


def normalised(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").translate(LOWER_AZ)


class Node:
    """An edge label, children by first byte, and (owner, rows) if a text ends here."""

    __slots__ = ("label", "children", "owner", "rows", "digest")

    def __init__(self, label: bytes):
        self.label, self.children, self.owner, self.rows, self.digest = label, None, None, 0, None


def common_length(a: bytes, b: bytes) -> int:
    """Length of the common prefix (halving, so that long labels compare in C)."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


class Trie:
    """Compressed radix trie of byte strings that keeps the better owner of each."""

    def __init__(self, largest: bool):
        self.root, self.bytes, self.largest = Node(b""), 0, largest

    def insert(self, text: bytes, owner: int | None, rows: int, digest: str) -> None:
        node, at = self.root, 0
        while at < len(text):
            child = node.children.get(text[at]) if node.children else None
            if child is None:
                child = Node(text[at:])
                if node.children is None:
                    node.children = {}
                node.children[text[at]] = child
                self.bytes += len(child.label) + 150
                node, at = child, len(text)
                break
            label = child.label
            if text.startswith(label, at):
                node, at = child, at + len(label)
                continue
            same = common_length(label, text[at : at + len(label)])
            upper = Node(label[:same])
            child.label = label[same:]
            upper.children = {child.label[0]: child}
            node.children[text[at]] = upper
            self.bytes += 150
            node, at = upper, at + same
        if node.rows == 0 or (owner is not None and (node.owner is None or (owner > node.owner) == self.largest)):
            node.owner = owner
        node.rows += rows
        node.digest = digest

    @staticmethod
    def texts(top: Node, before: bytes) -> Iterator[tuple[bytes, Node]]:
        stack = [(top, before)]
        while stack:
            node, prefix = stack.pop()
            whole = prefix + node.label
            if node.rows:
                yield whole, node
            if node.children:
                stack.extend((child, whole) for child in node.children.values())

    def branching(self) -> tuple[Node, bytes]:
        """The first node below which texts part (or end), and the bytes before its label."""
        node, before = self.root, b""
        while node.children and len(node.children) == 1 and not node.rows:
            before += node.label
            node = next(iter(node.children.values()))
        return node, before

    def spill(self) -> Iterator[tuple[bytes, Node]] | None:
        """Cuts off the largest subtree where texts part and gives its texts; None if there is one text only."""
        node, before = self.branching()
        if not node.children:
            return None
        sizes = {first: sum(len(n.label) + 150 for n in self.nodes(child)) for first, child in node.children.items()}
        first = max(sizes, key=lambda k: (sizes[k], k))
        top = node.children.pop(first)
        self.bytes -= sizes[first]
        return self.texts(top, before + node.label)

    @staticmethod
    def nodes(top: Node) -> Iterator[Node]:
        stack = [top]
        while stack:
            node = stack.pop()
            yield node
            if node.children:
                stack.extend(node.children.values())


def merged_texts(docs: DataFrame, largest: bool) -> DataFrame:
    """(length, digest, content, owner, rows): each task's distinct texts, merged as far as memory allows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine: dict[str, list] = {}
        held = 0

        def out() -> pa.RecordBatch:
            rows = [(len(t), d, t, o, n) for d, (t, o, n) in mine.items()]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            kinds = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["length", "digest", "content", "owner", "rows"])

        for batch in batches:
            for part in slices(batch, "text"):
                for text, owner in zip(part.column("text").to_pylist(), part.column("doc_id").to_pylist(), strict=True):
                    content = normalised(text)
                    digest = hashlib.sha256(content).hexdigest()
                    have = mine.get(digest)
                    if have is None:
                        mine[digest] = [content, owner, 1]
                        held += len(content) + 300
                    else:
                        have[1] = better(have[1], owner, largest)
                        have[2] += 1
                if held > MERGE_BYTES:
                    yield out()
                    mine.clear()
                    held = 0
        yield out()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "length long, digest string, content binary, owner long, rows long")


def better(a: int | None, b: int | None, largest: bool) -> int | None:
    if a is None or b is None:
        return b if a is None else a
    return max(a, b) if largest else min(a, b)


def grown(texts: DataFrame, largest: bool, trie_bytes: int) -> DataFrame:
    """Texts of one round -> (length, digest, owner, rows, content): content only where the subtree was spilled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(largest)
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
        names = ["length", "digest", "owner", "rows", "content"]

        def chunks(found: Iterator[tuple[bytes, Node]], spilled: bool) -> Iterator[pa.RecordBatch]:
            rows: list[tuple] = []
            size = 0
            for whole, node in found:
                rows.append((len(whole), node.digest, node.owner, node.rows, whole if spilled else None))
                size += len(whole) if spilled else 100
                if size > 1 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        for part in batches:
            for content, owner, n, digest in zip(*[part.column(c).to_pylist() for c in ("content", "owner", "rows", "digest")], strict=True):
                trie.insert(content, owner, n, digest)
                while trie.bytes > trie_bytes and (cut := trie.spill()) is not None:
                    yield from chunks(cut, True)
        yield from chunks(Trie.texts(trie.root, b""), False)

    return texts.select("content", "owner", "rows", "digest").mapInArrow(run, "length long, digest string, owner long, rows long, content binary")


def text_owners(docs: DataFrame, largest: bool = True, trie_bytes: int = TRIE_BYTES, partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """(digest, keep_id, group_size): one row per distinct text."""
    texts = merged_texts(docs, largest)
    total = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    done, open_rows = [], texts
    for turn in range(ROUNDS):
        parts = max(least, -(-total // partition_bytes)) << min(turn, 10)
        # Another hash each round: subtrees that were too large together need not meet again.
        home = F.pmod(F.xxhash64(F.lit(turn), "length", "digest"), F.lit(parts))
        result = stored(grown(open_rows.repartition(parts, home), largest, trie_bytes), "trie-round")
        done.append(result.where("content is null").select("digest", "owner", "rows"))
        spilled = result.where("content is not null")
        total = spilled.agg(F.sum(F.octet_length("content").cast("long"))).first()[0]
        if total is None:
            break
        # A text that is spilled more than once by a task was met again after its subtree had left.
        open_rows = spilled.select("length", "digest", "content", "owner", "rows")
    else:
        raise RuntimeError(f"subtrees were still spilled after {ROUNDS} rounds")
    owners = done[0]
    for more in done[1:]:
        owners = owners.unionByName(more)
    if len(done) > 1:
        # A text may be settled in one round and, met after its subtree had left, again in another.
        owners = owners.groupBy("digest").agg((F.max if largest else F.min)("owner").alias("owner"), F.sum("rows").alias("rows"))
        owners = stored(owners, "trie-owners")  # else a join with it could not split a text that very many rows have
    return owners.select("digest", F.col("owner").alias("keep_id"), F.col("rows").alias("group_size"))


def document_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, text_sha256) of every row: the digest of the normalised text."""

    def digests(part: pa.RecordBatch) -> pa.RecordBatch:
        found = [hashlib.sha256(normalised(t)).hexdigest() for t in part.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found, pa.string())], ["doc_id", "text_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return per_batch(docs.select("doc_id", "text"), "text", digests, f"doc_id {kind}, text_sha256 string")


def exact_groups(docs: DataFrame, largest: bool = True, **options) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256): one row per document."""
    owners = text_owners(docs, largest, **options)
    rows = document_digests(docs).join(owners.withColumnRenamed("digest", "text_sha256"), "text_sha256")
    number = F.row_number().over(Window.partitionBy("text_sha256", "doc_id").orderBy("doc_id"))
    owns = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    # Only owners are numbered: the rows of one text with one id.
    kept = rows.where(owns).withColumn("kept", number == 1)
    return kept.unionByName(rows.where(~owns).withColumn("kept", F.lit(False))).select(
        "doc_id", F.col("keep_id").cast(docs.schema["doc_id"].dataType), "group_size", "kept", "text_sha256"
    )


def lower_az(text: Column) -> Column:
    """A-Z lower-cased, all other characters as they are; null is empty."""
    upper = "".join(map(chr, range(65, 91)))
    return F.translate(F.coalesce(text, F.lit("")), upper, upper.lower())


def drop_copies(docs: DataFrame, largest: bool = True, **options) -> DataFrame:
    """``docs`` without the rows that another row owns."""
    digest, place = fresh_name(docs.columns, "dedup_digest"), fresh_name(docs.columns, "dedup_place")
    owners = text_owners(docs, largest, **options).select(F.col("digest").alias(digest), F.col("keep_id").alias(place))
    mine = docs.withColumn(digest, F.sha2(lower_az(quoted("text")), 256)).join(owners, digest)
    mine = mine.where(quoted("doc_id").eqNullSafe(F.col(place)))
    number = F.row_number().over(Window.partitionBy(digest).orderBy(digest))
    return mine.withColumn(place, number).where(F.col(place) == 1).select(*[quoted(c) for c in docs.columns])


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


SQL = r"""
WITH n AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM n"""
