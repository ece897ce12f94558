"""Free-text CSV read by file splits: quoted fields with line breaks, any file size.

A line break ends a record only outside quotes, so where a split's records
begin depends on all the text before it.  In RFC-4180 text a place is inside
quotes exactly if an odd number of quotes stands before it, which is a prefix
sum over the splits:

1. the file is scanned as plain lines (splittable), and the quotes of each
   split are added up (one small row per split);
2. a running sum over a file's splits says for each whether it begins inside
   quotes;
3. each split's lines are put together to records where they are, in the
   order of the scan.  Only the records that cross a split boundary (at most
   two pieces a split) are shuffled, and joined in the order of their splits;
4. ``from_csv`` parses the records.

The text itself is never shuffled, and no file is one task.  The split table
is broadcast up to ``BROADCAST_SPLITS`` rows (25 TB of 128 MB splits);
beyond, lines are dealt out by split and sorted in it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from storefront_etl.sources.parquet import scratch_path

QUOTE = '"'
BROADCAST_SPLITS = 200_000
BYTE_ORDER_MARK = "﻿"

# Kinds of pieces: a whole record, or the part of one that a split has at its beginning, as a whole, or at its end.
WHOLE, HEAD, MIDDLE, TAIL = range(4)


def scanned_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file, block, at, line, quotes): every line with its split and its place in the scan."""
    text = spark.read.option("lineSep", "\n").text(path if isinstance(path, str) else list(path))
    quotes = F.octet_length("value") - F.octet_length(F.replace(F.col("value"), F.lit(QUOTE), F.lit("")))
    return text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"), quotes.alias("quotes"),
    )


def split_parities(lines: DataFrame) -> DataFrame:
    """(file, block, odd): whether a split begins inside quotes.

    What stands here holds for the place in the file, however it is split
    when the lines are read again.
    """
    splits = lines.groupBy("file", "block").agg(F.sum("quotes").alias("quotes"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return splits.select("file", "block", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("odd"))


def checked(record: str, sep: str, file: str) -> str:
    """The record; an error if a quote stands where RFC-4180 has none (its parity would mislead)."""
    if QUOTE in record:
        outside = record.split(QUOTE)[::2]
        first, last = outside[0], outside[-1]
        if (first and not first.endswith(sep)) or (last and not last.startswith(sep)) or any(
            piece and not (piece.startswith(sep) and piece.endswith(sep)) for piece in outside[1:-1]
        ):
            raise ValueError(f"{file}: a quote inside an unquoted field, or text after a quoted one: {record[:200]!r}; read it with split=False")
    return record


def split_pieces(lines: DataFrame, sep: str, fragments: bool) -> DataFrame:
    """(file, block, kind, first, text): the records of each split, or only their parts that cross a boundary.

    Needs the lines of a split one after the other.  ``first`` marks what
    begins a file.
    """
    schema = "file string, block long, kind int, first boolean, text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: tuple | None = None  # the split at hand: file, block
        odd, open_, began, first = False, None, False, False
        out: list[tuple] = []

        def closed(parts: list[str], kind: int, first: bool) -> None:
            if fragments == (kind != WHOLE):
                text = "\n".join(parts)
                if kind in (WHOLE, HEAD):
                    text = text.removesuffix("\r")
                if first:
                    text = text.removeprefix(BYTE_ORDER_MARK)
                out.append((*now, kind, first, checked(text, sep, now[0]) if kind == WHOLE else text))

        def ended() -> None:
            """The split is over: its last record may go on in the next one."""
            if open_:
                closed(open_, TAIL if began else MIDDLE, first)

        for batch in batches:
            files = batch.column("file").dictionary_encode()
            places, blocks = files.indices.to_numpy(), batch.column("block").to_numpy()
            quotes, starts_odd = batch.column("quotes").to_numpy(), batch.column("odd").to_numpy(zero_copy_only=False)
            texts = batch.column("line").to_pylist()
            edges = np.flatnonzero((places[1:] != places[:-1]) | (blocks[1:] != blocks[:-1])) + 1
            for lo, hi in zip([0, *edges], [*edges, len(texts)], strict=True):
                if lo == hi:
                    continue
                here = (files.dictionary[int(places[lo])].as_py(), int(blocks[lo]))
                if here != now:
                    if now is not None:
                        ended()
                    now, odd, open_, first = here, bool(starts_odd[lo]), None, False
                    began, fresh = not odd, int(blocks[lo]) == 0
                total = (int(odd) + np.cumsum(quotes[lo:hi])) % 2
                # A record is over after a line with which an even number of quotes is behind.
                at = lo
                for end in lo + np.flatnonzero(total == 0) + 1:
                    parts = [*(open_ or []), *texts[at:end]]
                    if open_ is None:
                        first = fresh
                    if began:
                        closed(parts, WHOLE, first)
                    else:
                        closed(parts, HEAD, False)
                        began = True
                    open_, fresh, at = None, False, int(end)
                if at < hi:
                    if open_ is None:
                        open_, first = [], fresh
                    open_ += texts[at:hi]
                odd = bool(total[-1])
                if len(out) >= 1000:
                    yield rows(out)
                    out = []
            if out:
                yield rows(out)
                out = []
        if now is not None:
            ended()
        if out:
            yield rows(out)

    def rows(out: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string())
        columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, ["file", "block", "kind", "first", "text"])

    return lines.select("file", "block", "odd", "quotes", "line").mapInArrow(run, schema)


def joined_fragments(fragments: DataFrame, sep: str) -> DataFrame:
    """(file, first, text): the records that cross split boundaries."""
    # Slim rows find the split where each record begins: the last open end before.
    order = Window.partitionBy("file").orderBy("block", "kind").rowsBetween(Window.unboundedPreceding, 0)
    begins = F.when(F.col("kind") == TAIL, F.col("block"))
    homes = fragments.select("file", "block", "kind").withColumn("home", F.last(begins, ignorenulls=True).over(order))
    parts = fragments.join(homes, ["file", "block", "kind"]).groupBy("file", "home").agg(
        F.sort_array(F.collect_list(F.struct("block", F.col("kind") != TAIL, "kind", "first", "text"))).alias("parts")
    )
    text = F.array_join(F.transform("parts", lambda p: p["text"]), "\n")
    unfinished = F.concat(F.col("file"), F.lit(" ends inside a quoted field"))
    whole = F.when(F.element_at("parts", -1)["kind"] == HEAD, text).otherwise(F.raise_error(unfinished).cast("string"))
    records = parts.select("file", F.element_at("parts", 1)["first"].alias("first"), whole.alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, text in zip(batch.column("file").to_pylist(), batch.column("text").to_pylist(), strict=True):
                checked(text, sep, file)
            yield batch

    return records.mapInArrow(run, "file string, first boolean, text string")


def read_quoted_csv(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None, sep: str = ",") -> DataFrame:
    """Header CSV (UTF-8, RFC-4180 quoting, line breaks in quoted fields) as text columns, read by file splits.

    All files must have the same header names in the same order (an error
    when read).  Missing fields and empty text are NULL, fields beyond the
    header are left out, empty lines are skipped, line breaks in fields stay as
    they are (``\\r\\n`` too).  A quote inside an unquoted
    field and a file that ends inside quotes are errors, not shifted columns.
    """
    paths = path if isinstance(path, str) else list(path)
    lines = scanned_lines(spark, paths)
    names = spark.read.options(header=True, sep=sep, quote=QUOTE, escape=QUOTE).csv(paths).columns
    splits_path = scratch_path(spark, "csv-splits")
    split_parities(lines).write.parquet(splits_path)
    splits = spark.read.schema("file string, block long, odd boolean").parquet(splits_path)
    few = splits.count() <= BROADCAST_SPLITS
    placed = lines.join(F.broadcast(splits) if few else splits, ["file", "block"], "left")
    gone = F.raise_error(F.concat(F.lit("the files changed while they were read: "), F.col("file"))).cast("boolean")
    placed = placed.withColumn("odd", F.when(F.col("odd").isNull(), gone).otherwise(F.col("odd")))
    if not few:
        placed = placed.repartition("file", "block").sortWithinPartitions("file", "block", "at")
    fragments_path = scratch_path(spark, "csv-fragments")
    split_pieces(placed, sep, fragments=True).write.parquet(fragments_path)
    fragments = spark.read.schema("file string, block long, kind int, first boolean, text string").parquet(fragments_path)
    records = split_pieces(placed, sep, fragments=False).select("file", "first", "text")
    if not fragments.isEmpty():  # no record crosses a boundary: no shuffle at all
        records = records.unionByName(joined_fragments(fragments, sep))
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    options = {"sep": sep, "quote": QUOTE, "escape": QUOTE, "multiLine": "true"}
    parsed = records.where("first OR text <> ''").select("file", "first", F.from_csv("text", schema, options).alias("record"))
    # Spark names a header's empty cells by their place.
    header = F.array(*[F.coalesce(F.col("record").getField(n), F.lit(f"_c{k}")) for k, n in enumerate(names)])
    same = F.array(*[F.lit(n) for n in names]) == header
    other = F.raise_error(F.concat(F.lit("CSV header differs in "), F.col("file"))).cast("boolean")
    data = parsed.where(F.when(~F.col("first"), F.lit(True)).otherwise(F.when(F.coalesce(same, F.lit(False)), F.lit(False)).otherwise(other)))
    wanted = list(columns) if columns is not None else names
    return data.select(*[F.col("record").getField(n).alias(n) for n in wanted])
