"""Substring dedup: repeated token windows are cut out (operator 5).

A window is 35 consecutive words of one document.  Every window gets a
Rabin-Karp hash (prefix sums of powers, so all windows of a text at once);
windows whose hash Spark counts twice or more merge into maximal intervals,
and the words under them go.

Counting every window would shuffle one row per word.  Most are proved
unique first: a window's minimizer is the smallest hash among its 8-word
pieces, so equal windows have equal minimizers, and a window whose minimizer
stands at one place of the whole corpus cannot repeat.  Only some 7 % of the
words hold a minimizer.  So

1. every text gives its distinct minimizer places and the digest it has if
   nothing is removed (one pass, slim output),
2. Spark counts the minimizers; documents with a repeated one are candidates,
3. the candidates' windows on repeated minimizers are hashed and counted,
4. a candidate is cut by the repeated hashes that are its own.

Equal texts are one candidate with a number of copies, so a group of copies
costs one text, however large it is.

Counts are pre-aggregated, so a passage in a third of all documents is a few
partial counts per task; joins against the counts have one row per hash on
one side, so Spark may split the hot side.  Windows are judged on the input.

Defined results: null and empty texts have no words, nothing removed and the
digest of the empty string; texts under 35 words keep all words; rows that
repeat count as places of their own (so 35 words or more that are there twice
go from both); an empty table gives no rows.  64-bit hashes: two different
windows of a corpus of 10^9 windows collide with odds of about 3 %.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storefront_etl.llm.common import Words, as_long, lists, per_batch, stored, table, window_hashes

WIDTH = 35
PIECE = 8


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    out, have = values, 1
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def window_ids(words: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(window hashes, their minimizers) of one text's word hashes."""
    return window_hashes(words, width), sliding_min(window_hashes(words, min(PIECE, width)), width - min(PIECE, width) + 1)


def content_key() -> Column:
    """Equal for equal texts: such documents have the same result."""
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def row_key() -> Column:
    """Equal for equal (doc_id, text)."""
    return F.xxhash64(F.col("text"), F.col("doc_id"))


def outlines(docs: DataFrame, width: int) -> DataFrame:
    """(content, row, doc_id, n_words, whole_sha256, minimizers): one row per document, texts read once."""

    def outline(part: pa.RecordBatch) -> pa.RecordBatch:
        words = Words(part.column("text"))
        hashes, all_words = words.hashes(), np.arange(len(words.starts))
        digests, found, lengths = [], [np.zeros(0, np.uint64)], []
        piece = min(PIECE, width)
        for lo, hi in zip(words.first[:-1], words.first[1:], strict=True):
            digests.append(hashlib.sha256(words.joined(all_words[lo:hi])).hexdigest())
            if hi - lo < width:
                lengths.append(0)
                continue
            pieces = window_hashes(hashes[lo:hi], piece)
            least = sliding_min(pieces, width - piece + 1)
            # A place is a minimizer if it is the first smallest piece of some window: one entry per place.
            # A piece equal to its window's minimum may be another place with the same hash; both then count,
            # which only makes more candidates.
            at = np.unique(least)
            at = pieces[np.isin(pieces, at)]
            found.append(at)
            lengths.append(len(at))
        every = np.concatenate(found)
        return pa.RecordBatch.from_arrays(
            [part.column("content"), part.column("row"), part.column("doc_id"), pa.array(words.counts(), pa.int64()), pa.array(digests, pa.string()),
             lists(every.view(np.int64), np.array(lengths, dtype=np.int64), pa.int64())],
            ["content", "row", "doc_id", "n_words", "whole_sha256", "minimizers"],
        )

    schema = f"content long, row long, doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, whole_sha256 string, minimizers array<long>"
    return per_batch(docs.select(content_key().alias("content"), row_key().alias("row"), "doc_id", "text"), "text", outline, schema)


def candidate_windows(texts: DataFrame, width: int) -> DataFrame:
    """(content, copies, window) of every window whose minimizer is in its text's ``shared`` list."""

    def windows(part: pa.RecordBatch) -> pa.RecordBatch:
        words = Words(part.column("text"))
        hashes = words.hashes()
        shared = part.column("shared")
        found, lengths = [np.zeros(0, np.uint64)], []
        for i, (lo, hi) in enumerate(zip(words.first[:-1], words.first[1:], strict=True)):
            lengths.append(0)
            if hi - lo >= width:
                whole, least = window_ids(hashes[lo:hi], width)
                whole = whole[np.isin(least, shared[i].values.to_numpy().view(np.uint64))]
                found.append(whole)
                lengths[-1] = len(whole)
        repeat = pa.array(np.repeat(np.arange(part.num_rows), lengths))
        return pa.RecordBatch.from_arrays(
            [part.column("content").take(repeat), part.column("copies").take(repeat), as_long(np.concatenate(found))],
            ["content", "copies", "window"],
        )

    return per_batch(texts, "text", windows, "content long, copies long, window long")


def cut(texts: DataFrame, width: int) -> DataFrame:
    """Candidates (content, text, ``repeated`` hashes) -> what stays of them."""

    def digest(part: pa.RecordBatch) -> pa.RecordBatch:
        words = Words(part.column("text"))
        hashes = words.hashes()
        removed, digests, kept_texts, repeated = [], [], [], part.column("repeated")
        for i, (lo, hi) in enumerate(zip(words.first[:-1], words.first[1:], strict=True)):
            keep = np.ones(hi - lo, dtype=bool)
            if hi - lo >= width:
                again = np.isin(window_hashes(hashes[lo:hi], width), repeated[i].values.to_numpy().view(np.uint64))
                edges = np.zeros(hi - lo + 1, dtype=np.int64)  # windows opening minus windows closing at each word
                edges[:-width] += again
                edges[width:] -= again
                keep = np.cumsum(edges[:-1]) == 0
            kept = words.joined(lo + np.flatnonzero(keep))
            removed.append(int(hi - lo - keep.sum()))
            digests.append(hashlib.sha256(kept).hexdigest())
            kept_texts.append(kept.decode("utf-8", "replace"))
        return pa.RecordBatch.from_arrays(
            [part.column("content"), pa.array(removed, pa.int64()), pa.array(digests, pa.string()), pa.array(kept_texts, pa.string())],
            ["content", "n_removed", "kept_sha256", "kept_text"],
        )

    return per_batch(texts, "text", digest, "content long, n_removed long, kept_sha256 string, kept_text string")


def dedup_substrings(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 and, where it may differ from the input, ``kept_text``.

    ``kept_text`` is null for documents that nothing is removed from.
    """
    whole = stored(outlines(docs, width), "substring-outlines")
    # One row per different text: copies cost a count.
    contents = stored(
        whole.groupBy("content").agg(F.count(F.lit(1)).alias("copies"), F.min("row").alias("row"), F.first("minimizers").alias("minimizers")),
        "substring-contents",
    )
    places = contents.select("content", "copies", F.explode("minimizers").alias("minimizer"))
    again = stored(
        places.groupBy("minimizer").agg(F.sum("copies").alias("n")).where("n > 1").select("minimizer"), "substring-minimizers"
    )
    shared = places.join(again, "minimizer").groupBy("content").agg(F.collect_set("minimizer").alias("shared"))
    one = shared.join(contents.select("content", "copies", "row"), "content")
    candidates = stored(
        docs.select(row_key().alias("row"), "text").join(one, "row").select("row", "content", "copies", "text", "shared").dropDuplicates(["row"]),
        "substring-candidates",
    )
    windows = stored(candidate_windows(candidates, width), "substring-windows")
    # Stored, so that both sides of the join are shuffled and Spark may split a window that very many texts have.
    repeated = stored(windows.groupBy("window").agg(F.sum("copies").alias("n")).where("n > 1").select("window"), "substring-repeated")
    own = windows.join(repeated, "window").groupBy("content").agg(F.collect_set("window").alias("repeated"))
    changed = cut(candidates.select("content", "text").join(own, "content"), width)
    return whole.join(changed, "content", "left").select(
        "doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"), "kept_text",
    )


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(table(spark, sf_dir, "documents")).drop("kept_text")


SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(ws[i : i + 34], ' ')) AS h
  FROM (SELECT doc_id, ws, unnest(range(1, CAST(len(ws) AS BIGINT) - 33)) AS i FROM w)),
repeated AS (SELECT h FROM windows GROUP BY h HAVING count(*) > 1),
covered AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM windows WHERE h IN (SELECT h FROM repeated)),
words AS (SELECT doc_id, ws[p] AS word, p FROM (SELECT doc_id, ws, unnest(range(1, CAST(len(ws) AS BIGINT) + 1)) AS p FROM w)),
kept AS (
  SELECT words.doc_id, string_agg(word, ' ' ORDER BY words.p) AS t, count(*) AS n
  FROM words ANTI JOIN covered ON words.doc_id = covered.doc_id AND words.p = covered.p GROUP BY words.doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id"""
