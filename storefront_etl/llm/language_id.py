"""Language identification by rank-order profiles (operator 10).

A profile is the ranking of the most frequent letter n-grams (1 to 3 letters,
words padded by a blank on both sides, letters lower-cased).  A language's
profile comes from the n-gram counts over *all* its training documents, added
up in Spark; a document's profile from its whole text.  The out-of-place
distance sums, over the document's n-grams, how far each stands from its rank
in the language's profile (the profile's length if it is not in it); the
nearest language wins, ties go to the first in code-point order.

The score is ``1 - nearest / greatest possible distance``.

Only the profiles come to the driver: ``PROFILE`` n-grams for each of at most
``MAX_LANGUAGES`` languages (an error beyond).  Texts never move.

Defined results: ``und`` with score 0 for null texts, texts without a letter,
and all texts if nothing was learned; a null doc_id is not held out and
teaches nothing; rows that repeat count as rows of their own; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from storefront_etl.llm.common import per_batch, stored, table

ORDERS = 3
PROFILE = 300
MAX_LANGUAGES = 1000
UNKNOWN = "und"
CODE_BITS = 21  # a code point


@functools.cache
def letter_codes() -> np.ndarray:
    """By code point: itself if it is a letter, else 0."""
    codes = np.zeros(0x110000, dtype=np.uint32)
    letters = [c for c in range(0x110000) if chr(c).isalpha()]
    codes[letters] = letters
    return codes


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams as 64-bit codes, counts) of a whole text; none if it has no letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    codes = np.zeros(len(points) + 2, dtype=np.uint64)
    codes[1:-1] = letter_codes()[points]
    # A blank (code 32) between words, runs of other characters being one blank.
    keep = np.ones(len(codes), dtype=bool)
    keep[1:] = (codes[1:] > 0) | (codes[:-1] > 0)
    codes = codes[keep]
    letter = codes > 0
    if not letter.any():
        return codes[:0], np.zeros(0, dtype=np.int64)
    codes[~letter] = 32
    grams = [codes[letter]]
    shift = np.uint64(CODE_BITS)
    long = codes
    for order in range(2, ORDERS + 1):
        long = long[:-1] << shift | codes[order - 1 :]
        # Blanks only at the ends: an n-gram lies in one padded word.
        inside = np.ones(len(long), dtype=bool)
        for k in range(1, order - 1):
            inside &= letter[k : k + len(long)]
        grams.append(long[inside])
    return np.unique(np.concatenate(grams), return_counts=True)


def ranking(grams: np.ndarray, counts: np.ndarray, length: int = PROFILE) -> np.ndarray:
    """The most frequent n-grams, by falling count (equal ones by code)."""
    if len(grams) > length:
        least = np.partition(counts, len(counts) - length)[len(counts) - length]
        some = counts >= least
        grams, counts = grams[some], counts[some]
    return grams[np.lexsort((grams, -counts))][:length]


class Profiles:
    def __init__(self, ranked: dict[str, list[int]], length: int = PROFILE):
        self.languages = sorted(ranked, key=lambda name: [ord(c) for c in name])
        self.length = length
        self.grams = np.unique(np.array([g for r in ranked.values() for g in r], dtype=np.uint64))
        # One row more for n-grams of no profile.
        self.places = np.full((len(self.grams) + 1, len(self.languages)), -1, dtype=np.int32)
        for k, name in enumerate(self.languages):
            at = np.searchsorted(self.grams, np.array(ranked[name], dtype=np.uint64))
            self.places[at, k] = np.arange(len(at))

    def nearest(self, text: str | None) -> tuple[str, float]:
        if text is None or not self.languages:
            return UNKNOWN, 0.0
        mine = ranking(*gram_counts(text), self.length)
        if not len(mine):
            return UNKNOWN, 0.0
        at = np.minimum(np.searchsorted(self.grams, mine), len(self.grams) - 1)
        at = np.where(self.grams[at] == mine, at, len(self.grams))
        places = self.places[at]
        off = np.abs(places - np.arange(len(mine), dtype=np.int32)[:, None])
        off[places < 0] = self.length
        distance = off.sum(axis=0)
        best = int(distance.argmin())
        return self.languages[best], 1.0 - float(distance[best]) / (self.length * len(mine))


def held_out(doc_id: Column) -> Column:
    """The documents that only test: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def language_profiles(train: DataFrame, length: int = PROFILE) -> Profiles:
    """Profiles from all rows of ``train`` (lang, text)."""

    def counts(part: pa.RecordBatch) -> pa.RecordBatch:
        """Counts of a slice of documents, each language's texts as one."""
        texts: dict[str, list[str]] = {}
        for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist(), strict=True):
            texts.setdefault(lang, []).append(text or "")
        found = [(lang, *gram_counts("\n".join(some))) for lang, some in texts.items()]
        names = np.repeat(np.array([f[0] for f in found], dtype=object), [len(f[1]) for f in found])
        grams = np.concatenate([f[1] for f in found]) if found else np.zeros(0, np.uint64)
        n = np.concatenate([f[2] for f in found]) if found else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array(grams.view(np.int64)), pa.array(n.astype(np.int64))], ["lang", "gram", "n"]
        )

    # Added up per task before the shuffle; what is left is one row per n-gram and language.
    grams = stored(
        per_batch(train.select("lang", "text"), "text", counts, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")),
        "language-grams",
    )
    languages = grams.select("lang").distinct().limit(MAX_LANGUAGES + 1).count()
    if languages > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram"))
    ranked: dict[str, list[int]] = {}
    for row in grams.withColumn("place", place).where(F.col("place") <= length).orderBy("lang", "place").collect():
        ranked.setdefault(row["lang"], []).append(row["gram"])
    return Profiles(ranked, length)


def identify_language(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """(doc_id, lang_pred, score): one row per document, from its text only."""
    shared = docs.sparkSession.sparkContext.broadcast(profiles)

    def predict(part: pa.RecordBatch) -> pa.RecordBatch:
        found = [shared.value.nearest(text) for text in part.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
            ["doc_id", "lang_pred", "score"],
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return per_batch(docs.select("doc_id", "text"), "text", predict, f"doc_id {kind}, lang_pred string, score double")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    taught = F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull()
    profiles = language_profiles(docs.where(taught))
    return identify_language(docs, profiles).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
