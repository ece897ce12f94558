"""Quality classifier: a regularised quadratic discriminant (operator 13).

One pass over the whole texts turns each document into ``FEATURES``
transformed statistics (logarithms of lengths, square roots of shares), kept
as whole numbers of ``2**-16``.  The labelled rows among them give, per class,
counts, sums and sums of products: added up in Spark as whole numbers, so
reruns agree to the last digit.  They hold everything that a normal density
per class needs, however many labelled rows there are.

Class k's covariance is shrunk twice: towards the pooled covariance by
``pooled`` and towards its diagonal by ``diagonal``.  A document's score is
the logistic function of the difference of the two log densities (Mahalanobis
distances by Cholesky factors that are made once, log determinants, and the
classes' shares), divided by a temperature.  The two shrinkages and the
temperature are those of ``GRID`` with the least log loss in ``FOLDS``-fold
cross-validation over the labelled rows; the folds' models come from the same
sums, without the fold's own.

Texts are read once and never move; labels are joined to the slim statistics.
The driver holds sums (some 150 numbers a fold and class) and the model.

Defined results: null and empty texts have zero statistics and a score like
any other; null labels, labels without a document and null ids teach nothing;
of ids labelled twice the lower quality counts; rows that repeat count again;
without labels of both classes every score is the share of class 1 (a half
without any); an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storefront_etl.llm.common import Words, lists, per_batch, stored, table
from storefront_etl.llm.quality import duplicate_lines, repeated_words

SCALE = 1 << 16
FOLDS = 5
HELD_OUT = 3
# (pooled, diagonal, temperature)
GRID = tuple(itertools.product((0.02, 0.1, 0.3, 0.7), (0.01, 0.05, 0.2), (1.0, 2.0, 4.0, 8.0)))
# Variance that every statistic has at least.
FLOOR = 1e-6


def byte_class(members) -> np.ndarray:
    found = np.zeros(256, dtype=bool)
    found[list(members)] = True
    return found


CLASSES = (
    byte_class(b"0123456789"), byte_class(range(65, 91)), byte_class(b"#*$%&|<>"), byte_class(b".,;:!?"), byte_class(b"\n"),
    byte_class(b"()[]{}/\\\"'@=+_-~^`"), byte_class(range(128, 256)),
)
FEATURES = (
    "log_words", "log_word_length", "log_word_spread", "duplicate_lines", "repeated_words", "stutter", "distinct_words", "vocabulary_growth",
    "digits", "capitals", "symbols", "stops", "line_breaks", "brackets", "non_ascii",
)


def document_features(texts: pa.Array) -> np.ndarray:
    """The transformed statistics of each text (columns ``FEATURES``)."""
    words = Words(texts)
    raw, offsets, first, hashes = words.raw, words.offsets, words.first, words.hashes()
    n, n_bytes = words.counts(), np.maximum(np.diff(offsets), 1)
    some = np.maximum(n, 1)

    def per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values)])
        return total[bounds[1:]] - total[bounds[:-1]]

    length = (words.ends - words.starts).astype(np.int64)
    mean = per_text(length, first) / some
    spread = np.sqrt(np.maximum(per_text(length * length, first) / some - mean**2, 0))
    same = np.zeros(len(hashes), dtype=np.int64)
    same[1:] = hashes[1:] == hashes[:-1]
    same[first[:-1][first[:-1] < len(hashes)]] = 0
    lines, repeated, distinct = np.zeros((3, len(n)))
    for i, (lo, hi, a, b) in enumerate(zip(first[:-1], first[1:], offsets[:-1], offsets[1:], strict=True)):
        lines[i] = duplicate_lines(raw[a:b].tobytes())
        repeated[i] = repeated_words(hashes[lo:hi])
        distinct[i] = len(np.unique(hashes[lo:hi]))
    breaks = per_text(raw == 10, offsets)
    shares = [lines / (breaks + 1), repeated / some, per_text(same, first) / np.maximum(n - 1, 1), distinct / some]
    growth = np.log1p(distinct) / np.log(np.maximum(n, 1) + 1)
    classes = [per_text(c[raw], offsets) / n_bytes for c in CLASSES]
    return np.column_stack([np.log1p(n), np.log1p(mean), np.log1p(spread), *np.sqrt(shares), growth, *np.sqrt(classes)])


def featured(docs: DataFrame) -> DataFrame:
    """(doc_id, x): the statistics of every document as whole numbers of ``1 / SCALE``."""

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        x = np.rint(document_features(part.column("text")) * SCALE).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id"), lists(x.ravel(), np.full(len(x), x.shape[1]), pa.int32())], ["doc_id", "x"]
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return per_batch(docs.select("doc_id", "text"), "text", run, f"doc_id {kind}, x array<int>")


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of statistics, as whole numbers."""
    return column.flatten().to_numpy().reshape(-1, len(FEATURES)).astype(np.int64)


# ---------------------------------------------------------------------------
# Models
# ---------------------------------------------------------------------------
@dataclass
class Moments:
    """Count, sums and sums of products of rows of whole numbers (exact)."""

    n: int
    sums: np.ndarray
    products: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        return Moments(self.n + other.n, self.sums + other.sums, self.products + other.products)

    @staticmethod
    def none() -> Moments:
        d = len(FEATURES)
        return Moments(0, np.zeros(d, dtype=object), np.zeros((d, d), dtype=object))

    def mean(self) -> np.ndarray:
        return self.sums.astype(np.float64) / self.n / SCALE

    def covariance(self) -> np.ndarray:
        # n * products - sums * sums is exact; the division comes last.
        exact = self.n * self.products - np.outer(self.sums, self.sums)
        return exact.astype(np.float64) / self.n / self.n / SCALE / SCALE


@dataclass
class Discriminant:
    """Two normal densities: means, covariances and shares of the classes 0 and 1."""

    means: tuple[np.ndarray, np.ndarray]
    covariances: tuple[np.ndarray, np.ndarray]
    shares: tuple[float, float]
    temperature: float

    @cached_property
    def factors(self) -> tuple[tuple[np.ndarray, float], ...]:
        """Per class the inverse of the Cholesky factor and half the log determinant."""
        lower = [np.linalg.cholesky(c) for c in self.covariances]
        return tuple((np.linalg.inv(f), float(np.log(np.diag(f)).sum())) for f in lower)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        """Class 1 against class 0, for rows of whole numbers."""
        densities = []
        for mean, share, (inverse, half_log) in zip(self.means, self.shares, self.factors, strict=True):
            # Sums row by row: a matrix product's last digits depend on the batch's size.
            z = ((x / SCALE - mean)[:, None, :] * inverse).sum(axis=2)
            densities.append(np.log(share) - half_log - 0.5 * (z * z).sum(axis=1))
        return (densities[1] - densities[0]) / self.temperature

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.log_odds(x), -700, 700)))


def fitted(classes: tuple[Moments, Moments], pooled: float, diagonal: float, temperature: float) -> Discriminant | None:
    """A model from two classes' moments; None if one has no rows."""
    n = [m.n for m in classes]
    if not all(n):
        return None
    own = [m.covariance() for m in classes]
    together = (n[0] * own[0] + n[1] * own[1]) / sum(n)
    shrunk = [(1 - pooled) * c + pooled * together for c in own]
    flat = np.diag(np.diag(together))
    floor = FLOOR * np.eye(len(FEATURES))
    covariances = tuple((1 - diagonal) * c + diagonal * flat + floor for c in shrunk)
    return Discriminant(tuple(m.mean() for m in classes), covariances, (n[0] / sum(n), n[1] / sum(n)), temperature)


def held_out(doc_id: Column) -> Column:
    """The documents that only test: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT == 1, F.lit(False))


def labelled(statistics: DataFrame, labels: DataFrame) -> DataFrame:
    """(fold, good, x) of the rows to learn from."""
    quality = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg((F.min("quality") > 0).alias("good"))
    taught = statistics.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    fold = F.pmod(F.xxhash64(taught.doc_id.cast("string")), F.lit(FOLDS)).cast("int")
    return taught.join(quality, "doc_id").select(fold.alias("fold"), F.col("good").cast("int").alias("good"), "x")


def moments(rows: DataFrame) -> dict[tuple[int, int], Moments]:
    """By (fold, class)."""
    d = len(FEATURES)
    upper = np.triu_indices(d)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            x, fold, good = matrix(part.column("x")), part.column("fold").to_numpy(), part.column("good").to_numpy()
            for f, g in itertools.product(range(FOLDS), (0, 1)):
                mine = x[(fold == f) & (good == g)]
                if len(mine):
                    values = np.concatenate([[len(mine)], mine.sum(axis=0), (mine.T @ mine)[upper]])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(values), f, np.int32)), pa.array(np.full(len(values), g, np.int32)), pa.array(np.arange(len(values), dtype=np.int32)),
                         pa.array(values.astype(np.int64))], ["fold", "good", "place", "value"])

    added = rows.mapInArrow(run, "fold int, good int, place int, value long").groupBy("fold", "good", "place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    found: dict[tuple[int, int], dict[int, int]] = {}
    for r in added.collect():  # a fixed number of rows
        found.setdefault((r["fold"], r["good"]), {})[r["place"]] = int(r["value"])
    out = {}
    for key, values in found.items():
        products = np.zeros((d, d), dtype=object)
        for k, (i, j) in enumerate(zip(*upper, strict=True)):
            products[i, j] = products[j, i] = values[1 + d + k]
        out[key] = Moments(values[0], np.array([values[1 + k] for k in range(d)], dtype=object), products)
    return out


def cross_validated(rows: DataFrame, by_fold: dict[tuple[int, int], Moments], grid: tuple = GRID) -> tuple:
    """The entry of ``grid`` with the least log loss over the folds (the last entry if a fold leaves a class empty)."""
    models = []
    for f in range(FOLDS):
        rest = tuple(sum((m for (k, g), m in by_fold.items() if g == c and k != f), Moments.none()) for c in (0, 1))
        models.append([fitted(rest, *entry) for entry in grid])
    if any(m is None for row in models for m in row):
        return grid[-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            x, fold, good = matrix(part.column("x")), part.column("fold").to_numpy(), part.column("good").to_numpy()
            loss = np.zeros(len(grid), dtype=np.int64)
            for f in range(FOLDS):
                mine = fold == f
                if mine.any():
                    for k, model in enumerate(models[f]):
                        odds = model.log_odds(x[mine])
                        loss[k] += int(np.rint(np.logaddexp(0, np.where(good[mine] == 1, -odds, odds)) * 1000).astype(np.int64).sum())
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(grid), dtype=np.int32)), pa.array(loss)], ["entry", "loss"])

    losses = {r["entry"]: r["loss"] for r in rows.mapInArrow(run, "entry int, loss long").groupBy("entry").agg(F.sum("loss").alias("loss")).collect()}
    return grid[min(losses, key=lambda k: (losses[k], k))]


def fit(statistics: DataFrame, labels: DataFrame) -> Discriminant | float:
    """The model over all labelled rows; without both classes the share of class 1."""
    rows = stored(labelled(statistics, labels), "discriminant-labelled")
    by_fold = moments(rows)
    classes = tuple(sum((m for (_, g), m in by_fold.items() if g == c), Moments.none()) for c in (0, 1))
    n = [m.n for m in classes]
    if not all(n):
        return n[1] / sum(n) if sum(n) else 0.5
    return fitted(classes, *cross_validated(rows, by_fold))


def classify(statistics: DataFrame, model: Discriminant | float) -> DataFrame:
    """(doc_id, score, predicted) of every row of statistics."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            x = matrix(part.column("x"))
            scores = np.full(len(x), model) if isinstance(model, float) else model.scores(x)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"]
            )

    kind = statistics.schema["doc_id"].dataType.simpleString()
    return statistics.mapInArrow(run, f"doc_id {kind}, score double, predicted int")


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted): one row per document."""
    statistics = stored(featured(docs), "discriminant-statistics")
    return classify(statistics, fit(statistics, labels)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
