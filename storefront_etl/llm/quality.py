"""Quality rules by an isolation forest on rule statistics (operator 9).

Every document gets the statistics that quality rules look at: words, letters
per word, symbols, repeated lines, words in repeated 8-word windows and so on.
Two base rules reject outright (under 20 words; over 30 % of the words in
repeated windows).  For the others an isolation forest tells how odd a
document is: trees split a random feature at a random value, and odd rows are
alone after few splits.  The score is ``2 ** -(mean path / expected path)``.

The forest sees the statistics themselves (``FEATURES``), each as its distance
from where the good documents lie: their ``TAIL`` and ``1 - TAIL`` quantiles,
in units of the space between.  No limit is set by hand; some good documents
are outside in something, and the forest weighs how far and in how much.
All labelled documents teach it, those past the base rules: of half of them (by
a hash of the id) the good ones (quality 1) give the quantiles and are counted
in the leaves of every tree, so that a crowd of equally bad rows can't hide
itself.  The trees' splits are random and need no rows; the first box of a tree
is between one unit and all the space the good rows take.  The threshold comes
from the other half: of all scores, the one that rejects bad rows (quality 0)
best against good ones, with at most ``GOOD_LOST`` of the good rows lost.
Without labels of both kinds in both halves, or if no threshold beats keeping
all, the forest rejects nothing.  Quantiles, counts and threshold are exact:
grouped counts and running sums over range partitions; only the forest itself,
which is of fixed size, reaches the driver.  One pass over the whole texts
makes the features to learn from and one the verdicts; texts never move.

Defined results: a null, empty or wordless text has zero statistics and fails
the base rules; a null label and labels without a document are ignored; of
ids that are labelled twice the lower quality counts; rows that repeat are
judged alike; an empty table gives no rows; extra columns pass
:func:`keep_good` unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storefront_etl.llm.common import Words, per_batch, plain_names, prefix_sums, stored, table, text_buffers, window_hashes

MIN_WORDS = 20
REPEAT_WIDTH = 8
MAX_REPEAT_PERCENT = 30
SYMBOLS = b"#*$%&|<>"
TREES = 128
# Splits on the longest way through a tree.
DEPTH = 8
SEED = 9
GOOD_LOST = 0.005
TAIL = 0.02
# Least space between a statistic's two quantiles.
LEAST_SPACE = 1e-3
FEATURES = ("log_words", "word_length", "symbols", "duplicate_lines", "repeated_words", "stutter", "vocabulary_growth", "capitals")

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(SYMBOLS)] = True
_CAPITAL = np.zeros(256, dtype=bool)
_CAPITAL[65:91] = True
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(hashes: np.ndarray, width: int = REPEAT_WIDTH) -> int:
    """Words covered by windows that are there twice or more."""
    windows = window_hashes(hashes, width)
    if len(windows) < 2:
        return 0
    order = np.argsort(windows)
    same = windows[order[1:]] == windows[order[:-1]]
    if not same.any():
        return 0
    again = np.zeros(len(windows), dtype=bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    edges = np.zeros(len(hashes) + 1, dtype=np.int64)
    edges[:-width] += again
    edges[width:] -= again
    return int((np.cumsum(edges[:-1]) > 0).sum())


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip(b" \t\n\v\f\r")]
    return len(lines) - len(set(lines))


def statistics(texts: pa.Array) -> np.ndarray:
    """The columns ``STATISTICS`` of each text."""
    words = Words(texts)
    raw, offsets = text_buffers(texts)
    hashes = words.hashes()
    out = np.zeros((len(offsets) - 1, len(STATISTICS)), dtype=np.int64)
    out[:, 0] = words.counts()
    # Code points: bytes that don't continue a character.
    starts = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    per_word = np.concatenate([[0], np.cumsum(starts[words.ends] - starts[words.starts])])
    out[:, 1] = per_word[words.first[1:]] - per_word[words.first[:-1]]
    symbols = np.concatenate([[0], np.cumsum(_SYMBOL[raw])])
    out[:, 2] = symbols[offsets[1:]] - symbols[offsets[:-1]]
    for i, (lo, hi, a, b) in enumerate(zip(words.first[:-1], words.first[1:], offsets[:-1], offsets[1:], strict=True)):
        out[i, 3] = duplicate_lines(raw[a:b].tobytes())
        out[i, 4] = repeated_words(hashes[lo:hi])
    return out


def stutter(texts: pa.Array) -> np.ndarray:
    """Share of each text's words that equal the word before."""
    words = Words(texts)
    hashes = words.hashes()
    same = np.zeros(len(hashes), dtype=np.int64)
    same[1:] = hashes[1:] == hashes[:-1]
    first = words.first[:-1]
    same[first[first < len(hashes)]] = 0  # the word before is another text's
    total = np.concatenate([[0], np.cumsum(same)])
    return (total[words.first[1:]] - total[first]) / np.maximum(words.counts() - 1, 1)


def features(texts: pa.Array, stats: np.ndarray) -> np.ndarray:
    """What the forest learns from (columns ``FEATURES``): lengths, shares and the growth of the vocabulary."""
    words = Words(texts)
    raw, offsets, first, hashes = words.raw, words.offsets, words.first, words.hashes()

    def per_text(chosen: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(chosen)])
        return total[offsets[1:]] - total[offsets[:-1]]

    n = np.maximum(stats[:, 0], 1)
    distinct = np.array([len(np.unique(hashes[lo:hi])) for lo, hi in zip(first[:-1], first[1:], strict=True)])
    return np.column_stack([
        np.log1p(stats[:, 0]), stats[:, 1] / n, stats[:, 2] / n, stats[:, 3] / (per_text(raw == 10) + 1), stats[:, 4] / n, stutter(texts),
        np.log1p(distinct) / np.log1p(n), per_text(_CAPITAL[raw]) / np.maximum(np.diff(offsets), 1),
    ])


def base_failed(stats: np.ndarray) -> np.ndarray:
    return (stats[:, 0] < MIN_WORDS) | (100 * stats[:, 4] > MAX_REPEAT_PERCENT * stats[:, 0])


def expected_path(n: float) -> float:
    """Mean depth of a failed search among n rows."""
    return 0.0 if n < 2 else 1.0 if n < 3 else 2 * (np.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


@dataclass
class Forest:
    """Flat trees: per node the feature (-1: leaf), the split, the left child (right is next) and a leaf's path."""

    feature: np.ndarray
    split: np.ndarray
    child: np.ndarray
    path: np.ndarray
    roots: np.ndarray
    norm: float
    threshold: float = np.inf
    # Where good documents lie, by feature.
    low: np.ndarray | None = None
    high: np.ndarray | None = None

    def judge(self, x: np.ndarray) -> np.ndarray:
        """Anomaly scores of rows of ``FEATURES``."""
        return self.scores(outside(x, self.low, self.high))

    def leaves(self, x: np.ndarray, root: int) -> np.ndarray:
        """The leaf of one tree that each row reaches."""
        at, rows = np.full(len(x), root), np.arange(len(x))
        while True:
            f = self.feature[at]
            inner = np.flatnonzero(f >= 0)
            if not len(inner):
                return at
            here = at[inner]
            at[inner] = self.child[here] + (x[rows[inner], f[inner]] >= self.split[here])

    def scores(self, x: np.ndarray) -> np.ndarray:
        depth = np.zeros(len(x))
        for root in self.roots:
            depth += self.path[self.leaves(x, root)]
        return np.exp2(-depth / max(1, len(self.roots)) / self.norm)


def outside(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """How far each value is below ``low`` or above ``high``, in units of the space between (0 inside)."""
    return np.maximum(np.maximum(x - high, low - x), 0.0) / np.maximum(high - low, LEAST_SPACE)


def random_trees(low: np.ndarray, high: np.ndarray, least: float | None = None, trees: int = TREES, depth: int = DEPTH, seed: int = SEED) -> Forest:
    """Trees of random splits; no row is needed yet, as :func:`grown` counts all of them.

    A node halves its box at a random place of a random feature.  With
    ``least`` a tree's first box is, by feature, between that wide and as wide
    as the rows are (on a logarithmic scale), so that neither what the rows
    have not shown nor a few rows far out take all splits.
    """
    rng = np.random.Generator(np.random.PCG64(seed))
    size = (1 << (depth + 1)) - 1
    feature, split = np.full((trees, size), -1, dtype=np.int64), np.zeros((trees, size))
    width = np.asarray(high, dtype=np.float64) - low
    for t in range(trees):
        span = width if least is None else least * (np.maximum(width, least) / least) ** rng.uniform(size=len(width))
        can = np.flatnonzero(span > 0)
        boxes = [(0, np.array(low, dtype=np.float64), low + span)]
        while boxes and len(can):
            at, lo, hi = boxes.pop()
            if at >= size // 2:
                continue
            f = int(rng.choice(can))
            feature[t, at], split[t, at] = f, rng.uniform(lo[f], hi[f])
            left, right = hi.copy(), lo.copy()
            left[f] = right[f] = split[t, at]
            boxes += [(2 * at + 1, lo, left), (2 * at + 2, right, hi)]
    first = np.arange(trees)[:, None] * size
    child = np.where(feature >= 0, first + 2 * np.arange(size) + 1, 0)
    return Forest(feature.ravel(), split.ravel(), child.ravel(), np.zeros(trees * size), first.ravel(), 1.0)


def leaf_counts(forest: Forest, x: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Rows of ``x`` (each ``weight`` times) by the leaf they reach in each tree."""
    out = np.zeros(len(forest.feature), dtype=np.int64)
    for root in forest.roots:
        np.add.at(out, forest.leaves(x, root), weight)
    return out


def grown(forest: Forest, counts: np.ndarray) -> Forest:
    """The trees with the rows that reach their leaves: branches without rows end at the first node that has none."""
    n = counts.copy()
    for at in np.flatnonzero(forest.feature >= 0)[::-1]:
        n[at] = n[forest.child[at]] + n[forest.child[at] + 1]
    size = len(n) // len(forest.roots)
    depth = np.floor(np.log2(np.arange(len(n)) % size + 1))
    feature = np.where(n > 0, forest.feature, -1)
    path = depth + np.array([expected_path(k) for k in n.tolist()])
    norm = max(expected_path(int(n[forest.roots].max())), 1e-9)
    return Forest(feature, forest.split, forest.child, np.where(feature < 0, path, 0.0), forest.roots, norm, forest.threshold, forest.low, forest.high)


def grow_forest(x: np.ndarray, least: float | None = None) -> Forest:
    """Trees whose leaves count the rows of ``x``."""
    forest = random_trees(np.zeros(x.shape[1]) if least is not None else x.min(axis=0), x.max(axis=0), least)
    return grown(forest, leaf_counts(forest, x, np.ones(len(x), dtype=np.int64)))


def calibrated(scores: np.ndarray, good: np.ndarray, good_lost: float = GOOD_LOST) -> float:
    """Rows that score at least this are rejected: the most bad rows, with few good ones lost."""
    if not good.any() or good.all():
        return float("inf")
    order = np.argsort(-scores, kind="stable")
    lost, caught = np.cumsum(good[order]), np.cumsum(~good[order])
    last = np.append(scores[order][1:] != scores[order][:-1], True)  # no threshold between equal scores
    gain = np.where(last & (lost <= good_lost * good.sum()), caught / (~good).sum() - lost / good.sum(), 0.0)
    best = int(gain.argmax())
    if gain[best] <= 0:
        return float("inf")
    # Halfway to the first row that stays.
    return float(scores[order][best : best + 2].mean())


NAMES = [f"x{k}" for k in range(len(FEATURES))]


def labelled_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(teach, good, x0, x1, ...) of every labelled document that the base rules pass."""

    def rows(part: pa.RecordBatch) -> pa.RecordBatch:
        stats = statistics(part.column("text"))
        x, passed = features(part.column("text"), stats), ~base_failed(stats)
        columns = [part.column("doc_id"), *[pa.array(x[:, k].copy()) for k in range(len(NAMES))]]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", *NAMES]).filter(pa.array(passed))

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(f"{c} double" for c in NAMES)
    good = (
        labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg((F.min("quality") > 0).alias("good"))
        .withColumn("teach", F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0)
    )
    # Only features meet the labels, not texts.
    return per_batch(docs.select("doc_id", "text"), "text", rows, schema).join(good, "doc_id").select("teach", "good", *NAMES)


def partitions_of(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def exact_quantiles(df: DataFrame, names: Sequence[str], n: int, at: Sequence[float]) -> np.ndarray:
    """Rows of quantiles (linear between ranks) of the columns of ``df``, which has ``n`` rows."""
    values = df.select(F.posexplode(F.array(*names)).alias("k", "v")).groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"))
    summed = prefix_sums(values, ["k"], [F.col("v")], {"upto": F.col("n")}, partitions_of(df), "quality-values")
    places = [(n - 1) * q for q in at]
    ranks = sorted({int(r) for p in places for r in (np.floor(p), np.ceil(p))})
    hit = F.array(*[F.lit(r).cast("long") for r in ranks])
    found = summed.select("k", "v", F.explode(F.filter(hit, lambda r: (r < F.col("upto")) & (r >= F.col("upto") - F.col("n")))).alias("r")).collect()
    value = {(r["k"], r["r"]): r["v"] for r in found}
    low = np.array([[value[k, int(np.floor(p))] for k in range(len(names))] for p in places])
    high = np.array([[value[k, int(np.ceil(p))] for k in range(len(names))] for p in places])
    return low + (high - low) * (np.array(places) % 1)[:, None]


def matrix(part: pa.RecordBatch) -> np.ndarray:
    return np.column_stack([part.column(c).to_numpy(zero_copy_only=False) for c in NAMES])


def counted(rows: DataFrame, forest: Forest) -> np.ndarray:
    """How many of ``rows`` reach each leaf: every task sends one number per leaf it meets."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(forest.feature), dtype=np.int64)
        for part in batches:
            x = outside(matrix(part), forest.low, forest.high)
            # Rows inside in everything go one way.
            out = x.any(axis=1)
            weight = np.ones(int(out.sum()) + 1, dtype=np.int64)
            weight[-1] = len(x) - out.sum()
            total += leaf_counts(forest, np.vstack([x[out], np.zeros((1, x.shape[1]))]), weight)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], ["leaf", "n"])

    found = rows.select(*NAMES).mapInArrow(count, "leaf long, n long").groupBy("leaf").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(len(forest.feature), dtype=np.int64)
    out[[r["leaf"] for r in found]] = [r["n"] for r in found]
    return out


def calibrated_on(rows: DataFrame, forest: Forest, good_lost: float = GOOD_LOST) -> float:
    """:func:`calibrated` for (good, x0, x1, ...) rows of any number."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            yield pa.RecordBatch.from_arrays([pa.array(forest.judge(matrix(part))), part.column("good")], ["score", "good"])

    def number(c: Column) -> Column:
        return F.sum(F.when(c, 1).otherwise(0)).cast("long")

    scored = rows.select("good", *NAMES).mapInArrow(score, "score double, good boolean")
    by_score = scored.groupBy("score").agg(number(F.col("good")).alias("good"), number(~F.col("good")).alias("bad"))
    sums = {"lost": F.col("good"), "caught": F.col("bad")}
    summed = stored(prefix_sums(by_score, [], [F.col("score").desc()], sums, partitions_of(rows), "quality-scores"), "quality-thresholds")
    n_good, n_bad = summed.agg(F.sum("good"), F.sum("bad")).first()
    gain = F.when(F.col("lost") <= good_lost * n_good, F.col("caught") / n_bad - F.col("lost") / n_good).otherwise(0.0)
    best = summed.select("score", gain.alias("gain")).orderBy(F.desc("gain"), F.desc("score")).first()
    if best["gain"] <= 0:
        return float("inf")
    # Halfway to the first row that stays.
    after = summed.where(F.col("score") < best["score"]).agg(F.max("score")).first()[0]
    return best["score"] if after is None else (best["score"] + after) / 2


def fit(docs: DataFrame, labels: DataFrame) -> Forest | None:
    """A forest of all labelled documents with a calibrated threshold; None if there is nothing to learn from."""
    rows = stored(labelled_rows(docs, labels), "quality-labelled")
    ends = [f(c).alias(f"{n}_{c}") for n, f in (("min", F.min), ("max", F.max)) for c in NAMES]
    kinds = {(r["teach"], r["good"]): r for r in rows.groupBy("teach", "good").agg(F.count(F.lit(1)).alias("n"), *ends).collect()}
    if len(kinds) < 4:
        return None
    good, taught = rows.where("teach and good"), kinds[True, True]
    low, high = exact_quantiles(good, NAMES, taught["n"], [TAIL, 1 - TAIL])
    far = np.array([[taught[f"{n}_{c}"] for c in NAMES] for n in ("min", "max")])
    trees = random_trees(np.zeros(len(NAMES)), outside(far, low, high).max(axis=0), least=1.0)
    trees.low, trees.high = low, high
    forest = grown(trees, counted(good, trees))
    forest.threshold = calibrated_on(rows.where("not teach"), forest)
    return forest


def learned(x: np.ndarray, good: np.ndarray, judged_rows: np.ndarray, teach: np.ndarray | None = None) -> Forest | None:
    """What :func:`fit` learns, from labelled rows in memory: ``teach`` (else every second row that it will judge) teaches, the others calibrate."""
    if teach is None:
        teach = np.cumsum(judged_rows) % 2 == 1
    x, good, teach = x[judged_rows], good[judged_rows], teach[judged_rows]
    if not all(g.any() and not g.all() for g in (good[teach], good[~teach])):
        return None
    low, high = np.quantile(x[teach][good[teach]], [TAIL, 1 - TAIL], axis=0)
    forest = grow_forest(outside(x[teach][good[teach]], low, high), least=1.0)
    forest.low, forest.high = low, high
    forest.threshold = calibrated(forest.judge(x[~teach]), good[~teach])
    return forest


def judged(texts: pa.Array, forest: Forest | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(statistics, base_failed, score, kept) of each text."""
    stats = statistics(texts)
    failed = base_failed(stats)
    if forest is None:
        scores = np.zeros(len(stats))
        return stats, failed, scores, ~failed
    scores = forest.judge(features(texts, stats))
    return stats, failed, scores, ~failed & (scores < forest.threshold)


def quality_rules(docs: DataFrame, forest: Forest | None) -> DataFrame:
    """doc_id, the statistics, base_failed, anomaly score and kept: one row per document."""

    def judge(part: pa.RecordBatch) -> pa.RecordBatch:
        stats, failed, scores, kept = judged(part.column("text"), forest)
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id"), *[pa.array(stats[:, k].copy()) for k in range(stats.shape[1])], pa.array(failed), pa.array(kept), pa.array(scores)],
            ["doc_id", *STATISTICS, "base_failed", "kept", "anomaly"],
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(f"{c} long" for c in STATISTICS) + ", base_failed boolean, kept boolean, anomaly double"
    return per_batch(docs.select("doc_id", "text"), "text", judge, schema)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that neither the base rules nor the forest reject."""
    forest = fit(docs, labels)

    def keep(part: pa.RecordBatch) -> pa.RecordBatch:
        return part.filter(pa.array(judged(part.column("text"), forest)[3]))

    plain = plain_names(docs)
    return per_batch(plain, "text", keep, plain.schema).toDF(*docs.columns)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_rules(docs, fit(docs, table(spark, sf_dir, "labels")))
