"""Helpers shared by the training-data operators.

* ``documents`` / ``stored``: reading a table, cutting lineage with a Parquet
  table in the shared scratch folder (never a local checkpoint);
* ``per_batch``: Arrow batches through a function, in slices of bounded bytes;
* ``Words``: word spans and 64-bit word hashes of a whole slice with numpy;
* ``prefix_sums``: running sums within groups of any size, without gathering
  a group in one task.

A word is a maximal run of bytes other than space and ``\\t``..``\\r``; UTF-8
never uses those bytes inside a longer character, so bytes are enough.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from storefront_etl.sources.parquet import scratch_path

WORD = r"[^\x20\x09-\x0D]+"

# Text bytes handled at once by numpy code: its temporaries take some 40 times that.
SLICE_BYTES = 1 << 19

_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True

LOWER_AZ = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_WORD_BASE = 0xD1342543DE82EF95 | 1
_MASK = (1 << 64) - 1
_BYTE_VALUES = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_powers: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}


def quoted(name: str) -> Column:
    """A column by its literal name (dots and backticks included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole table (``<sf_dir>/<name>.parquet``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back.

    This cuts the lineage: what was computed is not computed again, and a
    lost executor costs only the tasks it was running.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh_name(df_columns: Sequence[str], wanted: str) -> str:
    """``wanted`` or a variant that clashes with no column (case-insensitively)."""
    taken = {c.lower() for c in df_columns}
    name = wanted
    while name.lower() in taken:
        name = "_" + name
    return name


def plain_names(df: DataFrame) -> DataFrame:
    """``df`` with names that Arrow functions take: columns with dots or backticks are renamed (by place, so undone by ``toDF``)."""
    names: list[str] = []
    for c in df.columns:
        names.append(c if not set(c) & {".", "`"} else fresh_name([*df.columns, *names], c.replace(".", "_").replace("`", "_")))
    return df.toDF(*names)


def scatter_partitions(total_bytes: int, per_partition: int, least: int) -> int:
    """Partitions so that each holds about ``per_partition`` bytes."""
    return max(least, -(-int(total_bytes) // per_partition))


# ---------------------------------------------------------------------------
# Arrow batches
# ---------------------------------------------------------------------------
def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets from 0) of a string column; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    if pa.types.is_large_string(texts.type):
        kind = np.int64
    else:
        texts, kind = texts.cast(pa.string()), np.int32
    _, offsets, data = texts.buffers()
    if len(texts) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    offs = np.frombuffer(offsets, dtype=kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, dtype=np.uint8)[offs[0] : offs[-1]]
    return raw, offs - offs[0]


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``limit`` text bytes (one row at least)."""
    _, offs = text_buffers(batch.column(text))
    lo, n = 0, batch.num_rows
    while lo < n:
        hi = int(np.searchsorted(offs, offs[lo] + limit, side="right")) - 1
        hi = min(n, max(lo + 1, hi))
        yield batch.slice(lo, hi - lo)
        lo = hi


def per_batch(
    df: DataFrame, text: str, f: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: T.StructType | str
) -> DataFrame:
    """``f`` over every slice of rows, in place (no shuffle, no order needed)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                out = f(part)
                if out is not None:
                    yield out

    return df.mapInArrow(run, schema)


# ---------------------------------------------------------------------------
# Words and hashes
# ---------------------------------------------------------------------------
def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n at least (base odd)."""
    size = 1 << max(12, (n - 1).bit_length())
    have = _powers.get((base, 0))
    if have is None or len(have[0]) < size:
        have = tuple(
            np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size - 1, b, dtype=np.uint64))])
            for b in (base, pow(base, -1, 1 << 64))
        )
        if size <= 1 << 21:
            _powers[(base, 0)] = have
    return have


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the entropy of 64-bit values over all their bits."""
    h = h ^ (h >> _U(32))
    h = h * _U(0xFF51AFD7ED558CCD)
    h ^= h >> _U(33)
    h *= _U(0xC4CEB9FE1A85EC53)
    h ^= h >> _U(29)
    return h


def range_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range (polynomial prefix sums, by chunks)."""
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        j = int(np.searchsorted(ends, starts[i] + SLICE_BYTES, side="right"))
        j = max(j, i + 1)
        a, b = int(starts[i]), int(ends[j - 1])
        up, down = powers(_BASE, b - a + 1)
        sums = np.zeros(b - a + 1, dtype=np.uint64)
        np.cumsum(_BYTE_VALUES[raw[a:b]] * up[: b - a], out=sums[1:])
        s, e = starts[i:j] - a, ends[i:j] - a
        out[i:j] = (sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64) * _U(0xA0761D6478BD642F)
        i = j
    return mixed(out)


class Words:
    """The words of a run of texts: ``starts``/``ends`` in ``raw``; text k has words ``first[k]:first[k + 1]``."""

    def __init__(self, texts: pa.Array, lower: bool = False):
        raw, self.offsets = text_buffers(texts)
        self.raw = np.frombuffer(raw.tobytes().translate(LOWER_AZ), dtype=np.uint8) if lower else raw
        inside = ~_SEPARATOR[self.raw]
        edge = np.zeros(len(raw) + 1, dtype=bool)
        edge[self.offsets] = True
        gap = np.ones(len(raw) + 1, dtype=bool)
        gap[1:] = ~inside
        self.starts = np.flatnonzero(inside & (gap[:-1] | edge[:-1]))
        gap[:-1] = ~inside
        gap[-1] = True
        self.ends = np.flatnonzero(inside & (gap[1:] | edge[1:])) + 1
        self.first = np.searchsorted(self.starts, self.offsets)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        return range_hashes(self.raw, self.starts, self.ends)

    def word(self, i: int) -> bytes:
        return self.raw[self.starts[i] : self.ends[i]].tobytes()

    def joined(self, keep: np.ndarray) -> bytes:
        """The words with these indices, joined by one space."""
        raw = self.raw
        return b" ".join([raw[s:e].tobytes() for s, e in zip(self.starts[keep], self.ends[keep], strict=True)])


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Rabin-Karp hash of every ``width`` consecutive word hashes."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    up, down = powers(_WORD_BASE, len(words) + 1)
    sums = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(words * up[: len(words)], out=sums[1:])
    return mixed((sums[width:] - sums[:n]) * down[:n])


def as_long(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64), pa.int64())


def lists(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from concatenated values and the length of each list."""
    offsets = np.zeros(len(lengths) + 1, dtype=np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


# ---------------------------------------------------------------------------
# Running sums within groups of any size
# ---------------------------------------------------------------------------
def prefix_sums(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], sums: dict[str, Column], partitions: int, name: str
) -> DataFrame:
    """``df`` with, per group, the sum of each value over the rows before and including each row.

    The rows are range-partitioned by (group, order), so a group that holds a
    third of all rows spreads over a third of the partitions; a partition's
    rows are added up where they are, and a group's partitions (at most
    ``partitions`` rows) give each one its starting offset.  Ties in
    ``order`` are in no fixed order.
    """
    part, key = fresh_name(df.columns, "part"), fresh_name(df.columns, "group_key")
    keyed = df.withColumn(key, F.struct(*[F.coalesce(quoted(g).cast("string"), F.lit("")).alias(f"g{i}") for i, g in enumerate(group)],
                                        *[quoted(g).isNull().alias(f"n{i}") for i, g in enumerate(group)], F.lit(0).alias("all")))
    placed = stored(
        keyed.repartitionByRange(partitions, F.col(key), *order).withColumn(part, F.spark_partition_id()), name
    )
    offsets = placed.groupBy(key, part).agg(*[F.sum(v).alias(f"{k}_here") for k, v in sums.items()])
    before = Window.partitionBy(key).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = offsets.select(
        key, part, *[F.coalesce(F.sum(f"{k}_here").over(before), F.lit(0)).alias(f"{k}_before") for k in sums]
    )
    within = Window.partitionBy(key, part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        placed.withColumns({f"{k}_within": F.sum(v).over(within) for k, v in sums.items()})
        .join(offsets, [key, part])
        .withColumns({k: F.col(f"{k}_within") + F.col(f"{k}_before") for k in sums})
        .drop(key, part, *[f"{k}_{x}" for k in sums for x in ("within", "before")])
    )
