"""A training corpus from ``documents``: filter, clean, dedup, mix, tokenize.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and gives a DataFrame, which is written as Parquet and read again as the next
one's ``docs``; then the scratch tables behind it are dropped.  All but the
last return the columns of ``documents``.

1. quality rules: documents that the base rules or the forest reject go;
2. line dedup: lines of recurring templates go, documents stay;
3. near dedup: of each group linked by n-gram Jaccard one document stays;
4. mixing: documents are repeated or left out to meet the sources' targets;
5. byte-level BPE: token ids and the digests of ids and of the decoded text.

Groups of near copies keep their lines in stage 2, which takes no evidence from
them, so that stage 3 sees them whole.  A stage keeps to its operator's defined
results for nulls, empty and repeated rows; empty documents that line dedup leaves are kept until mixing, where a
document without words is not limited but has no weight in the targets.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from storefront_etl.llm import byte_bpe, jaccard_join, line_templates, mixing, quality
from storefront_etl.llm.common import stored, table
from storefront_etl.sources.parquet import drop_scratch, given_scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Not SQL: the forest, components and byte-pair merges.
ORACLE_SQL = None


# Scratch tables of the stage before, which are not needed once its rows are written.
_left: list[str] = []


def _stage(fn: Stage) -> Stage:
    """``fn``, which first drops the scratch tables of the stage called before it."""

    @functools.wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        drop_scratch(spark, _left)
        before = set(given_scratch())
        out = fn(spark, docs, sf_dir)
        _left[:] = [path for path in given_scratch() if path not in before]
        return out

    return run_stage


@_stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


@_stage
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_templates.drop_recurring_lines(docs)


@_stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one(docs)


@_stage
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(docs)


@_stage
def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return byte_bpe.encode_documents(docs, *byte_bpe.public_vocabulary())


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mix", mix),
    ("tokenize", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows.  A stage's rows are dropped when the next one's are written."""
    docs = table(spark, sf_dir, "documents")
    written: list[str] = []
    for name, stage in STAGES[:-1]:
        made = stage(spark, docs, sf_dir)
        before = set(given_scratch())
        docs = stored(made, f"stage-{name}")
        drop_scratch(spark, written)
        written = [path for path in given_scratch() if path not in before]
    return STAGES[-1][1](spark, docs, sf_dir)
