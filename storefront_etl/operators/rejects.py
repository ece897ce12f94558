"""A reject channel: rows that are not what the extract promises go to a table of their own.

The lenient casts turn junk into NULL, and a row with shifted fields into a
row of NULLs; nobody sees how many.  Here every row is either typed or
rejected, with the file it came from and the reason: ``fields`` for a record
that has more or fewer fields than the extract, else the columns whose text
is no value of their type.  Missing text is no error.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storefront_etl.functions.casts import lenient_cast
from storefront_etl.operators._types import ref
from storefront_etl.sources.csv import ESCAPE, QUOTE

FIELDS = "fields"
_RECORD, _FILE, _REASON = "__reject_record", "__reject_file", "__reject_reason"


def read_csv_checked(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str], sep: str = ",", header: bool = True) -> DataFrame:
    """All fields of a plain extract as text, with each row's file and, if its number of fields is wrong, its record.

    ``columns`` are the names of all fields in their order (files whose
    header says otherwise are an error).  For :func:`typed_and_rejected`.
    """
    schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in [*columns, _RECORD])
    reader = spark.read.schema(schema).options(
        header=header, sep=sep, quote=QUOTE, escape=ESCAPE, mode="PERMISSIVE", columnNameOfCorruptRecord=_RECORD, enforceSchema=not header,
        # Pruned fields are not counted, so a wrong number would go unseen.
        columnPruning=False,
    )
    return reader.csv(path if isinstance(path, str) else list(path)).withColumn(_FILE, F.col("_metadata.file_path"))


def typed_and_rejected(raw: DataFrame, types: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """(typed, rejected) of a frame from :func:`read_csv_checked`; each of its rows is in one of them.

    ``typed`` has the columns of the extract, those in ``types`` cast
    leniently.  ``rejected`` has ``file``, ``reason`` (``fields`` or the names
    of the columns, joined by commas) and ``record`` (the text of the line, or
    the fields as JSON).  Both read the extract when used.
    """
    names = [c for c in raw.columns if c not in (_RECORD, _FILE)]
    unknown = sorted(set(types) - set(names))
    if unknown:
        raise ValueError(f"no such columns: {unknown}")
    failed = [F.when(_no_value(ref(c), lenient_cast(c, kind)), F.lit(c)) for c, kind in types.items()]
    columns = F.concat_ws(",", *failed) if failed else F.lit("")
    reason = F.when(F.col(_RECORD).isNotNull(), F.lit(FIELDS)).otherwise(F.nullif(columns, F.lit("")))
    flagged = raw.withColumn(_REASON, reason)
    typed = flagged.where(F.col(_REASON).isNull()).select(*[lenient_cast(c, types[c]).alias(c) if c in types else ref(c) for c in names])
    record = F.coalesce(F.col(_RECORD), F.to_json(F.struct(*[ref(c) for c in names])))
    rejected = flagged.where(F.col(_REASON).isNotNull()).select(F.col(_FILE).alias("file"), F.col(_REASON).alias("reason"), record.alias("record"))
    return typed, rejected


def _no_value(text: Column, value: Column) -> Column:
    return (F.btrim(text) != "") & value.isNull()


def reject_counts(rejected: DataFrame) -> DataFrame:
    """(file, reason, n): how many rows each file lost for which reason."""
    return rejected.groupBy("file", "reason").agg(F.count(F.lit(1)).alias("n"))
