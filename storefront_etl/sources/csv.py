"""CSV extracts as all-string DataFrames, and CSV output.

Readers never infer types: every column is text and typing is done later
by explicit lenient casts.  Plain extracts are splittable and read in
parallel by byte range.  Free-text extracts (reviews) need RFC-4180 reading
(doubled quotes inside quoted fields, line breaks inside fields); they are
read by byte range as well, see :mod:`storefront_etl.sources.quoted_csv`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from storefront_etl.sources.quoted_csv import read_quoted_csv

# RFC-4180 quoting (a quote inside a quoted field is doubled).
QUOTE = '"'
ESCAPE = '"'


def read_csv_strings(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str] | None = None,
    sep: str = ",",
    multi_line: bool = False,
    encoding: str = "UTF-8",
) -> DataFrame:
    """Header CSV -> all-string DataFrame, optionally projected to ``columns``.

    ``columns`` are selected by header name (a missing one fails analysis),
    and the projection is pushed into the CSV scan.  Every file's header must
    name the same columns in the same order: Spark checks it and fails on a
    file that doesn't, rather than read its fields by position.  A UTF-8
    byte-order mark at the start of the file is dropped by the reader.

    A quote inside a quoted field is doubled, in every extract; a backslash
    is an ordinary character.  (The original reads took a backslash as the
    escape in all tables but this loses a field that ends in one; a quote
    written as backslash-quote keeps its backslash here.)
    """
    reader = (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("sep", sep)
        .option("encoding", encoding)
        .option("quote", QUOTE)
        .option("escape", ESCAPE)
        .option("multiLine", multi_line)
        .option("enforceSchema", False)
    )
    df = reader.csv(path if isinstance(path, str) else list(path))
    return df.select(*columns) if columns is not None else df


def read_reviews(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str] | None = None,
    raw: bool = False,
    split: bool = True,
) -> DataFrame:
    """Free-text extract (e.g. order reviews) read as RFC-4180 CSV.

    Files of any size are read by their splits (:mod:`.quoted_csv`).
    ``split=False`` uses Spark's ``multiLine`` reader instead, which takes a
    whole file in one task but lets a quote stand inside an unquoted field.

    ``raw=True`` reproduces the original default-option read, in which a
    doubled quote or a line break inside a message shifts columns.
    """
    if raw:
        df = spark.read.csv(path if isinstance(path, str) else list(path), header=True)
        return df.select(*columns) if columns is not None else df
    if split:
        return read_quoted_csv(spark, path, columns=columns)
    return read_csv_strings(spark, path, columns=columns, multi_line=True)


def read_category_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Category name -> English name dictionary (BOM-prefixed UTF-8)."""
    return read_csv_strings(
        spark, path, columns=("product_category_name", "product_category_name_english")
    )


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite") -> None:
    """Write a header CSV directory that :func:`read_reviews` reads back exactly.

    Every field is quoted with doubled inner quotes, and leading/trailing
    spaces are kept (Spark's writer trims them by default).  CSV has a single
    spelling for "no text", so empty text and NULL both read back as NULL
    (the reader's default, which the original job's reads also had).
    """
    (
        df.write.mode(mode)
        .option("header", True)
        .option("sep", sep)
        .option("quote", QUOTE)
        .option("escape", ESCAPE)
        .option("quoteAll", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
