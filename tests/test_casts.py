import datetime as dt

import pytest
from pyspark.sql import functions as F

from storefront_etl.functions.casts import lenient_cast, lenient_int, strict_int


def _one_col(spark, values, expr):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_lenient_int_accepts_old_cast_shapes(spark):
    values = ["650", "650.0", "-1.9", "+5", " 12 ", "00123", "5."]
    assert _one_col(spark, values, lenient_int) == [650, 650, -1, 5, 12, 123, 5]


def test_lenient_int_full_old_cast_parity(spark):
    values = [".5", ".", "-.5", "+.", "\t7", "7\n", "\x0b-3.25 ", "3000000000.5", "+", "1.5.5"]
    assert _one_col(spark, values, lenient_int) == [0, 0, 0, 0, 7, 7, -3, None, None, None]


def test_delete_character_is_trimmed_like_other_controls(spark):
    assert _one_col(spark, ["7\x7f", "\x7f7", "\x7f7.9\x00", "7\x7f7"], lenient_int) == [7, 7, 7, None]


def test_lenient_int_rejects_junk_without_raising(spark):
    values = ["1e2", "abc", "", "3000000000", "1.5x", "-", None]
    assert _one_col(spark, values, lenient_int) == [None] * len(values)


def test_strict_int_rejects_fractions(spark):
    assert _one_col(spark, ["01000", " 7 ", "\t8\n", "1.0", "x"], strict_int) == [1000, 7, 8, None, None]


def test_lenient_timestamp(spark):
    values = ["2017-10-02 10:56:33", "2017-10-02", "2017-02-30", "x", ""]
    got = _one_col(spark, values, lambda c: lenient_cast(c, "timestamp"))
    assert got == [dt.datetime(2017, 10, 2, 10, 56, 33), dt.datetime(2017, 10, 2), None, None, None]


def test_lenient_date_and_float(spark):
    assert _one_col(spark, ["2018-01-02", "2018-13-01"], lambda c: lenient_cast(c, "date")) == [
        dt.date(2018, 1, 2), None]
    got = _one_col(spark, ["12.5", " 1e2 ", "n/a"], lambda c: lenient_cast(c, "float"))
    assert got == [12.5, 100.0, None]


def test_lenient_cast_int_uses_truncating_rule(spark):
    assert _one_col(spark, ["650.0"], lambda c: lenient_cast(c, "int")) == [650]


@pytest.mark.parametrize("ansi", ["true"])
def test_session_is_ansi_and_plain_cast_would_raise(spark, ansi):
    assert spark.conf.get("spark.sql.ansi.enabled") == ansi
    with pytest.raises(Exception):
        spark.createDataFrame([("abc",)], "v string").select(F.col("v").cast("int")).collect()


def test_lenient_float_keeps_special_literals(spark):
    import math

    got = _one_col(spark, ["NaN", " inf ", "-Infinity", "n/a", "", "1d", "0x1p3"],
                   lambda c: lenient_cast(c, "double"))
    assert math.isnan(got[0]) and got[1] == float("inf") and got[2] == float("-inf")
    assert got[3:5] == [None, None]
    plain = _one_col(spark, ["1d", "0x1p3"], lambda c: c.try_cast("double"))
    assert got[5:] == plain
