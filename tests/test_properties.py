"""Property checks against pure-Python models (batched: one Spark job per example)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from storefront_etl.functions.casts import lenient_int
from storefront_etl.operators.postcode import expand_postcode_ranges

INT_MIN, INT_MAX = -(2**31), 2**31 - 1


def old_cast_int(s):
    """Model of the non-ANSI text -> INT cast the original job relied on."""
    if s is None:
        return None
    t = s.strip("".join(chr(i) for i in range(0x21)))
    if not t:
        return None
    i, negative = 0, False
    if t[0] in "+-":
        negative, i = t[0] == "-", 1
        if len(t) == 1:
            return None
    value = 0
    while i < len(t):
        c = t[i]
        i += 1
        if c == ".":
            if any(not ("0" <= d <= "9") for d in t[i:]):
                return None
            break
        if not ("0" <= c <= "9"):
            return None
        value = value * 10 + int(c)
    value = -value if negative else value
    return value if INT_MIN <= value <= INT_MAX else None


text = st.one_of(
    st.none(),
    st.text(alphabet="0123456789+-. \t\n\x0bae", max_size=12),
    st.integers(min_value=-(2**33), max_value=2**33).map(str),
    st.floats(allow_nan=False, allow_infinity=False, width=32).map(str),
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(st.lists(text, min_size=50, max_size=300))
def test_lenient_int_matches_old_cast_model(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = {r.i: r.x for r in df.select("i", lenient_int("v").alias("x")).collect()}
    for i, v in enumerate(values):
        assert got[i] == old_cast_int(v), (v, got[i], old_cast_int(v))


ranges = st.tuples(st.integers(0, 99_999), st.integers(-5, 60)).map(
    lambda t: (t[0], min(99_999, t[0] + t[1])))


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(st.lists(ranges, min_size=1, max_size=60))
def test_expansion_matches_python_model(spark, bounds):
    rows = [(f"L{i}", f"{lo:05d}-000 a {hi:05d}-999") for i, (lo, hi) in enumerate(bounds)]
    df = spark.createDataFrame(rows, "locality string, postcode_range string")
    got = sorted(tuple(r) for r in expand_postcode_ranges(df).collect())
    want = sorted((f"L{i}", str(p)) for i, (lo, hi) in enumerate(bounds) for p in range(lo, hi + 1))
    assert got == want


def test_first_mode_keeps_left_row_count(spark):
    from storefront_etl.operators.lookup import lookup_dimension

    facts = spark.range(0, 2000).select(
        F.col("id"), F.format_string("%05d", F.col("id") % 300).alias("zip"))
    dim = spark.range(0, 900).select(
        F.format_string("L%d", F.col("id")).alias("locality"), (F.col("id") % 300).cast("string").alias("cep"))
    out = lookup_dimension(facts, dim, key="zip", dim_key="cep", dim_value="locality", out="city",
                           on_multiple="first")
    assert out.count() == 2000
    expanded = lookup_dimension(facts, dim, key="zip", dim_key="cep", dim_value="locality", out="city")
    assert expanded.count() == 2000 * 3


csv_tokens = list('ab ,"\n\r\t;\\é€') + ["ção", "\r\n", '""']
csv_text = st.lists(st.sampled_from(csv_tokens), min_size=1, max_size=30).map("".join)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(st.lists(csv_text, min_size=1, max_size=80))
def test_csv_roundtrip_keeps_text(spark, tmp_path_factory, texts):
    from storefront_etl.sources.csv import read_reviews, write_csv

    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "id string, text string")
    out = str(tmp_path_factory.mktemp("csvprop") / "out")
    write_csv(df, out)
    back = {r.id: r.text for r in read_reviews(spark, out).collect()}
    assert len(back) == len(texts)
    for i, t in enumerate(texts):
        assert back[str(i)] == t, (t, back[str(i)])


def _first_group(value, groups, default):
    for label, values in groups:
        if value in values:
            return label
    return default


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(st.lists(st.one_of(
    st.none(),
    st.sampled_from([v for _, g in __import__("storefront_etl").CATEGORY_GROUPS for v in g]),
    st.sampled_from(["ac", "sp", "rs", "df", "ba", "xx", "SP", "", "pcs ", "PCS"]),
    st.text(max_size=6)), min_size=20, max_size=200))
def test_labels_match_first_group_model(spark, values):
    from storefront_etl.functions.labels import (
        CATEGORY_GROUPS, REGION_GROUPS, category_group, region_of_state)

    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = {r.i: (r.c, r.r) for r in df.select("i", category_group("v").alias("c"),
                                               region_of_state("v").alias("r")).collect()}
    for i, v in enumerate(values):
        assert got[i] == (_first_group(v, CATEGORY_GROUPS, "outros"), _first_group(v, REGION_GROUPS, "sul"))


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(st.lists(st.one_of(st.none(), st.datetimes(
    min_value=__import__("datetime").datetime(1900, 1, 1),
    max_value=__import__("datetime").datetime(2100, 12, 31))), min_size=20, max_size=200))
def test_calendar_names_match_python(spark, stamps):
    from storefront_etl.functions.calendar import with_day_of_week, with_month

    df = spark.createDataFrame([(i, t) for i, t in enumerate(stamps)], "i int, ts timestamp_ntz")
    df = with_month(with_day_of_week(df, "ts", "d", "dn"), "ts", "m", "mn")
    got = {r.i: (r.d, r.dn, r.m, r.mn) for r in df.collect()}
    for i, t in enumerate(stamps):
        if t is None:
            assert got[i] == (None, "saturday", None, "december")
        else:
            sunday_first = (t.isoweekday() % 7) + 1
            assert got[i] == (sunday_first, t.strftime("%A").lower(), t.month, t.strftime("%B").lower())


float_text = st.one_of(
    st.none(),
    st.floats(allow_nan=True, allow_infinity=True).map(str),
    st.text(alphabet="0123456789+-.eE dDfFxXpPinINaAfty\t", max_size=12),
    st.sampled_from(["NaN", "-Infinity", " inf ", "+nan", "Infinity", "1d", "0x1p3", "", " ", "n/a"]),
)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(st.lists(float_text, min_size=30, max_size=300))
def test_guarded_float_cast_equals_plain_try_cast(spark, values):
    import math

    from storefront_etl.functions.casts import lenient_cast

    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    rows = df.select("i", lenient_cast("v", "double").alias("g"), F.col("v").try_cast("double").alias("p"),
                     lenient_cast("v", "float").alias("gf"), F.col("v").try_cast("float").alias("pf")).collect()

    def same(a, b):
        return (a is None and b is None) or (a is not None and b is not None and (
            a == b or (math.isnan(a) and math.isnan(b))))

    for r in rows:
        assert same(r.g, r.p) and same(r.gf, r.pf), (values[r.i], r)


zip_text = st.one_of(st.none(), st.sampled_from(["01003", "1003", " 01003 ", "01004", "1004.0", "09999",
                                                 "abc", "", "-", "1e3", "01005", "00000"]))
locality = st.sampled_from(["Alpha", "beta", "GAMMA", "Delta", None])


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(st.lists(st.tuples(zip_text, st.sampled_from(["x", "Y", None])), min_size=5, max_size=120),
       st.lists(st.tuples(locality, st.sampled_from(["1003", "1004", "1005", "0", "x", None])),
                min_size=1, max_size=12))
def test_lookup_matches_left_join_model(spark, facts, dims):
    from storefront_etl.operators.lookup import lookup_dimension

    fdf = spark.createDataFrame([(i, z, c) for i, (z, c) in enumerate(facts)], "i int, zip string, city string")
    ddf = spark.createDataFrame(dims, "locality string, cep string")
    parsed = [(old_cast_int(k), loc) for loc, k in dims]

    def model(mode):
        out = []
        for i, (z, c) in enumerate(facts):
            key = old_cast_int(z)
            hits = [loc for k, loc in parsed if key is not None and k == key]
            if mode == "first" and hits:
                present = [h for h in hits if h is not None]
                hits = [min(present) if present else None]
            for loc in hits or [None]:
                value = loc.lower() if loc is not None else None
                out.append((i, value if value is not None else (c.lower() if c is not None else None)))
        return sorted(out, key=repr)

    common = dict(key="zip", dim_key="cep", dim_value="locality", out="city",
                  value_transform=F.lower, fallback=F.lower(F.col("city")))
    for mode, extra in (("expand", {}), ("expand", {"broadcast_max_rows": 0, "rows_per_salt": 3}),
                        ("first", {})):
        got = lookup_dimension(fdf, ddf, on_multiple=mode, **common, **extra)
        rows = sorted(((r.i, r.city) for r in got.collect()), key=repr)
        assert rows == model(mode), (mode, extra)


profile_rows = st.lists(st.tuples(
    st.one_of(st.none(), st.integers(-3, 3)),
    st.one_of(st.none(), st.sampled_from(["a", "b", "", "A"])),
    st.one_of(st.none(), st.sampled_from([0.0, -0.0, 1.5, float("nan")])),
), min_size=1, max_size=80)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(profile_rows)
def test_profiles_match_python_model(spark, rows):
    import math

    from storefront_etl.operators.fill import fill_missing, fill_missing_by_union
    from storefront_etl.operators.profile import null_profile, profile_columns

    df = spark.createDataFrame(rows, "k int, s string, f double")

    def missing(v):
        return v is None or (isinstance(v, float) and math.isnan(v))

    def distinct(col):
        vals = {("nan" if isinstance(v, float) and math.isnan(v) else (0.0 if v == 0 else v))
                for v in col if v is not None}
        return len(vals)

    cols = list(zip(*rows))
    want = {name: (len(rows), sum(missing(v) for v in col), distinct(col))
            for name, col in zip(("k", "s", "f"), cols)}
    got = {r.column_name: (r.row_count, r.null_count, r.distinct_count) for r in profile_columns(df).collect()}
    assert got == want
    assert tuple(null_profile(df).first()) == tuple(want[c][1] for c in ("k", "s", "f"))
    one = fill_missing(df, "s", F.lit("z"))
    two = fill_missing_by_union(df, "s", F.lit("z"))
    assert one.exceptAll(two).count() == 0 and two.exceptAll(one).count() == 0


range_text = st.one_of(
    st.none(),
    st.tuples(st.integers(0, 99_999), st.integers(0, 99_999)).map(lambda t: f"{t[0]:05d}-000 a {t[1]:05d}-999"),
    st.sampled_from(["x a y", "01000-000", "", " a ", "01000 a 0100x", "01000-000 a 01002-999 a 9"]),
)


def _bounds_model(text):
    import re

    if text is None:
        return None
    parts = text.split(" a ")
    lo_txt = parts[0].split("-")[0].strip("".join(chr(i) for i in range(0x21)))
    hi_txt = (parts[1] if len(parts) > 1 else "").split("-")[0].strip("".join(chr(i) for i in range(0x21)))
    ok = re.fullmatch(r"[+-]?[0-9]+", lo_txt) and re.fullmatch(r"[+-]?[0-9]+", hi_txt)
    return (int(lo_txt), int(hi_txt)) if ok else None


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(range_text)
def test_fail_mode_raises_exactly_on_malformed(spark, text):
    import pytest

    df = spark.createDataFrame([("L", text)], "locality string, postcode_range string")
    bounds = _bounds_model(text)
    if bounds is None:
        with pytest.raises(Exception, match="malformed postcode range"):
            expand_postcode_ranges(df, on_invalid="fail").collect()
    else:
        lo, hi = bounds
        assert expand_postcode_ranges(df, on_invalid="fail").count() == max(0, hi - lo + 1)


stamp = st.one_of(st.none(), st.datetimes(min_value=__import__("datetime").datetime(1990, 1, 1),
                                          max_value=__import__("datetime").datetime(2030, 12, 31)))


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(st.lists(st.tuples(stamp, stamp), min_size=10, max_size=150))
def test_day_diff_matches_calendar_days(spark, pairs):
    from storefront_etl.functions.calendar import with_day_diff

    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, s timestamp_ntz, e timestamp_ntz")
    got = {r.i: r.d for r in with_day_diff(df, "e", "s", "d").collect()}
    for i, (a, b) in enumerate(pairs):
        want = None if a is None or b is None else (b.date() - a.date()).days
        assert got[i] == want
