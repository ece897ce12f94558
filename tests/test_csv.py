import random

import pytest

from storefront_etl.sources import quoted_csv
from storefront_etl.sources.csv import read_csv_strings, read_reviews, write_csv
from storefront_etl.sources.quoted_csv import scanned_lines

REVIEWS = (
    'review_id,review_score,review_comment_title,review_comment_message,review_creation_date\n'
    '"b","4","x","veio ""certo"", mas tarde","2018-01-02"\n'
    '"c","5","y","linha um\nlinha dois","2018-01-03"\n'
)


def test_reviews_rfc4180(spark, tmp_path):
    path = tmp_path / "reviews.csv"
    path.write_text(REVIEWS, encoding="utf-8")
    df = read_reviews(spark, str(path))
    rows = sorted(tuple(r) for r in df.collect())
    assert rows == [
        ("b", "4", "x", 'veio "certo", mas tarde', "2018-01-02"),
        ("c", "5", "y", "linha um\nlinha dois", "2018-01-03"),
    ]
    assert all(t == "string" for _, t in df.dtypes)


def test_reviews_raw_read_shifts_columns(spark, tmp_path):
    path = tmp_path / "reviews.csv"
    path.write_text(REVIEWS, encoding="utf-8")
    raw = read_reviews(spark, str(path), raw=True)
    dates = {r.review_creation_date for r in raw.collect()}
    assert dates != {"2018-01-02", "2018-01-03"}


def test_write_then_read_keeps_spaces_quotes_and_empty(spark, tmp_path):
    df = spark.createDataFrame(
        [("1", "  padded  "), ("2", 'a "q", b\nc'), ("3", ""), ("4", None)], "id string, text string")
    out = str(tmp_path / "out")
    write_csv(df, out)
    back = sorted(tuple(r) for r in read_reviews(spark, out).collect())
    # CSV has one spelling for "no text": empty text and NULL both read back as NULL.
    assert back == [("1", "  padded  "), ("2", 'a "q", b\nc'), ("3", None), ("4", None)]


def test_all_strings_with_separator_and_projection(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("a;b;c\n1;2.5;z\n", encoding="utf-8")
    df = read_csv_strings(spark, str(path), columns=["c", "a"], sep=";")
    assert df.dtypes == [("c", "string"), ("a", "string")]
    assert tuple(df.first()) == ("z", "1")


def test_bom_is_dropped_in_both_read_modes(spark, tmp_path):
    path = tmp_path / "bom.csv"
    path.write_text('﻿review_id,msg\nr1,"a\nb"\n', encoding="utf-8")
    assert read_reviews(spark, str(path)).columns == ["review_id", "msg"]
    assert read_csv_strings(spark, str(path), multi_line=False).columns == ["review_id", "msg"]


def test_files_with_differing_header_order_are_refused(spark, tmp_path):
    folder = tmp_path / "x"
    folder.mkdir()
    (folder / "1.csv").write_text("a,b\n1,2\n3,4\n", encoding="utf-8")
    (folder / "2.csv").write_text("b,a\n2,1\n", encoding="utf-8")
    with pytest.raises(Exception, match="FAILED_READ_FILE|CSV header"):
        read_csv_strings(spark, str(folder)).collect()


def test_backslash_is_an_ordinary_character(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text('a,b\n"x\\",1\nc:\\d,2\n"say ""hi""",3\n', encoding="utf-8")
    rows = {r.b: r.a for r in read_csv_strings(spark, str(path)).collect()}
    assert rows == {"1": "x\\", "2": "c:\\d", "3": 'say "hi"'}


@pytest.fixture
def small_splits(spark):
    """Files are read in splits of 300 bytes."""
    was = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", 300)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    yield
    for k, v in was.items():
        spark.conf.set(k, v)


def quoted(field):
    return '"' + field.replace('"', '""') + '"'


def odd_fields(seed, n):
    rng = random.Random(seed)
    parts = ['"', ",", "\n", "\r\n", "\r", " ", "ab", "é", "\\", '","', '"\n"', "\n\n", "x" * 40]
    return [(str(k), "".join(rng.choice(parts) for _ in range(rng.choice([0, 1, 3, 9, 80]))), rng.choice(["plain", "", "z z"])) for k in range(n)]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_a_free_text_file_is_read_by_splits(spark, tmp_path, small_splits, end):
    """Many tasks for one file, and the rows of Spark's whole-file reader (but that line breaks in fields stay as they are)."""
    for name, seed in (("1.csv", 1), ("2.csv", 2)):
        lines = [f"{k},{quoted(t)},{p}" for k, t, p in odd_fields(seed, 90)]
        lines[7] = "7,only two"
        lines[9] = '"9","long ' + "y\n" * 900 + '",q'  # covers several splits as a whole
        text = "id,text,note" + end + end.join(lines) + (end if seed == 1 else "")
        (tmp_path / name).write_bytes(("\ufeff" if seed == 2 else "").encode() + text.encode())
    df = read_reviews(spark, str(tmp_path))
    whole = read_reviews(spark, str(tmp_path), split=False)
    assert df.columns == whole.columns == ["id", "text", "note"]
    same = lambda r: (r["id"], None if r["text"] is None else r["text"].replace("\r", "") if end == "\r\n" else r["text"], r["note"])
    got, want = (sorted(map(same, x.collect()), key=str) for x in (df, whole))
    assert got == want and len(got) == 180
    assert scanned_lines(spark, str(tmp_path)).rdd.getNumPartitions() > 20
    if end == "\n":
        narrow = read_reviews(spark, str(tmp_path), columns=["note", "id"])
        assert narrow.columns == ["note", "id"] and sorted(map(str, narrow.collect())) == sorted(map(str, whole.select("note", "id").collect()))


def test_more_splits_than_are_broadcast(spark, tmp_path, small_splits, monkeypatch):
    (tmp_path / "x.csv").write_text("id,text,note\n" + "\n".join(f"{k},{quoted(t)},{p}" for k, t, p in odd_fields(3, 60)), newline="")
    monkeypatch.setattr(quoted_csv, "BROADCAST_SPLITS", 0)
    got = sorted(map(str, read_reviews(spark, str(tmp_path)).collect()))
    assert got == sorted(map(str, read_reviews(spark, str(tmp_path), split=False).collect()))


@pytest.mark.parametrize("text, message", [
    ('a,b\n1,5" pipe\n2,7" pipe\n', "inside an unquoted field"),
    ('a,b\n1,"x" y\n', "inside an unquoted field"),
    ('a,b\n1,"never closed\n2,x\n', "ends inside a quoted field"),
])
def test_text_that_is_not_rfc4180_is_an_error(spark, tmp_path, text, message):
    path = tmp_path / "x.csv"
    path.write_text(text, newline="")
    with pytest.raises(Exception, match=message):
        read_reviews(spark, str(path)).collect()
    read_reviews(spark, str(path), split=False).collect()


def test_free_text_files_with_other_headers_are_refused(spark, tmp_path):
    (tmp_path / "1.csv").write_text('"a",b\n1,"2\n"\n')
    (tmp_path / "2.csv").write_text("a,b\n3,4\n")
    assert sorted(map(tuple, read_reviews(spark, str(tmp_path)).collect())) == [("1", "2\n"), ("3", "4")]
    (tmp_path / "3.csv").write_text("b,a\n3,4\n")
    with pytest.raises(Exception, match="CSV header differs"):
        read_reviews(spark, str(tmp_path)).collect()


def test_the_text_is_not_shuffled(spark, tmp_path, small_splits):
    """Only the pieces at split boundaries are, in their own branch; without any there is no shuffle."""
    def plan():
        return read_reviews(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()

    (tmp_path / "x.csv").write_text("id,text,note\n1,a,b\n")
    assert "Exchange hashpartitioning" not in plan() and "Union" not in plan() and "BroadcastHashJoin" in plan()
    (tmp_path / "x.csv").write_text("id,text,note\n" + "\n".join(f"{k},{quoted(t)},{p}" for k, t, p in odd_fields(3, 60)), newline="")
    whole, crossing = plan().split("Union", 1)[1].split("MapInArrow", 2)[1:]
    assert "FileScan text" in whole and "Exchange hashpartitioning" not in whole
    assert "Exchange hashpartitioning" in crossing and "FileScan text" not in crossing
