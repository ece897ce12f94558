"""The reject channel: planted broken rows arrive with file and reason, and every row is in one place."""

from collections import Counter

import pytest

from storefront_etl.operators.rejects import read_csv_checked, reject_counts, typed_and_rejected

COLUMNS = ["id", "qty", "price", "when"]
TYPES = {"qty": "int", "price": "double", "when": "timestamp"}


def write(folder):
    (folder / "a.csv").write_text(
        'id,qty,price,when\n1,2.0,3.5,2018-01-02 03:04:05\n2,x,3.5,2018-01-02\n3,,,\n4,1,2\n5,1,2,2018-01-01,extra\n6,no,nope,never\n"7, ""q""",1,1,2018-01-01\n',
        encoding="utf-8")
    (folder / "b.csv").write_text("id,qty,price,when\n8,1,junk,2018-01-01\n9, 4 ,NaN,2018-01-01\n", encoding="utf-8")


def test_planted_rows(spark, tmp_path):
    write(tmp_path)
    typed, rejected = typed_and_rejected(read_csv_checked(spark, str(tmp_path), COLUMNS), TYPES)
    assert [t for _, t in typed.dtypes] == ["string", "int", "double", "timestamp"] and typed.columns == COLUMNS
    rows = {r["id"]: r for r in typed.collect()}
    assert sorted(rows) == ["1", "3", '7, "q"', "9"] and rows["1"]["qty"] == 2 and rows["3"]["price"] is None and rows["9"]["qty"] == 4
    bad = rejected.collect()
    assert Counter(r["reason"] for r in bad) == {"fields": 2, "qty": 1, "qty,price,when": 1, "price": 1}
    assert {r["record"] for r in bad if r["reason"] == "fields"} == {"4,1,2", "5,1,2,2018-01-01,extra"}
    assert [r["record"] for r in bad if r["reason"] == "price"] == ['{"id":"8","qty":"1","price":"junk","when":"2018-01-01"}']
    assert len(bad) + len(rows) == 9
    # Narrow uses of either side see the same rows (no field is pruned from the check).
    assert typed.select("id").count() == 4 and rejected.select("reason").count() == 5
    by_file = {(r["file"].rsplit("/", 1)[1], r["reason"]): r["n"] for r in reject_counts(rejected).collect()}
    assert by_file[("a.csv", "fields")] == 2 and by_file[("b.csv", "price")] == 1 and sum(by_file.values()) == 5


def test_headers_and_names(spark, tmp_path):
    write(tmp_path)
    with pytest.raises(ValueError, match="no such columns"):
        typed_and_rejected(read_csv_checked(spark, str(tmp_path), COLUMNS), {"x": "int"})
    with pytest.raises(Exception, match="FAILED_READ_FILE|CSV header"):
        read_csv_checked(spark, str(tmp_path), ["id", "price", "qty", "when"]).collect()
    plain = tmp_path / "plain"
    plain.mkdir()
    (plain / "x.csv").write_text("1;2\n3\n")
    typed, rejected = typed_and_rejected(read_csv_checked(spark, str(plain), ["a.b", "c"], sep=";", header=False), {})
    assert [tuple(r) for r in typed.collect()] == [("1", "2")] and [r["record"] for r in rejected.collect()] == ["3"]
