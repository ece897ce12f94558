import pytest

from storefront_etl.streaming import start_table_stream


def test_customers_stream_matches_batch_semantics(spark, tmp_path):
    dim = spark.createDataFrame([("Alpha", "1003"), ("Beta", "1003")], "locality string, cep_prefix string")
    src = tmp_path / "in"
    src.mkdir()
    header = "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"
    (src / "part1.csv").write_text(header + "c1,u1,01003,x,SP\n", encoding="utf-8")
    (src / "part2.csv").write_text(header + "c2,u2,09999,y,BA\n", encoding="utf-8")
    out = str(tmp_path / "out")
    q = start_table_stream(spark, "customers", str(src), out, postcodes=dim,
                           checkpoint=str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    rows = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    assert rows == [
        ("c1", "u1", "01003", "alpha", "sp", "sudeste"),
        ("c1", "u1", "01003", "beta", "sp", "sudeste"),
        ("c2", "u2", "09999", None, "ba", "nordeste"),
    ]


def test_orders_stream_adds_calendar(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "o.csv").write_text(
        "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,"
        "order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date\n"
        "o1,c1,delivered,2017-10-01 10:00:00,2017-10-02 00:00:00,,2017-10-05 00:00:00,2017-10-20\n",
        encoding="utf-8")
    out = str(tmp_path / "out")
    q = start_table_stream(spark, "orders", str(src), out, checkpoint=str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    r = spark.read.parquet(out).first()
    assert (r.order_day_of_week, r.order_name_day_of_week, r.order_delivery_days, r.order_hour) == (
        1, "sunday", 4, 10)


def test_reviews_stream_reads_multiline_text(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "r.csv").write_text(
        "review_id,order_id,review_score,review_comment_message,review_creation_date\n"
        'r1,o1,4,"veio ""certo"", mas\ntarde",2018-01-18 00:00:00\n', encoding="utf-8")
    out = str(tmp_path / "out")
    columns = ["review_id", "order_id", "review_score", "review_comment_message", "review_creation_date"]
    q = start_table_stream(spark, "order_reviews", str(src), out, columns=columns,
                           checkpoint=str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    rows = spark.read.parquet(out).collect()
    assert len(rows) == 1 and rows[0].review_comment_message == 'veio "certo", mas\ntarde'


def test_stream_refuses_a_dimension_that_is_too_large_to_broadcast(spark, tmp_path):
    from storefront_etl.plans.tables import postcode_lookup

    dim = spark.createDataFrame([("Alpha", "1003"), ("Beta", "1003")], "locality string, cep_prefix string")
    prepared = postcode_lookup(dim, broadcast_max_rows=0)
    assert not prepared.broadcast
    src = tmp_path / "in"
    src.mkdir()
    with pytest.raises(ValueError, match="broadcast"):
        start_table_stream(spark, "sellers", str(src), str(tmp_path / "out"), postcodes=prepared)


def test_restart_without_naming_a_checkpoint_keeps_every_file(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    out = str(tmp_path / "out")
    header = "order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
    for name in ("o1", "o2", "o3"):
        (src / f"{name}.csv").write_text(header + f"{name},1,card,2,3.5\n", encoding="utf-8")
        start_table_stream(spark, "order_payments", str(src), out).awaitTermination(120)
    assert sorted(r.order_id for r in spark.read.parquet(out).collect()) == ["o1", "o2", "o3"]


def test_stream_refuses_swapped_headers(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.csv").write_text(
        "payment_sequential,order_id,payment_type,payment_installments,payment_value\n1,o1,card,2,3.5\n", encoding="utf-8")
    query = start_table_stream(spark, "order_payments", str(src), str(tmp_path / "out"))
    with pytest.raises(Exception, match="FAILED_READ_FILE|CSV header"):
        query.awaitTermination(120)
