"""End-to-end: the two jobs on micro CSV extracts (FIXTURES.md §2 rows)."""

import pytest

from storefront_etl.plans.jobs import PipelinePaths, main, prepare_postcodes, run_pipeline

RAW = {
    "postcode_ranges": "locality,postcode_range,extra\n"
                       "Alpha,01000-000 a 01003-999,1\n"
                       "Beta,01003-500 a 01004-999,2\n"
                       "Gamma,01003-000 a 01000-999,3\n",
    "customers": "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"
                 "c1,u1,01003,sp city,SP\nc2,u2,09999,nowhere,XX\nc3,u3,abc,junk,\n",
    "geolocation": "geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,geolocation_city,geolocation_state\n"
                   "01004,-23.5,-46.6,Raw City,SP\n09999,x,1,São Paulo,RJ\n",
    "order_items": "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"
                   "o1,1,p1,s1,2017-09-19 09:45:35,58.90,13.29\no2,1,p2,s2,bad,x,\n",
    "order_payments": "order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
                      "o1,1,credit_card,2.0,72.19\no2,x,boleto,-1.9,abc\n",
    "order_reviews": 'review_id,order_id,review_score,review_comment_message,review_creation_date\n'
                     'r1,o1,4,"veio ""certo"", mas\ntarde",2018-01-18 00:00:00\n',
    "orders": "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,"
              "order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date\n"
              "o1,c1,delivered,2017-10-02 23:59:00,2017-10-03 00:01:00,2017-10-04 19:55:00,"
              "2017-10-10 21:25:13,2017-10-18 00:00:00\n"
              "o2,c2,canceled,,,,,2017-02-30\n",
    "products": "product_id,product_category_name,product_name_lenght,product_description_lenght,"
                "product_photos_qty,product_weight_g,product_length_cm,product_height_cm,product_width_cm\n"
                "p1,Perfumaria,40,287,1,650,20,10.0,14\np2,,x,,,,,,\n",
    "sellers": "seller_id,seller_zip_code_prefix,seller_city,seller_state\n"
               "s1,01000,whatever,SP\ns2,09999,Campinas,BA\n",
}
DICTIONARY = "﻿product_category_name,product_category_name_english\nperfumaria,perfumery\npcs,computers"


@pytest.fixture(scope="module")
def outputs(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("pipeline")
    files = {}
    for name, text in RAW.items():
        p = base / f"{name}.csv"
        p.write_text(text, encoding="utf-8")
        files[name] = str(p)
    dictionary = base / "product_category.csv"
    dictionary.write_text(DICTIONARY, encoding="utf-8")
    postcodes = prepare_postcodes(spark, files["postcode_ranges"], str(base / "ceps.parquet"))
    paths = PipelinePaths(
        customers=files["customers"], geolocation=files["geolocation"],
        order_items=files["order_items"], order_payments=files["order_payments"],
        order_reviews=files["order_reviews"], orders=files["orders"], products=files["products"],
        sellers=files["sellers"], product_category=str(dictionary), postcodes=postcodes,
    )
    written = run_pipeline(spark, paths, str(base / "processed"))
    return {name: spark.read.parquet(path) for name, path in written.items()} | {
        "postcodes": spark.read.parquet(postcodes)}


def test_postcode_table(outputs):
    rows = sorted(tuple(r) for r in outputs["postcodes"].collect())
    assert rows == [("Alpha", "1000"), ("Alpha", "1001"), ("Alpha", "1002"), ("Alpha", "1003"),
                    ("Beta", "1003"), ("Beta", "1004")]


def test_nine_tables_written(outputs):
    assert {"customers", "geolocation", "order_items", "order_payments", "order_reviews",
            "orders", "products", "sellers", "product_category"} <= set(outputs)


def test_customers(outputs):
    df = outputs["customers"]
    assert df.columns == ["customer_id", "customer_unique_id", "customer_zip_code_prefix",
                          "customer_city", "customer_state", "customer_region"]
    rows = sorted(tuple(r) for r in df.collect())
    assert rows == [
        ("c1", "u1", "01003", "alpha", "sp", "sudeste"),
        ("c1", "u1", "01003", "beta", "sp", "sudeste"),
        ("c2", "u2", "09999", None, "xx", "sul"),
        ("c3", "u3", "abc", None, None, "sul"),
    ]


def test_geolocation_falls_back_to_raw_city(outputs):
    df = outputs["geolocation"]
    assert df.dtypes == [("geolocation_zip_code_prefix", "string"), ("geolocation_lat", "double"),
                         ("geolocation_lng", "double"), ("geolocation_city", "string"),
                         ("geolocation_state", "string")]
    rows = sorted(tuple(r) for r in df.collect())
    assert rows == [("01004", -23.5, -46.6, "beta", "sp"), ("09999", None, 1.0, "São Paulo", "rj")]


def test_sellers_fall_back_to_lowercased_city(outputs):
    rows = sorted(tuple(r) for r in outputs["sellers"].collect())
    assert rows == [("s1", "01000", "alpha", "sp", "sudeste"),
                    ("s2", "09999", "campinas", "ba", "nordeste")]


def test_typed_tables(outputs):
    items = {r.order_id: r for r in outputs["order_items"].collect()}
    assert abs(items["o1"].price - 58.9) < 1e-4 and items["o2"].price is None
    assert items["o2"].shipping_limit_date is None
    assert dict(outputs["order_items"].dtypes)["price"] == "float"
    pays = {r.order_id: r for r in outputs["order_payments"].collect()}
    assert (pays["o1"].payment_sequential, pays["o1"].payment_installments) == (1, 2)
    assert (pays["o2"].payment_sequential, pays["o2"].payment_installments) == (None, -1)
    assert pays["o2"].payment_value is None


def test_orders_features(outputs):
    df = outputs["orders"]
    assert df.columns[-7:] == ["order_day_of_week", "order_name_day_of_week", "order_month",
                               "order_name_month", "order_delivery_days", "order_hour",
                               "order_processing_days"]
    o = {r.order_id: r for r in df.collect()}
    assert (o["o1"].order_day_of_week, o["o1"].order_name_day_of_week) == (2, "monday")
    assert (o["o1"].order_month, o["o1"].order_name_month, o["o1"].order_hour) == (10, "october", 23)
    assert (o["o1"].order_delivery_days, o["o1"].order_processing_days) == (8, 1)
    assert o["o2"].order_purchase_timestamp is None
    assert (o["o2"].order_name_day_of_week, o["o2"].order_name_month) == ("saturday", "december")
    assert o["o2"].order_estimated_delivery_date is None
    assert dict(df.dtypes)["order_estimated_delivery_date"] == "date"


def test_products_units(outputs):
    p = {r.product_id: r for r in outputs["products"].collect()}
    assert p["p1"].product_category_name == "perfumaria"
    assert (p["p1"].product_weight_kg, p["p1"].product_length_m, p["p1"].product_height_m) == (0.65, 0.2, 0.1)
    assert p["p2"].product_weight_kg is None and p["p2"].product_name_lenght is None


def test_category_and_reviews(outputs):
    cats = {r.product_category_name: r.sub_product_category for r in outputs["product_category"].collect()}
    assert cats == {"perfumaria": "beleza e saude", "pcs": "eletronicos e tecnologia"}
    review = outputs["order_reviews"].first()
    assert review.review_comment_message == 'veio "certo", mas\ntarde'
    assert review.review_creation_date == "2018-01-18 00:00:00"


def test_cli_rejects_wrong_arguments():
    with pytest.raises(ValueError):
        main(["pipeline", "only-one-path"])
    with pytest.raises(ValueError):
        main([])


def test_job_description_is_set_on_the_calling_thread(spark):
    from storefront_etl.plans.jobs import _describe_jobs

    _describe_jobs(spark, "storefront-etl: table x")
    try:
        assert spark.sparkContext.getLocalProperty("spark.job.description") == "storefront-etl: table x"
    finally:
        spark.sparkContext.setJobDescription(None)


def test_write_tables_reports_failures_after_other_writes(spark, tmp_path):
    from pyspark.sql import functions as F

    from storefront_etl.sources.parquet import write_tables

    good = spark.range(5)
    bad = spark.range(5).select(F.raise_error(F.lit("boom")).alias("x"))
    with pytest.raises(Exception, match="boom"):
        write_tables({"good": good, "bad": bad}, str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "good.parquet")).count() == 5
