import datetime as dt


from storefront_etl.functions.calendar import with_day_diff, with_day_of_week, with_hour, with_month
from storefront_etl.functions.units import convert_units


def test_weekday_and_month_with_null(spark):
    df = spark.createDataFrame([(dt.datetime(2017, 10, 1, 13, 5),), (None,)], "ts timestamp")
    df = with_day_of_week(df, "ts", "dow", "dow_name")
    df = with_month(df, "ts", "m", "m_name")
    df = with_hour(df, "ts", "h")
    rows = [tuple(r)[1:] for r in df.collect()]
    assert rows[0] == (1, "sunday", 10, "october", 13)
    assert rows[1] == (None, "saturday", None, "december", None)


def test_null_name_option(spark):
    df = spark.createDataFrame([(None,)], "ts timestamp")
    out = with_day_of_week(df, "ts", "dow", "dow_name", null_name=None).first()
    assert out.dow_name is None


def test_day_diff_counts_calendar_days(spark):
    rows = [(dt.datetime(2017, 10, 2, 23, 59), dt.datetime(2017, 10, 3, 0, 1)),
            (dt.datetime(2017, 10, 5), dt.datetime(2017, 10, 3)),
            (None, dt.datetime(2017, 10, 3))]
    df = spark.createDataFrame(rows, "start timestamp, stop timestamp")
    got = [r.d for r in with_day_diff(df, "stop", "start", "d").collect()]
    assert got == [1, -2, None]


def test_unit_conversion(spark):
    df = spark.createDataFrame([(650, 20), (None, None)], "w int, l int")
    out = convert_units(df, {"w": ("kg", 1000), "l": ("m", 100)})
    assert dict(out.dtypes)["kg"] == "double"
    assert [tuple(r)[2:] for r in out.collect()] == [(0.65, 0.2), (None, None)]


def test_create_new_features_adds_all_columns(spark):
    from storefront_etl.plans.features import create_new_features

    customers = spark.createDataFrame([("c1", "sp")], "customer_id string, customer_state string")
    sellers = spark.createDataFrame([("s1", "ba")], "seller_id string, seller_state string")
    products = spark.createDataFrame(
        [("p1", 650, 20, 10, 15)],
        "product_id string, product_weight_g int, product_length_cm int, product_height_cm int, product_width_cm int")
    category = spark.createDataFrame([("pcs", "computers")],
                                     "product_category_name string, product_category_name_english string")
    orders = spark.createDataFrame(
        [("o1", dt.datetime(2017, 10, 2, 23, 59), dt.datetime(2017, 10, 3, 0, 1), dt.datetime(2017, 10, 9, 1))],
        "order_id string, order_purchase_timestamp timestamp, order_approved_at timestamp, "
        "order_delivered_customer_date timestamp")
    f = create_new_features(customers, sellers, products, category, orders)
    assert f.customers.first().customer_region == "sudeste"
    assert f.sellers.first().seller_region == "nordeste"
    assert f.product_category.first().sub_product_category == "eletronicos e tecnologia"
    p = f.products.first()
    assert (p.product_weight_kg, p.product_length_m, p.product_height_m, p.product_width_m) == (0.65, 0.2, 0.1, 0.15)
    o = f.orders.first()
    assert (o.order_day_of_week, o.order_name_day_of_week, o.order_month, o.order_name_month,
            o.order_delivery_days, o.order_hour, o.order_processing_days) == (2, "monday", 10, "october", 7, 23, 1)


def test_out_of_range_numbers_follow_the_chain_default(spark):
    from pyspark.sql import functions as F

    from storefront_etl.functions.calendar import day_of_week_name, month_name

    df = spark.createDataFrame([(n,) for n in (-1, 0, 1, 7, 8, 12, 13, None)], "n int")
    rows = df.select(day_of_week_name("n").alias("d"), month_name("n").alias("m"),
                     day_of_week_name(F.col("n"), null_name=None).alias("dn")).collect()
    assert [r.d for r in rows] == ["saturday", "saturday", "sunday", "saturday", "saturday", "saturday",
                                   "saturday", "saturday"]
    assert [r.m for r in rows] == ["december", "december", "january", "july", "august", "december",
                                   "december", "december"]
    assert [r.dn for r in rows] == [None, None, "sunday", "saturday", None, None, None, None]
