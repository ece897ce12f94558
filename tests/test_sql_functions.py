"""SQL functions give what the Column builders give, without Python in the plan."""

from pyspark.sql import functions as F

from storefront_etl.functions.calendar import day_of_week_name, month_name
from storefront_etl.functions.casts import lenient_cast, lenient_int, strict_int
from storefront_etl.functions.labels import CATEGORY_GROUPS, REGION_GROUPS, category_group, region_of_state
from storefront_etl.functions.sql import register_functions
from storefront_etl.operators.postcode import expand_postcode_ranges


def test_scalars(spark):
    names = register_functions(spark)
    texts = ["650.0", "-1.9", ".5", ".", "\t7", " 12 ", "\x7f3\x01", "+5", "abc", "", None, "1e2", "99999999999", "-", "+.", "1.2.3", "'", "NaN", " inf", "x1", "5.", "\\"]
    texts += [v for _, group in (*REGION_GROUPS, *CATEGORY_GROUPS) for v in group] + ["pr", "SP"]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    builders = {"lenient_int": lenient_int, "strict_int": strict_int, "region_of_state": region_of_state, "category_group": category_group}
    builders["lenient_double"] = lambda c: lenient_cast(c, "double")
    for name, build in builders.items():
        out = df.selectExpr("v", f"{name}(v) AS by_sql").withColumn("by_column", build("v"))
        assert out.schema["by_sql"].dataType == out.schema["by_column"].dataType
        assert [r for r in out.collect() if str(r["by_sql"]) != str(r["by_column"])] == [], name
        assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    numbers = spark.createDataFrame([(n,) for n in [None, 0, 1, 7, 8, 12, 13, -1]], "n int")
    for name, build in (("day_of_week_name", day_of_week_name), ("month_name_of", month_name)):
        assert numbers.selectExpr(f"{name}(n) AS x").collect() == numbers.select(build("n").alias("x")).collect()
    assert set(names) == {*builders, "day_of_week_name", "month_name_of", "postcode_prefixes"}


def test_table_function(spark):
    register_functions(spark, "etl_")
    rows = [("A", "01000-000 a 01003-999"), ("B", "01003-500 a 01004-999"), ("R", "01003-000 a 01000-999"), ("N", None), ("J", "x a y"), ("S", "01003-000")]
    df = spark.createDataFrame(rows, "locality string, postcode_range string")
    df.createOrReplaceTempView("etl_ranges")
    got = spark.sql("SELECT locality, CAST(p.cep_prefix AS STRING) AS cep_prefix FROM etl_ranges r, LATERAL etl_postcode_prefixes(r.postcode_range) p")
    assert sorted(got.collect()) == sorted(expand_postcode_ranges(df).collect())
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Join" not in plan
    spark.catalog.dropTempView("etl_ranges")
    assert spark.range(1).select(F.expr("etl_lenient_int('7.9')")).first()[0] == 7
