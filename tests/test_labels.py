from pyspark.sql import functions as F

from storefront_etl.functions.labels import category_group, region_of_state
from storefront_etl.sources.csv import read_category_dictionary


def _map(spark, values, fn):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_region_defaults_to_sul(spark):
    got = _map(spark, ["sp", "ba", "am", "df", "rs", "xx", None, "SP"], region_of_state)
    assert got == ["sudeste", "nordeste", "norte", "centro-oeste", "sul", "sul", "sul", "sul"]


def test_category_defaults_to_outros(spark):
    got = _map(spark, ["pcs", "alimentos", "bebes", "PCS", None], category_group)
    assert got == ["eletronicos e tecnologia", "alimentos_e_bebidas", "outros", "outros", "outros"]


# Invented dictionary rows: a category and an English name made up for this test.
DICTIONARY = """\ufeffproduct_category_name,product_category_name_english
pcs,Made-up computers
alimentos,Made-up food
moveis_decoracao,"Chairs, invented"
inexistente,No such thing
"""


def test_groups_over_a_dictionary_with_byte_order_mark(spark, tmp_path):
    (tmp_path / "dictionary.csv").write_text(DICTIONARY, encoding="utf-8")
    dictionary = read_category_dictionary(spark, str(tmp_path / "dictionary.csv"))
    assert dictionary.columns == ["product_category_name", "product_category_name_english"]
    rows = dictionary.select("*", category_group("product_category_name").alias("group")).collect()
    assert {r[0]: (r[1], r[2]) for r in rows} == {
        "pcs": ("Made-up computers", "eletronicos e tecnologia"),
        "alimentos": ("Made-up food", "alimentos_e_bebidas"),
        "moveis_decoracao": ("Chairs, invented", "casa e decoracao"),
        "inexistente": ("No such thing", "outros"),
    }


def test_label_mapping_is_native(spark):
    df = spark.createDataFrame([("pcs",)], "v string").select(category_group("v"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
