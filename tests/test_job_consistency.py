"""The whole job on stand-in extracts equals the registered per-table queries."""

import pytest

import __spark_entry__ as entry
from storefront_etl.plans.jobs import PipelinePaths, prepare_postcodes, run_pipeline
from storefront_etl.plans.standins import write_standin_extracts

SF = "/root/testdata/sf0.001"

TABLE_TO_QUERY = {
    "customers": "region_label",
    "geolocation": "lookup_fallback_raw",
    "sellers": "lookup_fallback_lower",
    "order_items": "cast_money",
    "order_payments": "cast_int_lenient",
    "orders": "order_features",
    "products": "unit_convert",
    "product_category": "category_group",
}


@pytest.fixture(scope="module")
def job_paths(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("job")
    raw = write_standin_extracts(spark, SF, str(base / "raw"))
    ceps = prepare_postcodes(spark, raw["postcode_ranges"], str(base / "ceps.parquet"))
    return base, PipelinePaths(**{k: v for k, v in raw.items() if k != "postcode_ranges"}, postcodes=ceps)


@pytest.fixture(scope="module")
def job_tables(spark, job_paths):
    base, paths = job_paths
    written = run_pipeline(spark, paths, str(base / "out"))
    return {name: spark.read.parquet(p) for name, p in written.items()}


def test_job_plans_are_shuffle_free(spark, job_paths):
    from storefront_etl.plans.jobs import build_tables

    for name, df in build_tables(spark, job_paths[1]).items():
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan and "Exchange SinglePartition" not in plan, name
        assert "BatchEvalPython" not in plan, name


@pytest.mark.parametrize("table", sorted(TABLE_TO_QUERY))
def test_job_table_equals_query(spark, job_tables, table):
    got = job_tables[table]
    want = entry.queries()[TABLE_TO_QUERY[table]](spark, SF)
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == 0
    assert want.exceptAll(got).count() == 0


def test_job_reviews_keep_whole_texts(spark, job_tables):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    reviews = job_tables["order_reviews"]
    assert reviews.count() == docs.count()
    joined = reviews.join(docs, reviews["review_id"] == docs["doc_id"].cast("string"))
    assert joined.where(joined["review_comment_message"] != joined["text"]).count() == 0
