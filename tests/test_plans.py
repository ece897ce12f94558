"""Physical-plan checks: native expressions, broadcast lookups, pruning, pushdown."""

import pytest

import __spark_entry__ as entry
from storefront_etl.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_udf_in_any_query(spark, name):
    plan = _plan(entry.queries()[name](spark, SF))
    assert "BatchEvalPython" not in plan
    assert "ArrowEvalPython" not in plan
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ["lookup_no_fallback", "lookup_fallback_raw", "lookup_fallback_lower",
                                  "region_label", "lookup_bigint_key"])
def test_lookups_broadcast_the_dimension(spark, name):
    assert "BroadcastHashJoin" in _plan(entry.queries()[name](spark, SF))


@pytest.mark.parametrize("name,fact", [
    ("lookup_fallback_raw", "c_custkey"), ("lookup_no_fallback", "c_custkey"), ("region_label", "c_custkey"),
    ("lookup_fallback_lower", "s_suppkey"), ("lookup_bigint_key", "o_orderkey"), ("lookup_first", "c_custkey"),
])
def test_lookups_scan_the_fact_table_once(spark, name, fact):
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(f"Relation [{fact}") == 1
    assert "Union" not in plan


def test_pushdown_and_pruning(spark):
    df = entry.queries()["like_prefix"](spark, SF)
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(p_name), StringStartsWith(p_name,red)]" in plan
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string>" in plan


def test_limit_preview_is_top_n(spark):
    assert "TakeOrderedAndProject" in _plan(entry.queries()["limit_preview"](spark, SF))


SHUFFLE_FREE = [
    "postcode_expand", "lookup_no_fallback", "lookup_fallback_raw", "lookup_fallback_lower", "region_label",
    "category_group", "unit_convert", "day_name", "month_name", "hour_of_day", "cast_money",
    "cast_coordinates", "cast_int_lenient", "like_prefix",
]


@pytest.mark.parametrize("name", SHUFFLE_FREE)
def test_projection_and_lookup_queries_do_not_shuffle(spark, name):
    plan = _plan(entry.queries()[name](spark, SF))
    for shuffle in ("Exchange hashpartitioning", "Exchange SinglePartition", "Exchange RoundRobin",
                    "Exchange rangepartitioning"):
        assert shuffle not in plan, (name, shuffle)


def test_sql_view_is_one_exchange_on_its_group(spark):
    plan = _plan(entry.queries()["sql_view"](spark, SF))
    assert plan.count("Exchange hashpartitioning") == 1 and "Exchange hashpartitioning(payment_type" in plan
    assert plan.count("Exchange SinglePartition") <= 1  # the share over the few groups
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("payments_")]


def test_csv_reader_prunes_columns(spark, tmp_path):
    from storefront_etl.sources.csv import read_csv_strings

    path = tmp_path / "wide.csv"
    path.write_text("a,b,c,d\n1,2,3,4\n", encoding="utf-8")
    plan = _plan(read_csv_strings(spark, str(path), columns=["c", "a"]))
    assert "ReadSchema: struct<a:string,c:string>" in plan


def test_postcode_expansion_is_codegen_with_its_scan(spark):
    plan = _plan(entry.queries()["postcode_expand"](spark, SF))
    assert "*(1) Generate" in plan and "*(1) ColumnarToRow" in plan
