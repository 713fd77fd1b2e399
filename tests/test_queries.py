"""Every registered query against its SQL, and the plans that must hold at scale."""

import pytest

import __spark_entry__ as contract
from compare import connect, differences

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def connection(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, connection, small, name):
    assert differences(spark, connection, small, name, QUERIES[name], ORACLES[name]) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_model_query_gives_rows(spark, small, name):
    assert QUERIES[name](spark, small).count() > 0


def test_entry(spark):
    assert contract.entry(spark).count() == 15


def plan(spark, small, name):
    return QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()


PYTHON = {"assign_nearest_wide", "recompute_centroids_wide"}
PLANNED = sorted(
    {name for name in ORACLES if not name.startswith("op")} - {"fit_als", "predicted_pairs", "kmeans_fifteen_steps", "read_centroids_file"}
)


@pytest.mark.parametrize("name", PLANNED)
def test_plans_stay_in_the_jvm_and_join_without_products(spark, small, name):
    text = plan(spark, small, name)
    assert ("Python" in text or "ArrowEval" in text) == (name in PYTHON)
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["top_words", "bottom_words", "top_rated_items", "preview", "sample_seeds"])
def test_reports_keep_k_rows_per_task(spark, small, name):
    assert "TakeOrderedAndProject" in plan(spark, small, name)


def test_class_ranking_is_limited_before_the_shuffle(spark, small):
    assert plan(spark, small, "top_terms_by_class").count("WindowGroupLimit") == 2


def test_columns_are_pruned_at_the_scan(spark, small):
    assert "ReadSchema: struct<l_partkey:bigint>" in plan(spark, small, "parity_count")
    assert "ReadSchema: struct<l_quantity:double,l_extendedprice:double>" in plan(
        spark, small, "cluster_sizes_planar"
    )
    scan = plan(spark, small, "count_by_protocol")
    assert "l_tax" not in scan and "l_shipdate" not in scan


def test_nearest_assignment_and_vectors_do_not_shuffle(spark, small):
    assert "Exchange" not in plan(spark, small, "assign_nearest_planar")
    assert "Exchange hash" not in plan(spark, small, "assign_nearest_wide")


def test_grouping_combines_before_the_shuffle(spark, small):
    for name in ("line_count", "word_count", "sum_by", "cluster_sizes_planar"):
        assert "partial_" in plan(spark, small, name)


def test_measured_expressions_are_evaluated_once(spark, small):
    assert plan(spark, small, "histogram").count("split(") == 1
    assert plan(spark, small, "tfidf_long").count("regexp_extract_all(") == 1
