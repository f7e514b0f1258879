"""Every registered vote query against its SQL."""

import pytest

from seatloom.plans.oracle import ORACLE
from seatloom.plans.queries import QUERIES
from tests import duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck.connect(SF)


def test_names():
    assert set(ORACLE) == set(QUERIES) and len(QUERIES) == 42


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert duck.rows(QUERIES[name](spark, SF).toPandas()) == duck.rows(con.execute(ORACLE[name]).df())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 25
    assert set(QUERIES) <= set(__spark_entry__.queries()) and set(ORACLE) <= set(__spark_entry__.oracle_sql())


def test_no_cross_or_nested_loop_joins_and_no_python(spark):
    for name in ("seat_results", "seat_party_long", "party_bloc_match", "fill_palette", "keyword_documents", "page_results", "seat_code_votes", "keyword_table_documents"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Cartesian" not in plan and "NestedLoop" not in plan and "Python" not in plan, name


def test_orders_are_read_once_and_rankings_are_cut_early(spark):
    """By seat_results: one scan of the votes' table, the rest reused; a ranking keeps its first rows before the shuffle."""
    for name in ("seat_results", "seat_rank_top3"):
        df = QUERIES[name](spark, SF)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert plan.count("orders.parquet") == 1 and "ReusedExchange" in plan and "WindowGroupLimit" in plan, name


def test_pages_are_never_brought_together(spark):
    """Every group of the page queries is within a page: no plan has a group of all rows."""
    for name in ("page_votes", "page_results", "page_errors", "boundary_features"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in plan, name


def test_stored_sides_are_joined_where_they_lie(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = QUERIES["feature_join_stored"](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_long_form_reads_votes_once(spark):
    """Names stay where they are: the votes' table is scanned by one job, into a table that the plan goes on from."""
    plan = QUERIES["seat_party_long"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "orders.parquet" not in plan and "customer.parquet" not in plan


def test_columns_are_pruned(spark):
    plan = QUERIES["keyword_documents"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<text:string,source:string>" in plan
