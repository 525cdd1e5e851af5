"""Physical-plan checks: the shapes the package is designed around."""

import pytest
from tables import MEDIUM

from clickmart.plans.catalog import all_queries

Q = all_queries()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_top_k_is_take_ordered(spark):
    for name in ("top_items", "top_merchants_all"):
        p = plan(Q[name](spark, MEDIUM))
        assert "TakeOrderedAndProject" in p, p


def test_no_python_in_feature_plan(spark):
    p = plan(Q["features_filled"](spark, MEDIUM))
    for op in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF"):
        assert op not in p


def test_item_ranking_reads_only_the_columns_it_needs(spark):
    p = plan(Q["top_items"](spark, MEDIUM))
    assert "ReadSchema: struct<item_id:bigint,action_type:int>" in p
    assert "PartitionFilters: [isnotnull(time_stamp" in p  # the day filter prunes folders


def test_filters_reach_the_scan(spark):
    p = plan(Q["filter_youth"](spark, MEDIUM))
    assert "PushedFilters" in p or "DataFilters" in p


def test_no_single_partition_exchange_before_aggregates(spark):
    for name in ("pair_features", "age_counts_raw", "count_by_seller"):
        p = plan(Q[name](spark, MEDIUM))
        assert "SinglePartition" not in p, name


def test_share_window_runs_after_the_aggregate(spark):
    # the only single-partition step is the percentage over <= 8 groups
    p = optimized(Q["age_share"](spark, MEDIUM))
    assert p.index("Window") < p.index("Aggregate")


def test_young_merchant_count_pre_aggregates_before_the_user_join(spark):
    o = optimized(Q["top_merchants_all"](spark, MEDIUM))
    assert "LeftSemi" not in o
    join_at = o.index("Join Inner")
    # the (user, seller) count sits below the join, on the log side
    assert "Aggregate [user_id#" in o[join_at:] or "Aggregate [user_id" in o[join_at:]


def test_pair_features_read_the_log_once(spark):
    from clickmart.operators import features
    from clickmart.sources import fixtures

    log = fixtures.log(spark, MEDIUM)
    p = plan(features.log_aggregate(log))
    assert p.count("FileScan parquet") == 1
    # one true distinct count (items): rows are never multiplied
    assert "Expand" not in p
    # with derived pairs: the log twice, and the profiles
    assert plan(Q["pair_features"](spark, MEDIUM)).count("FileScan parquet") == 3


def test_pair_feature_shuffles_with_large_sides(spark):
    # with no side small enough to broadcast, as at scale
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(Q["pair_features"](spark, MEDIUM))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # pairs 1, log combined 1, distincts 1, per pair 1, profiles 1, pairs by user 1
    assert p.count("Exchange hashpartitioning") <= 6, p
    assert "SinglePartition" not in p


@pytest.fixture()
def large_sides(spark):
    """No side small enough to broadcast, as at scale."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_log_rows_travel_without_instants_and_flags(spark, large_sides):
    from clickmart.sources import fixtures

    p = plan(fixtures.user_log(spark, MEDIUM))
    moved = p[: p.index("Exchange hashpartitioning(l_orderkey")]
    assert "l_shipdate" not in moved and "l_returnflag" not in moved


def test_pair_features_move_log_rows_once(spark, large_sides):
    p = plan(Q["pair_features"](spark, MEDIUM))
    # pairs, log rows; then the finished pairs and the profiles by user
    assert p.count("Exchange hashpartitioning") == 4, p
