"""A user holding a third of the log: results stay whole, work is split.

Thresholds are lowered so that AQE treats this small frame the way it
would treat a multi-gigabyte hot partition on a cluster.
"""

from collections import Counter

import pytest

from clickmart.operators import features, joins, ranking
from clickmart.schemas import LOG_SCHEMA, USERS_SCHEMA

N = 30000
HOT = 1
SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture()
def skewed(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    # every third row belongs to user 1; seller 3 is hot as well
    rows = [(HOT if i % 3 == 0 else i, i % 50, i % 7, 3 if i % 2 else i % 11, None, "1111", i % 4) for i in range(N)]
    users = [(u, u % 9, u % 2) for u in range(N)]
    yield rows, users, spark.createDataFrame(rows, LOG_SCHEMA), spark.createDataFrame(users, USERS_SCHEMA)
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _final_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_user_join_is_split(spark, skewed):
    rows, users, log, profiles = skewed
    df = joins.join_inner(log.select("user_id", "seller_id"), profiles.select("user_id", "age_range"))
    assert len(df.collect()) == N  # every log user has a profile: nothing lost
    assert "SortMergeJoin(skew=true)" in _final_plan(df)


def test_young_merchants_on_skewed_log(spark, skewed):
    rows, users, log, profiles = skewed
    age = {u: a for (u, a, _) in users}
    want = Counter(s for (u, _, _, s, _, d, a) in rows if d == "1111" and a != 0 and age[u] in (1, 2, 3))
    got = {r.seller_id: r.n for r in ranking.top_merchants(log, profiles, k=1000).collect()}
    assert got == dict(want)


def test_pair_features_on_skewed_log(spark, skewed):
    rows, users, log, profiles = skewed
    pairs = log.select("user_id", "seller_id").distinct().withColumnRenamed("seller_id", "merchant_id")
    pairs = pairs.withColumn("label", pairs.user_id.cast("int") * 0)
    got = {(r.user_id, r.merchant_id): r.total_logs for r in features.pair_features(pairs, log, profiles).collect()}
    want = Counter((u, s) for (u, _, _, s, _, _, _) in rows)
    assert got == dict(want)
    hot = [r for r in features.log_aggregate(log).collect() if r.user_id == HOT and r.merchant_id == 3][0]
    hot_rows = [r for r in rows if r[0] == HOT and r[3] == 3]
    assert hot.total_logs == len(hot_rows)
    assert hot.unique_item_ids == len({r[1] for r in hot_rows})
    assert hot.one_clicks == sum(1 for r in hot_rows if r[6] != 0)


def test_sql_share_reduces_the_hot_user_before_the_join(spark, skewed):
    from clickmart.operators import shares
    from clickmart.sources import register_views

    rows, users, log, profiles = skewed
    register_views(log.repartition(5), profiles)
    df = shares.sql_share(spark, "age_range")
    age = {u: a for (u, a, _) in users}
    want = Counter(age[u] for u in {r[0] for r in rows if r[6] == 2} if 1 <= age[u] <= 8)
    assert {r.age_range: r.buy_num for r in df.collect()} == dict(want)
    # distinct buyers are combined below the join, ahead of the shuffle by user
    plan = _final_plan(df)
    below = plan[plan.index("SortMergeJoin"):]
    assert below.index("HashAggregate(keys=[user_id") < below.index("FileScan" if "FileScan" in below else "Scan ExistingRDD")
    partial = "HashAggregate(keys=[user_id#"
    assert below.count(partial) >= 2, plan  # the combining step and the final one
