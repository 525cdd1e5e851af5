"""Whole-table positions and running totals against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from clickmart.operators import ranking
from clickmart.operators.ordering import running


def frame(spark, rows):
    return spark.createDataFrame(rows, "g string, v long, id long, position_of string").repartition(5)


def brute(rows, by_group):
    out, seen = [], {}
    for g, v, i, _ in sorted(rows, key=lambda r: ((r[0] is not None, r[0] or "") if by_group else 0, -r[1], r[2])):
        key = g if by_group else None
        n, total = seen.get(key, (0, 0))
        seen[key] = (n + 1, total + v)
        out.append((g, v, i, n + 1, total + v))
    return sorted(out, key=str)


@pytest.mark.parametrize("by_group", [False, True])
def test_positions_and_totals(spark, by_group):
    rng = random.Random(5)
    # a group of a third of all rows, a NULL group, few distinct values
    rows = [(rng.choice(["a", "a", "a", "b", "c", None]) if i % 3 else "hot", rng.randrange(6), i, "x") for i in range(900)]
    got = running(
        frame(spark, rows), [F.col("v").desc(), F.col("id")], groups=["g"] if by_group else [], totals={"total": "v"}
    )
    assert got.columns == ["g", "v", "id", "position_of", "position", "total"]
    assert sorted([(r.g, r.v, r.id, r.position, r.total) for r in got.collect()], key=str) == brute(rows, by_group)


def test_empty_and_single(spark):
    assert running(frame(spark, []), [F.col("v")]).count() == 0
    one = running(frame(spark, [(None, 3, 1, None)]), [F.col("v")], groups=["g"], totals={"t": "v"}).collect()
    assert [(r.position, r.t) for r in one] == [(1, 3)]


def test_ranks_are_spread_over_tasks(spark):
    counts = spark.range(0, 5000, numPartitions=4).select(F.col("id").alias("item_id"), (F.col("id") % 7).alias("n"))
    ranked = ranking.rank_all(counts, "item_id")
    assert [tuple(r) for r in ranked.orderBy("rank").limit(3).collect()] == [(1, 6, 6), (2, 13, 6), (3, 20, 6)]
    assert ranked.agg(F.max("rank"), F.count_distinct("rank")).first()[:] == (5000, 5000)
    # one window inside the ranges, one over their totals
    plan = ranked._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("windowspecdefinition(__range") == 2
