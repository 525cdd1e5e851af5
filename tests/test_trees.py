"""Trees as tables: against Spark ML's own trees and plain Python."""

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from clickmart.ml import models, trees
from clickmart.operators.features import PAIR_KEYS


def small(spark, n=400):
    # few distinct values and few rows: Spark ML's candidate thresholds are all of them too
    rows = [(i, i * 3, float((i * i + i // 7) % 5 < 2), Vectors.dense([i % 4, (i * 7) % 6, (i // 3) % 5, (i * i) % 9])) for i in range(n)]
    return spark.createDataFrame(rows, [*PAIR_KEYS, "label", "features"])


def shape(nodes):
    """{path from the root: (feature, threshold, rows, prediction)}, whatever the node numbers."""
    rows = {r.node: r for r in nodes.collect()}
    out, open_nodes = {}, [("", 0)]
    while open_nodes:
        path, n = open_nodes.pop()
        r = rows[n]
        out[path] = (r.feature, r.threshold, r.rows, r.prediction)
        if r.feature is not None:
            open_nodes += [(path + "L", r.left), (path + "R", r.right)]
    return out


def pruned(tree):
    """As Spark ML leaves it: siblings that are leaves of one prediction go."""
    tree = dict(tree)
    for path in sorted((p for p in tree if p.endswith("L")), key=len, reverse=True):
        parent, other = path[:-1], path[:-1] + "R"
        if tree[path][0] is None and tree[other][0] is None and tree[path][3] == tree[other][3]:
            tree[parent] = (None, None, tree[parent][2], tree[path][3])
            del tree[path], tree[other]
    return tree


@pytest.mark.parametrize("depth", [1, 3, 4])
def test_grown_tree_is_spark_mls(spark, depth):
    data = small(spark)
    theirs = trees.save_nodes(models.train(data, "dt", maxDepth=depth), spark)
    assert trees.broken_sums(theirs).count() == 0
    grown = trees.grow(data, depth)
    ours, other = pruned(shape(grown)), shape(theirs)
    assert {k: (v[0], *v[2:]) for k, v in ours.items()} == {k: (v[0], *v[2:]) for k, v in other.items()}
    # Spark ML's thresholds lie between values of the whole table, ours between values found in the node
    assert all(v[1] is None or abs(v[1] - other[k][1]) <= (0.5 if k else 0) for k, v in ours.items())
    assert trees.broken_sums(grown).count() == 0


@pytest.mark.parametrize("kind", ["dt", "rf", "gbt"])
def test_routing_gives_the_models_predictions(spark, kind):
    data = small(spark)
    model = models.train(data, kind)
    last = model.stages[-1]
    nodes = trees.save_nodes(model, spark)
    routed = trees.route(nodes, data.withColumn("node_of", F.lit(1)), 1 if kind == "dt" else last.getNumTrees, last.getOrDefault("maxDepth"))
    ours = {r.user_id: (r.prediction, round(r.score, 9)) for r in trees.tree_scores(routed, kind).collect()}
    assert ours == {r.user_id: (r.prediction, round(r.score, 9)) for r in models.score(model, data).collect()}
    assert set(trees.NODE_COLUMNS) == set(nodes.columns)


def brute_root(rows):
    def gini(part):
        share = sum(y for y, _ in part) / len(part)
        return len(part) * 2 * share * (1 - share)

    best = None
    for f in range(len(rows[0][1])):
        values = sorted({x[f] for _, x in rows})
        for a, b in zip(values, values[1:]):
            sides = [[r for r in rows if r[1][f] <= a], [r for r in rows if r[1][f] > a]]
            gain = round((gini(rows) - sum(map(gini, sides))) / len(rows), 9)
            if gain > 0 and (best is None or gain > best[2]):
                best = (f, (a + b) / 2, gain)
    return best


def test_root_split_matches_brute_force(spark):
    rows = [(float((i * 5) % 7 < 3), [float((i * 3) % 8), float(i % 5), float((i * i) % 6)]) for i in range(90)]
    df = spark.createDataFrame([(0, y, x) for y, x in rows], "node int, label double, x array<double>").repartition(3)
    got = trees.best_splits(trees.label_histograms(df)).first()
    assert (got.feature, got.threshold, got.gain) == brute_root(rows)
    assert got.left_neg + got.left_pos + got.right_neg + got.right_pos == 90


def test_no_split_and_no_rows(spark):
    pure = spark.createDataFrame([(1.0, Vectors.dense([i])) for i in range(5)], ["label", "features"])
    only = trees.grow(pure, 2).collect()
    assert [(r.node, r.feature, r.rows, r.prediction) for r in only] == [(0, None, 5, 1.0)]
    assert trees.grow(pure.where("false"), 2).count() == 0
    same = spark.createDataFrame([(float(i % 2), Vectors.dense([1.0])) for i in range(6)], ["label", "features"])
    assert trees.grow(same, 2).count() == 1


def test_rows_are_not_shuffled_by_routing(spark):
    data = small(spark)
    routed = trees.route(trees.save_nodes(models.train(data, "dt"), spark), data, 1, 5)
    plan = routed._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and plan.count("BroadcastHashJoin") >= 5
