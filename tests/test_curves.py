"""Curves, areas and the one-frame evaluation against Spark's evaluator and the per-model figures."""

import math

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F
from tables import SMALL

from clickmart.ml import metrics, models
from clickmart.operators import features
from clickmart.plans.catalog import feature_table


@pytest.fixture(scope="module")
def assembled(spark):
    return models.prepare(features.assemble(features.fill_features(feature_table(spark, SMALL))), "test-curves")


def scored(spark, n=3000):
    rows = [("a" if i % 3 else None, float((i * 31) % 7 < 2), float(i % 2), (i * 7919) % 401 / 401) for i in range(n)]
    return spark.createDataFrame(rows, "model string, label double, prediction double, score double").repartition(5)


@pytest.mark.parametrize("metric, name", [("areaUnderROC", "score_auc"), ("areaUnderPR", "score_aupr")])
def test_areas_are_the_evaluators(spark, metric, name):
    df = scored(spark)
    got = metrics.score_areas(metrics.score_curve(metrics.score_points(df, by=["model"]), by=["model"]), by=["model"])
    for r in got.collect():
        part = df.where(F.col("model").eqNullSafe(F.lit(r.model)))
        want = BinaryClassificationEvaluator(rawPredictionCol="score", metricName=metric, numBins=0).evaluate(part)
        assert math.isclose(r[name], want, abs_tol=2e-9)


def test_curve_points(spark):
    df = scored(spark, 200)
    rows = [(r.label, r.score) for r in df.collect()]
    curve = metrics.score_curve(metrics.score_points(df)).orderBy("place").collect()
    assert [c.score for c in curve] == sorted({s for _, s in rows}, reverse=True)
    for c in curve:
        assert (c.tp, c.fp) == (sum(y for y, s in rows if s >= c.score), sum(1 - y for y, s in rows if s >= c.score))
    assert (curve[-1].tpr, curve[-1].fpr) == (1.0, 1.0)


def test_one_class_and_missing_scores(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.5), (0.0, 1.0, float("nan")), (0.0, 0.0, None)], "label double, prediction double, score double")
    points = metrics.score_points(df)
    assert sorted((r.score is None, r.neg) for r in points.collect()) == [(False, 1), (True, 2)]
    areas = metrics.score_areas(metrics.score_curve(points)).first()
    assert areas.score_auc is None and areas.score_aupr is None


def test_evaluation_equals_each_models_own(spark, assembled):
    training, test = models.split(assembled)
    got = {r.model: r for r in models.evaluate_all(assembled, kinds=("lr", "dt", "svm_norm")).collect()}
    assert set(got) == {"lr", "dt", "svm_norm"}
    for kind, r in got.items():
        model = models.train(training, kind)
        own = models.score(model, test).cache()
        m = metrics.summary(own).first()
        assert all(math.isclose(r[c], m[c], abs_tol=1e-9) for c in m.asDict()), kind
        assert math.isclose(r.train_error, metrics.error_rate(models.score(model, training)).first()[0], abs_tol=1e-9)
        # scores of compressed training differ in the last digits, which can part or join equal ones
        assert math.isclose(r.score_auc, metrics.score_auc(own, "score"), abs_tol=1e-6)


def test_compressed_rows_train_the_same_models(spark, assembled):
    small = models.compressed(assembled)
    assert small.agg(F.sum("weight")).first()[0] == assembled.count() > small.count()
    a, b = (models.train(df, "nb").stages[-1] for df in (assembled, small))
    assert abs(a.pi.toArray() - b.pi.toArray()).max() < 1e-9 and abs(a.theta.toArray() - b.theta.toArray()).max() < 1e-9
    a, b = (models.train(df, "svm", maxIter=10).stages[-1].getOrDefault("weights") for df in (assembled, small))
    assert max(abs(x - y) for x, y in zip(a, b)) < 1e-9
