"""Model, metric and sink checks."""

import math

import pytest
from tables import SMALL
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from clickmart.ml import metrics, models
from clickmart.operators import features
from clickmart.plans.catalog import feature_table
from clickmart.session import fresh_dir
from clickmart.sinks import libsvm_lines, write_libsvm, write_submission
from clickmart.sources import read_libsvm


@pytest.fixture(scope="module")
def assembled(spark):
    filled = features.fill_features(feature_table(spark, SMALL))
    return models.prepare(features.assemble(filled), "test-models")


def _hard_eval(df, metric):
    ev = BinaryClassificationEvaluator(rawPredictionCol="prediction", labelCol="label", metricName=metric)
    return ev.evaluate(df)


def test_hard_metrics_equal_the_evaluator(spark):
    rows = [(1.0, 1.0), (1.0, 0.0), (0.0, 1.0), (0.0, 0.0), (0.0, 0.0), (1.0, 1.0), (0.0, 0.0)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    assert math.isclose(metrics.hard_auc(df).first()[0], _hard_eval(df, "areaUnderROC"), abs_tol=1e-9)
    assert math.isclose(metrics.hard_aupr(df).first()[0], _hard_eval(df, "areaUnderPR"), abs_tol=1e-9)


def test_metrics_when_nothing_is_predicted_positive(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (0.0, 0.0), (0.0, 0.0)], "label double, prediction double")
    assert metrics.hard_auc(df).first()[0] == 0.5
    assert metrics.hard_aupr(df).first()[0] == 0.25
    s = metrics.summary(df).first()
    assert (s.error_rate, s.accuracy, s.rows) == (0.25, 0.75, 4)


def test_naive_bayes_matches_closed_form(spark, assembled):
    nb = models.train(assembled, "nb").stages[-1]
    counts = {r.label: r["count"] for r in assembled.groupBy("label").count().collect()}
    n = sum(counts.values())
    for label, c in counts.items():
        assert math.isclose(nb.pi[int(label)], math.log(c + 1.0) - math.log(n + 2.0), abs_tol=1e-9)


@pytest.mark.parametrize("kind", models.KINDS)
def test_every_model_trains_and_scores(spark, assembled, kind):
    scored = models.score(models.train(assembled, kind), assembled)
    assert scored.count() == assembled.count()
    assert scored.where(~F.col("prediction").isin(0.0, 1.0)).count() == 0


def test_save_load_same_scores(spark, assembled):
    model = models.train(assembled, "gbt")
    path = models.save(model, fresh_dir(spark, "model-test"))
    a = models.score(model, assembled).select("user_id", "merchant_id", "score")
    b = models.score(models.load(path), assembled).select("user_id", "merchant_id", "score")
    assert a.exceptAll(b).count() == 0
    assert "Tree" in models.describe(model) or "tree" in models.describe(model)


def test_seeded_forest_is_repeatable(spark, assembled):
    # the first line names the model's uid; the trees follow
    a = models.train(assembled, "rf").stages[-1].toDebugString.split("\n", 1)[1]
    b = models.train(assembled, "rf").stages[-1].toDebugString.split("\n", 1)[1]
    assert a == b and "Tree 0" in a


def test_evaluate_all_one_row_per_model(spark, assembled):
    ev = models.evaluate_all(assembled, kinds=("lr", "dt"))
    rows = {r.model: r for r in ev.collect()}
    assert set(rows) == {"lr", "dt"}
    for r in rows.values():
        assert 0.0 <= r.error_rate <= 1.0 and math.isclose(r.error_rate + r.accuracy, 1.0)


def test_normalizer_leaves_zero_vector(spark):
    from pyspark.ml.feature import Normalizer

    df = spark.createDataFrame([(Vectors.dense([0.0, 0.0]),), (Vectors.dense([3.0, 4.0]),)], ["features"])
    out = [r.n.toArray().tolist() for r in Normalizer(inputCol="features", outputCol="n").transform(df).collect()]
    assert out == [[0.0, 0.0], [0.6, 0.8]]


def test_libsvm_round_trip(spark, assembled):
    path = fresh_dir(spark, "libsvm-test")
    write_libsvm(assembled, path)
    back = read_libsvm(spark, path)
    assert back.count() == assembled.count()
    a = sorted((r.label, tuple(r.features.toArray())) for r in assembled.collect())
    b = sorted((r.label, tuple(r.features.toArray())) for r in back.collect())
    assert a == b


def test_libsvm_lines_keep_zeros(spark):
    df = spark.createDataFrame([(0, *([0] * 10))], "label int, " + ", ".join(f"{f} long" for f in features.FEATURES))
    assert libsvm_lines(df).first().line == "0.0 " + " ".join(f"{i}:0.0" for i in range(1, 11))


def test_submission_file(spark, assembled):
    scored = models.score(models.train(assembled, "lr"), assembled)
    path = fresh_dir(spark, "submission-test")
    write_submission(scored, path, single_file=True)
    back = spark.read.option("header", True).csv(path)
    assert back.columns == ["user_id", "merchant_id", "score"]
    assert back.count() == assembled.count()


def test_sgd_svm_matches_mllib_weights(spark, assembled):
    from pyspark.mllib.classification import SVMWithSGD as MLlibSVM
    from pyspark.mllib.linalg import Vectors as MV
    from pyspark.mllib.regression import LabeledPoint

    ours = models.train(assembled, "svm", maxIter=20).stages[-1].getOrDefault("weights")
    # the reference implementation, on the same rows (test-side only)
    rdd = assembled.rdd.map(lambda r: LabeledPoint(r.label, MV.dense(r.features.toArray())))
    theirs = MLlibSVM.train(rdd, iterations=20).weights.toArray()
    assert max(abs(a - b) for a, b in zip(ours, theirs)) < 1e-9


def test_sgd_svm_pipeline_saves_and_loads(spark, assembled):
    model = models.train(assembled, "svm_norm", maxIter=5)
    path = models.save(model, fresh_dir(spark, "sgd-model"))
    a = models.score(model, assembled).select("user_id", "merchant_id", "prediction", "score")
    b = models.score(models.load(path), assembled).select("user_id", "merchant_id", "prediction", "score")
    assert a.exceptAll(b).count() == 0


def test_split_does_not_depend_on_the_layout(spark, assembled):
    for df in (assembled, assembled.select("label", "features")):
        one = [part.drop("features").collect() for part in models.split(df)]
        two = [part.drop("features").collect() for part in models.split(df.repartition(7))]
        assert [sorted(x) for x in one] == [sorted(x) for x in two]
        assert sum(map(len, one)) == assembled.count()
        assert abs(len(one[0]) / assembled.count() - 0.6) < 0.05


def test_svm_steps_compile_no_new_code(spark, assembled):
    count = lambda: spark._jvm.org.apache.spark.metrics.source.CodegenMetrics.METRIC_COMPILATION_TIME().getCount()
    models.train(assembled, "svm", maxIter=2, tol=0.0)
    before = count()
    models.train(assembled, "svm", maxIter=12, tol=0.0)
    assert count() - before <= 2


def test_submission_scores_equal_each_models_own(spark, assembled):
    paths = {}
    for kind, extra in (("lr", {"maxIter": 5}), ("gbt", {"maxIter": 1}), ("svm_norm", {"maxIter": 2})):
        paths[kind] = models.save(models.train(assembled, kind, **extra), fresh_dir(spark, f"sub-{kind}"))
    out = models.score_to_submission(paths, assembled)
    for kind, path in paths.items():
        own = models.score(models.load(path), assembled).select("user_id", "merchant_id", "score")
        assert out.where(out.model == kind).drop("model").exceptAll(own).count() == 0
    assert out.count() == 3 * assembled.count()


def test_score_auc_is_exact(spark):
    rows = [(float(i % 3 == 0), (i * 7919) % 5003 / 5003) for i in range(4000)]
    df = spark.createDataFrame(rows, "label double, score double")
    pos = [s for y, s in rows if y]
    neg = sorted(s for y, s in rows if not y)
    from bisect import bisect_left, bisect_right

    area = sum(bisect_left(neg, s) + 0.5 * (bisect_right(neg, s) - bisect_left(neg, s)) for s in pos) / len(pos) / len(neg)
    assert math.isclose(metrics.score_auc(df, "score"), area, abs_tol=1e-12)
