"""Model and metric queries over the feature table.

The metric queries score a fixed rule (``purchase_times >= 2``) so the
DuckDB oracle can reproduce the predictions; the model queries train
Spark ML models on the whole feature table and are checked by row count.
"""

from __future__ import annotations

import functools

from pyspark.ml.feature import Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..ml import metrics, models, trees
from ..operators import features
from ..schemas import FEATURES
from ..session import fresh_dir
from ..sinks import libsvm_lines, stage, write, write_libsvm
from ..sources import fixtures, read_libsvm
from . import jobs
from .catalog import feature_table, query


# One stored feature table per application, kind and state of the input files.
_FEATURES: dict[tuple, str] = {}


def _filled(spark: SparkSession, d: str, scoring: bool = False) -> DataFrame:
    """The filled feature table, computed once and read back from the staging folder."""
    key = (scoring, fixtures.source_state(spark, d, ("lineitem", "orders", "part", "customer")))
    if key not in _FEATURES:
        path = fresh_dir(spark, "scoring-features" if scoring else "train-features")
        features.fill_features(feature_table(spark, d, scoring)).write.parquet(path)
        _FEATURES[key] = path
    return spark.read.parquet(_FEATURES[key])


def _assembled(spark: SparkSession, d: str, scoring: bool = False) -> DataFrame:
    filled = _filled(spark, d, scoring)
    return features.assemble(filled, label=None if scoring else "label")


def rule_predictions(spark: SparkSession, d: str) -> DataFrame:
    """label + a hard prediction from a fixed rule, for the metric checks."""
    f = _filled(spark, d)
    pred = F.when(F.col("purchase_times") >= 2, 1.0).otherwise(0.0)
    return f.select("label", pred.alias("prediction"))


@query("libsvm_lines")
def q_libsvm_lines(spark, d):
    return libsvm_lines(_filled(spark, d))


@query("normalize_l2")
def q_normalize_l2(spark, d):
    assembled = _assembled(spark, d)
    norm = Normalizer(inputCol="features", outputCol="norm", p=2.0).transform(assembled)
    arr = vector_to_array("norm")
    return norm.select(
        "user_id", "merchant_id", *[F.round(arr[i], 6).alias(f) for i, f in enumerate(FEATURES)]
    )


def _nb_model(spark, d):
    data = _assembled(spark, d).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return models.train(data, "nb").stages[-1]
    finally:
        data.unpersist()


# The naive Bayes queries return the fitted parameters: one value per
# class (priors) or per class and feature (likelihoods), so the rows built
# on the driver are bounded by the model, not by the data.
@query("nb_priors")
def q_nb_priors(spark, d):
    nb = _nb_model(spark, d)
    rows = [(float(i), round(float(v), 6)) for i, v in enumerate(nb.pi.toArray())]
    schema = T.StructType(
        [T.StructField("label", T.DoubleType()), T.StructField("log_prior", T.DoubleType())]
    )
    return spark.createDataFrame(rows, schema)


@query("nb_likelihoods")
def q_nb_likelihoods(spark, d):
    nb = _nb_model(spark, d)
    theta = nb.theta.toArray()
    rows = [
        (float(c), j, round(float(theta[c][j]), 6))
        for c in range(theta.shape[0])
        for j in range(theta.shape[1])
    ]
    schema = T.StructType(
        [
            T.StructField("label", T.DoubleType()),
            T.StructField("feature", T.IntegerType()),
            T.StructField("log_likelihood", T.DoubleType()),
        ]
    )
    return spark.createDataFrame(rows, schema)


@query("error_rate")
def q_error_rate(spark, d):
    return metrics.error_rate(rule_predictions(spark, d))


@query("accuracy")
def q_accuracy(spark, d):
    return metrics.accuracy(rule_predictions(spark, d))


@query("hard_auc")
def q_hard_auc(spark, d):
    return metrics.hard_auc(rule_predictions(spark, d))


@query("hard_aupr")
def q_hard_aupr(spark, d):
    return metrics.hard_aupr(rule_predictions(spark, d))


def _train_and_score(kind: str):
    def run(spark, d):
        data = _assembled(spark, d).persist(StorageLevel.MEMORY_AND_DISK)
        model = models.train(data, kind)
        # scoring re-reads the staged files; the cache served the fit only
        data.unpersist()
        scored = models.score(model, data)
        return scored.withColumn("score", F.round("score", 9))

    return run


for _kind in models.KINDS:
    query(f"train_{_kind}")(_train_and_score(_kind))


@query("evaluate_all")
def q_evaluate_all(spark, d):
    return models.evaluate_all(_assembled(spark, d))


SUBMISSION_KINDS = ("lr", "svm", "gbt", "svm_norm")


@query("train_save_all")
def q_train_save_all(spark, d):
    return models.train_all(_assembled(spark, d))


@query("submission")
def q_submission(spark, d):
    """Train and save the submitted models, then score every unlabelled pair with all of them."""
    saved = models.train_all(_assembled(spark, d), kinds=SUBMISSION_KINDS)
    paths = {r["model"]: r["path"] for r in saved.collect()}  # one row per model
    return models.score_to_submission(paths, _assembled(spark, d, scoring=True))


@query("submission_keys")
def q_submission_keys(spark, d):
    """The (model, pair) rows of a submission of quickly trained models: exact."""
    out_dir = fresh_dir(spark, "quick-models")
    data, paths = _assembled(spark, d), {}
    for kind, few in (("lr", dict(maxIter=2)), ("svm", dict(maxIter=2)), ("nb", {}), ("dt", dict(maxDepth=2))):
        paths[kind] = models.save(models.train(data, kind, **few), f"{out_dir}/{kind}")
    scored = models.score_to_submission(paths, _assembled(spark, d, scoring=True))
    return scored.where("score is not null").select("model", "user_id", "merchant_id")


@query("submission_round_trip")
def q_submission_round_trip(spark, d):
    """Two saved models' submissions, written by one job and read back: naive Bayes and the SVM's first steps."""
    out_dir, data = fresh_dir(spark, "submitted"), _assembled(spark, d)
    few = {"nb": {}, "svm": dict(maxIter=SVM_STEPS, tol=0.0)}
    paths = {kind: models.save(models.train(data, kind, **options), f"{out_dir}/models/{kind}") for kind, options in few.items()}
    write(_filled(spark, d, scoring=True), f"{out_dir}/features")
    read = jobs.submissions_job(spark, f"{out_dir}/features", paths, f"{out_dir}/files")
    return read.withColumn("score", F.round("score", 9))


@query("libsvm_round_trip")
def q_libsvm_round_trip(spark, d):
    """Features written as LibSVM files and read back."""
    path = fresh_dir(spark, "libsvm")
    write_libsvm(_assembled(spark, d), path)
    x = vector_to_array("features")
    return read_libsvm(spark, path).select("label", *[x[i].alias(f) for i, f in enumerate(FEATURES)])


@query("split_rows")
def q_split_rows(spark, d):
    """Which side of the train / test split each pair is on (K1)."""
    sides = models.split(_filled(spark, d))
    named = [part.select("user_id", "merchant_id", F.lit(name).alias("side")) for part, name in zip(sides, ("train", "test"))]
    return named[0].unionByName(named[1])


@query("evaluate_nb")
def q_evaluate_nb(spark, d):
    """Hold-out metrics of naive Bayes on the stable split (Q9)."""
    training, test = models.split(_assembled(spark, d))
    scored = models.score(models.train(training, "nb"), test)
    return metrics.summary(scored)


def _nb_points(spark, d):
    """Naive Bayes scores (to 9 digits) of all pairs, a row per distinct score."""
    data = _assembled(spark, d)
    scored = models.score(models.train(models.compressed(data), "nb"), data)
    return stage(metrics.score_points(scored.withColumn("score", F.round("score", 9))), spark, "nb-points")


@query("score_curve")
def q_score_curve(spark, d):
    """The ROC and PR curve of naive Bayes scores, a row per threshold."""
    curve = metrics.score_curve(_nb_points(spark, d))
    return curve.select("place", "score", "tp", "fp", *[F.round(c, 9).alias(c) for c in ("tpr", "fpr", "precision")])


@query("score_areas")
def q_score_areas(spark, d):
    """Both exact areas of naive Bayes scores."""
    return metrics.score_areas(metrics.score_curve(_nb_points(spark, d)))


@query("evaluate_fitted_nb")
def q_evaluate_fitted_nb(spark, d):
    """``evaluate_all`` of naive Bayes: all its figures (Q9)."""
    return models.evaluate_all(_assembled(spark, d), kinds=("nb",))


@query("compressed_rows")
def q_compressed_rows(spark, d):
    """The distinct (label, features) rows that linear models are fitted on, and how often each stands in the table."""
    rows = models.compressed(_assembled(spark, d))
    x = vector_to_array("features")
    return rows.select("label", *[x[i].alias(f) for i, f in enumerate(FEATURES)], "weight")


SVM_STEPS = 4


@query("svm_weights")
def q_svm_weights(spark, d):
    """Weights after the first gradient steps of the SVM (K4)."""
    model = models.train(_assembled(spark, d), "svm", maxIter=SVM_STEPS, tol=0.0).stages[-1]
    rows = [(i, round(w, 6) + 0.0) for i, w in enumerate(model.getOrDefault("weights"))]  # one row per feature
    return spark.createDataFrame(rows, "feature int, weight double")


@query("svm_norm_weights")
def q_svm_norm_weights(spark, d):
    """Weights after the first gradient steps of the SVM on L2-normalised features."""
    model = models.train(_assembled(spark, d), "svm_norm", maxIter=SVM_STEPS, tol=0.0).stages[-1]
    rows = [(i, round(w, 6) + 0.0) for i, w in enumerate(model.getOrDefault("weights"))]  # one row per feature
    return spark.createDataFrame(rows, "feature int, weight double")


@query("lr_gradient")
def q_lr_gradient(spark, d):
    """Logistic-regression gradient at the fitted weights, per feature, relative to the feature's sum (K3).

    Without regularisation the optimum has gradient 0; three decimals are kept.
    """
    data = _assembled(spark, d)
    model = models.train(data, "lr")
    scored = model.transform(data).select(
        (vector_to_array("probability")[1] - F.col("label")).alias("r"), vector_to_array("features").alias("x")
    )
    cells = scored.select("r", F.posexplode("x").alias("feature", "v"))
    return cells.groupBy("feature").agg(
        (F.round(F.abs(F.sum(F.col("r") * F.col("v"))) / F.greatest(F.sum(F.abs("v")), F.lit(1.0)), 3) + 0.0).alias("gradient")
    )


@query("tree_leaf_counts")
def q_tree_leaf_counts(spark, d):
    """Rows per class, summed over the decision tree's leaves (K5, K10): every row is in one leaf."""
    data = _assembled(spark, d)
    tree = models.train(data, "dt").stages[-1].setLeafCol("leaf")
    leaves = tree.transform(data).groupBy("leaf", "label").agg(F.count("*").alias("n"))
    return leaves.groupBy("label").agg(F.sum("n").alias("n"))


TREE_KINDS = ("dt", "rf", "gbt")


def _tree_parts(spark: SparkSession, d: str):
    """(kind, model, node table, trees, depth) of the three tree models, and the rows."""
    data = _assembled(spark, d)
    parts = []
    for kind in TREE_KINDS:
        model = models.train(data, kind)
        last = model.stages[-1]
        count = 1 if kind == "dt" else last.getNumTrees
        parts.append((kind, model, trees.save_nodes(model, spark), count, last.getOrDefault("maxDepth")))
    return data, parts


@query("tree_nodes")
def q_tree_nodes(spark, d):
    """Node tables of the tree models held against the rows.

    Per model: rows at the first tree's root (a forest's trees are grown on
    resampled rows: those of the routed rows), inner nodes whose children do
    not add up, and leaves whose rows are not those routed there (NULL for
    the forest).
    """
    data, parts = _tree_parts(spark, d)
    out = []
    for kind, _, nodes, count, depth in parts:
        reached = trees.route(nodes, data, count, depth).groupBy("tree", "node").agg(F.count("*").alias("reached"))
        leaves = nodes.where("feature is null").join(reached, ["tree", "node"], "left")
        wrong = F.count_if(F.coalesce("reached", F.lit(0)) != F.col("rows"))
        out.append(
            leaves.agg(
                F.sum(F.when(F.col("tree") == 0, F.col("reached"))).alias("root_rows"),
                (F.lit(None).cast("long") if kind == "rf" else wrong).alias("wrong_leaves"),
            ).select(F.lit(kind).alias("model"), F.lit(count).alias("trees"), "root_rows", "wrong_leaves",
                     F.lit(trees.broken_sums(nodes).count()).alias("broken_sums"))
        )
    return functools.reduce(DataFrame.unionByName, out)


@query("tree_routes")
def q_tree_routes(spark, d):
    """Predictions by routing every row through the node tables against the models' own."""
    data, parts = _tree_parts(spark, d)
    out = []
    for kind, model, nodes, count, depth in parts:
        ours = trees.tree_scores(trees.route(nodes, data, count, depth), kind).withColumnsRenamed({"prediction": "p", "score": "s"})
        own = models.score(model, data)
        same = own.join(ours, list(features.PAIR_KEYS), "left")
        out.append(
            same.select(
                F.lit(kind).alias("model"), *features.PAIR_KEYS, F.col("prediction").eqNullSafe(F.col("p")).alias("same_label"),
                (F.round(F.abs(F.col("score") - F.col("s")), 9) + 0.0).alias("score_gap"),
            )
        )
    return functools.reduce(DataFrame.unionByName, out)


@query("tree_root_split")
def q_tree_root_split(spark, d):
    """The best first Gini split of all pairs (K5)."""
    rows = _assembled(spark, d).select(F.lit(0).alias("node"), "label", vector_to_array("features").alias("x"))
    return trees.best_splits(trees.label_histograms(rows)).drop("node")


GROWN_DEPTH = 3


@query("tree_grown")
def q_tree_grown(spark, d):
    """A Gini tree of three levels grown from label histograms (K5)."""
    grown = trees.grow(_assembled(spark, d), GROWN_DEPTH)
    return grown.select("node", "feature", "threshold", "gain", "rows", F.col("stats")[1].cast("long").alias("positives"))


@query("tree_grown_scores")
def q_tree_grown_scores(spark, d):
    """Every pair routed through the grown tree: leaf and positive share."""
    data = _assembled(spark, d)
    nodes = stage(trees.grow(data, GROWN_DEPTH), spark, "grown")
    routed = trees.route(nodes, data, 1, GROWN_DEPTH)
    return routed.select(
        *features.PAIR_KEYS, "node", F.round(F.col("stats")[1] / (F.col("stats")[0] + F.col("stats")[1]), 9).alias("score")
    )
