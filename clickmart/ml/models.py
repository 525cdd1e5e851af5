"""Repeat-buyer classifiers with Spark ML.

Each model is a one- or two-stage ``Pipeline`` over the assembled
``features`` column, so every kind saves and loads the same way
(``PipelineModel``) and scoring is a ``transform`` that adds columns to
the pair rows (no positional zip of predictions). Training is
distributed by Spark ML (tree aggregation for the linear models,
histogram aggregation for the trees); the input is staged to the shared
folder and persisted first, so iterations re-read it rather than the log.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.feature import Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.features import PAIR_KEYS
from ..session import fresh_dir
from ..sinks.writers import stage
from . import metrics
from .sgd import SVMWithSGD

SEED = 11

# Parameters of the original runs (evaluation run; the save run differs
# only where SAVE_OVERRIDES says so). ``svm`` / ``svm_norm`` use the
# gradient-descent trainer of the original; ``svm_lbfgs`` is Spark ML's
# LinearSVC on the same loss (other optimiser, other weights).
DEFAULTS: dict[str, dict] = {
    "lr": dict(maxIter=100, regParam=0.0, fitIntercept=False, tol=1e-6),
    "svm": dict(maxIter=100, stepSize=1.0, regParam=0.01, tol=0.001),
    "dt": dict(impurity="gini", maxDepth=5, maxBins=32, seed=SEED),
    "nb": dict(smoothing=1.0, modelType="multinomial"),
    "rf": dict(
        numTrees=3, featureSubsetStrategy="auto", impurity="gini", maxDepth=4, maxBins=32, seed=SEED
    ),
    "gbt": dict(maxIter=3, maxDepth=3, stepSize=0.1, maxBins=32, lossType="logistic", seed=SEED),
    "svm_norm": dict(maxIter=100, stepSize=1.0, regParam=0.01, tol=0.001),
    "svm_lbfgs": dict(maxIter=100, regParam=0.01, fitIntercept=False, standardization=False),
}
SAVE_OVERRIDES: dict[str, dict] = {"svm": dict(maxIter=200), "gbt": dict(maxIter=30)}
# the models the original trained, evaluated and saved
KINDS = ("lr", "svm", "dt", "nb", "rf", "gbt", "svm_norm")

_ESTIMATORS = {
    "lr": LogisticRegression,
    "svm": SVMWithSGD,
    "dt": DecisionTreeClassifier,
    "nb": NaiveBayes,
    "rf": RandomForestClassifier,
    "gbt": GBTClassifier,
    "svm_norm": SVMWithSGD,
    "svm_lbfgs": LinearSVC,
}


def estimator(kind: str, **overrides) -> Pipeline:
    """The estimator for ``kind`` with the original parameters."""
    if kind not in _ESTIMATORS:
        raise ValueError(f"unknown model kind {kind!r}; one of {tuple(_ESTIMATORS)}")
    params = {**DEFAULTS[kind], **overrides}
    if kind == "svm_norm":
        norm = Normalizer(inputCol="features", outputCol="norm_features", p=2.0)
        return Pipeline(stages=[norm, SVMWithSGD(featuresCol="norm_features", **params)])
    return Pipeline(stages=[_ESTIMATORS[kind](featuresCol="features", labelCol="label", **params)])


def prepare(assembled: DataFrame, label: str = "train") -> DataFrame:
    """Stage to the shared folder and persist: the input of iterative training."""
    staged = stage(assembled, assembled.sparkSession, label)
    return staged.persist(StorageLevel.MEMORY_AND_DISK)


SPLIT_CELLS = 10_000
_PRIME = 1_000_003


def split_cell(df: DataFrame, seed: int = SEED, keys: tuple[str, ...] = ("user_id", "merchant_id")) -> F.Column:
    """A number below ``SPLIT_CELLS`` from a row's keys alone (from all its values without them)."""
    if set(keys) <= set(df.columns):
        cell = F.lit(seed * 104_729)
        for i, k in enumerate(keys):
            cell = cell + F.pmod(F.coalesce(F.col(k), F.lit(-1)).cast("long"), F.lit(_PRIME)) * (7919 + 92_202 * i)
        return F.pmod(F.pmod(cell, F.lit(_PRIME)), F.lit(SPLIT_CELLS))
    values = [vector_to_array(f.name) if f.dataType.typeName() == "vectorudt" else F.col(f.name) for f in df.schema]
    return F.pmod(F.xxhash64(F.lit(seed), *values), F.lit(SPLIT_CELLS))


def split(df: DataFrame, weights=(0.6, 0.4), seed: int = SEED) -> list[DataFrame]:
    """Train / test split by a hash of the keys (K1): the same however the rows are laid out."""
    cell, total, out, low = split_cell(df, seed), sum(weights), [], 0
    for i in range(len(weights)):
        high = round(SPLIT_CELLS * sum(weights[: i + 1]) / total)
        out.append(df.where((cell >= low) & (cell < high)))
        low = high
    return out


def train(df: DataFrame, kind: str, **overrides) -> PipelineModel:
    """Fit one model on (label, features) rows (K3-K8, K15), counted ``weight`` times if they have one."""
    if "weight" in df.columns and kind in _ESTIMATORS:
        overrides = {"weightCol": "weight", **overrides}
    return estimator(kind, **overrides).fit(df)


def score(model: PipelineModel, df: DataFrame, keep: Iterable[str] = ("user_id", "merchant_id")) -> DataFrame:
    """Predictions plus a positive-class score.

    ``score`` is the probability of label 1 where the model has one,
    otherwise the margin for label 1 (SVM); ``prediction`` is the hard
    label the original submissions used.
    """
    out = model.transform(df)
    cols = set(out.columns)
    if "probability" in cols:
        s = vector_to_array("probability")[1]
    else:
        s = vector_to_array("rawPrediction")[1]
    keep = [c for c in keep if c in cols]
    return out.select(*keep, "label", "prediction", s.alias("score"))


def save(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def describe(model: PipelineModel) -> str:
    """Text dump of a tree model, or the model's summary string."""
    last = model.stages[-1]
    return getattr(last, "toDebugString", str(last))


def compressed(df: DataFrame) -> DataFrame:
    """(label, features, weight): equal rows as one row with their number.

    Exact for every model whose sums are linear in the rows; the features
    are small counts, so the more rows, the fewer of them are distinct.
    """
    rows = df.groupBy("label", vector_to_array("features").alias("x")).agg(F.count(F.lit(1)).cast("double").alias("weight"))
    return rows.select("label", array_to_vector("x").alias("features"), "weight")


# models fitted on compressed rows. The trees' bootstraps and samples are drawn from the rows themselves; logistic
# regression stops somewhere else along its collinear features when the same sums are added in another order
WEIGHTED = ("nb", "svm", "svm_norm")


def score_all(fitted: dict[str, PipelineModel], df: DataFrame, keep: Iterable[str] = PAIR_KEYS) -> DataFrame:
    """Every model's prediction and score of the same rows, read once: a row per model and row of ``df``."""
    out, names = df, list(fitted)
    for kind, model in fitted.items():
        scored = model.transform(out)
        source = "probability" if "probability" in scored.columns else "rawPrediction"
        made = set(scored.columns) - set(out.columns)
        out = scored.withColumns(
            {f"prediction_{kind}": F.col("prediction"), f"score_{kind}": vector_to_array(source)[1]}
        ).drop(*made)
    parts = ", ".join(f"'{k}', prediction_{k}, score_{k}" for k in names)
    return out.select(*keep, F.expr(f"stack({len(names)}, {parts}) as (model, prediction, score)"))


def evaluate_all(assembled: DataFrame, kinds: Iterable[str] = KINDS, weights=(0.6, 0.4)) -> DataFrame:
    """Train on 60% and report hold-out metrics per model (Q9).

    All models score one frame, training and hold-out rows together; one
    aggregate reduces it to counts per (model, side, score), from which
    all figures of all models come: hold-out metrics, training error and
    the exact areas under the score's curves.
    """
    data = prepare(assembled, "evaluate")
    training, _ = split(data, weights)
    small = compressed(training).persist(StorageLevel.MEMORY_AND_DISK)
    cut = round(SPLIT_CELLS * weights[0] / sum(weights))
    try:
        fitted = {kind: train(small if kind in WEIGHTED else training, kind) for kind in kinds}
        sided = data.withColumn("side", F.when(split_cell(data) < cut, "train").otherwise("test"))
        scored = score_all(fitted, sided, keep=("label", "side"))
        points = stage(metrics.score_points(scored, by=("model", "side")), data.sparkSession, "score-points")
    finally:
        small.unpersist()
        data.unpersist()
    held = points.where("side = 'test'").drop("side")
    areas = metrics.score_areas(metrics.score_curve(held, by=("model",)), by=("model",))
    trained = metrics.summaries(points.where("side = 'train'"), by=("model",)).select("model", F.col("error_rate").alias("train_error"))
    return metrics.summaries(held, by=("model",)).join(trained, "model").join(areas, "model")


def train_all(
    assembled: DataFrame, out_dir: str | None = None, kinds: Iterable[str] = KINDS
) -> DataFrame:
    """Train every model on all rows, save it, report training error (Q10)."""
    data = prepare(assembled, "train-all")
    spark = data.sparkSession
    out_dir = out_dir or fresh_dir(spark, "models")
    small = compressed(data).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fitted = {k: train(small if k in WEIGHTED else data, k, **SAVE_OVERRIDES.get(k, {})) for k in kinds}
        paths = [(kind, save(model, f"{out_dir}/{kind}")) for kind, model in fitted.items()]
        points = stage(metrics.score_points(score_all(fitted, data, keep=("label",)), by=("model",)), spark, "train-points")
    finally:
        small.unpersist()
        data.unpersist()
    errors = metrics.summaries(points, by=("model",)).select("model", "error_rate")
    return spark.createDataFrame(paths, "model string, path string").join(errors, "model")


def score_to_submission(
    model_paths: dict[str, str], assembled: DataFrame, hard: bool = False
) -> DataFrame:
    """Load saved models and score unlabelled pairs (Q11).

    One row per (model, pair): ``score`` is the positive-class score, or
    the hard label when ``hard`` (the original submission form, T10). All
    models score the same rows, which are read once, and their scores are
    unpivoted at the end.
    """
    scored = score_all({kind: load(path) for kind, path in model_paths.items()}, assembled)
    value = F.col("prediction" if hard else "score")
    return scored.select("model", *PAIR_KEYS, value.alias("score"))
