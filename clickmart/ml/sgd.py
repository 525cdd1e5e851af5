"""Linear SVM trained by full-batch gradient descent, as DataFrame aggregates.

The repeat-buyer SVMs were trained with Spark MLlib's SGD solver (hinge
loss, L2 updater, step ``step / sqrt(t)``, whole data set per step, no
intercept, stop when the weight change is below ``tol`` times the weight
norm). Spark ML has no SGD-trained SVM (``LinearSVC`` minimises the same
loss with L-BFGS and lands on other weights), so this module runs the
same iterations with DataFrame aggregates: each step is one JVM-side
aggregate over all rows, summing the hinge sub-gradient and loss per
partition before a single small merge; only the weight vector (one value
per feature) lives on the driver.

``SVMWithSGD`` fits it inside a ``Pipeline``; ``SVMWithSGDModel`` scores
with a built-in linear expression and saves / loads with its parameters.
"""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasRawPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sinks.writers import stage


class _SGDParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasRawPredictionCol):
    maxIter = Param(Params._dummy(), "maxIter", "number of gradient steps", TypeConverters.toInt)
    stepSize = Param(Params._dummy(), "stepSize", "initial step size", TypeConverters.toFloat)
    regParam = Param(Params._dummy(), "regParam", "L2 regularisation", TypeConverters.toFloat)
    tol = Param(Params._dummy(), "tol", "relative weight change that stops", TypeConverters.toFloat)
    threshold = Param(Params._dummy(), "threshold", "margin above which label 1", TypeConverters.toFloat)
    weightCol = Param(Params._dummy(), "weightCol", "column with how often a row counts; empty: once", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(
            maxIter=100, stepSize=1.0, regParam=0.01, tol=0.001, threshold=0.0,
            featuresCol="features", labelCol="label", predictionCol="prediction",
            rawPredictionCol="rawPrediction", weightCol="",
        )


def _margin(x: Column, weights: list[float]) -> Column:
    """``w . x`` with the weights as data of an array function.

    As literals of plain arithmetic they would be part of the generated
    code, which every gradient step would then compile anew.
    """
    products = F.zip_with(x, F.lit([float(w) for w in weights]), lambda a, b: a * b)
    return F.aggregate(products, F.lit(0.0), lambda acc, v: acc + v)


def gradient_step_sums(data: DataFrame, weights: list[float]) -> tuple[list[float], float, float]:
    """Hinge sub-gradient sum, loss sum and number of rows at ``weights``.

    ``data`` has distinct rows of ``x`` (array of doubles) and ``y`` (label
    scaled to -1/+1) and their number ``k``. The margin is projected once
    per row; each row then adds ``c * x`` with ``c = -k y`` where the hinge
    is active and 0 elsewhere.
    """
    # as text, a step is a few calls into the JVM; the weights' text is folded to data, so no step compiles new code
    at = f"transform(split('{','.join(map(repr, map(float, weights)))}', ','), v -> cast(v as double))"
    margins = data.selectExpr("x", "y", "k", f"aggregate(zip_with(x, {at}, (a, b) -> a * b), 0.0D, (s, v) -> s + v) as m")
    rows = margins.selectExpr(
        "x", "k", "if(1.0D > y * m, -y * k, 0.0D) as c", "if(1.0D > y * m, (1.0D - y * m) * k, 0.0D) as l"
    )
    sums = [f"sum(c * x[{j}]) as g{j}" for j in range(len(weights))]
    row = rows.selectExpr(*sums, "sum(l) as loss", "sum(k) as n").first()
    return [row[f"g{j}"] or 0.0 for j in range(len(weights))], row["loss"] or 0.0, row["n"] or 0.0


class SVMWithSGD(Estimator, _SGDParams, DefaultParamsReadable, DefaultParamsWritable):
    """Full-batch gradient descent on the L2-regularised hinge loss."""

    def __init__(self, **kwargs):
        super().__init__()
        self._set(**kwargs)

    def _fit(self, dataset: DataFrame) -> SVMWithSGDModel:
        g = self.getOrDefault
        # every step reads distinct rows only, stored in as few files as their size asks for
        rows = dataset.groupBy(
            vector_to_array(g(self.featuresCol)).alias("x"),
            (F.col(g(self.labelCol)).cast("double") * 2.0 - 1.0).alias("y"),
        ).agg(F.sum(F.col(g(self.weightCol)) if g(self.weightCol) else F.lit(1.0)).alias("k"))
        data = stage(rows, dataset.sparkSession, "svm-rows").persist(StorageLevel.MEMORY_AND_DISK)
        try:
            first = data.select(F.size("x").alias("d")).first()
            weights = [0.0] * (first["d"] if first else 0)
            step, reg, tol = g(self.stepSize), g(self.regParam), g(self.tol)
            previous = None
            for t in range(1, (g(self.maxIter) if weights else 0) + 1):
                grad, _, n = gradient_step_sums(data, weights)
                if n == 0:
                    break
                rate = step / math.sqrt(t)
                shrink = 1.0 - rate * reg
                weights = [w * shrink - rate * (gj / n) for w, gj in zip(weights, grad)]
                if previous is not None:
                    diff = math.sqrt(sum((a - b) ** 2 for a, b in zip(previous, weights)))
                    norm = math.sqrt(sum(w * w for w in weights))
                    if diff < tol * max(norm, 1.0):
                        break
                previous = weights
        finally:
            data.unpersist()
        model = SVMWithSGDModel(weights=weights, threshold=g(self.threshold))
        return self._copyValues(model)


class SVMWithSGDModel(Model, _SGDParams, DefaultParamsReadable, DefaultParamsWritable):
    """Linear scorer: margin = w . x; label 1 when the margin exceeds the threshold."""

    weights = Param(Params._dummy(), "weights", "one weight per feature", TypeConverters.toListFloat)

    def __init__(self, weights: list[float] | None = None, threshold: float = 0.0):
        super().__init__()
        self._setDefault(weights=[])
        self._set(weights=list(weights or []), threshold=threshold)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        g = self.getOrDefault
        margin_col = "__svm_margin"
        scored = dataset.withColumn(
            margin_col, _margin(vector_to_array(g(self.featuresCol)), g(self.weights))
        )
        margin = F.col(margin_col)
        return (
            scored.withColumn(g(self.rawPredictionCol), array_to_vector(F.array(-margin, margin)))
            .withColumn(
                g(self.predictionCol),
                F.when(margin > F.lit(g(self.threshold)), 1.0).otherwise(0.0),
            )
            .drop(margin_col)
        )
