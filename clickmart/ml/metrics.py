"""Classification metrics as one-pass DataFrame aggregates.

The original scripts counted mismatches with two ``count()`` jobs per
metric and fed hard 0/1 labels to a curve evaluator. Here one aggregate
yields the confusion counts, and the curve areas for hard predictions are
the closed forms the evaluator reduces to: ROC area (TPR + TNR) / 2 and
PR area ``r*p + (1 - r)*(p + b)/2`` (recall r, precision p, base rate b;
b when nothing is predicted positive). ``score_auc`` gives the real area
from a continuous score via Spark's evaluator.

``score_points`` reduces scored rows of any number of models to one row
per distinct score in one aggregate; ``score_curve`` adds the running true
and false positives by two-level sums (no task sees a whole model), and
``score_areas`` and ``summaries`` come from the points alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import running

DIGITS = 9


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: pos, neg, tp, fp, tn, fn (as doubles)."""
    y = F.col(label) == 1
    p = F.col(prediction) == 1
    one = lambda cond: F.sum(F.when(cond, 1.0).otherwise(0.0))
    return df.agg(
        one(y).alias("pos"),
        one(~y).alias("neg"),
        one(y & p).alias("tp"),
        one(~y & p).alias("fp"),
        one(~y & ~p).alias("tn"),
        one(y & ~p).alias("fn"),
    )


def _hard_auc(pos: Column, neg: Column, tp: Column, fp: Column) -> Column:
    return F.when((pos == 0) | (neg == 0), F.lit(0.5)).otherwise(
        (F.lit(1.0) + tp / pos - fp / neg) / 2
    )


def _hard_aupr(pos: Column, neg: Column, tp: Column, fp: Column) -> Column:
    base = pos / (pos + neg)
    recall = tp / pos
    precision = tp / (tp + fp)
    return F.when(((tp + fp) == 0) | (pos == 0), base).otherwise(
        recall * precision + (F.lit(1.0) - recall) * (precision + base) / 2
    )


def error_rate(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Share of rows where prediction != label."""
    wrong = F.when(F.col(prediction) != F.col(label), 1.0).otherwise(0.0)
    return df.agg(F.round(F.avg(wrong), DIGITS).alias("error_rate"))


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Share of rows where prediction == label."""
    right = F.when(F.col(prediction) == F.col(label), 1.0).otherwise(0.0)
    return df.agg(F.round(F.avg(right), DIGITS).alias("accuracy"))


def hard_auc(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """ROC area of hard 0/1 predictions."""
    c = confusion(df, label, prediction)
    return c.select(F.round(_hard_auc(c.pos, c.neg, c.tp, c.fp), DIGITS).alias("hard_auc"))


def hard_aupr(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """PR area of hard 0/1 predictions."""
    c = confusion(df, label, prediction)
    return c.select(F.round(_hard_aupr(c.pos, c.neg, c.tp, c.fp), DIGITS).alias("hard_aupr"))


def summary(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """error_rate, accuracy, hard_auc, hard_aupr and the counts, in one pass."""
    c = confusion(df, label, prediction)
    n = c.pos + c.neg
    return c.select(
        F.round((c.fp + c.fn) / n, DIGITS).alias("error_rate"),
        F.round((c.tp + c.tn) / n, DIGITS).alias("accuracy"),
        F.round(_hard_auc(c.pos, c.neg, c.tp, c.fp), DIGITS).alias("hard_auc"),
        F.round(_hard_aupr(c.pos, c.neg, c.tp, c.fp), DIGITS).alias("hard_aupr"),
        n.cast("long").alias("rows"),
    )


def score_auc(df: DataFrame, score: str = "rawPrediction", label: str = "label", metric: str = "areaUnderROC", bins: int = 0) -> float:
    """Curve area from a continuous score (or hard labels, to reproduce T9).

    ``bins=0`` is exact, a point per distinct score; a positive number
    merges neighbouring scores into about so many points.
    """
    ev = BinaryClassificationEvaluator(rawPredictionCol=score, labelCol=label, metricName=metric, numBins=bins)
    return ev.evaluate(df)


# ------------------------------------------------- curves of many models at once
def score_points(scored: DataFrame, by: Sequence[str] = (), label: str = "label", prediction: str = "prediction", score: str = "score") -> DataFrame:
    """Per group and distinct score: rows of each label, and those predicted positive. NULL or NaN scores rank last."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    value = F.when(F.isnan(score), F.lit(None).cast("double")).otherwise(F.col(score).cast("double"))
    return scored.groupBy(*by, value.alias("score")).agg(
        F.count_if(y).alias("pos"), F.count_if(~y).alias("neg"), F.count_if(y & p).alias("hit"), F.count_if(~y & p).alias("alarm")
    )


def score_curve(points: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """ROC and PR curve as a table: a row per distinct score taken as the threshold, highest first.

    Adds ``place``, ``tp`` and ``fp`` (rows with this score or a higher one)
    and the curves' coordinates; a group without positives (negatives) has
    NULL tpr (fpr).
    """
    order = [F.col("score").desc_nulls_last()]
    summed = running(points, order, groups=by, totals={"tp": "pos", "fp": "neg"}, position="place")
    sides = points.groupBy(*by).agg(F.sum("pos").alias("all_pos"), F.sum("neg").alias("all_neg"))
    if by:
        names = {b: f"__{b}" for b in by}
        sides = sides.withColumnsRenamed(names)
        same = [summed[b].eqNullSafe(sides[n]) for b, n in names.items()]
        summed = summed.join(F.broadcast(sides), same).drop(*names.values())  # a row per group of the points: a model or so
    else:
        totals = sides.first()
        summed = summed.withColumns({c: F.lit(totals[c]) for c in ("all_pos", "all_neg")})
    return summed.withColumns(
        {
            "tpr": F.try_divide(F.col("tp").cast("double"), F.col("all_pos").cast("double")),
            "fpr": F.try_divide(F.col("fp").cast("double"), F.col("all_neg").cast("double")),
            "precision": F.col("tp") / (F.col("tp") + F.col("fp")),
        }
    )


def score_areas(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Exact areas under both curves per group, in one aggregate: a step's earlier point follows from its own counts.

    ROC: trapezoids from (0, 0), summed in whole numbers. PR: trapezoids
    that begin at the first point's precision, as Spark's evaluator has it.
    """
    earlier = F.col("tp") - F.col("pos") + F.col("fp") - F.col("neg")
    before = F.when(earlier > 0, (F.col("tp") - F.col("pos")) / earlier).otherwise(F.col("precision"))
    twice = F.col("neg").cast("decimal(19,0)") * (F.col("tp") * 2 - F.col("pos")).cast("decimal(19,0)")
    sides = F.max("all_pos").cast("double") * F.max("all_neg")
    return curve.groupBy(*by).agg(
        F.round(F.try_divide(F.sum(twice).cast("double"), sides * 2), DIGITS).alias("score_auc"),
        F.round(F.try_divide(F.sum(F.col("pos") * (F.col("precision") + before)), F.max("all_pos") * 2.0), DIGITS).alias("score_aupr"),
    )


def summaries(points: DataFrame, by: Sequence[str]) -> DataFrame:
    """``summary`` of every group of the points."""
    names = {"pos": "pos", "neg": "neg", "tp": "hit", "fp": "alarm"}
    c = points.groupBy(*by).agg(*[F.sum(v).cast("double").alias(k) for k, v in names.items()])
    n, wrong = F.col("pos") + F.col("neg"), F.col("pos") - F.col("tp") + F.col("fp")
    sides = [F.col(x) for x in ("pos", "neg", "tp", "fp")]
    return c.select(
        *by, F.round(wrong / n, DIGITS).alias("error_rate"), F.round((n - wrong) / n, DIGITS).alias("accuracy"),
        F.round(_hard_auc(*sides), DIGITS).alias("hard_auc"), F.round(_hard_aupr(*sides), DIGITS).alias("hard_aupr"),
        n.cast("long").alias("rows"),
    )
