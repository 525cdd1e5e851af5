"""Trees as tables: nodes, routing, split search and growing.

A saved tree model is already a table of nodes; ``node_table`` reads it in
one form for single trees, forests and boosted trees. ``route`` sends rows
down all trees by one join with the node table per level: the table is as
small as the model (trees times 2 ** (depth + 1) nodes), so each join is a
broadcast and no row is shuffled. ``tree_scores`` adds the trees' leaves
up to the model's prediction.

``best_splits`` states the best Gini split of every node from one
aggregate of label histograms per (node, feature, value), combined before
the shuffle; ``grow`` repeats it per level into a node table of the same
form. Every row takes part: no sample decides the candidate thresholds.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.features import PAIR_KEYS
from ..session import fresh_dir
from ..sinks.writers import stage

#: Nodes that a model may have for its table to be broadcast; larger ones are joined without a hint.
BROADCAST_NODES = 1 << 18
GAIN_DIGITS = 9

NODE_COLUMNS = ("tree", "weight", "node", "feature", "threshold", "left", "right", "prediction", "stats", "rows")


# ------------------------------------------------------------------- nodes
def node_table(spark: SparkSession, model_path: str) -> DataFrame:
    """The nodes of a saved tree pipeline; ``feature`` .. ``right`` are NULL for a leaf.

    ``stats`` holds the rows per class for classification trees. Splits on
    categories have no threshold and are refused.
    """
    data = spark.read.parquet(f"{model_path}/stages/*/data")
    if "nodeData" in data.columns:
        # id, metadata and weight of each tree; only the order of the columns is the same in all versions
        trees = spark.read.parquet(f"{model_path}/stages/*/treesMetadata").toDF("treeID", "metadata", "weight")
        data = data.join(F.broadcast(trees), "treeID").select(F.col("treeID").alias("tree"), "weight", "nodeData.*")
    else:
        data = data.select(F.lit(0).alias("tree"), F.lit(1.0).alias("weight"), "*")
    inner = F.col("leftChild") >= 0
    threshold = F.when(F.col("split.numCategories") == -1, F.col("split.leftCategoriesOrThreshold")[0]).otherwise(
        F.raise_error(F.lit("splits on categories have no threshold"))
    )
    return data.select(
        "tree", "weight", F.col("id").alias("node"),
        F.when(inner, F.col("split.featureIndex")).alias("feature"), F.when(inner, threshold).alias("threshold"),
        F.when(inner, F.col("leftChild")).alias("left"), F.when(inner, F.col("rightChild")).alias("right"),
        "prediction", F.col("impurityStats").alias("stats"), F.col("rawCount").alias("rows"),
    )


def save_nodes(model: PipelineModel, spark: SparkSession, label: str = "trees") -> DataFrame:
    """``node_table`` of a fitted pipeline, by way of a saved copy in the staging folder."""
    path = fresh_dir(spark, label)
    model.write().save(path)
    return node_table(spark, path)


def broken_sums(nodes: DataFrame) -> DataFrame:
    """Inner nodes whose rows are not those of their two children."""
    child = nodes.select(F.col("tree").alias("ct"), F.col("node").alias("cn"), F.col("rows").alias("child_rows"))
    sides = nodes.where(F.col("feature").isNotNull()).select("tree", "node", "rows", F.explode(F.array("left", "right")).alias("side"))
    met = sides.join(child, (F.col("tree") == F.col("ct")) & (F.col("side") == F.col("cn")), "left")
    return met.groupBy("tree", "node", "rows").agg(F.sum("child_rows").alias("below")).where(~F.col("below").eqNullSafe(F.col("rows")))


# ----------------------------------------------------------------- routing
def route(nodes: DataFrame, rows: DataFrame, trees: int, depth: int, features: str = "features") -> DataFrame:
    """Every row in every tree with the leaf it ends in: ``rows``' columns, tree, node and the leaf's values."""
    steps = nodes.select("tree", "node", "feature", "threshold", "left", "right")
    ends = nodes.select("tree", "node", "weight", "prediction", "stats")
    if trees * 2 ** (depth + 1) <= BROADCAST_NODES:
        steps, ends = F.broadcast(steps), F.broadcast(ends)
    kept = [c for c in rows.columns if c != features]
    x = vector_to_array(features) if rows.schema[features].dataType.typeName() == "vectorudt" else F.col(features)
    at = rows.select(*kept, x.alias("__x"), F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"), F.lit(0).alias("node"))
    for _ in range(depth):
        met = at.join(steps, ["tree", "node"])
        goes_left = F.get(F.col("__x"), F.col("feature")) <= F.col("threshold")
        below = F.when(goes_left, F.col("left")).otherwise(F.col("right"))
        at = met.select(*kept, "__x", "tree", F.when(F.col("feature").isNull(), F.col("node")).otherwise(below).alias("node"))
    return at.drop("__x").join(ends, ["tree", "node"]).select(*kept, "tree", "node", "weight", "prediction", "stats")


def tree_scores(routed: DataFrame, kind: str, keys: tuple[str, ...] = PAIR_KEYS) -> DataFrame:
    """Prediction and positive-class score per row: class shares voted by ``dt`` and ``rf``, margins added by ``gbt``.

    A row's trees stand in one task, so they are combined before the shuffle.
    """
    if kind == "gbt":
        margin = F.sum(F.col("weight") * F.col("prediction"))
        out = routed.groupBy(*keys).agg(margin.alias("margin"))
        return out.select(
            *keys, F.when(F.col("margin") > 0, 1.0).otherwise(0.0).alias("prediction"),
            (F.lit(1.0) / (F.lit(1.0) + F.exp(F.col("margin") * -2.0))).alias("score"),
        )
    total = F.col("stats")[0] + F.col("stats")[1]
    votes = [F.sum(F.try_divide(F.col("stats")[i], total) * F.col("weight")).alias(f"v{i}") for i in range(2)]
    out = routed.groupBy(*keys).agg(*votes)
    return out.select(
        *keys, F.when(F.col("v1") > F.col("v0"), 1.0).otherwise(0.0).alias("prediction"),
        (F.col("v1") / (F.col("v0") + F.col("v1"))).alias("score"),
    )


# ------------------------------------------------------------ split search
def label_histograms(rows: DataFrame) -> DataFrame:
    """neg and pos per (node, feature, value) of rows (node, label, x): the one pass of a level."""
    cells = rows.select("node", "label", F.posexplode("x").alias("feature", "value"))
    y = F.col("label") == 1
    return cells.groupBy("node", "feature", "value").agg(F.count_if(~y).alias("neg"), F.count_if(y).alias("pos"))


def _purity(neg: Column, pos: Column) -> Column:
    """Rows times the sum of squared class shares; 0 of no rows."""
    n = (neg + pos).cast("double")
    return F.coalesce(F.try_divide(neg.cast("double") * neg + pos.cast("double") * pos, n), F.lit(0.0))


def best_splits(histograms: DataFrame, min_rows: int = 1) -> DataFrame:
    """The split of greatest Gini gain per node, if any has one above 0.

    Candidates lie midway between neighbouring values of a feature in the node; both
    sides keep ``min_rows`` rows. Gains equal to ``GAIN_DIGITS`` digits go
    to the first feature, then the lowest threshold. The window of a (node,
    feature) holds its distinct values, not its rows.
    """
    by_value = Window.partitionBy("node", "feature").orderBy("value")
    whole = Window.partitionBy("node", "feature")
    sums = histograms.select(
        "node", "feature", "value", F.lead("value").over(by_value).alias("next"),
        *[F.sum(c).over(by_value.rowsBetween(Window.unboundedPreceding, 0)).alias(f"left_{c}") for c in ("neg", "pos")],
        *[F.sum(c).over(whole).alias(c) for c in ("neg", "pos")],
    ).where("next is not null")
    ln, lp, n, p = (F.col(c) for c in ("left_neg", "left_pos", "neg", "pos"))
    rows = (n + p).cast("double")
    gain = (_purity(ln, lp) + _purity(n - ln, p - lp) - _purity(n, p)) / rows
    found = sums.select(
        "node", "feature", ((F.col("value") + F.col("next")) / 2).alias("threshold"), F.round(gain, GAIN_DIGITS).alias("gain"),
        "left_neg", "left_pos", (n - ln).alias("right_neg"), (p - lp).alias("right_pos"),
    ).where((F.col("gain") > 0) & (ln + lp >= min_rows) & (n + p - ln - lp >= min_rows))
    names = [c for c in found.columns if c not in ("node", "gain")]
    best = found.groupBy("node").agg(F.min(F.struct((-F.col("gain")).alias("loss"), *names)).alias("b"))
    return best.select("node", *[f"b.{c}" for c in names], (-F.col("b.loss")).alias("gain"))


def grow(data: DataFrame, depth: int = 3, min_rows: int = 1, features: str = "features", label: str = "label") -> DataFrame:
    """A Gini tree of (label, features) rows as a node table (children of node n: 2n + 1, 2n + 2).

    One aggregate over all rows per level. A level's splits (at most a row
    per node) are stored; rows find their node by broadcast joins, so only
    histograms are shuffled. No rows give no nodes.
    """
    spark = data.sparkSession
    rows = data.select(F.col(label).alias("label"), vector_to_array(features).alias("x"), F.lit(0).alias("node"))
    y = F.col("label") == 1
    root = rows.agg(F.count_if(~y).alias("neg"), F.count_if(y).alias("pos")).where("neg + pos > 0")
    level, found = stage(root.select(F.lit(0).alias("node"), "neg", "pos"), spark, "tree-level"), []
    for _ in range(depth):
        splits = stage(best_splits(label_histograms(rows), min_rows), spark, "tree-splits")
        found.append(_nodes(level, splits))
        sides = [("left", 1), ("right", 2)]
        level = reduce(
            DataFrame.unionByName,
            [splits.select((F.col("node") * 2 + k).alias("node"), F.col(f"{s}_neg").alias("neg"), F.col(f"{s}_pos").alias("pos")) for s, k in sides],
        )
        met = rows.join(F.broadcast(splits.select("node", "feature", "threshold")), "node")
        side = F.when(F.get(F.col("x"), F.col("feature")) <= F.col("threshold"), 1).otherwise(2)
        rows = met.select("label", "x", (F.col("node") * 2 + side).alias("node"))
    found.append(_nodes(level, None))
    return reduce(DataFrame.unionByName, found)


def _nodes(level: DataFrame, splits: DataFrame | None) -> DataFrame:
    """A level's nodes; those without a split are leaves."""
    if splits is None:
        none = {"feature": "int", "threshold": "double", "gain": "double"}
        met = level.withColumns({c: F.lit(None).cast(kind) for c, kind in none.items()})
    else:
        met = level.join(splits.select("node", "feature", "threshold", "gain"), "node", "left")
    inner = F.col("feature").isNotNull()
    return met.select(
        F.lit(0).alias("tree"), F.lit(1.0).alias("weight"), "node", "feature", "threshold",
        F.when(inner, F.col("node") * 2 + 1).alias("left"), F.when(inner, F.col("node") * 2 + 2).alias("right"),
        F.when(F.col("pos") > F.col("neg"), 1.0).otherwise(0.0).alias("prediction"),
        F.array(F.col("neg").cast("double"), F.col("pos").cast("double")).alias("stats"), (F.col("neg") + F.col("pos")).alias("rows"), "gain",
    )
