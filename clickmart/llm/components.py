"""Connected components of links, as joins and aggregates.

Alternating large-star and small-star steps: every step replaces links by
links to the smallest neighbour known, until nothing changes, in a number
of rounds that grows with the logarithm of the longest chain. Each round
is cut by ``checkpoint()`` into ``spark.checkpoint.dir``; a vertex with a
third of all links is a skewed join key (which AQE splits) and a minimum
that is combined before the shuffle, never one task's list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_dir


def cut(df: DataFrame) -> DataFrame:
    """Checkpoint in the shared folder that the cluster names."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def _large(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small(links: DataFrame) -> DataFrame:
    # every link points from the larger to the smaller vertex
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _state(links: DataFrame) -> tuple:
    # sums of two independent 62-bit mixes: equal for equal sets of links, without an overflow
    mix = F.xxhash64("a", "b")
    return tuple(
        links.agg(
            F.count(F.lit(1)),
            F.sum(mix.cast("decimal(20,0)")),
            F.sum((F.hash("b", "a")).cast("long")),
        ).first()
    )


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every vertex of ``links`` (a, b): root is the least vertex it reaches.

    Self-links, repeated and both-way links are fine; null ends are ignored; no links, no rows.
    """
    links = (
        links.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    links = cut(links)
    before = _state(links)
    while before[0]:
        links = cut(_small(_large(links)))
        after = _state(links)
        if after == before:
            break
        before = after
    # a star forest: each vertex points to its root, roots to nothing
    roots = links.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
