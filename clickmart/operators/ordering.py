"""Positions and running totals over a whole sorted table, without a single task that sees all of it.

``running`` range-partitions the rows by the order, stores the ranges, and
sums twice: a window inside each range, and one over the per-range totals
(a row per range and group), which are joined back as offsets. The result
equals ``row_number()`` and ``sum() over (order by ...)`` over the whole
table; no task holds more than one range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sinks.writers import stage

_RANGE, _BASE = "__range", "__base"


def running(
    df: DataFrame,
    order: Sequence[Column],
    groups: Sequence[str] = (),
    totals: dict[str, str] | None = None,
    position: str = "position",
) -> DataFrame:
    """Adds the 1-based ``position`` in ``order`` and running totals, each row included.

    ``totals`` maps the name of a new column to the column it adds up;
    ``groups`` restarts both per group, whatever the groups' sizes. Rows
    that are equal in ``order`` are numbered in no particular order (and
    share a range), so break ties by the order's last column. NULL groups
    are a group of their own; an empty table stays empty.
    """
    totals, groups = dict(totals or {}), list(groups)
    keys = [F.col(g).asc_nulls_first() for g in groups] + list(order)
    ranged = df.repartitionByRange(*keys).withColumn(_RANGE, F.spark_partition_id())
    # stored, so that a range keeps its rows whatever is computed again
    rows = stage(ranged, df.sparkSession, "ranges")

    inside = Window.partitionBy(_RANGE, *groups).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumns(
        {position: F.row_number().over(Window.partitionBy(_RANGE, *groups).orderBy(*order)).cast("long")}
        | {name: F.sum(c).over(inside) for name, c in totals.items()}
    )
    names = {position: F.count(F.lit(1))} | {name: F.sum(c) for name, c in totals.items()}
    sums = rows.groupBy(_RANGE, *groups).agg(*[agg.alias(f"{_BASE}_{n}") for n, agg in names.items()])
    earlier = Window.partitionBy(*groups).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(
        F.col(_RANGE).alias("__r"),
        *[F.col(g).alias(f"__g{i}") for i, g in enumerate(groups)],
        *[F.sum(f"{_BASE}_{n}").over(earlier).alias(f"{_BASE}_{n}") for n in names],
    )
    same = local[_RANGE] == bases["__r"]
    for i, g in enumerate(groups):
        same = same & local[g].eqNullSafe(bases[f"__g{i}"])
    out = local.join(bases, same)
    return out.select(
        *df.columns,
        *[(F.col(n) + F.coalesce(F.col(f"{_BASE}_{n}"), F.lit(0))).alias(n) for n in names],
    )
