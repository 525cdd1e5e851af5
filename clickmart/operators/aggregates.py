"""Grouped counts.

Every aggregate here is algebraic, so Spark plans it as a partial
(map-side) HashAggregate before the shuffle and a final one after: a hot
key (a seller with a third of all rows) costs one partial row per map
task, not a third of the data in one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import count_distinct_with_null


def count_by(df: DataFrame, keys: str | Sequence[str], name: str = "n") -> DataFrame:
    """Rows per key."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def distinct_count_by(
    df: DataFrame, keys: str | Sequence[str], value: str, name: str, null_as_value: bool = True
) -> DataFrame:
    """Distinct ``value`` per key; NULL counts as a value by default."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    expr = count_distinct_with_null(value) if null_as_value else F.count_distinct(value)
    return df.groupBy(*keys).agg(expr.alias(name))
