"""Joins between the log, the profiles and the pair tables.

No join hint is given: both sides grow with the data, so the strategy is
left to AQE, which switches to a broadcast hash join only when the
*measured* size of a side after its filters is under
``spark.sql.adaptive.autoBroadcastJoinThreshold``, and splits skewed
partitions of a sort-merge join (one user holding a third of the log).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import YOUTH_BANDS
from . import filters


def join_inner(log: DataFrame, users: DataFrame, key: str = "user_id") -> DataFrame:
    """Inner equi-join on the user key."""
    return log.join(users, key, "inner")


def join_left_profile(pairs: DataFrame, users: DataFrame) -> DataFrame:
    """Left join of pairs to profiles, USING user_id."""
    return pairs.join(users, ["user_id"], "left")


def join_youth(log: DataFrame, users: DataFrame, bands=YOUTH_BANDS) -> DataFrame:
    """Log rows of young users.

    Written as a left-semi join: each log row is emitted at most once and
    only the young users' keys are shuffled (or broadcast, if AQE measures
    them small), never their profiles.
    """
    keys = filters.youth(users, bands).select("user_id")
    return log.join(keys, "user_id", "left_semi")


def join_tagged(tagged: DataFrame, bands=YOUTH_BANDS) -> DataFrame:
    """Reduce-side join of a tagged union, as an equi-join of its two halves.

    ``tagged`` carries ``(user_id, value, tag)`` with tag ``a`` for log
    rows (value = seller) and ``b`` for profile rows (value = age band).
    Returns the sellers of log rows whose user has a young age band.
    """
    log = tagged.where(F.col("tag") == "a").select(
        "user_id", F.col("value").alias("seller_id")
    )
    young = (
        tagged.where(F.col("tag") == "b")
        .where(F.col("value").isin(*[str(b) for b in bands]))
        .select("user_id")
    )
    return log.join(young, "user_id", "left_semi")
