"""Row filters over the log and the user profiles.

Plain column predicates: Catalyst pushes them below joins and, on a
Parquet input, into the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import not_equal_null_safe
from ..schemas import (
    ACTION_CLICK,
    ACTION_PURCHASE,
    DEFAULT_DAY,
    VALID_AGE_BANDS,
    VALID_GENDERS,
    YOUTH_BANDS,
)

USER_MODES = ("all", "complete", "any")


def on_day(log: DataFrame, day: str | None = DEFAULT_DAY) -> DataFrame:
    """Rows of one MMDD day; ``None`` keeps every day; ``'11%'`` is a LIKE pattern."""
    if day is None:
        return log
    if "%" in day or "_" in day:
        return log.where(F.col("time_stamp").like(day))
    return log.where(F.col("time_stamp") == F.lit(day))


def day_engaged(log: DataFrame, day: str | None = DEFAULT_DAY) -> DataFrame:
    """Rows of ``day`` whose action is anything but a click.

    A missing action counts as "not a click", as the string comparison of
    the text jobs did.
    """
    return on_day(log, day).where(not_equal_null_safe("action_type", ACTION_CLICK))


def day_purchase(log: DataFrame, day: str | None = DEFAULT_DAY) -> DataFrame:
    """Purchases on ``day``."""
    return on_day(log, day).where(F.col("action_type") == ACTION_PURCHASE)


def age_valid(users: DataFrame) -> DataFrame:
    """Users with a known age band 1-8."""
    lo, hi = min(VALID_AGE_BANDS), max(VALID_AGE_BANDS)
    return users.where(F.col("age_range").between(lo, hi))


def gender_valid(users: DataFrame) -> DataFrame:
    """Users with a known gender (0 or 1)."""
    return users.where(F.col("gender").isin(*VALID_GENDERS))


def youth(users: DataFrame, bands=YOUTH_BANDS) -> DataFrame:
    """Users in the young age bands."""
    return users.where(F.col("age_range").isin(*bands))


def users_complete(users: DataFrame) -> DataFrame:
    """Profiles the RDD jobs kept: the gender field is present.

    A line ``id,age,`` lost its trailing empty field on split and was
    dropped; ``id,,gender`` still had three fields and was kept.
    """
    return users.where(F.col("gender").isNotNull())


def users_any_attr(users: DataFrame) -> DataFrame:
    """Profiles the MapReduce join kept: age or gender present."""
    return users.where(F.col("age_range").isNotNull() | F.col("gender").isNotNull())


def select_users(users: DataFrame, mode: str = "all") -> DataFrame:
    """Apply one of the three profile filters: ``all``, ``complete``, ``any``."""
    if mode == "all":
        return users
    if mode == "complete":
        return users_complete(users)
    if mode == "any":
        return users_any_attr(users)
    raise ValueError(f"users mode must be one of {USER_MODES}, got {mode!r}")
