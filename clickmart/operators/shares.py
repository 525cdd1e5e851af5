"""Distinct-buyer counts and shares by a profile attribute (Q3-Q6).

Plan shape: the day's purchases are first reduced to distinct buyers
(partial aggregate, then one shuffle on ``user_id``); the join with the
profiles reuses that partitioning, so only the profile side moves; the
distinct count per attribute is then finished without another shuffle of
buyer rows, and the percentage window runs over at most a handful of
groups. No group is ever gathered in one task: the hot attribute value
(one age band with a third of the buyers) is only ever a partial count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import format_percent, format_percent_sign, percent_of_total
from ..schemas import DEFAULT_DAY, LOG_VIEW, USERS_VIEW, VALID_AGE_BANDS, VALID_GENDERS
from . import filters

VALID = {"age_range": VALID_AGE_BANDS, "gender": VALID_GENDERS}


def buyers(log: DataFrame, day: str | None = DEFAULT_DAY) -> DataFrame:
    """Distinct users with a purchase on ``day``."""
    return filters.day_purchase(log, day).select("user_id").distinct()


def buyer_counts(
    log: DataFrame,
    users: DataFrame,
    attr: str,
    day: str | None = DEFAULT_DAY,
    users_mode: str = "all",
    valid: Sequence[int] | None = None,
) -> DataFrame:
    """Distinct buyers per value of ``attr``.

    ``valid=None`` keeps every group, unknown ones (0, 2, NULL) included,
    as the RDD jobs saved them; otherwise only the listed values count.
    """
    profile = filters.select_users(users, users_mode).select("user_id", attr)
    if valid is not None:
        profile = profile.where(F.col(attr).isin(*valid))
    joined = buyers(log, day).join(profile, "user_id")
    return joined.groupBy(attr).agg(F.count_distinct("user_id").alias("buy_num"))


def _total() -> F.Column:
    return F.sum("buy_num").over(Window.partitionBy())


def share(
    log: DataFrame,
    users: DataFrame,
    attr: str,
    day: str | None = DEFAULT_DAY,
    users_mode: str = "all",
    valid: Sequence[int] | None = None,
) -> DataFrame:
    """Buyer share per valid value, ``percent`` printed with 5 decimals (Q5/Q6)."""
    valid = VALID[attr] if valid is None else valid
    counts = buyer_counts(log, users, attr, day, users_mode, valid)
    return counts.withColumn("percent", format_percent(percent_of_total("buy_num", _total()), 5))


def share_report(raw_counts: DataFrame, attr: str, valid: Sequence[int] | None = None) -> DataFrame:
    """Report form of the RDD jobs: valid groups only, ``12.3%`` text."""
    valid = VALID[attr] if valid is None else valid
    counts = raw_counts.where(F.col(attr).isin(*valid))
    return counts.withColumn(
        "percent", format_percent_sign(percent_of_total("buy_num", _total()), 1)
    )


# The day's purchases are reduced to distinct buyers before the join, so a
# user with a third of all rows is one row per task in the shuffle.
SHARE_SQL = """
SELECT ui.{attr} AS {attr}, COUNT(DISTINCT b.user_id) AS buy_num
FROM (SELECT DISTINCT user_id FROM {log} WHERE action_type = 2 AND time_stamp = :day) AS b
LEFT OUTER JOIN {users} AS ui USING (user_id)
WHERE {predicate}
GROUP BY ui.{attr}
"""

PREDICATES = {
    "age_range": "ui.age_range BETWEEN 1 AND 8",
    "gender": "ui.gender IN (0, 1)",
}


def sql_share(spark: SparkSession, attr: str, day: str = DEFAULT_DAY, log: str = LOG_VIEW, users: str = USERS_VIEW) -> DataFrame:
    """The SQL form over the registered views of the log and the profiles.

    The left join is made inner by the WHERE on a profile column; Catalyst
    rewrites it so (EliminateOuterJoin) and pushes both filters down.
    """
    text = SHARE_SQL.format(attr=attr, log=log, users=users, predicate=PREDICATES[attr])
    counts = spark.sql(text, args={"day": day})
    return counts.withColumn("percent", format_percent(percent_of_total("buy_num", _total()), 5))
