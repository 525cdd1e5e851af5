"""The (user, merchant) feature table (Q7, Q8).

The original job ran five grouped passes over the log (one per feature
family, the distinct counts as two-stage group-bys) and joined the five
results. Here one aggregate of one read gives all of them: only the items
are a true distinct count, which Spark takes by grouping on (user, seller,
item) first. Categories and days have small domains; their values travel
as sets inside those groups, so rows are not multiplied per distinct
count. ``log_aggregate`` combines before its shuffles, so a hot pair stays
spread over tasks. ``pair_features`` joins the rows to the wanted pairs
first: rows of other pairs are never aggregated, and as they then stand
together by pair, the aggregate moves nothing again (a pair's rows are one
task's stream, sorted with spilling). The profiles are joined on
``user_id``.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import count_distinct_with_null, count_where, domain_size, not_equal_null_safe
from .aggregates import distinct_count_by
from ..schemas import (
    ACTION_CART,
    ACTION_CLICK,
    ACTION_FAVOURITE,
    ACTION_PURCHASE,
    FEATURES,
)

PAIR_KEYS = ("user_id", "merchant_id")
LOG_FEATURES = FEATURES[2:]
PROFILE_FEATURES = FEATURES[:2]
_USER, _MERCHANT, _COPIES, _FOUND = "__user", "__merchant", "__copies", "__found"


def total_logs(log: DataFrame) -> DataFrame:
    """Log rows per (user, merchant) (E5)."""
    return log.groupBy("user_id", F.col("seller_id").alias("merchant_id")).agg(
        F.count(F.lit(1)).alias("total_logs")
    )


def distinct_per_pair(log: DataFrame, column: str, name: str) -> DataFrame:
    """Distinct ``column`` values per (user, merchant), NULL counted."""
    pairs = log.withColumnRenamed("seller_id", "merchant_id")
    return distinct_count_by(pairs, list(PAIR_KEYS), column, name)


def action_counts(log: DataFrame) -> DataFrame:
    """Rows per (user, merchant, action) (E5), the ``times`` column."""
    return log.groupBy("user_id", F.col("seller_id").alias("merchant_id"), "action_type").agg(
        F.count(F.lit(1)).alias("times")
    )


def action_measures() -> list[F.Column]:
    """The four action counts (J1-J4) as conditional counts.

    ``one_clicks`` keeps the original definition: every action that is
    not a click, a missing action included (T1), so it equals carts +
    purchases + favourites on well-formed rows.
    """
    a = F.col("action_type")
    return [
        count_where(not_equal_null_safe(a, ACTION_CLICK)).alias("one_clicks"),
        count_where(a == ACTION_CART).alias("shopping_carts"),
        count_where(a == ACTION_PURCHASE).alias("purchase_times"),
        count_where(a == ACTION_FAVOURITE).alias("favor_times"),
    ]


def clicks() -> F.Column:
    """The real click count beside the inverted ``one_clicks``."""
    return count_where(F.col("action_type") == ACTION_CLICK).alias("clicks")


def action_features(log: DataFrame) -> DataFrame:
    """The four action counts and the real clicks per (user, merchant) in one pass."""
    return log.groupBy("user_id", F.col("seller_id").alias("merchant_id")).agg(
        *action_measures(), clicks()
    )


def log_measures() -> list[F.Column]:
    """All eight log features of a group of log rows."""
    return [
        F.count(F.lit(1)).alias("total_logs"),
        *action_measures(),
        count_distinct_with_null("item_id").alias("unique_item_ids"),
        domain_size("cat_id").cast("long").alias("categories"),
        domain_size("time_stamp").cast("long").alias("browse_days"),
    ]


def log_aggregate(log: DataFrame) -> DataFrame:
    """All eight log features per (user, merchant), from one read of the log."""
    grouped = log.groupBy("user_id", F.col("seller_id").alias("merchant_id"))
    return grouped.agg(*log_measures()).select(*PAIR_KEYS, *LOG_FEATURES)


def pair_features(pairs: DataFrame, log: DataFrame, users: DataFrame) -> DataFrame:
    """Pairs + profile + log features, NULL where a pair has no rows (Q7).

    Column order follows the original table: the pair columns, then
    ``age_range, gender``, then the eight log features. Equal pair rows are
    aggregated once and come back as often as they were.
    """
    extra = [c for c in pairs.columns if c not in PAIR_KEYS]
    wanted = pairs.groupBy(*PAIR_KEYS, *extra).agg(F.count(F.lit(1)).alias(_COPIES))
    rows = log.select(
        F.col("user_id").alias(_USER), F.col("seller_id").alias(_MERCHANT), "item_id", "cat_id", "time_stamp", "action_type"
    )
    met = wanted.join(rows, (F.col("user_id") == F.col(_USER)) & (F.col("merchant_id") == F.col(_MERCHANT)), "left")
    agg = met.groupBy(*PAIR_KEYS, *extra, _COPIES).agg(*log_measures(), F.count(_USER).alias(_FOUND))
    found = agg.withColumns({c: F.when(F.col(_FOUND) > 0, F.col(c)) for c in LOG_FEATURES})
    with_profile = found.join(users.select("user_id", *PROFILE_FEATURES), ["user_id"], "left")
    copies = F.explode(F.sequence(F.lit(1), F.col(_COPIES).cast("int")))
    return with_profile.select(*PAIR_KEYS, *extra, *FEATURES, copies.alias("copy")).drop("copy")


def fill_features(df: DataFrame, value: int = 0, gender_value: int | None = None) -> DataFrame:
    """Missing features become ``value`` (C14).

    ``gender_value`` lets the missing gender get its own code (e.g. 2,
    "unknown") instead of 0, which is also a valid gender (T11).
    """
    if gender_value is None:
        return df.fillna(value, subset=list(FEATURES))
    rest = [f for f in FEATURES if f != "gender"]
    return df.fillna(value, subset=rest).fillna(gender_value, subset=["gender"])


def assemble(
    df: DataFrame,
    label: str | None = "label",
    keep: tuple[str, ...] = PAIR_KEYS,
    output: str = "features",
) -> DataFrame:
    """Dense feature vector + double label.

    ``label=None`` gives every row label 0.0, as the unlabelled pairs had.
    """
    vec = VectorAssembler(inputCols=list(FEATURES), outputCol=output, handleInvalid="keep")
    label_col = F.col(label).cast("double") if label else F.lit(0.0)
    staged = df.select(*keep, label_col.alias("label"), *FEATURES)
    return vec.transform(staged).select(*keep, "label", output)
