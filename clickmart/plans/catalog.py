"""Named queries over the test tables: each takes (spark, sf_dir).

Every query reads the generated parquet (the click log through the table
``fixtures.log_table`` stores once per application from the three-table
view) and runs over the whole tables. Parameters follow the original
jobs: day ``1111``, top 100, young = bands 1-3. Because the single day
is sparse, the ranked reports are also registered for the whole of
November (``*_month``) and for all days (``*_all``), so ranks depend on
real counts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import features, filters, joins, ranking, shares
from ..operators.aggregates import count_by
from ..operators.ordering import running
from ..schemas import ACTION_CLICK, ACTION_FAVOURITE, DEFAULT_DAY, LOG_COLUMNS, LOG_SCHEMA
from ..session import fresh_dir
from ..sinks import write, write_lines
from ..sources import fixtures, readers
from ..sources.stored_log import StoredLog

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

MONTH = "11%"


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return deco


def _log(spark: SparkSession, d: str, *cols: str) -> DataFrame:
    return fixtures.log(spark, d, cols or None)


def _users(spark: SparkSession, d: str) -> DataFrame:
    return fixtures.user_info(spark, d)


# --------------------------------------------------------------- filters ---
@query("filter_day_engaged")
def q_filter_day_engaged(spark, d):
    return filters.day_engaged(_log(spark, d))


@query("filter_day_purchase")
def q_filter_day_purchase(spark, d):
    return filters.day_purchase(_log(spark, d))


@query("filter_age_valid")
def q_filter_age_valid(spark, d):
    return filters.age_valid(_users(spark, d))


@query("filter_youth")
def q_filter_youth(spark, d):
    return filters.youth(_users(spark, d))


@query("users_complete")
def q_users_complete(spark, d):
    return filters.users_complete(_users(spark, d))


@query("users_any_attr")
def q_users_any_attr(spark, d):
    return filters.users_any_attr(_users(spark, d))


# --------------------------------------------------------------- sources ---
def _as_lines(df: DataFrame, file_path: str) -> DataFrame:
    """The CSV text form of a view: one comma-joined line per row."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    return df.select(F.concat_ws(",", *fields).alias("value"), F.lit(file_path).alias("file_path"))


@query("split_fields")
def q_split_fields(spark, d):
    lines = _as_lines(_log(spark, d), "user_log_format1.csv")
    return readers.typed(readers.split_fields(lines, LOG_COLUMNS), LOG_SCHEMA)


@query("tagged_source")
def q_tagged_source(spark, d):
    lines = _as_lines(_log(spark, d), "data/user_log_format1.csv").unionByName(
        _as_lines(_users(spark, d), "data/user_info_format1.csv")
    )
    return readers.tagged_source(lines)


# real files: written under the staging folder, read back whole
@query("csv_scan")
def q_csv_scan(spark, d):
    path = fresh_dir(spark, "csv-log")
    write(_log(spark, d), path, fmt="csv")
    return readers.read_log(spark, path)


@query("csv_multi_path")
def q_csv_multi_path(spark, d):
    base = fresh_dir(spark, "csv-parts")
    log = _log(spark, d)
    clicks = F.col("action_type") == 0
    write(log.where(clicks), f"{base}/clicks", fmt="csv")
    # the other file has its columns in another order
    write(log.where(~clicks).select(*reversed(LOG_COLUMNS)), f"{base}/rest", fmt="csv")
    return readers.read_log(spark, f"{base}/clicks,{base}/rest")


@query("csv_users_scan")
def q_csv_users_scan(spark, d):
    path = fresh_dir(spark, "csv-users")
    write(_users(spark, d), path, fmt="csv")
    return readers.require_unique(readers.read_users(spark, path), "user_id")


def _text_files(spark: SparkSession, d: str) -> tuple[str, str]:
    base = fresh_dir(spark, "text")
    paths = f"{base}/user_log_format1.csv", f"{base}/user_info_format1.csv"
    for df, path in zip((_log(spark, d), _users(spark, d)), paths):
        write_lines(_as_lines(df, path), path, column="value")
    return paths


@query("text_scan")
def q_text_scan(spark, d):
    log, _ = _text_files(spark, d)
    return readers.typed(readers.split_fields(readers.read_lines(spark, log), LOG_COLUMNS), LOG_SCHEMA)


@query("tagged_scan")
def q_tagged_scan(spark, d):
    return readers.read_tagged(spark, ",".join(_text_files(spark, d)))


@query("csv_sink_round_trip")
def q_csv_sink_round_trip(spark, d):
    path, top = fresh_dir(spark, "csv-top"), q_top_merchants_all(spark, d)
    write(top, path, fmt="csv")
    return readers.read_csv(spark, path, top.schema)


@query("report_round_trip")
def q_report_round_trip(spark, d):
    path = fresh_dir(spark, "report")
    write_lines(q_rank_report(spark, d), path)
    return readers.read_lines(spark, path).select(F.col("value").alias("line"))


def _damaged_log(spark: SparkSession, d: str) -> str:
    """The log as a text file with a header in which some lines are cut, too long, blank or no numbers."""
    path = f"{fresh_dir(spark, 'dirty')}/user_log_dirty.csv"
    log = _log(spark, d)
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in LOG_COLUMNS]
    kind = F.pmod(F.col("user_id") + F.col("item_id"), F.lit(11))
    line = (
        F.when(kind == 0, F.concat_ws(",", *fields[:5]))
        .when(kind == 1, F.concat_ws(",", *fields, F.lit("x")))
        .when(kind == 2, F.concat_ws(",", F.concat(F.lit("u"), fields[0]), *fields[1:]))
        .when(kind == 3, F.concat_ws(",", *fields[:6], F.lit("1.5")))
        .when(kind == 4, F.lit(""))
        .otherwise(F.concat_ws(",", *fields))
    )
    header = spark.createDataFrame([(",".join(LOG_COLUMNS),)], "value string")
    write_lines(header.unionByName(log.select(line.alias("value"))), path, column="value")
    return path


@query("csv_quarantine_good")
def q_csv_quarantine_good(spark, d):
    """The rows of a damaged file that can be read."""
    return readers.quarantine(spark, _damaged_log(spark, d), LOG_SCHEMA)[0]


@query("csv_quarantine_bad")
def q_csv_quarantine_bad(spark, d):
    """The other lines of that file, with the file's name and the reason."""
    bad = readers.quarantine(spark, _damaged_log(spark, d), LOG_SCHEMA)[1]
    name = F.regexp_extract("file", r"([^/]+\.csv)(?:/[^/]*)?$", 1)
    return bad.select(name.alias("file"), "line", "reason")


# ----------------------------------------------------------------- joins ---
@query("join_inner")
def q_join_inner(spark, d):
    log = filters.day_engaged(_log(spark, d, "user_id", "seller_id", "time_stamp", "action_type"))
    users = filters.users_complete(_users(spark, d)).select("user_id", "age_range")
    return joins.join_inner(log.select("user_id", "seller_id"), users)


@query("join_left_profile")
def q_join_left_profile(spark, d):
    return joins.join_left_profile(fixtures.train_pairs(spark, d), _users(spark, d))


@query("join_youth")
def q_join_youth(spark, d):
    log = filters.day_engaged(_log(spark, d, "user_id", "seller_id", "time_stamp", "action_type"))
    return joins.join_youth(log.select("user_id", "seller_id"), _users(spark, d))


@query("join_tagged")
def q_join_tagged(spark, d):
    return joins.join_tagged(q_tagged_source(spark, d))


# ----------------------------------------------------------- aggregates ---
@query("count_by_item")
def q_count_by_item(spark, d):
    return ranking.item_counts(_log(spark, d, "item_id", "time_stamp", "action_type"))


@query("count_by_seller")
def q_count_by_seller(spark, d):
    log = _log(spark, d, "user_id", "seller_id", "time_stamp", "action_type")
    return ranking.youth_seller_counts(log, _users(spark, d))


@query("distinct_buyers")
def q_distinct_buyers(spark, d):
    return shares.buyers(_log(spark, d, "user_id", "time_stamp", "action_type"))


@query("total_logs")
def q_total_logs(spark, d):
    return features.total_logs(_log(spark, d, "user_id", "seller_id"))


@query("action_counts")
def q_action_counts(spark, d):
    return features.action_counts(_log(spark, d, "user_id", "seller_id", "action_type"))


@query("unique_items")
def q_unique_items(spark, d):
    log = _log(spark, d, "user_id", "seller_id", "item_id")
    return features.distinct_per_pair(log, "item_id", "unique_item_ids")


@query("categories")
def q_categories(spark, d):
    log = _log(spark, d, "user_id", "seller_id", "cat_id")
    return features.distinct_per_pair(log, "cat_id", "categories")


@query("browse_days")
def q_browse_days(spark, d):
    log = _log(spark, d, "user_id", "seller_id", "time_stamp")
    return features.distinct_per_pair(log, "time_stamp", "browse_days")


@query("action_features")
def q_action_features(spark, d):
    return features.action_features(_log(spark, d, "user_id", "seller_id", "action_type"))


# --------------------------------------------------------------- top-k ---
_RANK_LOG = ("item_id", "time_stamp", "action_type")
_SELLER_LOG = ("user_id", "seller_id", "time_stamp", "action_type")


@query("top_items")
def q_top_items(spark, d):
    return ranking.top_items(_log(spark, d, *_RANK_LOG))


@query("top_items_month")
def q_top_items_month(spark, d):
    return ranking.top_items(_log(spark, d, *_RANK_LOG), day=MONTH)


@query("top_items_all")
def q_top_items_all(spark, d):
    """From the stored day counts; no log row is read."""
    return ranking.top_k(fixtures.stored_log(spark, d).item_counts(), "item_id")


@query("top_items_replaced")
def q_top_items_replaced(spark, d):
    """The all-time report after November came again: favourites turned into clicks, the 11th withdrawn."""
    log = _log(spark, d)
    stored = StoredLog.create(log, fresh_dir(spark, "replaced-log"))
    turned = F.when(F.col("action_type") == ACTION_FAVOURITE, ACTION_CLICK).otherwise(F.col("action_type"))
    november = log.where(F.col("time_stamp").like(MONTH) & (F.col("time_stamp") != DEFAULT_DAY))
    stored.replace_days(november.withColumn("action_type", turned), withdrawn=[DEFAULT_DAY])
    return ranking.top_k(stored.item_counts(), "item_id")


@query("top_merchants")
def q_top_merchants(spark, d):
    return ranking.top_merchants(_log(spark, d, *_SELLER_LOG), _users(spark, d))


@query("top_merchants_month")
def q_top_merchants_month(spark, d):
    return ranking.top_merchants(_log(spark, d, *_SELLER_LOG), _users(spark, d), day=MONTH)


@query("top_merchants_all")
def q_top_merchants_all(spark, d):
    return ranking.top_merchants(_log(spark, d, *_SELLER_LOG), _users(spark, d), day=None)


@query("top_merchants_complete")
def q_top_merchants_complete(spark, d):
    return ranking.top_merchants(
        _log(spark, d, *_SELLER_LOG), _users(spark, d), day=None, users_mode="complete"
    )


@query("sorted_item_counts")
def q_sorted_item_counts(spark, d):
    counts = ranking.item_counts(_log(spark, d, *_RANK_LOG), day=MONTH)
    return ranking.sorted_counts(counts, "item_id")


@query("item_ranks")
def q_item_ranks(spark, d):
    """Every item with its exact rank by engaged actions of the whole log."""
    return ranking.rank_all(ranking.item_counts(_log(spark, d, *_RANK_LOG), day=None), "item_id")


@query("seller_item_ranks")
def q_seller_item_ranks(spark, d):
    """Every (seller, item) pair with its rank within the seller and the running share of the seller's actions."""
    log = filters.day_engaged(_log(spark, d, "item_id", "seller_id", "time_stamp", "action_type"), None)
    counts = count_by(log, ["seller_id", "item_id"])
    order = [F.col("n").desc(), F.col("item_id").asc_nulls_last()]
    return running(counts, order, groups=["seller_id"], totals={"running_n": "n"}, position="rank")


@query("log_preview")
def q_log_preview(spark, d):
    # ordered by user, every other column breaks ties: a deterministic 10
    return _log(spark, d).orderBy(*[F.col(c).asc_nulls_last() for c in LOG_COLUMNS]).limit(10)


@query("rank_report")
def q_rank_report(spark, d):
    return ranking.rank_report(q_top_items_month(spark, d), "item_id")


# --------------------------------------------------------------- shares ---
_BUY_LOG = ("user_id", "time_stamp", "action_type")


@query("age_counts_raw")
def q_age_counts_raw(spark, d):
    return shares.buyer_counts(_log(spark, d, *_BUY_LOG), _users(spark, d), "age_range", users_mode="complete")


@query("gender_counts_raw")
def q_gender_counts_raw(spark, d):
    return shares.buyer_counts(_log(spark, d, *_BUY_LOG), _users(spark, d), "gender", users_mode="complete")


@query("age_share")
def q_age_share(spark, d):
    return shares.share(_log(spark, d, *_BUY_LOG), _users(spark, d), "age_range")


@query("gender_share")
def q_gender_share(spark, d):
    return shares.share(_log(spark, d, *_BUY_LOG), _users(spark, d), "gender")


@query("age_share_month")
def q_age_share_month(spark, d):
    return shares.share(_log(spark, d, *_BUY_LOG), _users(spark, d), "age_range", day=MONTH)


@query("sql_age_share")
def q_sql_age_share(spark, d):
    fixtures.register_views(_log(spark, d), _users(spark, d))
    return shares.sql_share(spark, "age_range")


@query("sql_gender_share")
def q_sql_gender_share(spark, d):
    fixtures.register_views(_log(spark, d), _users(spark, d))
    return shares.sql_share(spark, "gender")


@query("age_share_report")
def q_age_share_report(spark, d):
    return shares.share_report(q_age_counts_raw(spark, d), "age_range")


@query("gender_share_report")
def q_gender_share_report(spark, d):
    return shares.share_report(q_gender_counts_raw(spark, d), "gender")


# ------------------------------------------------------------- features ---
_FEATURE_LOG = ("user_id", "item_id", "cat_id", "seller_id", "time_stamp", "action_type")


def feature_table(spark: SparkSession, d: str, scoring: bool = False) -> DataFrame:
    pairs = fixtures.scoring_pairs(spark, d) if scoring else fixtures.train_pairs(spark, d)
    return features.pair_features(pairs, _log(spark, d, *_FEATURE_LOG), _users(spark, d))


@query("pair_features")
def q_pair_features(spark, d):
    return feature_table(spark, d)


@query("features_filled")
def q_features_filled(spark, d):
    return features.fill_features(feature_table(spark, d))


@query("scoring_features")
def q_scoring_features(spark, d):
    return features.fill_features(feature_table(spark, d, scoring=True))


def all_queries() -> dict[str, Query]:
    # the model queries register themselves on import
    from . import model_queries  # noqa: F401

    return dict(QUERIES)
