"""The click-log tables, derived from the generated TPC-H-style parquet.

``user_log`` is one row per lineitem: the order's customer is the user,
the part is the item (its size the category, its brand the brand), the
supplier is the seller, the ship date gives the MMDD day code and the
return flag / line status give the action. ``user_info`` comes from the
customer table with some ages and genders missing. ``pairs`` are the
(user, seller) pairs with a purchase, labelled 1 when the purchases fall
on two or more days.

Both joins always run, whatever columns are asked for, so the rows never
depend on the projection.

``log_table`` stores the whole log once per application and state of the
input files in the shared staging folder, and ``stored_log`` also its item
counts per day, made from the stored rows when they are first asked for
(see ``stored_log.StoredLog``); later queries read only the columns
they use and never repeat the three-table join. It has one layout at every
size: a folder per day code, which the one-day and November reports prune
exactly, each file sorted by (user, seller). This is how the log would be
kept in production (a stored fact table); the view is only a device of the
generated data.
"""

from __future__ import annotations

import threading
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import ACTION_FAVOURITE, ACTION_PURCHASE, LOG_COLUMNS, LOG_VIEW, USERS_VIEW
from ..session import app_id, fingerprint, fresh_dir
from .stored_log import StoredLog



def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _action(returnflag: Column, linestatus: Column) -> Column:
    return (
        F.when(returnflag == "A", F.lit(2))
        .when(returnflag == "N", F.lit(0))
        .when(linestatus == "F", F.lit(1))
        .otherwise(F.lit(3))
        .cast("int")
    )


def user_log(spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None) -> DataFrame:
    """The log view with only ``columns`` (all seven by default)."""
    cols = tuple(columns) if columns is not None else LOG_COLUMNS
    unknown = set(cols) - set(LOG_COLUMNS)
    if unknown:
        raise ValueError(f"unknown log columns: {sorted(unknown)}")

    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_shipdate", "l_returnflag", "l_linestatus"
    )
    ship = F.col("l_shipdate")
    if isinstance(li.schema["l_shipdate"].dataType, T.TimestampType):
        # read as an instant: take its UTC wall clock, whatever the session zone
        ship = F.to_utc_timestamp(ship, spark.conf.get("spark.sql.session.timeZone"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_size", "p_brand")
    # day and action are made before the joins: two short numbers per row travel, not an instant and two texts
    day = (F.month(ship) * 100 + F.dayofmonth(ship)).cast("short")
    li = li.select(
        "l_orderkey", "l_partkey", "l_suppkey", day.alias("day"),
        _action(F.col("l_returnflag"), F.col("l_linestatus")).cast("byte").alias("action"),
    )
    df = li.join(orders, "l_orderkey").join(part, "l_partkey")

    exprs = {
        "user_id": lambda: F.col("o_custkey").cast("bigint"),
        "item_id": lambda: F.col("l_partkey").cast("bigint"),
        "cat_id": lambda: F.col("p_size").cast("bigint"),
        "seller_id": lambda: F.col("l_suppkey").cast("bigint"),
        "brand_id": lambda: F.col("p_brand").cast("string"),
        "time_stamp": lambda: F.lpad(F.col("day").cast("string"), 4, "0"),
        "action_type": lambda: F.col("action").cast("int"),
    }
    return df.select(*[exprs[c]().alias(c) for c in cols])


_SOURCES = ("lineitem", "orders", "part")
_LOG_TABLES: dict[tuple, str] = {}
_COUNTED: set[str] = set()
_LOCK = threading.Lock()


def source_state(spark: SparkSession, sf_dir: str, names: Iterable[str] = _SOURCES) -> tuple:
    """Identifies the application and the files a stored table was made from."""
    return (app_id(spark), *fingerprint(spark, [f"{sf_dir.rstrip('/')}/{n}.parquet" for n in names]))


def _stored(spark: SparkSession, sf_dir: str, refresh: bool, counted: bool) -> StoredLog:
    """The stored log, and its counts if ``counted``: each is made once.

    The folder is remembered, not the DataFrames, so each caller reads it
    through its own session.
    """
    key = source_state(spark, sf_dir)
    with _LOCK:
        path = None if refresh else _LOG_TABLES.get(key)
        if path is None:
            path = fresh_dir(spark, "user-log")
            StoredLog.write(user_log(spark, sf_dir), path)
            _LOG_TABLES[key] = path
        stored = StoredLog(spark, path)
        if counted and path not in _COUNTED:
            stored.count()
            _COUNTED.add(path)
    return stored


def stored_log(spark: SparkSession, sf_dir: str, refresh: bool = False) -> StoredLog:
    """The full log and its counts, written once per application and state of its files."""
    return _stored(spark, sf_dir, refresh, counted=True)


def log_table(spark: SparkSession, sf_dir: str, refresh: bool = False) -> DataFrame:
    """The full log, written once per application and state of its files."""
    return _stored(spark, sf_dir, refresh, counted=False).log()


def log(spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None) -> DataFrame:
    """Columns of the stored log (see ``log_table``)."""
    cols = list(columns) if columns is not None else list(LOG_COLUMNS)
    return log_table(spark, sf_dir).select(*cols)


def user_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer; about 10% of ages and a quarter of genders null."""
    c = table(spark, sf_dir, "customer")
    age = F.col("c_custkey") % 10
    gender = F.col("c_nationkey") % 4
    return c.select(
        F.col("c_custkey").cast("bigint").alias("user_id"),
        F.when(age == 9, F.lit(None)).otherwise(age).cast("int").alias("age_range"),
        F.when(gender == 3, F.lit(None)).otherwise(gender).cast("int").alias("gender"),
    )


def train_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user, merchant, label): pairs with a purchase; label 1 if bought on 2+ days.

    "Two or more distinct days" is tested as ``min(day) < max(day)`` (NULL
    days are ignored by both, as by a distinct count): an algebraic
    aggregate, so one partially aggregated shuffle instead of the two a
    distinct count needs.
    """
    purchases = log(spark, sf_dir, ["user_id", "seller_id", "time_stamp", "action_type"])
    return (
        purchases.where(F.col("action_type") == ACTION_PURCHASE)
        .groupBy("user_id", "seller_id")
        .agg(F.min("time_stamp").alias("first_day"), F.max("time_stamp").alias("last_day"))
        .select(
            "user_id",
            F.col("seller_id").alias("merchant_id"),
            F.when(F.col("first_day") < F.col("last_day"), 1).otherwise(0).cast("int").alias("label"),
        )
    )


def scoring_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unlabelled pairs to score: every (user, seller) pair with a favourite.

    The third column mirrors the unused score column of the original
    unlabelled pair file: present, always empty.
    """
    favourites = log(spark, sf_dir, ["user_id", "seller_id", "action_type"])
    return (
        favourites.where(F.col("action_type") == ACTION_FAVOURITE)
        .select("user_id", F.col("seller_id").alias("merchant_id"))
        .distinct()
        .withColumn("prob", F.lit(None).cast("string"))
    )


def register_views(log: DataFrame, users: DataFrame) -> None:
    """Register the SQL forms' views (A8) under names of the package's own."""
    log.createOrReplaceTempView(LOG_VIEW)
    users.createOrReplaceTempView(USERS_VIEW)
