"""A click log kept by day, with mergeable item counts beside it.

Two tables under one folder, each replaced by whole partitions:

* ``log``: the rows, a folder per day code, sorted by (user, seller);
* ``item_days``: per (day, item) the rows and the non-click actions, a
  folder per month, sorted by (day, item).

Counts add, so the report of a day, a month or the whole time is a sum over
``item_days`` and reads no log row. ``replace_days`` writes the days it is
given by dynamic partition overwrite and counts their months again from two
columns of the stored rows; every other folder stays as it is. Counts come
from the stored log alone, never from older counts, so running it again,
after a failure in between or by mistake, ends with the same tables.

Defined results: rows without a day, or with an empty one, are kept under
the null day and month; a missing item is counted as item NULL; a day named
in ``withdrawn`` that the new rows do not hold is removed; an empty
delivery without withdrawn days changes nothing; other columns of the rows
are dropped.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import not_equal_null_safe
from ..schemas import ACTION_CLICK, LOG_COLUMNS, LOG_SCHEMA
from ..session import release

DAY, MONTH = "time_stamp", "month"
_COUNTS = [T.StructField(c, T.LongType()) for c in ("item_id", "n_rows", "engaged")]
_SCHEMAS = {
    "log": LOG_SCHEMA,
    "item_days": T.StructType([T.StructField(DAY, T.StringType()), *_COUNTS, T.StructField(MONTH, T.StringType())]),
}
# Fixed value: the folder name that Spark gives a null partition value.
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def _in_months(months: Iterable[str | None]) -> Column:
    """Days of the months, NULL being one; on the partition column it selects folders."""
    tests = [F.col(DAY).isNull() if m is None else F.col(DAY).startswith(m) for m in months]
    return reduce(or_, tests)


class StoredLog:
    """The two tables under ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    @classmethod
    def create(cls, log: DataFrame, path: str) -> StoredLog:
        """Store a whole log in a new folder and count it."""
        stored = cls.write(log, path)
        stored.count()
        return stored

    @classmethod
    def write(cls, log: DataFrame, path: str) -> StoredLog:
        """Store a whole log in a new folder; ``count`` it before its counts are read or days replaced."""
        stored = cls(log.sparkSession, path)
        stored._write_log(log, "errorifexists")
        return stored

    def count(self) -> None:
        """Count the stored rows; counts already there, as of an attempt that failed, are written anew."""
        release(self.spark, f"{self.path}/item_days")
        self._write_counts(self.log(), "overwrite")

    def table(self, name: str) -> DataFrame:
        # a given schema keeps day and month codes as text (inference would read 0511 as 511)
        return self.spark.read.schema(_SCHEMAS[name]).parquet(f"{self.path}/{name}")

    def log(self) -> DataFrame:
        return self.table("log").select(*LOG_COLUMNS)

    def item_counts(self, month: str | None = None, day: str | None = None) -> DataFrame:
        """(item_id, n): items with non-click actions in ``month``, on ``day`` or in all time, from the counts."""
        counts = self.table("item_days")
        if day is not None:
            counts = counts.where((F.col(MONTH) == day[:2]) & (F.col(DAY) == day))
        if month is not None:
            counts = counts.where(F.col(MONTH) == month)
        return counts.groupBy("item_id").agg(F.sum("engaged").alias("n")).where("n > 0")

    def replace_days(self, rows: DataFrame, withdrawn: Iterable[str] = ()) -> list[str | None]:
        """Replace the days that ``rows`` hold, remove ``withdrawn`` ones; returns all days touched.

        The rows are read twice, for their days (366 at most) and to be
        written; both must give the same days.
        """
        days = [r[0] for r in rows.select(F.nullif(DAY, F.lit(""))).distinct().collect()]
        gone = sorted(set(withdrawn) - set(days))
        if days:
            self._write_log(rows, "overwrite")
        self._remove("log", DAY, gone)
        touched = [*days, *gone]
        months = {d if d is None else d[:2] for d in touched}
        if months:
            of_months = self.log().where(_in_months(months))
            self._write_counts(of_months, "overwrite")
            left = {r[0] for r in of_months.select(F.substring(DAY, 1, 2)).distinct().collect()}
            self._remove("item_days", MONTH, months - left)
        return touched

    def _write_log(self, rows: DataFrame, mode: str) -> None:
        """Rebalanced on the day, so AQE cuts a big day into evenly sized files."""
        (
            rows.select(*LOG_COLUMNS)
            .hint("rebalance", DAY)
            .sortWithinPartitions(DAY, "user_id", "seller_id")
            .write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(f"{self.path}/log")
        )

    def _write_counts(self, log: DataFrame, mode: str) -> None:
        """Written where they are counted: a task of AQE's size has a file per month, and counts move once."""
        engaged = F.count_if(not_equal_null_safe("action_type", ACTION_CLICK))
        (
            log.groupBy(DAY, "item_id")
            .agg(F.count(F.lit(1)).alias("n_rows"), engaged.alias("engaged"))
            .withColumn(MONTH, F.substring(DAY, 1, 2))
            .sortWithinPartitions(MONTH, DAY, "item_id")
            .write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(MONTH)
            .parquet(f"{self.path}/item_days")
        )

    def _remove(self, name: str, key: str, values: Iterable[str | None]) -> None:
        for v in values:
            release(self.spark, f"{self.path}/{name}/{key}={_NULL_FOLDER if v is None else v}")
