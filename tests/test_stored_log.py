"""The stored log: replacing days, withdrawn days, null days, counts that follow."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from clickmart.schemas import LOG_SCHEMA
from clickmart.sources.stored_log import StoredLog


def row(day, item, action, user=1):
    return (user, item, 5, 9, "b", day, action)


ROWS = [
    row("0511", 1, 2), row("0511", 1, 0), row("0511", None, None), row("0530", 1, 3), row("1111", 2, 2),
    row("1111", 2, 2), row(None, 3, 1), row("1201", 4, 0),
]


def frame(spark, rows):
    return spark.createDataFrame(rows, LOG_SCHEMA)


def state(stored):
    """Both tables, as multisets."""
    log = stored.table("log").select(*LOG_SCHEMA.names)
    days = stored.table("item_days").select("time_stamp", "item_id", "n_rows", "engaged", "month")
    return [Counter(map(tuple, t.collect())) for t in (log, days)]


def expected(rows):
    days = {}
    for _, item, _, _, _, day, action in rows:
        n, engaged = days.get((day, item), (0, 0))
        days[day, item] = (n + 1, engaged + (action != 0))
    return [Counter(rows), Counter((d, i, n, e, d and d[:2]) for (d, i), (n, e) in days.items())]


@pytest.fixture()
def stored(spark, tmp_path):
    return StoredLog.create(frame(spark, ROWS), f"file://{tmp_path}/log")


def test_counts_of_a_new_log(stored):
    assert state(stored) == expected(ROWS)
    assert {r["item_id"]: r["n"] for r in stored.item_counts().collect()} == {1: 2, None: 1, 2: 2, 3: 1}
    assert {r["item_id"]: r["n"] for r in stored.item_counts("05").collect()} == {1: 2, None: 1}
    assert {r["item_id"]: r["n"] for r in stored.item_counts(day="0530").collect()} == {1: 1}


def test_replacing_a_day_twice_changes_only_that_day(spark, stored):
    new = [row("0511", 7, 2), row("0511", 7, 2), row("0511", 1, 1)]
    kept = [r for r in ROWS if r[5] != "0511"]
    others = lambda: {f for t in ("log", "item_days") for f in stored.table(t).inputFiles() if "=05" not in f}
    before = others()
    for _ in range(2):
        assert stored.replace_days(frame(spark, new)) == ["0511"]
        assert state(stored) == expected(kept + new)
    assert before and others() == before


def test_withdrawn_days_and_the_null_day(spark, stored):
    new = [row(None, 8, 1), row("", 8, 0)]
    touched = stored.replace_days(frame(spark, new), withdrawn=["1111", "1201", "0704"])
    assert set(touched) == {None, "0704", "1111", "1201"}
    kept = [r for r in ROWS if r[5] in ("0511", "0530")]
    assert state(stored) == expected(kept + [row(None, 8, 1), row(None, 8, 0)])


def test_rows_may_come_from_the_log_itself(spark, stored):
    day = stored.log().where("time_stamp = '1111'").withColumn("action_type", F.lit(0))
    stored.replace_days(day)
    want = [r if r[5] != "1111" else row("1111", 2, 0) for r in ROWS]
    assert state(stored) == expected(want)
    assert 2 not in {r["item_id"] for r in stored.item_counts().collect()}


def test_empty_deliveries_and_an_empty_log(spark, stored, tmp_path):
    before = state(stored)
    assert stored.replace_days(frame(spark, [])) == []
    assert state(stored) == before
    empty = StoredLog.create(frame(spark, []), f"file://{tmp_path}/empty")
    assert empty.item_counts().count() == 0
    empty.replace_days(frame(spark, ROWS))
    assert state(empty) == expected(ROWS)


def test_a_day_replaced_by_columns_of_other_names(spark, stored):
    more = frame(spark, [row("0530", 6, 3)]).withColumn("month", F.lit("x")).withColumn("n_rows", F.lit(1))
    stored.replace_days(more)
    assert state(stored) == expected([r for r in ROWS if r[5] != "0530"] + [row("0530", 6, 3)])


def test_all_time_counts_read_no_log_row(stored):
    files = stored.item_counts().inputFiles()
    assert files and all("/item_days/" in f for f in files)


def test_the_log_is_stored_without_counts_until_they_are_asked_for(spark):
    from tables import MEDIUM

    from clickmart.sources import fixtures

    folder = lambda df: df.inputFiles()[0].split("/log/")[0]
    log = fixtures.log_table(spark, MEDIUM, refresh=True)
    names = lambda: [f.getPath().getName() for f in _listed(spark, folder(log))]
    assert names() == ["log"]
    counted = fixtures.stored_log(spark, MEDIUM)
    assert sorted(names()) == ["item_days", "log"] and folder(counted.log()) == folder(log)
    want = Counter(r["item_id"] for r in log.where("action_type <> 0 or action_type is null").select("item_id").collect())
    assert {r["item_id"]: r["n"] for r in counted.item_counts().collect()} == dict(want)


def _listed(spark, path):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(at)


def test_counting_again_replaces_what_a_failed_attempt_left(spark, stored):
    before = state(stored)
    stored.count()
    assert state(stored) == before
