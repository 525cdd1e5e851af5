"""Cross-form checks and invariants on the generated tables."""

from tables import MEDIUM, SMALL
from pyspark.sql import functions as F

from clickmart.operators import features, shares
from clickmart.plans.catalog import all_queries
from clickmart.sources import fixtures

Q = all_queries()


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_rows_do_not_depend_on_the_projection(spark):
    cols = ["item_id", "seller_id", "time_stamp", "action_type"]
    few = fixtures.user_log(spark, MEDIUM, cols)
    every = fixtures.user_log(spark, MEDIUM).select(*cols)
    assert few.count() == every.count() == 60000
    assert few.exceptAll(every).count() == 0


def test_sql_share_equals_dataframe_share(spark):
    for attr in ("age_range", "gender"):
        assert _rows(Q[f"sql_{'age' if attr == 'age_range' else 'gender'}_share"](spark, MEDIUM)) == _rows(
            Q[f"{'age' if attr == 'age_range' else 'gender'}_share"](spark, MEDIUM)
        )


def test_raw_counts_contain_report_counts(spark):
    raw = {r.age_range: r.buy_num for r in Q["age_counts_raw"](spark, MEDIUM).collect()}
    rep = {r.age_range: r.buy_num for r in Q["age_share_report"](spark, MEDIUM).collect()}
    assert rep and all(raw[k] == v for k, v in rep.items())
    assert None in raw  # unknown ages are kept in the raw form


def test_tagged_join_equals_semi_join(spark):
    a = Q["join_tagged"](spark, MEDIUM).select("user_id", F.col("seller_id").cast("long"))
    b = Q["join_youth"](spark, MEDIUM)
    assert _rows(a) == _rows(b)


def test_split_fields_round_trip(spark):
    assert _rows(Q["split_fields"](spark, SMALL)) == _rows(fixtures.user_log(spark, SMALL))


def test_feature_invariants(spark):
    f = Q["features_filled"](spark, MEDIUM)
    bad = f.where(
        (F.col("one_clicks") != F.col("shopping_carts") + F.col("purchase_times") + F.col("favor_times"))
        | (F.col("unique_item_ids") > F.col("total_logs"))
        | (F.col("categories") > F.col("total_logs"))
        | (F.col("browse_days") > F.col("total_logs"))
        | (F.col("purchase_times") < 1)
    )
    assert bad.count() == 0
    assert f.count() == 18648
    assert f.agg(F.sum("label")).first()[0] == 1315


def test_total_logs_split_into_clicks_and_the_rest(spark):
    log = fixtures.user_log(spark, MEDIUM, ["user_id", "seller_id", "action_type"])
    clicks = log.where("action_type = 0").groupBy("user_id", F.col("seller_id").alias("merchant_id")).count()
    agg = features.log_aggregate(fixtures.user_log(spark, MEDIUM, features_cols()))
    j = agg.join(clicks, ["user_id", "merchant_id"], "left").fillna(0, subset=["count"])
    assert j.where(F.col("total_logs") != F.col("count") + F.col("one_clicks")).count() == 0


def features_cols():
    return ["user_id", "item_id", "cat_id", "seller_id", "time_stamp", "action_type"]


def test_shares_sum_to_100(spark):
    for name in ("age_share", "gender_share", "age_share_month"):
        df = Q[name](spark, MEDIUM)
        total = sum(float(r.percent.replace(",", "")) for r in df.collect())
        assert abs(total - 100.0) < 1e-3


def test_fixture_figures(spark):
    # figures recorded for the mapping at sf0.01
    log = fixtures.user_log(spark, MEDIUM, ["user_id", "time_stamp", "action_type"])
    day = log.where("time_stamp = '1111'")
    assert day.count() == 163
    assert day.where("action_type != 0").count() == 106
    assert day.where("action_type = 2").count() == 58
    assert shares.buyers(log).count() == 56


def test_stored_log_equals_the_view(spark):
    stored = fixtures.log(spark, SMALL)
    view = fixtures.user_log(spark, SMALL)
    assert stored.columns == view.columns
    assert stored.count() == view.count()
    assert stored.exceptAll(view).count() == 0 and view.exceptAll(stored).count() == 0
    # same session, same folder: the log is written once
    assert fixtures.log_table(spark, SMALL).inputFiles() == fixtures.log_table(spark, SMALL).inputFiles()


def test_day_folders_prune(spark):
    by_day = fixtures.log_table(spark, SMALL)
    assert by_day.schema["time_stamp"].dataType.simpleString() == "string"
    # a one-day filter prunes folders instead of reading them
    plan = by_day.where("time_stamp = '1111'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(time_stamp" in plan and "= 1111)" in plan
    # the November forms prune by prefix
    month = by_day.where("time_stamp like '11%'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(time_stamp" in month and "StartsWith(time_stamp" in month


def test_log_is_stored_again_when_its_files_change(spark, tmp_path):
    for t in ("lineitem", "orders", "part", "customer"):
        spark.read.parquet(f"{SMALL}/{t}.parquet").write.parquet(str(tmp_path / f"{t}.parquet"))
    before = fixtures.log(spark, str(tmp_path)).count()
    spark.read.parquet(f"{SMALL}/lineitem.parquet").limit(10).write.mode("append").parquet(str(tmp_path / "lineitem.parquet"))
    assert fixtures.log(spark, str(tmp_path)).count() == before + 10


def test_pair_label_equals_distinct_day_count(spark):
    purchases = fixtures.log(spark, MEDIUM).where("action_type = 2")
    by_count = purchases.groupBy("user_id", F.col("seller_id").alias("merchant_id")).agg(
        (F.count_distinct("time_stamp") >= 2).cast("int").alias("label")
    )
    assert _rows(fixtures.train_pairs(spark, MEDIUM)) == _rows(by_count)
