"""Hand-made edge frames for the semantics traps."""

from pyspark.sql import Row
from pyspark.sql import functions as F

from clickmart.operators import features, filters, joins, ranking, shares
from clickmart.schemas import LOG_SCHEMA, USERS_SCHEMA
from clickmart.sources import readers


def log_df(spark, rows):
    # rows: (user, item, cat, seller, day, action)
    full = [(u, i, c, s, None, d, a) for (u, i, c, s, d, a) in rows]
    return spark.createDataFrame(full, LOG_SCHEMA)


def users_df(spark, rows):
    return spark.createDataFrame(rows, USERS_SCHEMA)


def test_t1_one_clicks_counts_non_clicks(spark):
    log = log_df(spark, [(1, 10, 1, 5, "1111", a) for a in (0, 0, 1, 2, 2, 3)])
    r = features.action_features(log).first()
    assert (r.one_clicks, r.shopping_carts, r.purchase_times, r.favor_times) == (4, 1, 2, 1)
    assert r.one_clicks == r.shopping_carts + r.purchase_times + r.favor_times


def test_null_action_counts_as_non_click(spark):
    log = log_df(spark, [(1, 10, 1, 5, "1111", None), (1, 10, 1, 5, "1111", 0), (1, 10, 1, 5, "1111", 2)])
    r = features.action_features(log).first()
    assert (r.one_clicks, r.purchase_times) == (2, 1)
    # the day filter of the ranking jobs keeps the NULL action as well
    assert filters.day_engaged(log).count() == 2


def test_t2_user_filter_modes(spark):
    users = users_df(spark, [(1, 3, None), (2, None, 1), (3, None, None), (4, 2, 0)])
    ids = lambda df: sorted(r.user_id for r in df.collect())
    assert ids(filters.select_users(users, "complete")) == [2, 4]
    assert ids(filters.select_users(users, "any")) == [1, 2, 4]
    assert ids(filters.select_users(users, "all")) == [1, 2, 3, 4]


def test_t3_ties_broken_by_id_at_the_cut(spark):
    # items 7, 8, 9 tie with 1 action; the cut at k = 3 keeps the lowest ids
    rows = [(1, 5, 1, 1, "1111", 1)] * 3 + [(1, i, 1, 1, "1111", 1) for i in (9, 8, 7)]
    top = ranking.top_items(log_df(spark, rows), k=3).collect()
    assert [(r["rank"], r.item_id, r.n) for r in top] == [(1, 5, 3), (2, 7, 1), (3, 8, 1)]


def test_t4_null_item_is_its_own_value(spark):
    log = log_df(spark, [(1, 10, None, 5, "1111", 0), (1, None, None, 5, "1111", 0)])
    r = features.log_aggregate(log).first()
    assert r.unique_item_ids == 2
    assert r.categories == 1  # one NULL category group
    assert r.browse_days == 1


def test_t5_bad_number_becomes_null(spark, tmp_path):
    p = tmp_path / "user_info.csv"
    p.write_text("user_id,age_range,gender\n1,x,1\n2,3,\n3,,0\n")
    rows = sorted(readers.read_users(spark, str(p)).collect())
    assert rows == [Row(user_id=1, age_range=None, gender=1), Row(user_id=2, age_range=3, gender=None),
                    Row(user_id=3, age_range=None, gender=0)]


def test_day_code_stays_text(spark, tmp_path):
    p = tmp_path / "user_log.csv"
    p.write_text("user_id,item_id,cat_id,seller_id,brand_id,time_stamp,action_type\n1,2,3,4,,0511,2\n")
    r = readers.read_log(spark, str(p)).first()
    assert r.time_stamp == "0511" and r.action_type == 2 and r.brand_id is None


def test_no_valid_buyer_gives_no_share_rows(spark):
    log = log_df(spark, [(1, 10, 1, 5, "1111", 2)])
    users = users_df(spark, [(1, 0, None)])
    assert shares.share(log, users, "age_range").count() == 0
    raw = shares.buyer_counts(log, users, "age_range")
    assert shares.share_report(raw, "age_range").count() == 0


def test_share_report_format(spark):
    log = log_df(spark, [(u, 10, 1, 5, "1111", 2) for u in (1, 2, 3)])
    users = users_df(spark, [(1, 1, 0), (2, 1, 1), (3, 2, 1)])
    raw = shares.buyer_counts(log, users, "age_range", users_mode="complete")
    got = {r.age_range: r.percent for r in shares.share_report(raw, "age_range").collect()}
    assert got == {1: "66.7%", 2: "33.3%"}
    five = {r.age_range: r.percent for r in shares.share(log, users, "age_range").collect()}
    assert five == {1: "66.66667", 2: "33.33333"}


def test_unseen_pair_gets_zero_features(spark):
    log = log_df(spark, [(1, 10, 1, 5, "1111", 2)])
    users = users_df(spark, [(1, 2, 1)])
    pairs = spark.createDataFrame([(9, 9, 0), (1, 5, 1)], "user_id long, merchant_id long, label int")
    filled = features.fill_features(features.pair_features(pairs, log, users))
    unseen = filled.where("user_id = 9").first()
    assert all(unseen[f] == 0 for f in features.FEATURES)
    seen = filled.where("user_id = 1").first()
    assert (seen.age_range, seen.gender, seen.total_logs, seen.purchase_times) == (2, 1, 1, 1)


def test_t11_gender_fill_option(spark):
    df = spark.createDataFrame([(1, 1, 0, None, None)], "user_id long, merchant_id long, label int, age_range int, gender int")
    for f in features.FEATURES[2:]:
        df = df.withColumn(f, F.lit(None).cast("long"))
    r = features.fill_features(df, gender_value=2).first()
    assert r.gender == 2 and r.age_range == 0 and r.total_logs == 0


def test_t13_duplicate_profile_rows_counted_once_per_band(spark):
    log = log_df(spark, [(1, 10, 1, 5, "1111", 2), (1, 11, 1, 5, "1111", 2)])
    users = users_df(spark, [(1, 2, 1), (1, 2, 1)])
    r = shares.buyer_counts(log, users, "age_range").collect()
    assert [(x.age_range, x.buy_num) for x in r] == [(2, 1)]


def test_join_youth_emits_each_log_row_once(spark):
    log = log_df(spark, [(1, 10, 1, 5, "1111", 1)])
    users = users_df(spark, [(1, 2, 1), (1, 3, 1)])
    assert joins.join_youth(log, users).count() == 1


def test_empty_log(spark):
    log = log_df(spark, [])
    users = users_df(spark, [(1, 2, 1)])
    assert ranking.top_items(log).count() == 0
    assert ranking.top_merchants(log, users).count() == 0
    assert shares.share(log, users, "age_range").count() == 0
    assert shares.buyer_counts(log, users, "gender").count() == 0
    pairs = spark.createDataFrame([(1, 5, 0)], "user_id long, merchant_id long, label int")
    r = features.fill_features(features.pair_features(pairs, log, users)).first()
    assert (r.age_range, r.gender) == (2, 1)
    assert all(r[f] == 0 for f in features.LOG_FEATURES)


def test_pair_aggregate_counts_nulls_once_and_does_not_expand(spark):
    from clickmart.operators.features import log_aggregate

    rows = [
        (1, None, None, 7, None, None, None), (1, None, 3, 7, None, "1111", 0), (1, 5, 3, 7, None, "1111", 2), (1, 5, 4, 7, None, None, 1),
        (1, 5, 4, 7, None, "bad", 3), (None, 5, 4, None, None, "0101", 0),
    ]
    log = spark.createDataFrame(rows, "user_id long, item_id long, cat_id long, seller_id long, brand_id string, time_stamp string, action_type int")
    out = log_aggregate(log)
    got = {r.user_id: (r.total_logs, r.unique_item_ids, r.categories, r.browse_days, r.one_clicks) for r in out.collect()}
    assert got == {1: (5, 2, 3, 3, 4), None: (1, 1, 1, 1, 0)}
    assert "Expand" not in out._jdf.queryExecution().executedPlan().toString()
    assert dict(out.dtypes)["categories"] == "bigint"


def test_equal_and_unknown_pairs_keep_their_rows(spark):
    log = spark.createDataFrame([(1, 5, 7, 2, "b", "1111", 2), (1, 6, 7, 2, "b", None, 0), (1, 6, 8, 3, "b", "1111", 2)], LOG_SCHEMA)
    users = spark.createDataFrame([(1, 4, 0)], USERS_SCHEMA)
    pairs = spark.createDataFrame([(1, 2, 0), (1, 2, 0), (1, 2, 1), (9, 9, 1), (None, 2, 0)], "user_id bigint, merchant_id bigint, label int")
    out = features.pair_features(pairs, log, users)
    found = [(r.user_id, r.merchant_id, r.label, r.age_range, r.total_logs, r.unique_item_ids, r.browse_days) for r in out.collect()]
    none = (None, None, None, None)
    want = [(1, 2, 0, 4, 2, 2, 2)] * 2 + [(1, 2, 1, 4, 2, 2, 2), (9, 9, 1, *none), (None, 2, 0, *none)]
    assert sorted(found, key=str) == sorted(want, key=str)
