"""End-to-end jobs over CSV files written from the sf0.001 views."""

import pytest
from tables import SMALL

from clickmart.plans import jobs
from clickmart.plans.catalog import all_queries
from clickmart.sources import fixtures

Q = all_queries()


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("inputs")
    paths = {k: str(d / f"{k}.csv") for k in ("user_log", "user_info", "train", "test")}
    fixtures.user_log(spark, SMALL).write.option("header", True).csv(paths["user_log"])
    fixtures.user_info(spark, SMALL).write.option("header", True).csv(paths["user_info"])
    fixtures.train_pairs(spark, SMALL).write.option("header", True).csv(paths["train"])
    fixtures.scoring_pairs(spark, SMALL).write.option("header", True).csv(paths["test"])
    return d, paths


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_top_items_job(spark, inputs):
    d, p = inputs
    got = jobs.top_items_job(spark, p["user_log"], str(d / "top_items"), day=None)
    assert _rows(got) == _rows(Q["top_items_all"](spark, SMALL))
    back = spark.read.option("header", True).csv(str(d / "top_items"))
    assert back.count() == got.count()


def test_top_merchants_report_job(spark, inputs):
    d, p = inputs
    jobs.top_merchants_job(spark, p["user_log"], p["user_info"], str(d / "top_m"), day=None, report=True)
    lines = [r.value for r in spark.read.text(str(d / "top_m")).collect()]
    first = Q["top_merchants_all"](spark, SMALL).where("rank = 1").first()
    assert f"1: {first.seller_id}, {first.n}" in lines


@pytest.mark.parametrize("form,key", [("sql", "sql_age_share"), ("dataframe", "age_share"),
                                      ("raw", "age_counts_raw"), ("report", "age_share_report")])
def test_share_job(spark, inputs, form, key):
    d, p = inputs
    got = jobs.share_job(spark, p["user_log"], p["user_info"], str(d / f"share_{form}"), form=form)
    assert _rows(got) == _rows(Q[key](spark, SMALL))


def test_features_train_score_jobs(spark, inputs):
    d, p = inputs
    table = jobs.features_job(spark, p["user_log"], p["user_info"], p["train"], str(d / "feat.parquet"),
                              libsvm_out=str(d / "feat_libsvm"))
    assert _rows(table) == _rows(Q["features_filled"](spark, SMALL))
    jobs.features_job(spark, p["user_log"], p["user_info"], p["test"], str(d / "test_feat.parquet"), labelled=False)
    saved = jobs.train_save_job(spark, str(d / "feat_libsvm"), str(d / "models"))
    paths = {r.model: r.path for r in saved.collect() if r.model in ("lr", "gbt")}
    scored = jobs.score_job(spark, str(d / "test_feat.parquet"), paths, str(d / "sub"))
    n_test = spark.read.parquet(str(d / "test_feat.parquet")).count()
    assert scored.count() == 2 * n_test
    sub = spark.read.option("header", True).csv(str(d / "sub" / "lr"))
    assert sub.columns == ["user_id", "merchant_id", "score"] and sub.count() == n_test


def test_evaluate_job_on_libsvm(spark, inputs):
    d, p = inputs
    jobs.features_job(spark, p["user_log"], p["user_info"], p["train"], str(d / "eval_feat.parquet"),
                      libsvm_out=str(d / "eval_libsvm"))
    result = jobs.evaluate_job(spark, str(d / "eval_libsvm"), str(d / "eval_out"), kinds=("lr", "nb"))
    rows = {r.model: r for r in result.collect()}
    assert set(rows) == {"lr", "nb"}
    assert all(0.0 <= r.error_rate <= 1.0 and 0.0 <= r.score_auc <= 1.0 for r in rows.values())
    assert spark.read.option("header", True).csv(str(d / "eval_out")).count() == 2


def test_formats_are_said_not_guessed(spark, inputs, tmp_path):
    d, p = inputs
    plain = str(tmp_path / "users")  # a Parquet folder without a suffix
    fixtures.user_info(spark, SMALL).write.parquet(plain)
    log = str(tmp_path / "log")
    fixtures.user_log(spark, SMALL).write.parquet(log)
    got = jobs.share_job(spark, log, plain, str(tmp_path / "out"), fmt="parquet")
    assert _rows(got) == _rows(Q["sql_age_share"](spark, SMALL))
    with pytest.raises(ValueError, match="no column"):
        jobs.share_job(spark, log, log, str(tmp_path / "out2"), fmt="parquet")
    with pytest.raises(ValueError, match="fmt"):
        jobs.top_items_job(spark, log, str(tmp_path / "out3"), fmt="orc")


def test_profiles_must_be_unique(spark, inputs, tmp_path):
    d, p = inputs
    twice = str(tmp_path / "twice.csv")
    users = fixtures.user_info(spark, SMALL)
    users.unionByName(users.limit(1)).write.option("header", True).csv(twice)
    with pytest.raises(ValueError, match="user_id"):
        jobs.share_job(spark, p["user_log"], twice, str(tmp_path / "out"))
