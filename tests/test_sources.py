"""Readers over real files: multi-path CSV, text lines, tagged routing."""

from clickmart.operators import joins
import pytest

from clickmart.schemas import LOG_SCHEMA
from clickmart.sources import bad_values, quarantine, read_csv, read_lines, read_log, read_pairs, read_tagged, read_users, split_fields, tagged_source

LOG_HEADER = "user_id,item_id,cat_id,seller_id,brand_id,time_stamp,action_type\n"


def test_multi_path_log(spark, tmp_path):
    a, b = tmp_path / "a.csv", tmp_path / "b.csv"
    a.write_text(LOG_HEADER + "1,2,3,4,,1111,0\n")
    b.write_text(LOG_HEADER + "5,6,7,8,9,1111,2\n\n")
    df = read_log(spark, f"{a},{b}")
    assert sorted(r.user_id for r in df.collect()) == [1, 5]


def test_unlabelled_pairs_keep_third_column(spark, tmp_path):
    p = tmp_path / "test.csv"
    p.write_text("user_id,merchant_id,prob\n1,2,\n")
    r = read_pairs(spark, str(p), labelled=False).first()
    assert (r.user_id, r.merchant_id, r.prob) == (1, 2, None)


def test_split_fields_short_lines(spark, tmp_path):
    p = tmp_path / "info.txt"
    p.write_text("1,3\n2,,1\n3\n")
    df = split_fields(read_lines(spark, str(p)), ["user_id", "age_range", "gender"])
    assert sorted(tuple(r) for r in df.collect()) == [("1", "3", None), ("2", None, "1"), ("3", None, None)]


def test_tagged_routing_by_file_name(spark, tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    (d / "user_log_format1.csv").write_text(
        LOG_HEADER + "1,2,3,40,,1111,1\n1,2,3,41,,1111,0\n2,2,3,42,,1111,2\n3,2,3,43,,1110,2\n"
    )
    (d / "user_info_format1.csv").write_text("user_id,age_range,gender\n1,2,0\n2,5,1\n3,1,\n4,,\n")
    tagged = tagged_source(read_lines(spark, [str(d / "user_log_format1.csv"), str(d / "user_info_format1.csv")]))
    got = sorted((r.user_id, r.value, r.tag) for r in tagged.collect())
    assert got == [(1, "2", "b"), (1, "40", "a"), (2, "42", "a"), (2, "5", "b"), (3, "1", "b")]
    young = joins.join_tagged(tagged).collect()
    assert [(r.user_id, r.seller_id) for r in young] == [(1, "40")]


def test_columns_are_found_by_name(spark, tmp_path):
    p = tmp_path / "info.csv"
    p.write_text("user_id,gender,age_range\n1,0,4\n")
    r = read_users(spark, str(p)).first()
    assert (r.user_id, r.age_range, r.gender) == (1, 4, 0)
    p.write_text("user_id,gender\n1,0\n")
    with pytest.raises(ValueError, match="age_range"):
        read_users(spark, str(p))


def test_malformed_values_are_counted_or_fail(spark, tmp_path):
    p = tmp_path / "log.csv"
    p.write_text(LOG_HEADER + "1,2,3,4,,1111,0\nx,2,y,4,,1111,0\n")
    assert sorted((r.user_id is None) for r in read_log(spark, str(p)).collect()) == [False, True]
    counts = bad_values(spark, str(p), LOG_SCHEMA).first()
    assert (counts.user_id, counts.cat_id, counts.item_id) == (1, 1, 0)
    with pytest.raises(Exception, match="not a bigint"):
        read_csv(spark, str(p), LOG_SCHEMA, strict=True).collect()


def test_tagged_scan_reads_each_file_once(spark, tmp_path):
    log, users = tmp_path / "user_log_1.csv", tmp_path / "user_info_1.csv"
    log.write_text(LOG_HEADER + "1,2,3,40,,1111,1\n")
    users.write_text("user_id,age_range,gender\n1,2,0\n")
    young = joins.join_tagged(read_tagged(spark, f"{log},{users}"))
    plan = young._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 2  # one per file, not both files per branch
    assert [(r.user_id, r.seller_id) for r in young.collect()] == [(1, "40")]


def test_quarantine_splits_good_rows_from_bad_lines(spark, tmp_path):
    a, b = tmp_path / "a.csv", tmp_path / "b.csv"
    a.write_text(LOG_HEADER + "1,2,3,4,,1111,0\n\n1,2,3\n   \n9,,,, ,1111,\n")
    b.write_text(LOG_HEADER + "x,2,3,4,5,1111,0\n1,2,3,4,5,1111,0,,\n1,2,3,4,5,1111,0.5\n 7 ,2,3,4,b,1111,3\n")
    good, bad = quarantine(spark, f"{a},{b}", LOG_SCHEMA)
    assert good.schema == LOG_SCHEMA
    assert sorted(map(tuple, good.collect())) == [
        (1, 2, 3, 4, None, "1111", 0), (7, 2, 3, 4, "b", "1111", 3), (9, None, None, None, " ", "1111", None),
    ]
    assert sorted((r.file.rsplit("/", 1)[1], r.line, r.reason) for r in bad.collect()) == [
        ("a.csv", "", "blank"), ("a.csv", "   ", "blank"), ("a.csv", "1,2,3", "short"),
        ("b.csv", "1,2,3,4,5,1111,0,,", "long"), ("b.csv", "1,2,3,4,5,1111,0.5", "action_type: not a int"),
        ("b.csv", "x,2,3,4,5,1111,0", "user_id: not a bigint"),
    ]


def test_quarantine_without_bad_or_any_lines(spark, tmp_path):
    clean, empty = tmp_path / "clean.csv", tmp_path / "empty.csv"
    clean.write_text(LOG_HEADER + "1,2,3,4,,1111,0\n")
    empty.write_text("")
    for path, n in ((clean, 1), (empty, 0)):
        good, bad = quarantine(spark, str(path), LOG_SCHEMA)
        assert (good.count(), bad.count()) == (n, 0)
