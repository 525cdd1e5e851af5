"""Staging goes under the folder the session names in spark.checkpoint.dir."""

import os

from clickmart.session import fingerprint, fresh_dir, release, shared_dir


def test_staging_lives_under_the_checkpoint_dir(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark, "a", "b") == base.rstrip("/") + "/a/b"
    one, two = fresh_dir(spark, "t"), fresh_dir(spark, "t")
    assert one != two and one.startswith(base.rstrip("/") + "/clickmart/")


def test_release_deletes_a_staged_folder(spark):
    path = fresh_dir(spark, "gone")
    spark.range(3).write.parquet(path)
    assert os.path.isdir(path.removeprefix("file://"))
    release(spark, path)
    assert not os.path.exists(path.removeprefix("file://"))


def test_fingerprint_follows_the_files(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.range(3).write.parquet(path)
    before = fingerprint(spark, [path])
    assert fingerprint(spark, [path]) == before
    spark.range(30).write.mode("append").parquet(path)
    assert fingerprint(spark, [path]) != before
