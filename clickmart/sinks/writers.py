"""Writers: tables, LibSVM, text reports, submissions, staging.

Nothing is funnelled through one task unless asked: ``coalesce(1)`` for
a single submission file is opt-in, as it puts the whole output through
one writer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import double_text
from ..schemas import FEATURES
from ..session import fresh_dir


def write(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "errorifexists",
    partition_by: Sequence[str] | None = None,
    header: bool = True,
) -> None:
    """Write a table as parquet or CSV."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", header).csv(path)
    else:
        w.format(fmt).save(path)


def libsvm_lines(df: DataFrame, label: str = "label", features: Sequence[str] = FEATURES) -> DataFrame:
    """``label 1:v ... 10:v`` text with explicit zeros (B6 text form)."""
    parts = [double_text(label)] + [
        F.concat(F.lit(f"{i + 1}:"), double_text(f)) for i, f in enumerate(features)
    ]
    return df.select(F.concat_ws(" ", *parts).alias("line"))


def write_libsvm(assembled: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """(label, features) as LibSVM files; dense rows keep their zeros."""
    assembled.select("label", "features").write.mode(mode).format("libsvm").save(path)


def write_lines(lines: DataFrame, path: str, column: str = "line", mode: str = "errorifexists") -> None:
    """One text line per row, e.g. a ``rank: id, count`` report."""
    lines.select(column).write.mode(mode).text(path)


def write_submission(
    scored: DataFrame,
    path: str,
    score: str = "score",
    single_file: bool = False,
    mode: str = "errorifexists",
) -> None:
    """user_id, merchant_id, score with a header."""
    out = scored.select("user_id", "merchant_id", F.col(score).alias("score"))
    if single_file:
        out = out.coalesce(1)
    out.write.mode(mode).option("header", True).csv(path)


def write_submissions(scored: DataFrame, path: str, score: str = "score", mode: str = "errorifexists") -> None:
    """The files of all models in one pass: a folder ``model=...`` of CSV with a header for each."""
    out = scored.select("model", "user_id", "merchant_id", F.col(score).alias("score"))
    out.write.mode(mode).partitionBy("model").option("header", True).csv(path)


def stage(df: DataFrame, spark: SparkSession, label: str) -> DataFrame:
    """Write ``df`` to the shared staging folder and read it back.

    Cuts the lineage before iterative work (model training): a lost
    executor then re-reads staged files instead of recomputing the log
    aggregates.
    """
    path = fresh_dir(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
