"""End-to-end jobs over stored inputs: read, compute, write.

The same work as the original batch jobs, driven by paths instead of the
test-table views: the click log and the profiles as CSV or Parquet (said
by ``fmt``, never guessed from a path), the pair files, LibSVM feature
files and saved models. Each job returns what it wrote, read back, so
nothing is computed twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..ml import models
from ..operators import features, ranking, shares
from ..schemas import DEFAULT_DAY, LOG_SCHEMA, PAIRS_SCHEMA, TOP_K, USERS_SCHEMA
from ..sinks import stage, write, write_libsvm, write_lines, write_submission, write_submissions
from ..sources import read_csv, read_libsvm, read_lines, read_log, read_pairs, read_submissions, read_table, read_users, register_views, require_unique


_SCHEMAS = {"log": LOG_SCHEMA, "users": USERS_SCHEMA, "train": PAIRS_SCHEMA}


def _read(spark: SparkSession, path: str, kind: str, fmt: str) -> DataFrame:
    """A log or the profiles, which must have one row per user."""
    if fmt == "csv":
        df = {"log": read_log, "users": read_users}[kind](spark, path)
    elif fmt == "parquet":
        df = read_table(spark, path, [f.name for f in _SCHEMAS[kind].fields])
    else:
        raise ValueError(f"fmt must be 'csv' or 'parquet', got {fmt!r}")
    return require_unique(df, "user_id") if kind == "users" else df


def top_items_job(
    spark: SparkSession, log_path: str, out: str, day: str | None = DEFAULT_DAY,
    k: int = TOP_K, report: bool = False, mode: str = "errorifexists", fmt: str = "csv",
) -> DataFrame:
    """Q1: top-k items on ``day``; ``report`` writes ``rank: id, count`` lines."""
    top = ranking.top_items(_read(spark, log_path, "log", fmt), day, k)
    if report:
        write_lines(ranking.rank_report(top, "item_id").orderBy("rank"), out, mode=mode)
        return read_lines(spark, out)
    write(top.orderBy("rank"), out, fmt="csv", mode=mode)
    return read_csv(spark, out, top.schema)


def top_merchants_job(
    spark: SparkSession, log_path: str, users_path: str, out: str,
    day: str | None = DEFAULT_DAY, k: int = TOP_K, users_mode: str = "all",
    report: bool = False, mode: str = "errorifexists", fmt: str = "csv",
) -> DataFrame:
    """Q2: top-k sellers among young buyers on ``day``."""
    top = ranking.top_merchants(
        _read(spark, log_path, "log", fmt), _read(spark, users_path, "users", fmt), day, k, users_mode
    )
    if report:
        write_lines(ranking.rank_report(top, "seller_id").orderBy("rank"), out, mode=mode)
        return read_lines(spark, out)
    write(top.orderBy("rank"), out, fmt="csv", mode=mode)
    return read_csv(spark, out, top.schema)


def share_job(
    spark: SparkSession, log_path: str, users_path: str, out: str, attr: str = "age_range",
    form: str = "sql", day: str = DEFAULT_DAY, mode: str = "errorifexists", fmt: str = "csv",
) -> DataFrame:
    """Q3-Q6: buyer counts / shares by ``attr``.

    ``form``: ``sql`` (SQL over temp views, all profiles), ``dataframe``
    (same result), ``raw`` (every group, RDD-job profiles) or ``report``
    (valid groups of the raw counts with ``12.3%`` text).
    """
    log, users = _read(spark, log_path, "log", fmt), _read(spark, users_path, "users", fmt)
    if form == "sql":
        register_views(log, users)
        result = shares.sql_share(spark, attr, day)
    elif form == "dataframe":
        result = shares.share(log, users, attr, day)
    elif form in ("raw", "report"):
        result = shares.buyer_counts(log, users, attr, day, users_mode="complete")
        if form == "report":
            result = shares.share_report(result, attr)
    else:
        raise ValueError(f"unknown form {form!r}")
    write(result, out, fmt="csv", mode=mode)
    return read_csv(spark, out, result.schema)


def features_job(
    spark: SparkSession, log_path: str, users_path: str, pairs_path: str, out: str,
    labelled: bool = True, libsvm_out: str | None = None, mode: str = "errorifexists", fmt: str = "csv",
) -> DataFrame:
    """Q7/Q8: the pair feature table (NULLs filled with 0) as Parquet.

    ``libsvm_out`` also writes (label, features) as LibSVM text, with
    label 0 for unlabelled pairs, as the original scoring input had.
    """
    names = [f.name for f in PAIRS_SCHEMA.fields][: None if labelled else 2]
    pairs = read_pairs(spark, pairs_path, labelled) if fmt == "csv" else read_table(spark, pairs_path, names)
    table = features.fill_features(
        features.pair_features(pairs, _read(spark, log_path, "log", fmt), _read(spark, users_path, "users", fmt))
    )
    write(table, out, mode=mode)
    table = read_table(spark, out)
    if libsvm_out:
        write_libsvm(features.assemble(table, label="label" if labelled else None), libsvm_out, mode=mode)
    return table


def _training_input(spark: SparkSession, path: str, fmt: str, num_features: int = 10) -> DataFrame:
    if fmt == "parquet":
        return features.assemble(read_table(spark, path))
    if fmt == "libsvm":
        return read_libsvm(spark, path, num_features)
    raise ValueError(f"fmt must be 'parquet' or 'libsvm', got {fmt!r}")


def evaluate_job(
    spark: SparkSession, train_path: str, out: str | None = None,
    kinds: tuple[str, ...] = models.KINDS, mode: str = "errorifexists", fmt: str = "libsvm",
) -> DataFrame:
    """Q9: 60/40 split, train each model, hold-out metrics per model."""
    result = models.evaluate_all(_training_input(spark, train_path, fmt), kinds=kinds)
    if out:
        write(result, out, fmt="csv", mode=mode)
    return result


def train_save_job(spark: SparkSession, train_path: str, models_dir: str, fmt: str = "libsvm") -> DataFrame:
    """Q10: train every model on all rows and save it under ``models_dir``."""
    return models.train_all(_training_input(spark, train_path, fmt), models_dir)


def score_job(
    spark: SparkSession, features_path: str, model_paths: dict[str, str], out_dir: str,
    hard: bool = False, single_file: bool = False, mode: str = "errorifexists",
) -> DataFrame:
    """Q11: score unlabelled pairs with saved models, one submission per model."""
    table = read_table(spark, features_path)
    assembled = features.assemble(table, label=None)
    scored = stage(models.score_to_submission(model_paths, assembled, hard), spark, "scored")
    for kind in model_paths:
        write_submission(
            scored.where(scored.model == kind), f"{out_dir}/{kind}", single_file=single_file, mode=mode
        )
    return scored


def submissions_job(
    spark: SparkSession, features_path: str, model_paths: dict[str, str], out_dir: str,
    hard: bool = False, mode: str = "errorifexists",
) -> DataFrame:
    """Q11: the submissions of all saved models in one pass, read back from the files (model, pair, score)."""
    assembled = features.assemble(read_table(spark, features_path), label=None)
    write_submissions(models.score_to_submission(model_paths, assembled, hard), out_dir, mode=mode)
    return read_submissions(spark, out_dir)
