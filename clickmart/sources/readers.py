"""Typed readers for the delimited inputs, LibSVM files and raw text lines.

CSV columns are found by their header names, whatever their order; a file
without a declared column is an error. Values are read as text and cast:
by default a malformed number becomes NULL instead of failing the job
under ANSI mode; ``strict=True`` fails instead, and ``bad_values`` counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import LOG_SCHEMA, PAIRS_SCHEMA, USERS_SCHEMA, all_string
from ..session import fresh_dir

PathLike = str | Sequence[str]


def _paths(p: PathLike) -> list[str]:
    if isinstance(p, str):
        # a comma-separated list of inputs, as the MapReduce jobs accepted
        return [s for s in p.split(",") if s]
    return list(p)


def typed(df: DataFrame, schema: T.StructType, strict: bool = False) -> DataFrame:
    """Cast string columns to ``schema``; bad values become NULL (T5), or an error if strict."""
    out = []
    for f in schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.StringType):
            out.append(c.alias(f.name))
        else:
            value = F.trim(c).try_cast(f.dataType)
            if strict:
                wrong = F.raise_error(F.concat(F.lit(f"{f.name}: not a {f.dataType.simpleString()}: "), c))
                value = F.when(c.isNotNull() & value.isNull(), wrong).otherwise(value)
            out.append(value.alias(f.name))
    return df.select(*out)


def _csv_text(spark: SparkSession, paths: PathLike, schema: T.StructType, header: bool) -> DataFrame:
    """The declared columns as text."""
    names = [f.name for f in schema.fields]
    options = {"header": header, "sep": ",", "nullValue": "", "encoding": "UTF-8", "mode": "FAILFAST" if header else "PERMISSIVE"}
    if not header:
        return spark.read.options(**options).schema(all_string(schema)).csv(_paths(paths))
    parts = []
    for path in _paths(paths):  # each input names its own columns
        found = spark.read.options(**{**options, "mode": "PERMISSIVE"}).csv(path)
        missing = set(names) - set(found.columns)
        if missing:
            raise ValueError(f"{path} has no column {sorted(missing)}; it has {found.columns}")
        parts.append(found.select(*names))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def read_csv(
    spark: SparkSession, paths: PathLike, schema: T.StructType, header: bool = True, strict: bool = False
) -> DataFrame:
    """Declared columns of CSV files, by name with a header, by position without."""
    return typed(_csv_text(spark, paths, schema, header), schema, strict)


def bad_values(spark: SparkSession, paths: PathLike, schema: T.StructType, header: bool = True) -> DataFrame:
    """One row: per column, the values that are there but not of its type."""
    text = _csv_text(spark, paths, schema, header)
    wrong = [
        F.count_if(F.col(f.name).isNotNull() & F.trim(F.col(f.name)).try_cast(f.dataType).isNull()).alias(f.name)
        for f in schema.fields
    ]
    return text.agg(*wrong)


def read_log(spark: SparkSession, paths: PathLike, header: bool = True) -> DataFrame:
    """The click log (user, item, cat, seller, brand, day code, action)."""
    return read_csv(spark, paths, LOG_SCHEMA, header)


def read_users(spark: SparkSession, paths: PathLike, header: bool = True) -> DataFrame:
    """User profiles (user, age band, gender)."""
    return read_csv(spark, paths, USERS_SCHEMA, header)


def require_unique(df: DataFrame, key: str) -> DataFrame:
    """``df``, after checking that no two rows have the same non-null key."""
    twice = df.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1").first()
    if twice is not None:
        raise ValueError(f"{key} {twice[0]} has {twice[1]} rows; profiles must be one row per {key}")
    return df


def read_pairs(spark: SparkSession, paths: PathLike, labelled: bool = True) -> DataFrame:
    """(user, merchant, label) pairs; unlabelled pair files keep a string third column."""
    if labelled:
        return read_csv(spark, paths, PAIRS_SCHEMA)
    schema = T.StructType(PAIRS_SCHEMA.fields[:2] + [T.StructField("prob", T.StringType())])
    return read_csv(spark, paths, schema)


def read_submissions(spark: SparkSession, path: str) -> DataFrame:
    """The submission files of all models below ``path`` (see ``sinks.write_submissions``)."""
    fields = "user_id bigint, merchant_id bigint, score double, model string"
    return spark.read.schema(fields).options(header=True, mode="FAILFAST").csv(path).select("model", "user_id", "merchant_id", "score")


def read_libsvm(spark: SparkSession, path: str, num_features: int = 10) -> DataFrame:
    """(label, features); giving ``numFeatures`` avoids a counting pass."""
    return spark.read.format("libsvm").option("numFeatures", num_features).load(path)


def read_table(spark: SparkSession, paths: PathLike, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet tables (e.g. a log written by day), with the declared columns if given."""
    df = spark.read.parquet(*_paths(paths))
    if columns is None:
        return df
    missing = set(columns) - set(df.columns)
    if missing:
        raise ValueError(f"{paths} has no column {sorted(missing)}; it has {df.columns}")
    return df.select(*columns)


def read_lines(spark: SparkSession, paths: PathLike) -> DataFrame:
    """Raw text lines plus the file each came from."""
    return spark.read.text(_paths(paths)).select(
        "value", F.col("_metadata.file_path").alias("file_path")
    )


def split_fields(lines: DataFrame, names: Sequence[str], line_col: str = "value") -> DataFrame:
    """Positional split of comma-separated lines (no quoting).

    A field that is missing (short line) or empty becomes NULL, which
    covers the trailing-empty-field loss of a plain Java ``split``.
    """
    parts = F.split(F.col(line_col), ",", -1)
    return lines.select(
        *[F.nullif(F.get(parts, i), F.lit("")).alias(n) for i, n in enumerate(names)]
    )


def line_fault(schema: T.StructType, line_col: str = "value") -> F.Column:
    """Why a comma-separated line is no row of ``schema`` (no quoting); NULL if it is one.

    ``blank``, ``short``, ``long``, or the first field that is there but
    not of its type (``user_id: not a bigint``).
    """
    line = F.col(line_col)
    parts = F.split(line, ",", -1)
    fault = F.when(F.trim(line) == "", "blank")
    fault = fault.when(F.size(parts) < len(schema), "short").when(F.size(parts) > len(schema), "long")
    for i, f in enumerate(schema.fields):
        value = F.trim(F.get(parts, i))
        if not isinstance(f.dataType, T.StringType):
            kind = f.dataType.simpleString()
            fault = fault.when((value != "") & value.try_cast(f.dataType).isNull(), f"{f.name}: not a {kind}")
    return fault


def quarantine(spark: SparkSession, paths: PathLike, schema: T.StructType, out: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Good rows, and bad lines as (file, line, reason), from one read of text files.

    Fields stand in the order of ``schema``; lines that repeat its names
    are headers and belong to neither. Empty fields are NULL, no fault.
    Both outputs are written in one pass, to ``out`` or the staging folder.
    """
    names = [f.name for f in schema.fields]
    lines = read_lines(spark, paths).where(F.col("value") != ",".join(names)).withColumn("reason", line_fault(schema))
    parts = F.split(F.col("value"), ",", -1)
    good = F.col("reason").isNull()
    fields = []
    for i, f in enumerate(schema.fields):
        value = F.nullif(F.get(parts, i), F.lit(""))
        value = value if isinstance(f.dataType, T.StringType) else F.trim(value).try_cast(f.dataType)
        fields.append(F.when(good, value).alias(f.name))
    out = out or fresh_dir(spark, "quarantine")
    (
        lines.select(
            F.when(~good, F.col("file_path")).alias("_file"), F.when(~good, F.col("value")).alias("_line"),
            F.col("reason").alias("_reason"), F.struct(*fields).alias("_row"), (~good).alias("_bad"),
        ).write.partitionBy("_bad").parquet(out)
    )
    kept = T.StructType([
        T.StructField("_file", T.StringType()), T.StructField("_line", T.StringType()), T.StructField("_reason", T.StringType()),
        T.StructField("_row", schema), T.StructField("_bad", T.BooleanType()),
    ])
    # the schema is given: an input without bad (or any) lines has no folder to infer it from
    stored = spark.read.schema(kept).parquet(out)
    bad = stored.where("_bad").select(F.col("_file").alias("file"), F.col("_line").alias("line"), F.col("_reason").alias("reason"))
    return stored.where("not _bad").select("_row.*"), bad


def tagged_source(
    lines: DataFrame,
    log_marker: str = "user_log",
    users_marker: str = "user_info",
    day: str | None = "1111",
) -> DataFrame:
    """Route mixed input lines by file name and tag them (A4).

    Log lines of ``day`` whose action is not a click become
    ``(user_id, value=seller_id, tag='a')``; profile lines with an age or a
    gender become ``(user_id, value=age_range, tag='b')``. Blank and header
    lines drop out (their user id is not a number). The result feeds an
    ordinary join (``operators.joins.join_tagged``), not a per-user reducer.
    """
    is_log = F.col("file_path").contains(log_marker)
    is_users = ~is_log & F.col("file_path").contains(users_marker)
    return log_lines(lines.where(is_log), day).unionByName(user_lines(lines.where(is_users)))


def _field(i: int) -> F.Column:
    return F.nullif(F.get(F.split(F.col("value"), ",", -1), i), F.lit(""))


def _tag(lines: DataFrame, keep: F.Column, value: F.Column, tag: str) -> DataFrame:
    return lines.where((F.length("value") > 0) & keep).select(
        _field(0).try_cast("bigint").alias("user_id"), value.alias("value"), F.lit(tag).alias("tag")
    ).where(F.col("user_id").isNotNull())


def log_lines(lines: DataFrame, day: str | None = "1111") -> DataFrame:
    """Tagged log lines of a day that are no clicks."""
    keep = ~F.coalesce(_field(6), F.lit("")).eqNullSafe("0")
    if day is not None:
        keep = keep & (F.coalesce(_field(5), F.lit("")) == day)
    return _tag(lines, keep, _field(3), "a")


def user_lines(lines: DataFrame) -> DataFrame:
    """Tagged profile lines with an age or a gender."""
    return _tag(lines, _field(1).isNotNull() | _field(2).isNotNull(), _field(1), "b")


def read_tagged(
    spark: SparkSession, paths: PathLike, log_marker: str = "user_log", users_marker: str = "user_info", day: str | None = "1111"
) -> DataFrame:
    """Tagged rows of mixed text inputs (A4): each input is routed by its file name and read once."""
    name = lambda p: p.rstrip("/").rsplit("/", 1)[-1]
    logs = [p for p in _paths(paths) if log_marker in name(p)]
    users = [p for p in _paths(paths) if users_marker in name(p) and p not in logs]
    parts = [log_lines(read_lines(spark, logs), day)] if logs else []
    parts += [user_lines(read_lines(spark, users))] if users else []
    if not parts:
        raise ValueError(f"no input is named after {log_marker} or {users_marker}: {_paths(paths)}")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
