"""Session construction and the shared staging folder.

Every job in the package is a DataFrame plan; this module only sets the
knobs that decide how those plans behave at scale (AQE, skew handling,
partition sizing) and resolves where staged tables may be written.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# Settings the package relies on. AQE re-plans joins from runtime sizes,
# splits skewed join partitions and coalesces small shuffle outputs. A side
# is broadcast only below Spark's thresholds: on file-size estimates when
# planning, on measured shuffle sizes when AQE plans again.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "clickmart",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the package's settings.

    On a cluster pass ``master=None`` and let spark-submit decide; set
    ``shuffle_partitions`` to roughly input-bytes / 128 MB for the largest
    shuffle (AQE coalesces downwards from there).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SCALE_CONF)
    conf.setdefault("spark.ui.enabled", "false")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    # getOrCreate may return a running session: re-apply the SQL settings.
    for k, v in conf.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    make_importable(spark)
    return spark


def make_importable(spark: SparkSession) -> None:
    """Let Python workers find this package where the driver did.

    Enough where they see the driver's file system (one machine, a shared
    mount); elsewhere ship the package with ``--py-files`` or install it.
    """
    sc = _context(spark)
    if sc is None:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = [p for p in sc.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        sc.environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - a remote (Connect) session has none
        return None


def app_id(spark: SparkSession) -> str:
    sc = _context(spark)
    if sc is not None:
        return sc.applicationId
    return spark.conf.get("spark.app.id", "remote")


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder every executor can reach, under ``spark.checkpoint.dir``.

    The cluster names the shared folder; it is only read here. A session
    that names none keeps its staged tables beside its tables, in
    ``spark.sql.warehouse.dir``, which executors share as well.
    """
    sc = _context(spark)
    base = spark.conf.get("spark.checkpoint.dir", None) or (sc.getCheckpointDir() if sc is not None else None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_staging"
    return "/".join([base.rstrip("/"), *parts])


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, unique folder under the shared staging area.

    The application's staging folder goes when its JVM ends (or by
    ``release``).
    """
    app = shared_dir(spark, "clickmart", app_id(spark))
    if _context(spark) is not None:
        fs, path = _hadoop(spark, app)
        fs.mkdirs(path)
        fs.deleteOnExit(path)
    return f"{app}/{label}-{uuid.uuid4().hex[:12]}"


def _hadoop(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def release(spark: SparkSession, path: str | None = None) -> None:
    """Delete one staged folder, or all of the application."""
    fs, at = _hadoop(spark, path or shared_dir(spark, "clickmart", app_id(spark)))
    fs.delete(at, True)


def fingerprint(spark: SparkSession, paths: list[str]) -> tuple:
    """Size, file count and modification time of each path: changes when its files do."""
    out = []
    for p in paths:
        fs, path = _hadoop(spark, p)
        summary = fs.getContentSummary(path)
        out.append((p, summary.getLength(), summary.getFileCount(), fs.getFileStatus(path).getModificationTime()))
    return tuple(out)
