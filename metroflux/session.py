"""Spark session construction and shared-storage helpers."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # one from_json per message, not one pruned copy per extracted field
    "spark.sql.optimizer.enableJsonExpressionOptimization": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


RUNTIME_CONF = {k: v for k, v in DEFAULT_CONF.items() if k.startswith("spark.sql.") and "arrow" not in k}


def apply_runtime_conf(spark: SparkSession) -> None:
    """Session-level SQL settings the operators rely on (safe to set on a
    running session, e.g. one created by a driver program)."""
    for k, v in RUNTIME_CONF.items():
        spark.conf.set(k, v)


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "metroflux", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings every job here assumes.

    On a cluster the master and shuffle partitions come from spark-submit;
    they are only set here when given (tests and local benchmarks).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_BASE: dict[str, str] = {}


def shared_dir(spark: SparkSession, name: str) -> str:
    """A directory under the cluster's shared checkpoint location.

    ``spark.checkpoint.dir`` names the shared folder on a cluster and is
    read from the session.  Only when it is unset (tests, local runs) a
    local scratch folder is used for this application; the setting itself
    cannot be changed on a running session, so the folder is registered
    with ``setCheckpointDir`` instead."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        app = spark.sparkContext.applicationId
        if app not in _LOCAL_BASE:
            _LOCAL_BASE[app] = tempfile.mkdtemp(prefix="metroflux-ckpt-")
        base = _LOCAL_BASE[app]
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    path = base.rstrip("/") + "/" + name
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)      # on the file system the path names
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(jpath)
    return path
