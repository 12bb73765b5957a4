"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the semantics depend on (not tuning): UTC session zone (T9) and ANSI mode.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Tuning defaults for local runs (applied only when get_spark starts a local master).
LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "cellscope", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    # local tuning only for sessions we start ourselves (tests, bench, a laptop); on a
    # cluster (no master given) its own configuration stays in force
    conf = {**(LOCAL_CONF if master else {}), **REQUIRED_CONF, **(extra or {})}
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    ensure_session(spark)
    return spark


def ensure_session(spark: SparkSession) -> SparkSession:
    """Pin the semantic settings on an existing session (the driver hands us its own)."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and staged tables: `spark.checkpoint.dir`.

    Where it is unset, a local master (tests, a laptop) gets a scratch folder of its own; any
    other master is an error, since executors on other machines could not read it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a remote (Connect) session exposes no SparkContext
        sc = None
    if sc is not None:
        configured = configured or sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if sc is None or not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="cellscope-ckpt-")
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured


def session_key(spark: SparkSession) -> str:
    """Identity of the running application (for per-session memoisation)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - remote session
        return str(id(spark))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder."""
    import uuid

    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/cellscope/{name}-{uuid.uuid4().hex[:12]}"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
