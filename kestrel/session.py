"""Session construction and shared-storage helpers."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SCAN_PARTITIONS = "spark.kestrel.scanPartitions"


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "kestrel", scan_partitions: int | None = None
                  ) -> SparkSession:
    """A session tuned for the operators in this package.

    Only sets values a cluster deployment is unlikely to override: AQE with partition
    coalescing and skew-join splitting, UTC session time, Arrow for pandas UDFs, removal
    of checkpoints that nothing refers to, UI off. ``spark.sql.shuffle.partitions`` stays
    the deployment's unless the caller passes it. ``scan_partitions`` is for machines whose
    inputs are single files: see ``tables.documents``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if scan_partitions:
        builder = builder.config(SCAN_PARTITIONS, str(scan_partitions))
    builder = (
        builder
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, configuring it if needed.

    On a cluster the deployment names a shared folder in ``spark.checkpoint.dir``; that
    setting always wins. When nothing is configured, a ``local[...]`` master gets a fresh
    temp folder that is removed when the driver ends; on a cluster that is an error, since
    its executors share no local folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote session: the server owns the setting
        return spark.conf.get("spark.checkpoint.dir", "")
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        configured = local_fallback(sc.master)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def local_fallback(master: str) -> str:
    """A temp folder for a single-machine session; refused for any other master."""
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise RuntimeError(f"spark.checkpoint.dir must name a shared folder on {master}")
    folder = tempfile.mkdtemp(prefix="kestrel-ckpt-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def remove_tree(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared store, if it is there."""
    try:
        hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
        hadoop_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()) \
                   .delete(hadoop_path, True)
    except Exception:  # noqa: BLE001 - the session has ended: nothing left to ask
        pass


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint directory, removed when the driver ends
    (the queries that write it are lazy: their readers come later)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    folder = f"{base}/kestrel-scratch/{uuid.uuid4().hex}"
    atexit.register(remove_tree, spark, folder)
    return f"{folder}/{name}"


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage of a table that several fits read.

    A reliable checkpoint is written to the shared directory named by
    ``spark.checkpoint.dir``, so a lost executor costs a re-read, not a replay of the
    text pipeline.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
