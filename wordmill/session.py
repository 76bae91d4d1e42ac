"""Session construction and the few settings every job relies on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings the library assumes. Time zone UTC makes timestamp parsing and
# day projection independent of the machine; AQE re-plans joins and
# partition counts from runtime statistics and splits skewed join partitions.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "wordmill",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session with the library's settings.

    On a cluster, ``master`` stays ``None`` and the cluster's own settings
    (including ``spark.checkpoint.dir``) win. Locally a checkpoint folder is
    chosen only when the session has none.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in BASE_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and materialized intermediates.

    Read from ``spark.checkpoint.dir``. Only a local-mode session (tests,
    single-machine runs) may leave it unset; it then gets a folder under
    ``WORDMILL_CHECKPOINT_DIR`` or ``/tmp``. On a cluster a machine-local
    folder would lose intermediates with their executor, so an unset
    setting is an error there.
    """
    sc = spark.sparkContext
    configured = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder (e.g. on HDFS or object storage) on a cluster")
        configured = os.environ.get("WORDMILL_CHECKPOINT_DIR", "/tmp/wordmill-checkpoints")
        spark.conf.set("spark.checkpoint.dir", configured)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(configured)
    return configured
