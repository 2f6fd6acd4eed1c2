"""SparkSession construction and the session settings the library relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job in the library assumes.  Times are naive UTC (the raw tables use
# TIMESTAMP without zone), AQE re-plans joins and coalesces shuffle partitions at run time,
# and skewed join partitions are split.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # A JSON object that repeats a key is JSON; the last value counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "tierline") -> SparkSession:
    """Return the active session, or build one with the library defaults.

    On a cluster ``master`` stays ``None`` so that spark-submit decides.  Local runs and tests
    pass ``local[N]`` and a small ``shuffle_partitions``.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        apply_defaults(active)
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        builder = builder.config("spark.ui.enabled", "false")
        builder = builder.config("spark.driver.memory", os.environ.get("TIERLINE_DRIVER_MEMORY", "8g"))
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Set the defaults on a running session.  All are run-time settings; one that cannot be set
    would change results without a sign, so the error is raised."""
    for k, v in SESSION_DEFAULTS.items():
        spark.conf.set(k, v)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Checkpoint folder for lineage cuts.

    A cluster names a shared folder in ``spark.checkpoint.dir``; that setting is always used.
    Only when it is unset (local runs, tests) is a scratch folder created.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    master = spark.sparkContext.master or ""
    if not master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster; "
                         "a machine-local folder does not survive a lost executor")
    local = tempfile.mkdtemp(prefix="tierline-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return local
