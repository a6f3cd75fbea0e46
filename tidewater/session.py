"""Session settings shared by the library, tests and the bench."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Session settings the library relies on. Timestamps are compared without a
# zone (TIMESTAMP_NTZ); the session zone only matters for second counts, so it
# is pinned to keep results repeatable across machines.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.scheduler.mode": "FAIR",  # tables that load side by side share the executors
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(
    master: str | None = None,
    app: str = "tidewater",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the library's settings.

    On a cluster pass ``master=None`` and let the launcher decide; the shuffle
    partition count should then follow the data (AQE coalesces small ones).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names it. Only on a local master, where driver and tasks are one
    process, is a scratch folder of our own set when it is unset; elsewhere that
    would put staged rows on each executor's own disk, so it is an error.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir() or named
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = fallback or os.environ.get("TIDEWATER_SCRATCH") or tempfile.mkdtemp(prefix="tidewater-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path
