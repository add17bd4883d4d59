"""SparkSession helper for local runs, tests and the bench.

On a cluster the session comes from the launcher; only settings that are
still unset are filled in here (``spark.checkpoint.dir`` in particular is
taken from the cluster when it names a shared folder).
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Defaults tuned for local[N]; at cluster scale shuffle partitions should be
# sized so one partition is ~128-256 MB after AQE coalescing.
_LOCAL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # coalesce to the advisory size instead of maximising (tiny) task counts
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # tables stored by response id join on it and a second key without a shuffle (sources/store.py)
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app_name: str = "bidscope", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_LOCAL_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("BIDSCOPE_DRIVER_MEMORY", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the reliable checkpoint folder, setting one only when unset.

    A cluster names a shared folder in ``spark.checkpoint.dir``; that one is
    always kept.  The fallback (a scratch folder) is for local masters only; on a
    cluster without the setting this raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if fallback is None and sc.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    import tempfile
    path = fallback or tempfile.mkdtemp(prefix="bidscope-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()
