"""SparkSession construction and session-level settings shared by pipelines."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every pipeline relies on.  AQE lets Spark coalesce small shuffle partitions, turn a sort-merge join
# into a broadcast join once the runtime size of one side is known (autoBroadcastJoinThreshold is the checked
# bound), and split skewed join partitions (a single job or account can hold a large share of the rows).
_PIPELINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "trestle",
                  extra: dict | None = None) -> SparkSession:
    """Local/test session.  On a cluster the session comes from the launcher; use :func:`configure` there."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("TRESTLE_DRIVER_MEMORY", "8g"),
        "spark.sql.session.timeZone": "UTC",
        **_PIPELINE_CONF,
        **(extra or {}),
    }
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings the pipelines rely on to an existing session."""
    for key, value in _PIPELINE_CONF.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only in local mode (tests, the benchmark) is a scratch folder created when none is set; on a cluster a
    missing setting is an error, because a machine-local folder is not visible to the other executors.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (landed tables are written there)")
        configured = tempfile.mkdtemp(prefix="trestle-ckpt-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(configured)
    return configured
