"""Spark session and checkpoint-directory helpers.

The library never creates its own session inside an operator: every public
function takes DataFrames (and, where a job needs it, a ``SparkSession``).
``get_spark`` is a convenience for tests, the bench and command-line use.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session of this library wants. AQE re-plans joins and
# partition counts from runtime statistics; ANSI stays on (Spark 4 default),
# so the operators use try_divide / try_cast where input can be dirty.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # feature frames are wide (hundreds of columns); keep whole-stage codegen on
    "spark.sql.codegen.maxFields": "2000",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # remove checkpoint files once their DataFrame is garbage-collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # the status listeners run even with the UI off; wide feature plans carry
    # heavy metadata, so long-lived sessions keep only recent executions
    "spark.sql.ui.retainedExecutions": "50",
    "spark.ui.retainedJobs": "200",
    "spark.ui.retainedStages": "200",
}


def get_spark(master: str | None = None, app_name: str = "featureloom",
              shuffle_partitions: int | None = None,
              extra_conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint directory, setting one only when the cluster
    has not named one.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is
    used as is. Only when it is unset (local tests) do we create a scratch
    folder, because a machine-local folder is useless to other executors.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - e.g. a Spark Connect session: the server's setting applies
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share; "
                           "a folder of this machine is of no use to them")
    local = tempfile.mkdtemp(prefix="featureloom-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def checkpoint_path(spark: SparkSession, name: str) -> str:
    """A path under the checkpoint directory for an explicitly written table."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, name) if "://" not in base else base.rstrip("/") + "/" + name
