"""Spark session settings and the shared scratch location.

All jobs assume a cluster: no machine-local temp folders, lineage is cut
with ``checkpoint()`` or written tables under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Session defaults for the engine. Shuffle partitions default to the
# core count for local runs; on a cluster the submitter overrides it and
# AQE coalesces small partitions at run time.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Responder calls are paid side effects: never race two copies of a task.
    "spark.speculation": "false",
    # Checkpoint files of DataFrames that are no longer referenced are removed.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # GBK / GB18030 CSV input needs the JVM's full charset table.
    "spark.sql.legacy.javaCharsets": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "recsort", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("RECSORT_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_runtime_conf(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Settings that may be changed on an existing session."""
    for k in ("spark.sql.session.timeZone", "spark.sql.legacy.javaCharsets",
              "spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled"):
        try:
            spark.conf.set(k, DEFAULT_CONF[k])
        except Exception:  # static conf on some deployments
            pass


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, a local session (one process, as in tests) gets a
    folder of its own; on a cluster that folder would not be seen by the
    executors, so there it raises.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not root:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="recsort-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder (never reused)."""
    return f"{checkpoint_root(spark)}/recsort/{name}-{uuid.uuid4().hex[:12]}"
