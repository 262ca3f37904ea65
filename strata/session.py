"""Session construction and the shared scratch location.

On a cluster the scratch location is the shared folder named by
``spark.checkpoint.dir``, read from the session. Where it is unset, a temporary
folder is used with a local master; with any other master that is an error.
Scratch folders are not removed: results read from them stay valid.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.stateSchemaCheck": "true",
    # Remove RDD checkpoint files (ordered-scan slices) once nothing references them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(
    app: str = "strata",
    cpus: int | str = "*",
    shuffle_partitions: int = 8,
    driver_memory: str = "16g",
    extra: dict | None = None,
) -> SparkSession:
    """Local session for tests and the bench; clusters bring their own session."""
    b = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    conf = dict(_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint dir, setting a local one only if unset."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext; the server owns the setting
        configured = spark.conf.get("spark.checkpoint.dir", None)
        return configured or _local_folder(spark.conf.get("spark.master", ""))
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    sc.setCheckpointDir(configured or _local_folder(sc.master))
    return sc.getCheckpointDir()


def _local_folder(master: str) -> str:
    """A temporary folder, on a single machine only: on a cluster the executors would not see it."""
    if not re.fullmatch(r"local(\[[^]]*\])?", master or ""):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="strata-ckpt-")


def pinned(df: DataFrame) -> DataFrame:
    """``df`` written to the checkpoint folder: computed once, re-read after a lost executor."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    return os.path.join(base, "strata", f"{name}-{uuid.uuid4().hex[:12]}")
