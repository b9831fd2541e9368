"""Session construction and the shared working folder.

On a cluster the shared folder is whatever ``spark.checkpoint.dir`` names
(a distributed file system path every executor can reach).  Only when it is
unset and the master is a single local process, as in tests, do we create one
under ``/tmp`` and remove it at exit; elsewhere an unset folder is an error.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Settings for a large cluster (hundreds of executors, ~100 TB of input).
# Scoring multiplies every weather row by the number of districts (15), so the
# weather scan uses smaller splits than the default to keep each task's
# output near the advisory partition size.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "64m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    # round-robin repartitions sort first, so a retried task rebuilds the
    # same partition contents after an executor loss
    "spark.sql.execution.sortBeforeRepartition": "true",
    "spark.task.maxFailures": "8",
    "spark.stage.maxConsecutiveAttempts": "8",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def shuffle_partitions_for(input_bytes: int, target_bytes: int = 256 << 20,
                           expansion: float = 1.0) -> int:
    """Shuffle partitions so that each holds about ``target_bytes`` after a
    plan step that multiplies data by ``expansion``."""
    return max(1, int(input_bytes * expansion // target_bytes) + 1)


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "tidewatch", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for checkpoints and intermediate tables."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None) \
        or sc.getConf().get("spark.checkpoint.dir", None)
    if d:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(d)
        return sc.getCheckpointDir() or d
    if not sc.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    # one process holds driver and executors: a folder of its own is shared,
    # and goes with it
    d = tempfile.mkdtemp(prefix="tidewatch-ckpt-", dir="/tmp")
    atexit.register(shutil.rmtree, d, ignore_errors=True)
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused path under the shared folder."""
    base = shared_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


def materialize(df):
    """Cut lineage: a reliable checkpoint in the shared folder (never a
    local checkpoint), for inputs that several jobs reuse (model fits, folds).
    Lost executors then recompute nothing upstream of it."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
