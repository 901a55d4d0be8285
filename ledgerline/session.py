"""Session helpers.

The library never builds its own cluster configuration: a job receives the
session the cluster gives it. ``local_session`` exists for tests and the bench.
"""

from __future__ import annotations

import atexit
import os
import tempfile

from pyspark.sql import SparkSession

# Settings the operators are designed around. AQE re-plans joins at run time
# (broadcast when a side turns out small, split skewed partitions).
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # JSON objects with a repeated key keep the last value (J1).
    "spark.sql.variant.allowDuplicateKeys": "true",
}


# Starting points for a large cluster (~100 TB inputs, ~1000 executors). AQE
# sizes shuffle partitions at run time from a high initial count; scans split
# into 256 MB tasks; a partition five times the median and over 512 MB counts
# as skewed and is split.
CLUSTER_CONF = {
    **RECOMMENDED_CONF,
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "ledgerline") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("LEDGERLINE_DRIVER_MEMORY", "16g"))
    )
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Where the session leaves it unset, a local master (tests, a laptop) gets a
    temporary folder; on a cluster that would be a different disk on every
    machine, so it is an error there.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect has no SparkContext on the client
        sc = None
    d = d or (sc.getCheckpointDir() if sc is not None else None)
    if not d:
        if sc is None or not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # a core setting some sessions refuse to change at run time
            pass
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh directory under the shared checkpoint folder for written tables."""
    import uuid

    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/ledgerline/{name}-{uuid.uuid4().hex[:12]}"
    if not _written:
        atexit.register(remove_scratch, spark)
    _written.append(path)
    return path


_written: list[str] = []


def remove_scratch(spark: SparkSession) -> None:
    """Delete the scratch folders this process asked for. Runs at exit; a
    result may read them until then."""
    try:
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        while _written:
            target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_written.pop())
            target.getFileSystem(conf).delete(target, True)
    except Exception:  # the session is gone: nothing can be deleted through it
        pass
