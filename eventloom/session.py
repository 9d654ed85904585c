"""Session helpers.

The engine's times are UTC end to end (ISO-8601 strings with ``Z``, epoch
milliseconds inside message ids), so every entry point pins the session time
zone. Checkpoints go to ``spark.checkpoint.dir`` when the cluster names one;
a scratch folder is chosen only when it is unset (local runs and tests).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def ensure_utc(spark: SparkSession) -> SparkSession:
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def local_session(cpus: str | int = "*", shuffle_partitions: int = 8, app: str = "eventloom") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", os.environ.get("EVENTLOOM_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster
    (``spark.checkpoint.dir``). Only a local-mode session without one (tests,
    single-machine runs) gets a scratch folder; on a cluster a machine-local
    folder would not survive executor loss, so it must be configured."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS or an object store)")
    path = tempfile.mkdtemp(prefix="eventloom-ckpt-")
    sc.setCheckpointDir(path)
    return path


def cluster_conf(input_bytes: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a large cluster run, sized from the input volume.

    Shuffles start with about one partition per ``target_partition_bytes`` of
    input and AQE coalesces small ones and splits skewed join partitions; scan
    splits match the same size so a task's working set fits executor memory.
    """
    initial = max(200, int(input_bytes // target_partition_bytes))
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        # Running values are split along the order, so a hot key is no single task.
        "spark.eventloom.scan.split": "true",
        # Keyed streaming state (one row per device) in RocksDB, off the JVM heap.
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
