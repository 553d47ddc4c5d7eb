"""Session construction and the shared scratch location.

Library code never invents a machine-local folder on a cluster: intermediate
tables and lineage cuts go under ``spark.checkpoint.dir``, which the cluster
names.  Only on a local master without that setting (tests) is a temporary
directory chosen and registered as the checkpoint dir.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int | None = None,
                  app: str = "staykit") -> SparkSession:
    """A local session tuned for the small fixtures (tests, bench)."""
    n = os.cpu_count() if cpus == "*" else int(cpus)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_conf(total_cores: int, partition_mb: int = 256) -> dict[str, str]:
    """Settings for a large cluster (pass to ``SparkSession.builder.config``).

    Shuffles start with ~3 partitions per core and AQE coalesces them to
    ``partition_mb`` each; skewed join partitions are split; scan splits are
    ``partition_mb``.  Broadcasts stay behind AQE's measured-size threshold.
    """
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{partition_mb}m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{partition_mb * 4}m",
        "spark.sql.shuffle.partitions": str(max(200, 3 * total_cores)),
        "spark.sql.files.maxPartitionBytes": f"{partition_mb}m",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
        "spark.sql.session.timeZone": "UTC",
    }


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir).  Where
    neither is configured a local master (tests) gets a temporary one; any
    other master is refused, as its executors would not see that folder.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="staykit-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh, unique directory name under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/{tag}-{uuid.uuid4().hex[:12]}"
