"""Session construction and shared scratch space.

Writers and streams need a directory every executor can reach. On a cluster that
is the folder named by ``spark.checkpoint.dir``; it is read from the session and
only set here when it is missing (local runs and tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC clock, ANSI casts that raise, adaptive execution
# (partition coalescing and skew-join splitting).
#
# Broadcasts: the planner's static broadcast decision uses size *estimates* (compressed
# file sizes scaled by the projected columns), which can be far below the in-memory size
# of a text-heavy side. It is switched off; a join side is broadcast only when adaptive
# execution has *measured* it (the completed shuffle stage's actual bytes) below the
# adaptive threshold. Larger sides stay sort-merge joins.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "sparkwright",
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def scale_conf(input_bytes: int, total_cores: int, partition_bytes: int = 128 * 1024 ** 2,
               shuffle_fraction: float = 0.25, max_shuffle_partitions: int = 100_000) -> dict[str, str]:
    """Partition sizing for a cluster run over ``input_bytes`` of input.

    Scan splits target ``partition_bytes``. Shuffles are sized from the expected
    shuffle volume (``shuffle_fraction`` of the input: columns are pruned and
    aggregates combine map-side before the exchange) at ``partition_bytes`` per
    reducer, at least 3 waves of the cluster's cores and at most
    ``max_shuffle_partitions`` (map-status bookkeeping grows with maps x reducers);
    adaptive execution coalesces partitions that turn out small and splits a
    partition more than 5x the median and over 256 MB in skewed joins.
    """
    wanted = int(input_bytes * shuffle_fraction) // partition_bytes
    initial = min(max(wanted, 3 * total_cores, 8), max_shuffle_partitions)
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 * 1024 ** 2),
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder. Without one, a ``local`` master gets a folder of its own; any other raises,
    because its executors would each write to their own disk."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return spark.sparkContext.getCheckpointDir()
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="sparkwright-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused path below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "sparkwright", f"{name}-{uuid.uuid4().hex[:12]}")
