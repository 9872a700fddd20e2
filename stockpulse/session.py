"""Local session for tests and benches.  On a cluster, use the cluster's
session; nothing here is required by the library."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "stockpulse") -> SparkSession:
    return (SparkSession.builder.master(f"local[{cores}]").appName(app)
            .config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
            .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
            .config("spark.sql.adaptive.enabled", "true")
            .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
            .config("spark.sql.adaptive.skewJoin.enabled", "true")
            .config("spark.sql.session.timeZone", "UTC")
            .config("spark.driver.memory", os.environ.get("STOCKPULSE_DRIVER_MEM", "8g"))
            .config("spark.sql.execution.arrow.pyspark.enabled", "true")
            .getOrCreate())


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int = 4,
                 target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings to size shuffles and splits for a cluster run over ``input_bytes``.

    Shuffle width starts at ~input / 256 MB (at least 3 waves of the
    cluster's cores); AQE coalesces small partitions back towards the
    advisory size and splits skewed ones.  Apply with ``spark.conf.set`` or
    ``--conf`` at submit time; ``spark.checkpoint.dir`` must name a shared
    (distributed) folder.
    """
    cores = max(1, executors * cores_per_executor)
    partitions = max(3 * cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 << 20),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }
