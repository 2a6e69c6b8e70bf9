"""Session settings for large runs."""

from __future__ import annotations

from pyspark.sql import SparkSession

PARTITION_BYTES = 128 * 1024 * 1024
MOST_PARTITIONS = 100_000  # more of them, times as many map tasks, are too many blocks for a driver


def settings_for(input_bytes: int, cores: int) -> dict[str, str]:
    """SQL settings for a run over ``input_bytes`` on ``cores``.

    Shuffles start with one partition per 128 MB of input and at least two per core; from 12 TB on
    partitions grow instead of their number, to 1 GB at 100 TB. Adaptive execution merges small ones,
    splits skewed ones and broadcasts a side once its measured size allows it.
    """
    size = max(PARTITION_BYTES, -(-input_bytes // MOST_PARTITIONS))
    partitions = max(2 * cores, -(-input_bytes // size))
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(size),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(size),
    }


def apply(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    for name, value in settings.items():
        spark.conf.set(name, value)
    return spark
