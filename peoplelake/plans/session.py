"""Session settings the operators are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def configured(builder: SparkSession.Builder, shuffle_partitions: int | None = None) -> SparkSession.Builder:
    """Adaptive execution with skew-join splitting, UTC, and partitions sized to fit executor memory.

    ``shuffle_partitions`` is the starting point that adaptive execution coalesces from: for large inputs, about the
    largest shuffle divided by the 128 MB target. Set ``spark.checkpoint.dir`` to a folder all executors reach.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.parquet.compression.codec": "zstd",
    }
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder
