"""Session settings. On a cluster pass ``scale_conf`` to the submit command or the builder."""

from __future__ import annotations

from pyspark.sql import SparkSession

_MIB = 1024 * 1024


def scale_conf(input_bytes: int) -> dict[str, str]:
    """Settings for a cluster that works on inputs of about this size.

    The shuffle starts with many partitions, which adaptive execution merges where little is left after
    the partial aggregates. Their number ends at 50,000: with the number of input splits it determines
    how much the driver has to track, so very large inputs get larger splits and partitions instead.
    """
    partitions = min(50_000, max(200, input_bytes // (256 * _MIB)))
    split = 512 if input_bytes > 10 * _MIB * _MIB else 128
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": f"{split}m",
        "spark.sql.session.timeZone": "UTC",
    }


def local_session(name: str = "tidefeed", cores: int | str = "*", **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
