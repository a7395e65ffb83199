"""Session defaults."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(
    app_name: str = "opinara",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session with adaptive execution on, timestamps in UTC and fair scheduling between threads.

    ``master`` and memory are left to spark-submit unless given. On a cluster leave
    ``shuffle_partitions`` unset and give a generous
    ``spark.sql.adaptive.coalescePartitions.initialPartitionNum``; adaptive execution
    merges the small ones.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.scheduler.mode", "FAIR")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
