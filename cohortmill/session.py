"""Spark session factory.  Library code always works on the session it is given."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings that hold at any scale.
BASE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Groups that a task keeps in a hash map where buffers are sketches; beyond, it sorts its rows.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "10000",
    "spark.ui.enabled": "false",
}


def get_session(
    app_name: str = "cohortmill",
    master: str | None = None,
    settings: dict[str, str] | None = None,
    log_level: str = "WARN",
    initial_partitions: int | None = None,
) -> SparkSession:
    """Get or create a session.

    ``master`` stays unset by default so that ``spark-submit`` decides; pass
    ``local[*]`` for a single machine.  ``initial_partitions`` is the width that shuffles
    start with before adaptive execution merges; give it a few times the cores of a cluster.
    """
    if initial_partitions is not None:
        name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
        settings = {name: str(initial_partitions), **(settings or {})}
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**BASE_SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel(log_level)
    return spark
