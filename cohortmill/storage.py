"""Shared working storage: where lineage is cut and intermediate files live."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``.  Only a session in local
    mode that names none gets a temporary folder of this machine.
    """
    context = spark.sparkContext
    named = spark.conf.get(_CHECKPOINT_SETTING, None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {_CHECKPOINT_SETTING} to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="cohortmill-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nothing else uses, grouped by application for later clean-up."""
    application = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/{application}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, scratch: Scratch | None = None) -> DataFrame:
    """Write ``df`` once to shared storage and continue from the written table.

    A lost executor then costs a re-read of this table, not a re-run of the scan
    and shuffles behind it.  ``scratch`` owns the table if given.
    """
    spark = df.sparkSession
    path = scratch.path(label) if scratch else scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Owns the intermediate tables of one run and removes them when it is released.

    As a context manager it releases only if its block fails, so that results which
    read those tables stay usable until their owner releases them.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.paths: list[str] = []

    def path(self, label: str) -> str:
        self.paths.append(scratch_path(self.spark, label))
        return self.paths[-1]

    def release(self) -> None:
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        configuration = self.spark.sparkContext._jsc.hadoopConfiguration()
        while self.paths:
            path = hadoop(self.paths.pop())
            path.getFileSystem(configuration).delete(path, True)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, kind, value, trace) -> None:
        if kind is not None:
            self.release()


@contextmanager
def held(df: DataFrame) -> Iterator[DataFrame]:
    """Keep ``df`` in executor memory (spilling to disk) for the length of a block."""
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()
