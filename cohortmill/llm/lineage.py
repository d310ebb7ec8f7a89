"""Cutting lineage in the shared folder of the session."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cohortmill.storage import shared_dir


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the folder that ``spark.checkpoint.dir`` names.

    A lost executor then costs a re-read of those files.  A session without that
    setting, as in tests, gets a temporary one in local mode only.
    """
    folder = shared_dir(df.sparkSession)
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return df.checkpoint()
