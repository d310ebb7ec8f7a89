"""Scoring of feature rows as they arrive."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cohortmill.functions.geometry import all_usable
from cohortmill.operators.scoring import SegmentModel, Unusable, clustered_table, treat_unusable


def read_feature_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None
) -> DataFrame:
    """Feature rows from the Parquet files that land in a folder."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def score_rows(
    rows: DataFrame, model: SegmentModel | PipelineModel, unusable: Unusable = "null"
) -> DataFrame:
    """Clustered rows of a batch or streaming table, from either form of the model.

    ``unusable`` means the same for both, see ``SegmentModel.score``.

    The scoring keeps no state between rows: no watermark, no state store, and a
    restarted stream continues from its checkpoint alone.
    """
    if isinstance(model, SegmentModel):
        return clustered_table(model.score(rows, unusable))
    assembler, *others = model.stages
    # Kept as NaN by the assembler; the cluster that a later stage makes of that is taken back.
    tolerant = PipelineModel([assembler.copy().setHandleInvalid("keep"), *others])
    usable = all_usable(assembler.getInputCols())
    return clustered_table(treat_unusable(tolerant.transform(rows), usable, unusable))


def write_scored(
    scored: DataFrame, path: str, checkpoint: str, once: bool = False, interval: str = "1 minute"
) -> StreamingQuery:
    """Append scored rows to a Parquet table, exactly once per input row.

    ``once`` takes everything that is there in bounded steps and stops.  Offsets
    and commits live under ``checkpoint``, which must be shared storage.
    """
    writer = scored.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)
    return writer.format("parquet").start(path)
