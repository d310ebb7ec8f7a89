"""A fitted segmentation as plain numbers, applied to batch or streaming rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Literal

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortmill.operators.evaluation import assign
from cohortmill.operators.features import (
    DEFAULT_FEATURES,
    FEATURE_TABLE_COLUMNS,
    Feature,
    feature_names,
    with_features,
)
from cohortmill.operators.scaling import Standardizer, scaled_names, standardize

_MODEL_SCHEMA = T.StructType(
    [
        T.StructField(
            "features",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("source", T.StringType()),
                        T.StructField("name", T.StringType()),
                        T.StructField("log", T.BooleanType()),
                        T.StructField("floor", T.DoubleType()),
                    ]
                )
            ),
        ),
        T.StructField("means", T.ArrayType(T.DoubleType())),
        T.StructField("deviations", T.ArrayType(T.DoubleType())),
        T.StructField("centers", T.ArrayType(T.ArrayType(T.DoubleType()))),
    ]
)


Unusable = Literal["null", "skip", "error"]


def treat_unusable(scored: DataFrame, usable: Column, unusable: Unusable) -> DataFrame:
    """``scored`` with a NULL ``cluster_id`` where not ``usable``, without those rows, or a failure."""
    if unusable == "skip":
        return scored.where(usable)
    if unusable not in ("null", "error"):
        raise ValueError(f"unusable={unusable!r} is none of null, skip, error")
    other = F.lit(None) if unusable == "null" else F.raise_error(F.lit("a feature is NULL, NaN or infinite"))
    return scored.withColumn("cluster_id", F.when(usable, F.col("cluster_id")).otherwise(other.cast("int")))


@dataclass(frozen=True)
class SegmentModel:
    """Feature definitions, scaler and centers: a few numbers per feature and cluster.

    ``score`` is a projection of built-in expressions.  It has no state, so the
    same call serves a table and a stream.
    """

    features: tuple[Feature, ...]
    scaler: Standardizer
    centers: tuple[tuple[float, ...], ...]

    @property
    def scaled_columns(self) -> list[str]:
        return scaled_names(self.scaler.columns)

    def scale(self, table: DataFrame) -> DataFrame:
        return standardize(with_features(table, self.features), self.scaler)

    def score(self, table: DataFrame, unusable: Unusable = "null") -> DataFrame:
        """Adds the feature and scaled columns, ``cluster_id`` and ``d2``.

        ``unusable`` says what becomes of rows with a NULL, NaN or infinite feature:
        ``null`` keeps them without a cluster, ``skip`` leaves them out, ``error`` fails.
        """
        assigned = assign(self.scale(table), self.scaled_columns, self.centers)
        return treat_unusable(assigned, F.col("cluster_id").isNotNull(), unusable)

    def save(self, spark: SparkSession, path: str) -> None:
        row = (
            [(f.source, f.name, f.log, f.floor) for f in self.features],
            list(self.scaler.means),
            list(self.scaler.deviations),
            [list(c) for c in self.centers],
        )
        spark.createDataFrame([row], _MODEL_SCHEMA).coalesce(1).write.mode("overwrite").json(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> SegmentModel:
        row = spark.read.schema(_MODEL_SCHEMA).json(path).first()
        features = tuple(Feature(**f.asDict()) for f in row["features"])
        return make_model(features, row["means"], row["deviations"], row["centers"])


def make_model(
    features: Sequence[Feature],
    means: Sequence[float],
    deviations: Sequence[float],
    centers: Sequence[Sequence[float]],
) -> SegmentModel:
    scaler = Standardizer(tuple(feature_names(features)), tuple(means), tuple(deviations))
    return SegmentModel(tuple(features), scaler, tuple(tuple(map(float, c)) for c in centers))


def from_ml_stages(
    fitted: PipelineModel, features: Sequence[Feature] = DEFAULT_FEATURES
) -> SegmentModel:
    """The numbers of an assembler, scaler and K-Means model."""
    _, scaler, clusters = fitted.stages
    return make_model(
        features,
        [float(x) for x in scaler.mean],
        [float(x) for x in scaler.std],
        [[float(x) for x in c] for c in clusters.clusterCenters()],
    )


def clustered_table(scored: DataFrame) -> DataFrame:
    """The seven published columns."""
    return scored.select(*FEATURE_TABLE_COLUMNS, F.col("cluster_id").cast("int").alias("cluster_id"))
