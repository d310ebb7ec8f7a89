"""Standardisation: zero mean, unit sample standard deviation."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortmill.functions.geometry import all_usable, doubles


@dataclass(frozen=True)
class Standardizer:
    """Mean and deviation per column.  A constant column scales to 0."""

    columns: tuple[str, ...]
    means: tuple[float, ...]
    deviations: tuple[float, ...]

    def scaled(self) -> list[Column]:
        return [
            (F.col(c) - F.lit(m)) * F.lit(1.0 / s if s else 0.0)
            for c, m, s in zip(self.columns, self.means, self.deviations, strict=True)
        ]


def scaled_names(columns: Sequence[str]) -> list[str]:
    return [f"scaled_{c}" for c in columns]


def scaler_params(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, mean, deviation), one row per column, from a single aggregate."""
    moments = df.agg(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                F.avg(c).alias("mean"),
                F.coalesce(F.stddev_samp(c), F.lit(0.0)).alias("deviation"),
            ).alias(f"m{i}")
            for i, c in enumerate(columns)
        ]
    )
    return moments.select(F.inline(F.array(*moments.columns)))


def fit_standardizer(df: DataFrame, columns: Sequence[str], weight: str | None = None) -> Standardizer:
    """Mean and sample deviation of every column over the usable rows, in one aggregate of one vector.

    A row with a NULL, NaN or infinite feature is left out, for any number of columns.  A row of
    ``weight`` w counts as w equal rows; one without a positive weight is left out.
    Brings one number pair per column to the driver, as any scaler fit does.
    """
    features = F.array(*doubles(columns))
    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    usable = df.where(all_usable(columns)).select(array_to_vector(features).alias("v"), w.alias("w")).where("w > 0")
    # A grouped aggregate has no row where there is nothing to summarise.
    found = usable.groupBy(F.lit(1)).agg(
        F.sum("w").alias("n"),
        F.sum(F.col("w") * F.col("w")).alias("squares"),
        Summarizer.metrics("mean", "variance").summary(F.col("v"), F.col("w")).alias("s"),
    ).first()
    if found is None:
        return Standardizer(tuple(columns), (0.0,) * len(columns), (0.0,) * len(columns))
    n = found["n"]
    # The summary divides by n - squares / n; weights that stand for rows divide by n - 1.
    share = (n - found["squares"] / n) / (n - 1) if n > 1 else 0.0
    deviations = tuple(math.sqrt(max(0.0, float(x) * share)) for x in found["s"]["variance"])
    return Standardizer(tuple(columns), tuple(map(float, found["s"]["mean"])), deviations)


def standardize(df: DataFrame, scaler: Standardizer) -> DataFrame:
    """Adds one ``scaled_`` column per feature, all inside whole-stage codegen."""
    names = scaled_names(scaler.columns)
    return df.withColumns(dict(zip(names, scaler.scaled(), strict=True)))


def scaling_stages(columns: Sequence[str], handle_invalid: str = "error") -> list:
    """The same two steps as Spark ML stages, for a saved PipelineModel."""
    return [
        VectorAssembler(
            inputCols=list(columns), outputCol="raw_features", handleInvalid=handle_invalid
        ),
        StandardScaler(
            inputCol="raw_features", outputCol="scaled_features", withMean=True, withStd=True
        ),
    ]


def ml_standardize(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Adds ``raw_features`` and ``scaled_features`` vectors through Spark ML."""
    return Pipeline(stages=scaling_stages(columns)).fit(df).transform(df)
