"""Entity rows to the model's input columns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortmill import fixed_values as fixed
from cohortmill.functions.scalars import log_scale

FEATURE_TABLE_COLUMNS = (
    "app_id",
    "game_name",
    "price",
    "rating_percent",
    "popularity",
    "playtime_hours",
)


@dataclass(frozen=True)
class Feature:
    """One model input: a column of the feature table, optionally log-scaled."""

    source: str
    name: str
    log: bool = False
    floor: float | None = None


# The order is the order of the vector slots.
DEFAULT_FEATURES = (
    Feature("price", "log_price", log=True),
    Feature("rating_percent", "rating_percent"),
    Feature("popularity", "log_popularity", log=True),
    Feature("playtime_hours", "log_playtime", log=True),
)


def feature_table(
    joined: DataFrame, min_popularity: int = fixed.MIN_POPULARITY, extra: Sequence[str] = ()
) -> DataFrame:
    """The six published columns, and ``extra`` ones, of every entity that passes the final thresholds.

    The thresholds apply to the rounded rating.  They only touch aggregate
    columns, so Catalyst evaluates them below the metadata join.
    """
    rounded = joined.withColumn("rating_percent", F.round("rating_percent", 2))
    return rounded.select(*FEATURE_TABLE_COLUMNS, *extra).where(
        F.col("rating_percent").between(fixed.MIN_RATING, fixed.MAX_RATING)
        & (F.col("popularity") >= min_popularity)
        & (F.col("playtime_hours") >= 0)
    )


def with_features(table: DataFrame, features: Sequence[Feature] = DEFAULT_FEATURES) -> DataFrame:
    """Adds the log-scaled feature columns."""
    return table.withColumns(
        {f.name: log_scale(F.col(f.source), f.floor) for f in features if f.log}
    )


def feature_names(features: Sequence[Feature] = DEFAULT_FEATURES) -> list[str]:
    return [f.name for f in features]
