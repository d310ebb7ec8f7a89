"""The tables behind the charts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortmill import fixed_values as fixed
from cohortmill.functions.scalars import contains_any, magnitude_text
from cohortmill.operators.profile import PROFILED


def elbow_series(sweep: DataFrame, best: DataFrame) -> DataFrame:
    """(K, metric, value, is_best): both measures over K.  ``best`` is ``best_k(sweep)``."""
    chosen = best.select(F.col("K").alias("best"))
    long = sweep.unpivot("K", ["WSSSE_Cost", "Silhouette_Score"], "metric", "value")
    return long.join(chosen, F.col("K") == F.col("best"), "left").select(
        "K", "metric", "value", F.col("best").isNotNull().alias("is_best")
    )


def scatter_rows(
    labelled: DataFrame,
    x: str = "rating_percent",
    y: str = "playtime_hours",
    size: str = "popularity",
    words: Sequence[str] = fixed.NOTABLE_WORDS,
    z: str | None = None,
) -> DataFrame:
    """Point rows of the 2D or 3D feature view, with the caption of notable entities."""
    axes = [F.col(x).alias("x"), F.col(y).alias("y")]
    if z is not None:
        axes.append(F.col(z).alias("z"))
    return labelled.select(
        "app_id",
        *axes,
        F.col(size).alias("size"),
        F.col("cluster_label").alias("hue"),
        F.when(contains_any(F.col("game_name"), words), F.col("game_name")).alias("caption"),
    )


def notable_entities(table: DataFrame, words: Sequence[str] = fixed.NOTABLE_WORDS) -> DataFrame:
    """Entities whose name contains any of the words, ignoring case."""
    return table.where(contains_any(F.col("game_name"), words))


def feature_bars(statistics: DataFrame) -> DataFrame:
    """(cluster_id, metric, value, caption): one bar per cluster and mean."""
    metrics = [f"avg_{name}" for name in PROFILED.values()]
    unit = F.when(F.col("metric") == "avg_price", "$").otherwise("")
    return statistics.unpivot("cluster_id", metrics, "metric", "value").withColumn(
        "caption", magnitude_text(F.col("value"), unit)
    )


def share_slices(shares: DataFrame, labels: DataFrame) -> DataFrame:
    """(cluster_id, caption, game_count, share_percent): the slices of the size chart."""
    caption = F.format_string("%s\n(%d games)", F.col("label"), F.col("game_count"))
    return shares.join(labels.select("cluster_id", "label"), "cluster_id").select(
        "cluster_id", caption.alias("caption"), "game_count", "share_percent"
    )
