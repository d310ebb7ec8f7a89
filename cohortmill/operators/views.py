"""Views of many points: density tiles that stay few whatever the rows, and the two principal axes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortmill.functions.geometry import all_usable

LEVELS = 6


@dataclass(frozen=True)
class Extent:
    """The box of a view."""

    x_low: float
    x_high: float
    y_low: float
    y_high: float


def extent_of(points: DataFrame, x: str, y: str) -> Extent | None:
    """The box around all usable points, four numbers; None without any."""
    box = points.where(all_usable((x, y))).agg(F.min(x), F.max(x), F.min(y), F.max(y)).first()
    return None if box[0] is None else Extent(*map(float, box))


def _cell(value: Column, low: float, high: float, level: int) -> Column:
    """The cell of 2**level along an axis; the upper end belongs to the last one, a box without width is one cell."""
    last = (1 << level) - 1
    if high <= low:
        return F.lit(0).cast("bigint")
    at = F.floor((value.cast("double") - low) / (high - low) * (1 << level))
    return F.least(F.greatest(at, F.lit(0)), F.lit(last)).cast("bigint")


def density_tiles(
    points: DataFrame,
    x: str = "rating_percent",
    y: str = "playtime_hours",
    levels: int = LEVELS,
    extent: Extent | None = None,
    group: str = "cluster_id",
    key: str = "app_id",
) -> DataFrame:
    """(level, cell_x, cell_y, group, n, example): points per cell and cluster at every zoom level.

    Level z has 2**z cells along each axis, so a level holds at most 4**z rows per cluster, however many points
    there are; its counts add up to the points.  ``example`` is the smallest key in the cell.  Points are
    counted once, for the finest level, on the map side; coarser levels are sums of finer ones.  Points outside ``extent`` fall
    into the cells at its edge; points with a NULL, NaN or infinite coordinate are in no cell.
    """
    extent = extent or extent_of(points, x, y) or Extent(0.0, 0.0, 0.0, 0.0)
    finest = (
        points.where(all_usable((x, y)))
        .select(
            _cell(F.col(x), extent.x_low, extent.x_high, levels).alias("cell_x"),
            _cell(F.col(y), extent.y_low, extent.y_high, levels).alias("cell_y"),
            group,
            key,
        )
        .groupBy("cell_x", "cell_y", group)
        .agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("example"))
    )
    zoomed = finest.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(levels))))
    at = [F.expr(f"shiftright({c}, {levels} - level)").alias(c) for c in ("cell_x", "cell_y")]
    return (
        zoomed.select("level", *at, group, "n", "example")
        .groupBy("level", "cell_x", "cell_y", group)
        .agg(F.sum("n").alias("n"), F.min("example").alias("example"))
    )


def principal_axes(scaled: DataFrame, columns: Sequence[str], axes: int = 2) -> np.ndarray:
    """Directions (columns of a matrix) of the largest variance, from the covariance of all usable rows.

    The covariance is summed up by tasks; the driver sees its d x d numbers.  Of the two signs of a direction
    the one whose largest entry is positive.  Zeros where there are fewer than two usable rows.
    """
    usable = scaled.where(all_usable(columns))
    vectors = usable.select(array_to_vector(F.array(*[F.col(c).cast("double") for c in columns])).alias("v"))
    axes = min(axes, len(columns))
    if len(vectors.take(2)) < 2:
        return np.zeros((len(columns), axes))
    found = PCA(k=axes, inputCol="v").fit(vectors).pc.toArray()
    return found * np.where(found[np.abs(found).argmax(axis=0), np.arange(axes)] < 0, -1, 1)


def projected(scaled: DataFrame, columns: Sequence[str], directions: np.ndarray) -> DataFrame:
    """Adds ``axis_0``, ``axis_1``, ...: the coordinates of each row along the directions; NULL for unusable rows."""
    usable = all_usable(columns)
    coordinates = {
        f"axis_{j}": F.when(usable, sum((F.col(c) * F.lit(float(w)) for c, w in zip(columns, directions[:, j], strict=True)), F.lit(0.0)))
        for j in range(directions.shape[1])
    }
    return scaled.withColumns(coordinates)
