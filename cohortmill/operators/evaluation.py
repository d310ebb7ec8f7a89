"""Assignment, cost and silhouette, one form each for every width and number of clusters.

An assigned table carries the scaled feature columns and ``cluster_id``.  A row with a
feature that is NULL, NaN or infinite has no cluster and counts in no measure.  Where ``weight``
names a column, a row of weight w counts as w equal rows, and one without a positive weight not at all.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from cohortmill.functions.geometry import all_usable, dot, doubles, nearest_center, squared_norm


def assign(scaled: DataFrame, scaled_columns: Sequence[str], centers) -> DataFrame:
    """Adds ``cluster_id`` and the squared distance ``d2`` to the nearest center, NULL for unusable rows.

    The generator keeps the measurement in one place; as two columns it would be made twice.
    """
    rows = scaled.drop("cluster_id", "d2")
    found = rows.select("*", F.inline(F.array(nearest_center(scaled_columns, centers))))
    return found.select(*[F.col(f"`{c}`") for c in rows.columns], "cluster_id", "d2")


def _weighed(rows: DataFrame, weight: str | None) -> DataFrame:
    return rows if weight is None else rows.where(F.col(weight) > 0)


def _times(value: Column, weight: str | None) -> Column:
    return value if weight is None else value * F.col(weight)


def wssse(assigned: DataFrame, weight: str | None = None) -> DataFrame:
    """One row: the within-set sum of squared errors."""
    return _weighed(assigned, weight).agg(F.sum(_times(F.col("d2"), weight)).alias("wssse"))


def cluster_sums(
    assigned: DataFrame, scaled_columns: Sequence[str], weight: str | None = None
) -> DataFrame:
    """Per cluster: row count, sum of squared norms and the sum vector.

    Plain sums, combined on the map side: the shuffle carries one row per cluster
    and task, however uneven the clusters are.
    """
    features = doubles(scaled_columns)
    rows = _weighed(assigned, weight).where(F.col("cluster_id").isNotNull())
    sums = rows.groupBy("cluster_id").agg(
        (F.count(F.lit(1)) if weight is None else F.sum(weight)).alias("n"),
        F.sum(_times(squared_norm(features), weight)).alias("norms"),
        *[F.sum(_times(c, weight)).alias(f"s{i}") for i, c in enumerate(features)],
    )
    return sums.select("cluster_id", "n", "norms", F.array(*[f"s{i}" for i in range(len(features))]).alias("total"))


def cost_from_sums(sums: Sequence[Row], centers) -> float:
    """The cost from the rows of ``cluster_sums``: sum of |x|^2 - 2 x.c + |c|^2."""
    cost = 0.0
    for row in sums:
        center = centers[row["cluster_id"]]
        cross = sum(s * c for s, c in zip(row["total"], center, strict=True))
        cost += row["norms"] - 2.0 * cross + row["n"] * sum(c * c for c in center)
    return cost


def _row_silhouette(scaled_columns: Sequence[str], own: Column, sums: Sequence[Row]) -> Column:
    """The silhouette of one row from the sums of all clusters.

    The mean squared distance from x to a cluster of n rows with mean m and mean
    squared norm y is |x|^2 - 2 x.m + y, so a row needs K sums and no other row.
    """
    features = doubles(scaled_columns)
    norm = squared_norm(features)
    mine, others = F.lit(None).cast("double"), []
    for row in sums:
        n = float(row["n"])
        reach = F.greatest(norm - dot(features, [2.0 * s / n for s in row["total"]]) + F.lit(row["norms"] / n), F.lit(0.0))
        here = own == row["cluster_id"]
        # The row itself is at distance 0 and does not count among its neighbours.
        mine = F.when(here, reach * (n / (n - 1.0)) if n > 1 else F.lit(None)).otherwise(mine)
        others.append(F.when(~here, reach))
    a, b = mine, F.least(*others)
    return F.when(a < b, 1.0 - a / b).when(a > b, b / a - 1.0).otherwise(F.lit(0.0))


def silhouette(
    assigned: DataFrame,
    scaled_columns: Sequence[str],
    sums: Sequence[Row] | None = None,
    weight: str | None = None,
) -> DataFrame:
    """One row: the mean squared-Euclidean silhouette, in two passes and without pairs.

    ``sums`` are the collected rows of ``cluster_sums``, K of them.  A row alone in its
    cluster counts 0; with a single non-empty cluster the value is NULL.
    """
    if sums is None:
        sums = cluster_sums(assigned, scaled_columns, weight).collect()
    if len(sums) < 2:
        return assigned.agg(F.lit(None).cast("double").alias("silhouette"))
    rows = _weighed(assigned, weight).where(F.col("cluster_id").isNotNull())
    score = _row_silhouette(scaled_columns, F.col("cluster_id"), sums)
    mean = F.avg(score) if weight is None else F.sum(score * F.col(weight)) / F.sum(weight)
    return rows.agg(mean.alias("silhouette"))


def _matrix(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Features and weights of the rows of a batch; its last column is the weight."""
    columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(width + 1)]
    return np.column_stack(columns[:-1]), columns[-1]


def _nearest(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """The id of each row's nearest center, the lowest of equally near ones."""
    return np.stack([((x - c) ** 2).sum(axis=1) for c in centers], axis=1).argmin(axis=1)


def sweep_scores(
    scaled: DataFrame,
    scaled_columns: Sequence[str],
    models: Mapping[int, Sequence[Sequence[float]]],
    weight: str | None = None,
) -> list[tuple[int, float, float | None]]:
    """(K, cost, silhouette) of every model, in two passes over ``scaled`` for all of them.

    A pass measures whole batches against every center at once and leaves one row per cluster and task.  The
    driver sees one row per cluster of each model.
    """
    width = len(scaled_columns)
    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    rows = _weighed(scaled, weight).where(all_usable(scaled_columns)).select(*doubles(scaled_columns), w.alias("w"))
    points = {k: np.array(centers, dtype=float) for k, centers in models.items()}

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {k: np.zeros((len(c), width + 2)) for k, c in points.items()}
        for batch in batches:
            x, w = _matrix(batch, width)
            each = np.column_stack([w, w * (x**2).sum(axis=1), x * w[:, None]])
            for k, centers in points.items():
                own = _nearest(x, centers)
                for j in range(width + 2):
                    sums[k][:, j] += np.bincount(own, each[:, j], len(centers))
        found = np.concatenate([np.column_stack([np.full(len(s), k), np.arange(len(s)), s]) for k, s in sums.items()])
        found = found[found[:, 2] > 0]
        columns = [pa.array(found[:, i].astype(np.int32)) for i in (0, 1)] + [pa.array(found[:, 2 + j]) for j in range(width + 2)]
        yield pa.RecordBatch.from_arrays(columns, names)

    slots = [f"s{i}" for i in range(width)]
    names = ["k", "cluster_id", "n", "norms", *slots]
    parts = rows.mapInArrow(summed, "k int, cluster_id int, " + ", ".join(f"{n} double" for n in names[2:]))
    found = (
        parts.groupBy("k", "cluster_id")
        .agg(*[F.sum(n).alias(n) for n in names[2:]])
        .select("k", "cluster_id", "n", "norms", F.array(*slots).alias("total"))
        .collect()
    )
    sums = {k: sorted((r for r in found if r["k"] == k), key=lambda r: r["cluster_id"]) for k in models}
    several = {
        k: (
            np.array([r["cluster_id"] for r in sums[k]]),
            np.array([r["n"] for r in sums[k]]),
            np.array([r["total"] for r in sums[k]]),
            np.array([r["norms"] for r in sums[k]]),
        )
        for k in models
        if len(sums[k]) > 1
    }

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = dict.fromkeys(several, 0.0)
        for batch in batches:
            x, w = _matrix(batch, width)
            norm = (x**2).sum(axis=1)
            for k, (ids, n, total, norms) in several.items():
                # Mean squared distance of each row to each cluster that has rows.
                reach = np.maximum(norm[:, None] - 2 * x @ (total / n[:, None]).T + norms / n, 0.0)
                place = np.searchsorted(ids, _nearest(x, points[k]))
                each = np.arange(len(x))
                size = n[place]
                a = reach[each, place] * np.divide(size, size - 1, out=np.zeros(len(x)), where=size > 1)
                reach[each, place] = np.inf
                b = reach.min(axis=1)
                larger = np.maximum(a, b)
                score = np.divide(b - a, larger, out=np.zeros(len(x)), where=(larger > 0) & (size > 1))
                totals[k] += float((score * w).sum())
        yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.int32()), pa.array(list(totals.values()), pa.float64())], ["k", "score"])

    scores: dict[int, float] = {}
    if several:
        parts = rows.mapInArrow(scored, "k int, score double").groupBy("k").agg(F.sum("score").alias("score"))
        scores = {r["k"]: r["score"] / float(several[r["k"]][1].sum()) for r in parts.collect()}
    return [(k, cost_from_sums(sums[k], centers), scores.get(k)) for k, centers in models.items()]


def fit_checks(assigned: DataFrame, scaled_columns: Sequence[str], centers, tolerance: float = 1e-2) -> DataFrame:
    """What a finished K-Means fit fulfils and other centers do not, one row.

    Every center is the mean of its rows, within ``tolerance`` a slot, and moving any center
    by ten times as much along any slot does not lower the cost.
    """
    sums = cluster_sums(assigned, scaled_columns).collect()  # one row per cluster
    cost = cost_from_sums(sums, centers)
    at_mean = all(
        abs(s / row["n"] - c) <= tolerance
        for row in sums
        for s, c in zip(row["total"], centers[row["cluster_id"]], strict=True)
    )

    def moved(cluster: int, slot: int, step: float):
        return [[x + step * (i == cluster and j == slot) for j, x in enumerate(c)] for i, c in enumerate(centers)]

    least = all(
        cost <= cost_from_sums(sums, moved(row["cluster_id"], slot, step))
        for row in sums
        for slot in range(len(scaled_columns))
        for step in (10 * tolerance, -10 * tolerance)
    )
    return assigned.agg(
        F.count("cluster_id").alias("assigned_rows"),
        F.countDistinct("cluster_id").alias("filled_clusters"),
        F.lit(at_mean).alias("centers_are_means"),
        F.lit(least).alias("moved_centers_cost_more"),
    )
