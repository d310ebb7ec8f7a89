"""What findings are worth: intervals by a Poisson bootstrap, and the gap statistic against uniform draws.

Random numbers are digests of a key, a number and a seed.  They are the same on every run, in every
partitioning and in SQL, so a lost executor repeats its part exactly.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortmill.functions.geometry import all_usable
from cohortmill.operators.evaluation import sweep_scores

REPLICATES, DRAWS = 200, 10
#: Chances of at most 0, 1, 2, ... with mean 1, up to where the rest is below 1e-12.
POISSON_STEPS = tuple(math.exp(-1) * sum(1 / math.factorial(i) for i in range(k + 1)) for k in range(14))


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the digest of ``parts``, joined by colons."""
    digest = F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]).cast("binary"))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / float(1 << 48)


def poisson_weight(u: Column) -> Column:
    """How often a row counts in a replicate: Poisson with mean 1 by inversion."""
    weight = F.lit(0)
    for step in POISSON_STEPS:
        weight = weight + (u >= step).cast("int")
    return weight


def replicate_means(
    clustered: DataFrame,
    features: Sequence[str],
    key: str = "app_id",
    replicates: int = REPLICATES,
    seed: int = 42,
) -> DataFrame:
    """(cluster_id, replicate, feature, mean): each replicate's mean per cluster and feature, in one pass.

    A row meets every replicate inside its task and is summed up there, so the shuffle carries one row per
    cluster, replicate and task, however uneven the clusters are.
    """
    each = clustered.where(F.col("cluster_id").isNotNull()).select(
        "cluster_id", key, *features, F.explode(F.sequence(F.lit(1), F.lit(replicates))).alias("replicate")
    )
    # The generator keeps the digest a column: else each comparison of the weight, and each sum, computes it again.
    drawn = each.withColumn("_u", uniform(F.col(key), F.col("replicate"), F.lit(seed)))
    drawn = drawn.select("cluster_id", "replicate", *features, F.explode(F.array("_u")).alias("_u"))
    weighed = drawn.withColumn("_w", poisson_weight(F.col("_u"))).where("_w > 0")
    sums = weighed.groupBy("cluster_id", "replicate").agg(
        *[(F.sum(F.col(f) * F.col("_w")) / F.sum(F.when(F.col(f).isNotNull(), F.col("_w")))).alias(f) for f in features]
    )
    return sums.unpivot(["cluster_id", "replicate"], list(features), "feature", "mean")


def _interval(value: Column, level: float) -> list[Column]:
    tail = (1 - level) / 2
    return [F.percentile(value, tail).alias("low"), F.percentile(value, 1 - tail).alias("high")]


def mean_intervals(means: DataFrame, clustered: DataFrame, level: float = 0.95) -> DataFrame:
    """(cluster_id, feature, mean, low, high): the mean and the middle ``level`` of its replicates.

    ``means`` are ``replicate_means`` of ``clustered``: one row per cluster, feature and replicate.
    """
    features = [r[0] for r in means.select("feature").distinct().collect()]
    exact = clustered.where(F.col("cluster_id").isNotNull()).groupBy("cluster_id").agg(*[F.avg(f).alias(f) for f in features])
    centers = exact.unpivot("cluster_id", features, "feature", "mean")
    bounds = means.groupBy("cluster_id", "feature").agg(*_interval(F.col("mean"), level))
    return centers.join(bounds, ["cluster_id", "feature"])


def ratio_intervals(means: DataFrame, cluster: int, baseline: int, level: float = 0.95) -> DataFrame:
    """(feature, low, high): the middle ``level`` of the ratio of two clusters' means, replicate by replicate."""
    sides = [
        means.where(F.col("cluster_id") == c).select("feature", "replicate", F.col("mean").alias(name))
        for c, name in ((cluster, "above"), (baseline, "below"))
    ]
    ratio = F.col("above") / F.nullif(F.col("below"), F.lit(0.0))
    return sides[0].join(sides[1], ["feature", "replicate"]).groupBy("feature").agg(*_interval(ratio, level))


def uniform_draw(scaled: DataFrame, columns: Sequence[str], key: str, draw: int, seed: int = 42) -> DataFrame:
    """As many rows as ``scaled`` has usable ones, uniform in the box around them.

    The driver sees the box, two numbers a column.
    """
    usable = scaled.where(all_usable(columns))
    box = usable.agg(*[F.min(c).alias(f"low{i}") for i, c in enumerate(columns)], *[F.max(c).alias(f"high{i}") for i, c in enumerate(columns)]).first()
    slots = [
        (
            F.lit(box[f"low{i}"])
            + uniform(F.col(key), F.lit(i), F.lit(draw), F.lit(seed)) * F.lit((box[f"high{i}"] or 0.0) - (box[f"low{i}"] or 0.0))
        ).alias(c)
        for i, c in enumerate(columns)
    ]
    return usable.select(key, *slots)


def gap_statistic(
    costs: Mapping[int, float], drawn_costs: Sequence[Mapping[int, float]]
) -> list[tuple[int, float, float, bool]]:
    """(K, gap, error, is_chosen) from the costs of the data and of every draw, per K.

    The gap is by how much the log cost lies below that of the draws; chosen is the smallest K whose gap
    reaches the next one less its error, else the K with the largest gap.
    """
    rows = []
    for k in sorted(costs):
        logs = [math.log(drawn[k]) for drawn in drawn_costs]
        mean = sum(logs) / len(logs)
        spread = math.sqrt(sum((x - mean) ** 2 for x in logs) / len(logs))
        rows.append((k, mean - math.log(costs[k]), spread * math.sqrt(1 + 1 / len(logs))))
    reached = [k for (k, gap, _), (_, following, error) in zip(rows, rows[1:]) if gap >= following - error]
    chosen = reached[0] if reached else max(rows, key=lambda r: (r[1], -r[0]))[0] if rows else None
    return [(k, gap, error, k == chosen) for k, gap, error in rows]


def model_costs(scaled: DataFrame, columns: Sequence[str], models: Mapping[int, Sequence[Sequence[float]]]) -> dict[int, float]:
    """The cost of each given model, from one pass over ``scaled``."""
    return {k: cost for k, cost, _ in sweep_scores(scaled, columns, models)}
