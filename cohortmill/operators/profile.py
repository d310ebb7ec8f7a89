"""Cluster-level tables: sizes, shares, statistics, labels, ranks, contrasts, examples.

All take the clustered table (``app_id, game_name, price, rating_percent,
popularity, playtime_hours, cluster_id``) or the statistics derived from it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortmill import fixed_values as fixed
from cohortmill.functions.scalars import rounded_mean

# Profiled column -> name used in the statistics table.
PROFILED = {
    "price": "price",
    "rating_percent": "rating_percent",
    "popularity": "popularity_reviews",
    "playtime_hours": "playtime_hours",
}

STATISTICS_ACCURACY = 1000


def cluster_sizes(clustered: DataFrame) -> DataFrame:
    return clustered.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("game_count")).orderBy("cluster_id")


def cluster_share(sizes: DataFrame) -> DataFrame:
    """Adds each cluster's share in percent.  The window spans one row per cluster."""
    everything = Window.partitionBy(F.lit(0))
    share = F.col("game_count") / F.sum("game_count").over(everything) * 100.0
    return sizes.withColumn("share_percent", F.round(share, 1)).orderBy("cluster_id")


def cluster_statistics(
    clustered: DataFrame,
    profiled: Mapping[str, str] = PROFILED,
    accuracy: int = STATISTICS_ACCURACY,
) -> DataFrame:
    """Count, mean and approximate lower median per cluster.

    One pass; each task sends one bounded sketch per cluster and column, so a
    cluster that holds most entities costs no more than any other.
    """
    measures = []
    for source, name in profiled.items():
        measures.append(rounded_mean(F.avg(source)).alias(f"avg_{name}"))
        measures.append(
            F.round(F.percentile_approx(source, 0.5, accuracy), 2).alias(f"median_{name}")
        )
    return (
        clustered.groupBy("cluster_id")
        .agg(F.count(F.lit(1)).alias("count"), *measures)
        .orderBy("cluster_id")
    )


def cluster_means(statistics: DataFrame, profiled: Mapping[str, str] = PROFILED) -> DataFrame:
    """Long form of the statistics: (cluster_id, feature, mean)."""
    renamed = statistics.select(
        "cluster_id", *[F.col(f"avg_{name}").alias(source) for source, name in profiled.items()]
    )
    return renamed.unpivot("cluster_id", list(profiled), "feature", "mean")


def cluster_ranks(statistics: DataFrame) -> DataFrame:
    """Clusters ranked per feature, highest mean first."""
    order = Window.partitionBy("feature").orderBy(F.desc("mean"))
    return cluster_means(statistics).withColumn("rank", F.rank().over(order))


def cluster_contrast(statistics: DataFrame) -> DataFrame:
    """Each cluster's mean against the lowest cluster mean of the same feature."""
    per_feature = Window.partitionBy("feature")
    ascending = F.struct("mean", "cluster_id")
    lowest = F.min(ascending).over(per_feature)
    ratio = F.col("mean") / F.nullif(F.col("lowest.mean"), F.lit(0.0))
    return (
        cluster_means(statistics)
        .withColumn("lowest", lowest)
        .select(
            "feature",
            "cluster_id",
            "mean",
            F.col("lowest.cluster_id").alias("lowest_cluster"),
            F.round(ratio, 4).alias("ratio_to_lowest"),
        )
    )


def contrast_between(statistics: DataFrame, cluster: int, baseline: int) -> DataFrame:
    """Ratio of the feature means of two given clusters."""

    def mean_of(wanted: int):
        return F.max(F.when(F.col("cluster_id") == wanted, F.col("mean")))

    ratio = mean_of(cluster) / F.nullif(mean_of(baseline), F.lit(0.0))
    return cluster_means(statistics).groupBy("feature").agg(F.round(ratio, 4).alias("ratio"))


def cluster_labels(statistics: DataFrame) -> DataFrame:
    """Names clusters by what they are, as cluster ids are arbitrary.

    Lowest mean rating: poorly received.  Of the others, highest mean popularity:
    blockbuster.  Of the others, lowest mean price: budget.  All others: mid tier.
    The windows span one row per cluster.
    """
    unnamed = statistics.withColumn("label", F.lit(None).cast("string"))
    choices = (
        ("poorly_received", F.asc("avg_rating_percent")),
        ("blockbuster", F.desc("avg_popularity_reviews")),
        ("budget", F.asc("avg_price")),
    )
    for label, order in choices:
        place = F.row_number().over(
            Window.partitionBy(F.col("label").isNull()).orderBy(order, "cluster_id")
        )
        first = F.col("label").isNull() & (F.col("place") == 1)
        unnamed = (
            unnamed.withColumn("place", place)
            .withColumn("label", F.when(first, F.lit(label)).otherwise(F.col("label")))
            .drop("place")
        )
    return unnamed.select(
        "cluster_id", "count", F.coalesce("label", F.lit("mid_tier")).alias("label")
    )


def label_texts(labels: DataFrame, statistics: DataFrame) -> DataFrame:
    """Adds the published name and short name of each label, and a description of its numbers."""
    texts = F.create_map(
        *[
            part
            for label, (name, short) in fixed.LABEL_TEXTS.items()
            for part in (F.lit(label), F.struct(F.lit(name).alias("name"), F.lit(short).alias("short_name")))
        ]
    )
    description = F.concat(
        F.lit("Means: rating "),
        F.col("avg_rating_percent").cast("string"),
        F.lit(" %, price "),
        F.col("avg_price").cast("string"),
        F.lit(", reviews "),
        F.col("avg_popularity_reviews").cast("string"),
        F.lit(", hours "),
        F.col("avg_playtime_hours").cast("string"),
    )
    described = statistics.select("cluster_id", description.alias("description"))
    return (
        labels.withColumn("text", texts[F.col("label")])
        .join(described, "cluster_id", "left")
        .select(*labels.columns, "text.name", "text.short_name", "description")
    )


def cluster_meta(labels: DataFrame, statistics: DataFrame, scored: DataFrame, n: int = 5) -> DataFrame:
    """(cluster_id, name, short_name, description, representative): up to ``n`` names per cluster."""
    listed = representatives(scored, n).groupBy("cluster_id").agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("place", "game_name"))), lambda r: r["game_name"]
        ).alias("representative")
    )
    texts = label_texts(labels, statistics).drop("count", "label")
    return texts.join(listed, "cluster_id", "left")


def with_labels(clustered: DataFrame, labels: Mapping[int, str]) -> DataFrame:
    """Adds ``cluster_label`` from a mapping with one entry per cluster."""
    pairs = [part for item in labels.items() for part in map(F.lit, item)]
    return clustered.withColumn("cluster_label", F.create_map(*pairs)[F.col("cluster_id")])


def representatives(scored: DataFrame, n: int = 5, columns: Sequence[str] = ("app_id", "game_name")) -> DataFrame:
    """The ``n`` entities nearest to each center.

    Spark limits each task to ``n`` rows per cluster before the shuffle, so a
    cluster that holds most entities does not become one large window.
    """
    order = Window.partitionBy("cluster_id").orderBy("d2", "app_id", "game_name")
    return (
        scored.select("cluster_id", *columns, "d2")
        .withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= n)
    )
