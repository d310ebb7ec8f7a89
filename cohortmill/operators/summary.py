"""The one-row model summary, the text report and the dashboard tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortmill import fixed_values as fixed
from cohortmill.operators.features import DEFAULT_FEATURES, Feature


def metrics_summary(
    totals: DataFrame,
    sizes: DataFrame,
    k: int,
    wssse: Column,
    silhouette: Column,
    features: Sequence[Feature] = DEFAULT_FEATURES,
) -> DataFrame:
    """(raw_rows, entities, optimal_k, wssse_cost, silhouette_score, features), one row.

    ``totals`` has the single row ``raw_rows``; the entity count is the sum of the
    cluster sizes.
    """
    entities = sizes.agg(F.sum("game_count"))
    return totals.select(
        "raw_rows",
        entities.scalar().alias("entities"),
        F.lit(k).alias("optimal_k"),
        F.round(wssse, 2).alias("wssse_cost"),
        F.round(silhouette, 4).alias("silhouette_score"),
        F.array(*[F.lit(fixed.FEATURE_TITLES.get(f.source, f.source)) for f in features]).alias("features"),
    )


def scaling_text(features: Sequence[Feature] = DEFAULT_FEATURES) -> str:
    """How the features are scaled, from their definitions."""
    logged = ", ".join(f.source for f in features if f.log)
    return (f"log1p of {logged}; " if logged else "") + "mean 0, deviation 1"


def model_summary(summary: DataFrame) -> DataFrame:
    """``metrics_summary`` under the published key names, the raw count with thousands marks."""
    return summary.select(
        F.format_number("raw_rows", 0).alias("raw_reviews"),
        F.col("entities").alias("clustered_games"),
        "optimal_k",
        "wssse_cost",
        "silhouette_score",
        "features",
    )


# Lines of the report are ordered by section, then by the number in the section.
SECTION = 10_000_000_000


def report_lines(
    summary: DataFrame,
    sizes: DataFrame,
    statistics: DataFrame,
    title: str = "Clustering summary",
    features: Sequence[Feature] = DEFAULT_FEATURES,
) -> DataFrame:
    """(line_no, line): the text report.  All inputs have one row per model or cluster."""

    def numbered(df: DataFrame, line: Column, base: int, order: Column | None = None) -> DataFrame:
        number = F.lit(base) if order is None else F.lit(base) + order
        return df.select(number.cast("bigint").alias("line_no"), line.alias("line"))

    rule = "=" * 70
    facts = [
        F.lit(title),
        F.lit(rule),
        F.concat(F.lit("Raw events read: "), F.format_number("raw_rows", 0)),
        F.concat(F.lit("Entities in the feature table: "), F.format_number("entities", 0)),
        F.lit("Algorithm: K-Means (Spark MLlib)"),
        F.format_string("Selected K: %d", F.col("optimal_k")),
        F.concat(F.lit("Features: "), F.array_join("features", ", ")),
        F.lit(f"Scaling: {scaling_text(features)}"),
        F.concat(F.lit("WSSSE cost: "), F.format_number("wssse_cost", 2)),
        F.concat(F.lit("Silhouette: "), F.format_number("silhouette_score", 4)),
        F.lit(rule),
        F.lit("Cluster sizes (cluster_id, game_count)"),
    ]
    lines = summary.select(F.posexplode(F.array(*facts)).alias("line_no", "line"))
    lines = lines.withColumn("line_no", F.col("line_no").cast("bigint"))
    lines = lines.unionByName(
        numbered(
            sizes,
            F.format_string("%10d %12d", F.col("cluster_id"), F.col("game_count")),
            SECTION,
            F.col("cluster_id"),
        )
    )
    heading = F.lit(" ".join(statistics.columns))
    lines = lines.unionByName(numbered(summary, heading, 2 * SECTION))
    cells = F.concat_ws(" ", *[F.col(c).cast("string") for c in statistics.columns])
    return lines.unionByName(numbered(statistics, cells, 2 * SECTION + 1, F.col("cluster_id")))


def dashboard_sections(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(section, payload): every row of every table as one JSON object, written in parallel."""
    sections = None
    for name, table in tables.items():
        rows = table.select(
            F.lit(name).alias("section"), F.to_json(F.struct(*table.columns)).alias("payload")
        )
        sections = rows if sections is None else sections.unionByName(rows)
    return sections
