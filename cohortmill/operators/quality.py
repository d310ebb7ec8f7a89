"""Checks of the result tables, as a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortmill import fixed_values as fixed


def quality_checks(clustered: DataFrame, clusters: int, min_popularity: int = fixed.MIN_POPULARITY) -> DataFrame:
    """(check_name, expected, actual, ok) over the clustered table.

    One shuffle on the key finds repeated keys; the other checks are summed up
    inside the same aggregate.
    """

    def violations(condition: Column) -> Column:
        return F.count_if(F.coalesce(condition, F.lit(True)))

    features = ("price", "rating_percent", "popularity", "playtime_hours")
    has_null = F.lit(False)
    for name in features:
        has_null = has_null | F.col(name).isNull()
    broken = {
        "null_keys": F.col("app_id").isNull(),
        "null_names": F.col("game_name").isNull(),
        "null_features": has_null,
        "rating_out_of_range": ~F.col("rating_percent").between(fixed.MIN_RATING, fixed.MAX_RATING),
        "popularity_below_minimum": F.col("popularity") < min_popularity,
        "negative_playtime": F.col("playtime_hours") < 0,
        "negative_price": F.col("price") < 0,
        "cluster_id_out_of_range": ~F.col("cluster_id").between(0, clusters - 1),
    }
    per_key = clustered.groupBy("app_id").agg(
        F.count(F.lit(1)).alias("n"),
        *[violations(condition).alias(name) for name, condition in broken.items()],
    )
    totals = per_key.agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("repeated_keys"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in broken],
    )
    return totals.unpivot([], totals.columns, "check_name", "actual").select(
        "check_name",
        F.lit(0).cast("long").alias("expected"),
        "actual",
        (F.col("actual") == 0).alias("ok"),
    )


def cross_checks(clustered: DataFrame, sizes: DataFrame, sweep: DataFrame, chosen_k: int) -> DataFrame:
    """Checks between tables: sizes add up to the rows, and the chosen K has the top silhouette."""
    rows = clustered.agg(F.count(F.lit(1)).alias("expected"))
    summed = sizes.agg(F.sum("game_count").alias("actual"))
    best = sweep.orderBy(F.desc_nulls_last("Silhouette_Score"), "K").limit(1)
    sizes_check = summed.select(
        F.lit("sizes_add_up").alias("check_name"), rows.scalar().alias("expected"), "actual"
    )
    best_check = best.select(
        F.lit("best_k_is_top_silhouette").alias("check_name"),
        F.col("K").cast("long").alias("expected"),
        F.lit(chosen_k).cast("long").alias("actual"),
    )
    return sizes_check.unionByName(best_check).withColumn("ok", F.col("expected") == F.col("actual"))


def usable_check(unusable: DataFrame) -> DataFrame:
    """The number of rows without usable features as a check; ``unusable`` has it as its only value."""
    return unusable.select(
        F.lit("unusable_feature_rows").alias("check_name"),
        F.lit(0).cast("long").alias("expected"),
        F.col(unusable.columns[0]).alias("actual"),
    ).withColumn("ok", F.col("expected") == F.col("actual"))


def column_types(df: DataFrame) -> DataFrame:
    """(ordinal, column_name, data_type): the schema as rows; reads no data."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema)]
    return df.sparkSession.createDataFrame(rows, "ordinal int, column_name string, data_type string")


def column_profile(df: DataFrame) -> DataFrame:
    """(column_name, data_type, row_count, null_count): the schema with what the rows hold, in one scan."""
    quoted = ["`" + f.name.replace("`", "``") + "`" for f in df.schema]
    filled = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(F.col(q)).alias(f"c{i}") for i, q in enumerate(quoted)],
    )
    return filled.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(i).alias("ordinal"),
                        F.lit(f.name).alias("column_name"),
                        F.lit(f.dataType.simpleString()).alias("data_type"),
                        F.col("rows").alias("row_count"),
                        (F.col("rows") - F.col(f"c{i}")).alias("null_count"),
                    )
                    for i, f in enumerate(df.schema)
                ]
            )
        )
    )
