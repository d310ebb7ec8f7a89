"""CSV and Parquet readers and the schemas of the published result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CLUSTERED_SCHEMA = T.StructType(
    [
        T.StructField("app_id", T.IntegerType()),
        T.StructField("game_name", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("rating_percent", T.DoubleType()),
        T.StructField("popularity", T.LongType()),
        T.StructField("playtime_hours", T.DoubleType()),
        T.StructField("cluster_id", T.IntegerType()),
    ]
)

SWEEP_SCHEMA = T.StructType(
    [
        T.StructField("K", T.IntegerType()),
        T.StructField("WSSSE_Cost", T.DoubleType()),
        T.StructField("Silhouette_Score", T.DoubleType()),
    ]
)

GAP_SCHEMA = T.StructType(
    [
        T.StructField("K", T.IntegerType()),
        T.StructField("gap", T.DoubleType()),
        T.StructField("error", T.DoubleType()),
        T.StructField("is_chosen", T.BooleanType()),
    ]
)

SIZES_SCHEMA = T.StructType(
    [
        T.StructField("cluster_id", T.IntegerType()),
        T.StructField("game_count", T.LongType()),
    ]
)

STATISTICS_SCHEMA = T.StructType(
    [
        T.StructField("cluster_id", T.IntegerType()),
        T.StructField("count", T.LongType()),
        T.StructField("avg_price", T.DoubleType()),
        T.StructField("median_price", T.DoubleType()),
        T.StructField("avg_rating_percent", T.DoubleType()),
        T.StructField("median_rating_percent", T.DoubleType()),
        T.StructField("avg_popularity_reviews", T.DoubleType()),
        T.StructField("median_popularity_reviews", T.LongType()),
        T.StructField("avg_playtime_hours", T.DoubleType()),
        T.StructField("median_playtime_hours", T.DoubleType()),
    ]
)


def read_csv_by_header(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """CSV with a header, every column a string, doubled quotes inside quoted fields.

    Blank fields, quoted or not, are NULL.

    ``multiline=False`` splits large files over tasks but ends a record at every
    line break; ``multiline=True`` keeps quoted line breaks and reads one task per
    file.  For large text, write many files or land the table as Parquet once.
    """
    return (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("escape", '"')
        .option("multiLine", multiline)
        .csv(path)
    )


def read_result_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A result table written by ``operators.sinks.write_csv``, with its known schema."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("multiLine", True)
        .csv(path)
    )


def land_as_parquet(raw: DataFrame, path: str) -> DataFrame:
    """Turn a CSV scan into a Parquet table once; later scans prune columns and skip row groups."""
    raw.write.mode("overwrite").parquet(path)
    return raw.sparkSession.read.schema(raw.schema).parquet(path)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
