"""The star-schema test tables, seen as raw event and metadata tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortmill.operators.cleaning import CleaningRules, EventColumns, MetadataColumns
from cohortmill.operators.features import Feature
from cohortmill.plans.segmentation import Settings
from cohortmill.sources.tables import read_table

# Order lines as events on parts.  The upper bound cuts into the data on purpose.
LINE_SETTINGS = Settings(
    rules=CleaningRules(measure_max=2700.0),
    statistics_accuracy=10000,
    notable_words=("RING", "cold w"),
)

# The event stream as events on users; balances may be negative.
USER_SETTINGS = Settings(
    events=EventColumns("user", "user_name", "bought", "minutes"),
    metadata=MetadataColumns("account", "holder", "balance"),
    features=(
        Feature("price", "log_price", log=True, floor=0.0),
        Feature("rating_percent", "rating_percent"),
        Feature("popularity", "log_popularity", log=True),
        Feature("playtime_hours", "log_playtime", log=True),
    ),
    statistics_accuracy=10000,
)

# Cluster centers in scaled feature space, for the queries that need no fit.
LINE_CENTERS = (
    (0.55, 0.8, -0.3, 0.2),
    (0.55, -0.9, -0.2, -0.5),
    (-1.9, 0.1, 0.0, 0.0),
    (0.5, 0.0, 1.4, 0.6),
)
USER_CENTERS = (
    (0.4, 0.5, -0.4, 0.3),
    (0.4, -0.8, 0.2, -0.4),
    (-2.0, 0.0, 0.5, 0.0),
)


def line_events(
    spark: SparkSession, folder: str, half: int | None = None, time: str | None = None
) -> DataFrame:
    """All-text events with bad keys, missing flags, missing names and bad measures.

    ``half`` 0 or 1 gives those of the even or the odd orders, as the events of one of two runs.
    ``time`` names a further column for when an event happened.
    """
    lines = read_table(spark, folder, "lineitem")
    if half is not None:
        lines = lines.where(F.pmod("l_orderkey", F.lit(2)) == half)
    line = F.col("l_linenumber")
    key = F.col("l_partkey").cast("string")
    return lines.select(
        F.when(line == 7, F.concat(key, F.lit("x"))).otherwise(key).alias("app_id"),
        F.when(
            line != 1,
            F.concat(
                F.lit("item "), key, F.when(F.col("l_linestatus") == "F", " (old)").otherwise("")
            ),
        ).alias("app_name"),
        F.when(line == 6, F.lit(None).cast("string"))
        .when(F.col("l_returnflag") == "R", "False")
        .when(F.col("l_returnflag") == "A", "TRUE")
        .otherwise("True")
        .alias("recommended"),
        F.when((line == 5) & (F.col("l_quantity") == 13), "n/a")
        .otherwise((F.col("l_quantity") * 60).cast("string"))
        .alias("author.playtime_forever"),
        *([] if time is None else [F.col("l_shipdate").alias(time)]),
    )


def part_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """All-text metadata of every part, many of them with bad keys, blank prices or missing names."""
    size = F.col("p_size")
    key = F.col("p_partkey").cast("string")
    return read_table(spark, folder, "part").select(
        F.when((size == 3) | (size >= 40), F.concat(key, F.lit("x"))).otherwise(key).alias("appid"),
        F.when(size != 4, F.col("p_name")).alias("name"),
        F.when(size == 1, "")
        .when(size == 2, "free")
        .otherwise(F.col("p_retailprice").cast("string"))
        .alias("price"),
    )


def repeated_part_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """``part_metadata`` where some keys come back with another price and some unchanged."""
    part = read_table(spark, folder, "part")
    size = F.col("p_size")
    key = F.col("p_partkey").cast("string")
    again = part.where(size.between(10, 19)).select(
        key.alias("appid"),
        F.col("p_name").alias("name"),
        (F.col("p_retailprice") + 5).cast("string").alias("price"),
    )
    same = part.where(size.between(20, 24)).select(
        key.alias("appid"),
        F.col("p_name").alias("name"),
        F.col("p_retailprice").cast("string").alias("price"),
    )
    return part_metadata(spark, folder).unionByName(again).unionByName(same)


def user_events(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("user_id").cast("string")
    return read_table(spark, folder, "events").select(
        key.alias("user"),
        F.concat(F.lit("user "), key).alias("user_name"),
        (F.col("event_type") == "purchase").cast("string").alias("bought"),
        F.col("value").cast("string").alias("minutes"),
    )


def customer_metadata(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("account"),
        F.col("c_name").alias("holder"),
        F.col("c_acctbal").cast("string").alias("balance"),
    )


def vector_columns(width: int) -> list[str]:
    return [f"x{i}" for i in range(width)]


def embedding_features(spark: SparkSession, folder: str) -> tuple[DataFrame, list[str]]:
    """Embeddings as one double column per slot, and the columns.

    The first vector gives the width; a vector of another width fails the query.
    """
    table = read_table(spark, folder, "embeddings")
    vector = F.col("embedding")
    first = table.select(F.size(vector)).first()
    width = first[0] if first else 0
    even = F.when(F.size(vector) == width, vector).otherwise(
        F.raise_error(F.concat(F.lit(f"vectors of {width} and "), F.size(vector), F.lit(" slots")))
    )
    names = vector_columns(width)
    slots = [F.get(F.col("v"), F.lit(i)).cast("double").alias(name) for i, name in enumerate(names)]
    return table.select("vec_id", even.alias("v")).select("vec_id", *slots), names


def vector_centers(width: int, k: int = 3) -> list[list[float]]:
    """Centers by rule: slot i of center j is -0.5, 0 or 0.5."""
    return [[0.5 * ((i + j) % 3 - 1) for i in range(width)] for j in range(k)]
