"""Left join of entities to their metadata."""

from __future__ import annotations

from typing import Literal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortmill import fixed_values as fixed

# A repeated metadata key is spread over this many join keys, unless a call gives another number.
FANOUT_SALTS = 64
# The column that says how many equal rows one row stands for.
COPIES = "copies"
# Identical metadata rows that one task unfolds at a time.
COPIES_PER_CHUNK = 1_000


def one_row_per_key(metadata: DataFrame) -> DataFrame:
    """One metadata row per key: the smallest (name, price), NULLs last.

    An aggregate rather than a window, so a repeated key is reduced on the map
    side and the result is already partitioned by key for the join.
    """
    rank = F.struct(
        F.col("meta_game_name").isNull().alias("no_name"),
        F.col("meta_game_name"),
        F.col("meta_price").isNull().alias("no_price"),
        F.col("meta_price"),
    )
    return (
        metadata.groupBy("meta_appid")
        .agg(F.min(rank).alias("row"))
        .select("meta_appid", "row.meta_game_name", "row.meta_price")
    )


def attach_metadata(
    entities: DataFrame,
    metadata: DataFrame,
    duplicates: Literal["first", "keep", "weight"] = "first",
    salts: int = FANOUT_SALTS,
) -> DataFrame:
    """Left outer join on the key, then the name and price fallbacks.

    ``first`` keeps one row per entity.  ``keep`` returns one row per matching
    metadata row, as a plain left join does.  ``weight`` returns one row per entity and distinct
    metadata row, with the number of rows it stands for in ``copies``: a weight for scaler, fit and
    measures, which ``unfold`` turns into rows again.  None forces a broadcast: Spark
    broadcasts the metadata only where its measured size is under
    ``spark.sql.autoBroadcastJoinThreshold``, and otherwise joins the two sides
    on the partitioning both aggregates already have.
    """
    if duplicates == "first":
        joined = entities.join(
            one_row_per_key(metadata), F.col("app_id") == F.col("meta_appid"), "left"
        )
    elif duplicates == "weight":
        joined = _with_variants(entities, metadata, salts)
    else:
        joined = unfold(_with_variants(entities, metadata, salts))
    return joined.withColumns(
        {
            "game_name": F.coalesce(
                F.col("meta_game_name"), F.col("review_app_name"), F.lit(fixed.UNKNOWN_NAME)
            ),
            "price": F.coalesce(F.col("meta_price"), F.lit(fixed.MISSING_PRICE)),
        }
    ).drop("meta_appid", "meta_game_name", "meta_price")


def _with_variants(entities: DataFrame, metadata: DataFrame, n_salts: int) -> DataFrame:
    """Left join with every distinct metadata row of a key, a hot key spread over salts.

    Identical metadata rows are counted first.  The variants of a key fall into salts
    by their content; an entity is repeated only for the salts its key really has, so an
    ordinary entity stays one row and an unmatched one meets no salt and keeps its NULLs.
    """
    variants = (
        metadata.groupBy("meta_appid", "meta_game_name", "meta_price")
        .agg(F.count(F.lit(1)).alias("_found"))
        .withColumn("salt", F.pmod(F.xxhash64("meta_game_name", "meta_price"), F.lit(n_salts)))
    )
    # At most n_salts numbers per key.
    salts = variants.groupBy(F.col("meta_appid").alias("salted_key")).agg(
        F.collect_set("salt").alias("salts")
    )
    spread = (
        entities.join(salts, F.col("app_id") == F.col("salted_key"), "left")
        .withColumn("entity_salt", F.explode_outer("salts"))
        .drop("salted_key", "salts")
    )
    joined = spread.join(
        variants,
        (F.col("app_id") == F.col("meta_appid")) & (F.col("entity_salt") == F.col("salt")),
        "left",
    )
    copies = F.coalesce(F.col("_found"), F.lit(1)).cast("bigint")
    return joined.withColumn(COPIES, copies).drop("_found", "salt", "entity_salt")


def unfold(table: DataFrame, copies: str = COPIES) -> DataFrame:
    """Each row as many times as ``copies`` says, without that column; 0 and NULL leave none.

    Many copies leave in chunks that are dealt out by their number before they are unfolded.
    """
    n = F.col(copies)
    chunks = F.sequence(F.lit(0).cast("bigint"), F.floor((n - 1) / COPIES_PER_CHUNK))
    chunked = table.where(n > 0).withColumn("_chunk", F.explode(chunks))
    single = chunked.where(n <= COPIES_PER_CHUNK)
    repeated = chunked.where(n > COPIES_PER_CHUNK)
    # The chunks are few bytes, so adaptive execution would merge them: the number is given.
    width = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = [F.xxhash64(*[F.col(f"`{c}`") for c in table.columns if c != copies]), F.col("_chunk")]
    dealt = single.unionByName(repeated.repartition(width, *rows))
    left = F.least(F.lit(COPIES_PER_CHUNK), n - F.col("_chunk") * COPIES_PER_CHUNK)
    copy = F.explode(F.sequence(F.lit(1).cast("bigint"), left))
    return dealt.withColumn("_copy", copy).drop("_copy", "_chunk", copies)
