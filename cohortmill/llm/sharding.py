"""Contiguous shards of near equal bytes from global prefix sums.

Rows are ordered over the whole table by range partitions.  Each partition's bytes are
summed inside it, the few partition totals give every partition its start, and a row's
shard follows from where its bytes begin.  Order: doc_id, where texts that are equal stand
together at the place of the smallest id among them.  Such a group stays in one shard while
it is small beside a shard; a larger group is cut between rows.

The driver sees the total alone; the table of partition totals has one row per partition.

Defined results: a null text counts as no bytes; null ids come first.  Repeated rows are
rows.  An empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortmill.llm.lineage import cut
from cohortmill.storage import materialize

SHARDS = 16
#: A group of equal texts is kept whole up to this share of a shard.
GROUP_SHARE = 0.01


def _prefixed(rows: DataFrame, value: str, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``name``: the sum of ``value`` over all rows before, in global ``order``.

    The part of a row and its place in it are fixed by the cut, so a lost executor
    cannot change them.
    """
    parted = cut(
        rows.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(*order, "_tie")
        .withColumn("_part", F.spark_partition_id())
    )
    totals = parted.groupBy("_part").agg(F.sum(value).alias("_total"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("_part", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("_part").orderBy(*order, "_tie").rowsBetween(Window.unboundedPreceding, -1)
    return (
        parted.withColumn("_within", F.coalesce(F.sum(value).over(within), F.lit(0)))
        .join(starts, "_part")
        .withColumn(name, F.col("_start") + F.col("_within"))
        .drop("_part", "_tie", "_start", "_within")
    )


def byte_shards(
    docs: DataFrame, shards: int = SHARDS, group_share: float = GROUP_SHARE, carry: Sequence[str] = ()
) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (from 0 in each shard) of every row, and its columns in ``carry``."""
    carried = [f"_carried_{i}" for i in range(len(carry))]
    rows = docs.select(
        *[F.col(c).alias(to) for c, to in zip(carry, carried)],
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64("text").alias("_text"),
        F.md5(F.col("text").cast("binary")).alias("_digest"),
    )
    rows = cut(rows)
    # A text's group: equal digests.  Its leader is the smallest id; its bytes decide whether it stays whole.
    groups = rows.groupBy("_text", "_digest").agg(
        F.min("doc_id").alias("_leader"), F.sum("size").alias("_group_bytes"), F.count("*").alias("_members")
    )
    total = rows.agg(F.sum("size")).first()[0] or 1
    rows = rows.join(
        groups.where("_members > 1").withColumnRenamed("_text", "_t").withColumnRenamed("_digest", "_d"),
        F.col("_text").eqNullSafe(F.col("_t")) & F.col("_digest").eqNullSafe(F.col("_d")),
        "left",
    ).select(
        *carried, "doc_id", "size", "text_crc32",
        F.coalesce("_leader", "doc_id").alias("_first"), "_text", F.coalesce("_group_bytes", F.lit(0)).alias("_group"),
    )
    placed = _prefixed(rows, "size", ["_first", "_text", "doc_id"], "_begin")
    placed = cut(placed.withColumn("_whole", (F.col("_group") > 0) & (F.col("_group") <= total * group_share / shards)))
    # A small group begins where its first row does.  Its first id is null if all its rows lack one.
    begins = placed.where("_whole").groupBy(F.col("_first").alias("_f"), F.col("_text").alias("_t")).agg(F.min("_begin").alias("_begin"))
    small = (
        placed.where("_whole").drop("_begin")
        .join(begins, F.col("_first").eqNullSafe(F.col("_f")) & (F.col("_text") == F.col("_t")))
        .drop("_f", "_t")
    )
    placed = placed.where("NOT _whole").unionByName(small)
    placed = placed.withColumn(
        "shard", F.least(F.floor(F.col("_begin") * shards / total), F.lit(shards - 1)).cast("int")
    )
    # The same prefix sums, of ones, number the rows of a shard.
    numbered = _prefixed(
        placed.select(*carried, "doc_id", "size", "text_crc32", "shard", "_first", "_text", F.lit(1).alias("_one")),
        "_one", ["shard", "_first", "_text", "doc_id"], "_row",
    )
    numbered = cut(numbered)
    first = numbered.groupBy("shard").agg(F.min("_row").alias("_first_row"))
    return numbered.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("_row") - F.col("_first_row")).cast("bigint").alias("slot"),
        *[F.col(held).alias(c) for c, held in zip(carry, carried)],
    )


def _free(name: str, taken: Sequence[str]) -> str:
    """``name``, with as many underscores as no column of that name needs."""
    while name.lower() in {c.lower() for c in taken}:
        name += "_"
    return name


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Every row of ``docs`` once, all columns as they were, as one folder of Parquet files per shard, in slot order.

    The folders are ``shard=N`` and a row's place in its shard is the column ``slot``; where ``docs`` has
    columns of those names, an underscore is added to the new ones.  Rows are told apart by a number given to
    the stored rows, so repeated rows and rows without a doc_id stay what they are.  An empty table gives no files.
    """
    number, shard, slot = (_free(name, docs.columns) for name in ("_number", "shard", "slot"))
    stored = materialize(docs.withColumn(number, F.monotonically_increasing_id()), "to-shard")
    placed = byte_shards(stored, shards, carry=[number]).select(
        F.col(number).alias("_placed"), F.col("shard").alias("_shard_of"), F.col("slot").alias("_slot_of")
    )
    joined = stored.join(placed, stored[number] == placed["_placed"]).select(
        *[stored[c] for c in docs.columns], placed["_shard_of"].alias(shard), placed["_slot_of"].alias(slot)
    )
    dealt = joined.repartition(shard, F.floor(F.col(slot) / 100_000)).sortWithinPartitions(shard, slot)
    dealt.write.partitionBy(shard).parquet(path)
