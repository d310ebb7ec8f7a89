"""Clusters of two runs: how far they agree, and ids that stay with their cluster over a refit.

Cluster ids of a fit are arbitrary.  What two runs share is the table of how many entities went from each
cluster of the one to each of the other, K x K numbers; all that follows comes from it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def contingency(before: DataFrame, after: DataFrame, keys: Sequence[str] = ("app_id",)) -> DataFrame:
    """(before_id, after_id, n) over the entities that both runs put into a cluster.

    One join on the keys, whose rows are counted on the map side.
    """
    sides = [
        df.where(F.col("cluster_id").isNotNull()).select(*keys, F.col("cluster_id").alias(name))
        for df, name in ((before, "before_id"), (after, "after_id"))
    ]
    return sides[0].join(sides[1], list(keys)).groupBy("before_id", "after_id").agg(F.count(F.lit(1)).alias("n"))


def adjusted_rand_index(table: DataFrame) -> DataFrame:
    """One row: entities, share of them in the best matched cells by row, and the adjusted Rand index.

    ``table`` is a contingency.  The index is 1 for equal partitions and 0 on average for random ones; it is NULL
    where both runs have a single cluster, or nothing in common.
    """

    def pairs(n):
        return n * (n - 1) / 2.0

    rows = table.groupBy("before_id").agg(F.sum("n").alias("n"), F.max("n").alias("top"))
    columns = table.groupBy("after_id").agg(F.sum("n").alias("n"))
    parts = (
        table.agg(F.coalesce(F.sum(pairs(F.col("n"))), F.lit(0.0)).alias("cells"), F.coalesce(F.sum("n"), F.lit(0)).alias("entities"))
        .join(rows.agg(F.sum(pairs(F.col("n"))).alias("rows"), F.sum("top").alias("top")))
        .join(columns.agg(F.sum(pairs(F.col("n"))).alias("columns")))
    )  # one row each
    everything = pairs(F.col("entities"))
    expected = F.col("rows") * F.col("columns") / F.nullif(everything, F.lit(0.0))
    spread = (F.col("rows") + F.col("columns")) / 2.0 - expected
    return parts.select(
        "entities",
        (F.col("top") / F.nullif(F.col("entities"), F.lit(0))).alias("purity"),
        ((F.col("cells") - expected) / F.nullif(spread, F.lit(0.0))).alias("adjusted_rand_index"),
    )


def assignment(gain: Sequence[Sequence[int]]) -> list[int]:
    """For each row of a square table its column, so that the sum of the chosen gains is largest.

    Shortest augmenting paths with potentials, n rows in n^3 steps.
    """
    n = len(gain)
    row_of, column_price, row_price = [-1] * n, [0] * n, [0] * n
    for new in range(n):
        reach = [float("inf")] * n
        came = [-1] * n
        done = [False] * n
        row, column = new, -1
        while True:
            best, step = -1, float("inf")
            for j in range(n):
                if not done[j]:
                    cost = -gain[row][j] - row_price[row] - column_price[j]
                    if cost < reach[j]:
                        reach[j], came[j] = cost, column
                    if reach[j] < step:
                        best, step = j, reach[j]
            row_price[new] += step
            for j in range(n):
                if done[j]:
                    row_price[row_of[j]] += step
                    column_price[j] -= step
                else:
                    reach[j] -= step
            done[best] = True
            column = best
            if row_of[column] < 0:
                break
            row = row_of[column]
        while column >= 0:
            previous = came[column]
            row_of[column] = row_of[previous] if previous >= 0 else new
            column = previous
    found = [-1] * n
    for column, row in enumerate(row_of):
        found[row] = column
    return found


def matched_ids(table: DataFrame) -> dict[int, int]:
    """The new id of each cluster of the later run: that of the earlier cluster it is matched with.

    The matching keeps as many entities as any can in the cluster of their id; of several such, one that
    leaves more ids as they are.  Clusters without a partner, as when K grew, get the next free ids.
    The driver sees the contingency, K x K numbers.
    """
    counts = {(r["before_id"], r["after_id"]): r["n"] for r in table.collect()}
    before, after = (sorted({pair[i] for pair in counts}) for i in (0, 1))
    n = max(len(before), len(after))
    wide = n + 1

    def gain(i: int, j: int) -> int:
        if i >= len(after) or j >= len(before):
            return 0
        return counts.get((before[j], after[i]), 0) * wide + (before[j] == after[i])

    chosen = assignment([[gain(i, j) for j in range(n)] for i in range(n)])
    ids, free = {}, max(before, default=-1) + 1
    for i, cluster in enumerate(after):
        if chosen[i] < len(before) and counts.get((before[chosen[i]], cluster), 0):
            ids[cluster] = before[chosen[i]]
        else:
            ids[cluster], free = free, free + 1
    return ids


def with_ids(after: DataFrame, ids: Mapping[int, int]) -> DataFrame:
    """``after`` with its cluster ids replaced; ids that are not listed, and NULL, stay."""
    if not ids:
        return after
    pairs = [F.lit(x) for item in ids.items() for x in item]
    renamed = F.create_map(*pairs)[F.col("cluster_id")]
    return after.withColumn("cluster_id", F.coalesce(renamed, F.col("cluster_id")).cast("int"))


def keep_ids(before: DataFrame, after: DataFrame, keys: Sequence[str] = ("app_id",)) -> DataFrame:
    """The later run under the ids of the earlier one."""
    return with_ids(after, matched_ids(contingency(before, after, keys)))
