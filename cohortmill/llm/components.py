"""Connected components by alternating large-star and small-star steps on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortmill.llm.lineage import cut


def _stars(links: DataFrame) -> DataFrame:
    """One large-star and one small-star step over (high, low) links, high > low."""
    both = links.select(F.col("high").alias("u"), F.col("low").alias("v")).union(
        links.select(F.col("low").alias("u"), F.col("high").alias("v"))
    )
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    lowest = large.groupBy("u").agg(F.min("v").alias("m"))
    rewired = large.join(lowest, "u").where("v <> m").select(F.col("v").alias("high"), F.col("m").alias("low"))
    return rewired.union(lowest.select(F.col("u").alias("high"), F.col("m").alias("low"))).distinct()


def _state(links: DataFrame) -> tuple:
    row = links.agg(
        F.count("*"), F.sum(F.hash("high", "low").cast("bigint")), F.bit_xor(F.xxhash64("high", "low"))
    ).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (two id columns), the component its smallest id.

    A hot node is met by aggregates that combine before the shuffle and by joins that
    adaptive execution can split.  The number of links and a checksum are all that the
    driver sees.  Links with a null end, and of a node to itself, say nothing.
    """
    a, b = links.columns
    links = cut(
        links.select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .distinct()
    )
    state = _state(links)
    while state[0]:
        links = cut(_stars(links))
        if (after := _state(links)) == state:
            break
        state = after
    return links.select(F.col("high").alias("node"), F.col("low").alias("component")).union(
        links.select(F.col("low"), F.col("low")).distinct()
    )
