"""Distances between two tables from their sketches: no sort, no row of either table is kept.

Sketches are built once per table, in one pass, and merge from run to run, so a table can be compared with one
whose rows are gone.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortmill.functions.sketches import rank_error
from cohortmill.storage import materialize

SKETCH_SIZE, BINS, LEAST_SHARE = 4096, 10, 1e-4


def column_sketches(table: DataFrame, columns: Sequence[str], size: int = SKETCH_SIZE) -> DataFrame:
    """(feature, n, sketch) of numeric columns; NULL and NaN are left out."""
    values = {c: F.col(c).cast("double") for c in columns}
    made = table.agg(
        *[F.kll_sketch_agg_double(F.when(~F.isnan(v), v), size).alias(c) for c, v in values.items()]
    )
    sketches = made.unpivot([], list(columns), "feature", "sketch")
    return sketches.select("feature", F.kll_sketch_get_n_double("sketch").alias("n"), "sketch")


def merged_sketches(parts: DataFrame, size: int = SKETCH_SIZE) -> DataFrame:
    """``column_sketches`` of several tables as those of one."""
    made = parts.groupBy("feature").agg(F.kll_merge_agg_double("sketch", size).alias("sketch"))
    return made.select("feature", F.kll_sketch_get_n_double("sketch").alias("n"), "sketch")


def sketch_values(sketches: DataFrame, size: int = SKETCH_SIZE) -> DataFrame:
    """(feature, x, weight): each sketch as points whose weights add up to one.

    All values of a table with at most ``size`` of them, else ``size`` quantiles.  The ranks are asked for as
    constants, so the driver sees the number of values per feature.
    """
    stored = materialize(sketches, "sketches")
    parts = []
    for row in stored.select("feature", "n").collect():  # one row per feature
        m = min(row["n"], size)
        if m:
            # Midway between two ranks, where rounding cannot reach the next value.
            ranks = F.lit([(i - 0.5) / m for i in range(1, m + 1)])
            own = stored.where(F.col("feature") == row["feature"])
            points = F.explode(F.kll_sketch_get_quantile_double("sketch", ranks))
            parts.append(own.select("feature", points.alias("x"), F.lit(1.0 / m).alias("weight")))
    if not parts:
        return stored.select("feature", F.lit(0.0).alias("x"), F.lit(0.0).alias("weight")).limit(0)
    return reduce(DataFrame.unionByName, parts)


def drift(before: DataFrame, after: DataFrame, size: int = SKETCH_SIZE, bins: int = BINS) -> DataFrame:
    """(feature, n_before, n_after, ks, ks_error, psi) of two tables of sketches.

    ``ks`` is the largest distance of the two distribution functions, ``psi`` the population stability index over
    the bins that the quantiles of ``before`` make, with shares of at least ``LEAST_SHARE``.  Both are exact while
    neither table has more values than ``size``; ``ks_error`` bounds what ``ks`` is off beyond that, in 98 of
    100 cases.  NULL where a table has no value.  Windows span the points of one feature, twice ``size`` at most.
    """
    counts = before.select("feature", F.col("n").alias("n_before")).join(
        after.select("feature", F.col("n").alias("n_after")), "feature"
    )
    shared = counts.where("n_before > 0 AND n_after > 0").select("feature")
    sides = [
        sketch_values(sketches, size).select("feature", "x", *[(F.col("weight") * own).alias(n) for n, own in weights])
        for sketches, weights in ((before, (("a", 1), ("b", 0))), (after, (("a", 0), ("b", 1))))
    ]
    steps = sides[0].unionByName(sides[1]).join(shared, "feature", "left_semi")
    steps = steps.groupBy("feature", "x").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    rising = Window.partitionBy("feature").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    # Sums of equal weights: nine digits settle what their order leaves open.
    curves = materialize(
        steps.select("feature", "x", *[F.round(F.sum(c).over(rising), 9).alias(c) for c in ("a", "b")]), "curves"
    )
    ks = curves.groupBy("feature").agg(F.max(F.abs(F.col("a") - F.col("b"))).alias("ks"))

    # A bin ends at the first point where ``before`` reaches its share; the last one takes the rest.
    at = curves.select("*", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin")).where(F.col("a") >= F.round(F.col("bin") / bins, 9))
    ends = at.groupBy("feature", "bin").agg(F.min("a").alias("a"), F.min("b").alias("b"))
    ends = ends.select("feature", "bin", *[F.when(F.col("bin") == bins, 1.0).otherwise(F.col(c)).alias(c) for c in ("a", "b")])
    previous = Window.partitionBy("feature").orderBy("bin")
    share = [F.greatest(F.col(c) - F.coalesce(F.lag(c).over(previous), F.lit(0.0)), F.lit(LEAST_SHARE)) for c in ("a", "b")]
    shares = ends.select("feature", share[0].alias("a"), share[1].alias("b"))
    psi = shares.groupBy("feature").agg(F.sum((F.col("a") - F.col("b")) * F.log(F.col("a") / F.col("b"))).alias("psi"))

    error = [F.when(F.col(n) > size, F.lit(rank_error(size))).otherwise(F.lit(0.0)) for n in ("n_before", "n_after")]
    return (
        counts.select("feature", "n_before", "n_after", (error[0] + error[1]).alias("ks_error"))
        .join(ks, "feature", "left")
        .join(psi, "feature", "left")
    )
