"""Previews and reproducible samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortmill import fixed_values as fixed


def preview(df: DataFrame, by: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows by key: a top-n per task, then one merge."""
    return df.orderBy(*by).limit(n)


def plot_sample(
    clustered: DataFrame,
    n: int = fixed.PLOT_SAMPLE_ROWS,
    seed: int = fixed.SEED,
    key: str = "app_id",
    distinct: Sequence[str] = (),
) -> DataFrame:
    """A uniform sample of min(n, rows) rows without replacement.

    Rows are ordered by a digest of key and seed, so the sample does not depend on
    partitioning; each task keeps its own top ``n`` and no full sort takes place.
    Rows that share a key are told apart by ``distinct`` columns where the table has them.
    """
    parts = [F.col(key).cast("string"), F.lit(f":{seed}")]
    others = [c for c in distinct if c in clustered.columns]
    parts += [F.coalesce(F.concat(F.lit(":"), F.col(c).cast("string")), F.lit("")) for c in others]
    return clustered.orderBy(F.md5(F.concat(*parts)), key, *others).limit(n)
