"""Quantile sketches as a binary column: built per task, merged by aggregates, kept from run to run."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rank_error(size: int) -> float:
    """How far the rank of a quantile is off at most, in 99 of 100 cases, for a sketch of that size.

    The published fit for this family of sketches; below about ``size`` values nothing is left out.
    """
    return 2.296 / size**0.9723


def quantile(sketch: str, rank: float) -> Column:
    """The smallest value whose rank reaches ``rank``: the lower median at 0.5.  NULL for an empty sketch."""
    filled = F.kll_sketch_get_n_double(sketch) > 0
    return F.when(filled, F.kll_sketch_get_quantile_double(F.col(sketch), F.lit(float(rank))))

