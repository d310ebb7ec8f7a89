"""Squared-Euclidean geometry over plain columns of doubles, as arithmetic that Spark compiles.

Sums are balanced trees, so an expression over many columns is wide but not deep.
"""

from __future__ import annotations

import operator
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _balanced(parts: Sequence[Column], join: Callable[[Column, Column], Column]) -> Column:
    parts = list(parts)
    while len(parts) > 1:
        parts = [reduce(join, parts[i : i + 2]) for i in range(0, len(parts), 2)]
    return parts[0]


def total(parts: Sequence[Column]) -> Column:
    return _balanced(parts, operator.add) if parts else F.lit(0.0)


def doubles(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).cast("double") for c in columns]


def all_usable(columns: Sequence[str]) -> Column:
    """True where every feature is a finite number; NULL, NaN and infinities are not."""
    finite = [F.coalesce(F.abs(c) < float("inf"), F.lit(False)) for c in doubles(columns)]
    return _balanced(finite, operator.and_) if finite else F.lit(True)


def squared_distance(features: Sequence[Column], point: Sequence[float]) -> Column:
    return total([(c - F.lit(float(x))) * (c - F.lit(float(x))) for c, x in zip(features, point, strict=True)])


def squared_norm(features: Sequence[Column]) -> Column:
    return total([c * c for c in features])


def dot(features: Sequence[Column], point: Sequence[float]) -> Column:
    return total([c * F.lit(float(x)) for c, x in zip(features, point, strict=True)])


def nearest_center(columns: Sequence[str], centers: Sequence[Sequence[float]]) -> Column:
    """struct(d2, cluster_id) of the nearest center; the lowest id wins a tie.

    NULL for features that are not usable: such a row is near nothing.
    """
    features = doubles(columns)
    measured = [
        F.struct(squared_distance(features, c).alias("d2"), F.lit(i).alias("cluster_id")) for i, c in enumerate(centers)
    ]
    return F.when(all_usable(columns), F.array_min(F.array(*measured)))
