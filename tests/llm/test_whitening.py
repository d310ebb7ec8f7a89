"""Whitening against whole-table linear algebra, and its eigenvectors against exact ones."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from cohortmill.llm import queries
from cohortmill.llm.whitening import refined_eigen, whiten

SCHEMA = "vec_id bigint, embedding array<float>, x string, n int, i int, component int, vector int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1, 2, 3, 4) for i, v in rows], SCHEMA).repartition(3)


def on_grid(rows):
    usable = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    return [(i, [math.floor(64 * float(np.float32(c))) + 1000000 for c in v]) for i, v in usable]


def check(got, rows):
    """Every contracted column from exact sums and a decomposition of the exact covariance."""
    want = on_grid(rows)
    fit = sorted({tuple(x) for _, x in want})
    n, width = len(fit), len(fit[0])
    total = [sum(column) for column in zip(*fit)]
    mean = [Fraction(t, n) for t in total]
    y = np.array([[float(a - m) for a, m in zip(x, mean)] for x in fit])
    v = y.T @ y / n
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    by = {}
    for r in got:
        by.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append(r)
    assert len(got) == len(want) * min(16, width)
    assert {r.n for r in got} == {n}
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error <= 1e-9
    for i, x in want:
        deviation = sum((n * a - t) ** 2 for a, t in zip(x, total))
        assert set(by[i, deviation]) == set(range(1, min(16, width) + 1))
    for k in range(min(16, width)):
        (explained,) = {r.explained for r in got if r.component == k + 1}
        assert explained == pytest.approx(values[k] / np.trace(v), rel=1e-9)
    gaps = np.abs(np.subtract.outer(values, values)) + np.eye(width) * values[0]
    for k in range(min(16, width)):
        if gaps[k].min() < 1e-3 * values[0]:
            continue
        ours = {(r.vec_id, r.deviation): r.whitened for r in got if r.component == k + 1}
        signs = set()
        for i, x in want:
            deviation = sum((n * a - t) ** 2 for a, t in zip(x, total))
            theirs = sum(float(a - m) * w for a, m, w in zip(x, mean, vectors[:, k])) / math.sqrt(values[k])
            if abs(theirs) > 1e-6:
                signs.add(round(ours[i, deviation] / theirs, 9))
        assert len(signs) == 1 and abs(signs.pop()) == 1


def varied(seed, n=120, width=20):
    pick = random.Random(seed)
    rows = [(i, [pick.gauss(0, 1 + d) for d in range(width)]) for i in range(n)]
    rows += [(1000 + i, rows[0][1]) for i in range(60)]  # a third of all rows alike
    return rows + [(5, rows[5][1]), (None, rows[6][1]), (5, rows[7][1])]


def test_whole_table(spark):
    rows = varied(1)
    check(whiten(table(spark, rows)).collect(), rows)


def test_hard_rows(spark):
    usable = varied(2, 40, 3)
    hard = [(None, None), (1, None), (2, []), (3, [1.0, None, 2.0]), (4, [1.0, math.nan, 2.0]), (5, [1.0, math.inf, 2.0]), (6, [1.0, 2.0]), (7, [1e30, 1.0, 2.0])]
    check(whiten(table(spark, usable + hard)).collect(), usable)


def test_tables_without_components(spark):
    assert whiten(table(spark, [])).collect() == []
    assert whiten(table(spark, [(1, None)])).collect() == []
    assert whiten(table(spark, [(i, [1.0, 2.0]) for i in range(5)])).collect() == []


def test_components_end_with_the_rank(spark):
    rows = [(i, [float(i), 2.0 * i, 0.0]) for i in range(9)]
    got = whiten(table(spark, rows)).collect()
    assert {r.component for r in got} == {1} and len(got) == 9
    assert got[0].explained == pytest.approx(1)


def test_large_values_keep_exact_deviations(spark):
    rows = [(0, [1e9, 0.0]), (1, [-1e9, 1.0]), (2, [0.0, 2.0]), (3, [1e12, 3.0])]
    x = on_grid(rows)
    total = [sum(c) for c in zip(*(v for _, v in x))]
    exact = {i: sum((4 * a - t) ** 2 for a, t in zip(v, total)) for i, v in x}
    got = {r.vec_id: r.deviation for r in whiten(table(spark, rows)).collect()}
    assert got == {i: d if d < 1 << 63 else None for i, d in exact.items()}
    assert None in got.values()


def orthogonal(pick, width):
    return np.linalg.qr(pick.standard_normal((width, width)))[0]


@pytest.mark.parametrize(
    "values",
    [
        np.linspace(1, 2, 30),
        np.concatenate([1 + 1e-9 * np.arange(5), 2 + 1e-7 * np.arange(5), np.linspace(3, 9, 20)]),
        np.concatenate([np.ones(10), np.full(10, 3.0)]),
        10.0 ** -np.arange(16),
        np.array([1.0, 1 + 1e-12, 1e-3, 1e-3]),
        np.zeros(4),
        np.array([5.0]),
    ],
)
def test_refinement_also_of_clustered_eigenvalues(values):
    pick = np.random.default_rng(7)
    q = orthogonal(pick, len(values)).astype(np.longdouble)
    v = (q * values) @ q.T
    v = (v + v.T) / 2
    found, x = refined_eigen(v)
    assert np.abs(x.T @ x - np.eye(len(values))).max() < 1e-17
    residual = v @ x - x * found
    assert np.abs(residual).max() < 1e-16 * max(1, np.abs(values).max())
    assert np.all(np.diff(found) <= 1e-15)
    if len(values) == 30:  # the start alone is right to single precision only
        assert np.abs(np.sort(found) - np.sort(np.linalg.eigvalsh(v.astype(float)))).max() < 1e-13


def test_the_query_reads_the_whole_table(spark, folder):
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    got = queries.op12_embedding_whitening(spark, folder).collect()
    check(got, [(r.vec_id, r.embedding) for r in rows])
