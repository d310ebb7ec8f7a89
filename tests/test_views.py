"""Density tiles, principal axes and titles with many words, against plain code."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortmill.functions.scalars import contains_any
from cohortmill.operators.views import Extent, density_tiles, extent_of, principal_axes, projected
from cohortmill.operators.words import containing_any, titles_with_words

POINTS = "app_id int, cluster_id int, x double, y double"


def points(spark, n=500):
    pick = random.Random(3)
    rows = [(i, pick.choice([0, 1, None]), pick.gauss(0, 1), pick.choice([0.0, 1.0, pick.random()])) for i in range(n)]
    rows += [(9001, 0, None, 1.0), (9002, 0, float("nan"), 1.0), (9003, 1, 1.0, float("inf"))]
    return spark.createDataFrame(rows, POINTS).repartition(4), rows[:n]


def test_every_level_holds_every_point_once(spark):
    table, rows = points(spark)
    tiles = density_tiles(table, "x", "y", levels=4).collect()
    low, high = min(r[2] for r in rows), max(r[2] for r in rows)
    for level in range(5):
        want, example = Counter(), {}
        for key, cluster, x, y in rows:
            cell = (min(int((x - low) / (high - low) * 16), 15) >> (4 - level), min(int(y * 16), 15) >> (4 - level), cluster)
            want[cell] += 1
            example[cell] = min(key, example.get(cell, key))
        got = {(r.cell_x, r.cell_y, r.cluster_id): r for r in tiles if r.level == level}
        assert {k: r.n for k, r in got.items()} == want
        assert {k: r.example for k, r in got.items()} == example
        assert len(got) <= 3 * 4**level


def test_tiles_stay_few_however_many_points(spark):
    sizes = []
    for n in (2_000, 40_000):
        table = spark.range(n).select(
            F.col("id").alias("app_id"), F.lit(0).alias("cluster_id"),
            (F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000).alias("x"), (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)) / 1000).alias("y"),
        )
        sizes.append(density_tiles(table, "x", "y", levels=3).count())
    assert sizes == [1 + 4 + 16 + 64] * 2


def test_given_extent_flat_boxes_and_no_points(spark):
    table, _ = points(spark)
    tiles = density_tiles(table, "x", "y", levels=1, extent=Extent(0.0, 1.0, 0.0, 1.0)).collect()
    assert {(r.cell_x, r.cell_y) for r in tiles if r.level == 1} == {(0, 0), (0, 1), (1, 0), (1, 1)}
    assert sum(r.n for r in tiles if r.level == 0) == 500
    flat = table.withColumn("x", F.lit(2.0))
    assert {r.cell_x for r in density_tiles(flat, "x", "y", levels=3).collect()} == {0}
    assert extent_of(table.limit(0), "x", "y") is None and density_tiles(table.limit(0), "x", "y").collect() == []


def test_principal_axes(spark):
    pick = np.random.default_rng(1)
    x = pick.standard_normal((300, 4)) @ np.diag([5.0, 2.0, 1.0, 0.1]) @ np.linalg.qr(pick.standard_normal((4, 4)))[0]
    names = ["a", "b", "c", "d"]
    table = spark.createDataFrame([tuple(map(float, r)) for r in x] + [(None, 1.0, 1.0, 1.0)], ", ".join(f"{n} double" for n in names))
    found = principal_axes(table.repartition(5), names)
    theirs = np.linalg.eigh(np.cov(x.T))[1][:, ::-1][:, :2]
    assert np.allclose(np.abs(found.T @ theirs), np.eye(2), atol=1e-9)
    assert all(found[np.abs(found[:, j]).argmax(), j] > 0 for j in range(2))
    got = [(r.axis_0, r.axis_1) for r in projected(table, names, found).collect()]
    assert got[-1] == (None, None) and np.allclose(got[:-1], x @ found)
    assert principal_axes(table.limit(1), names).tolist() == [[0.0, 0.0]] * 4


# --- many words


def titles(spark, n, seed):
    pick = random.Random(seed)
    word = lambda: "".join(pick.choice("abcdeé") for _ in range(pick.randint(1, 9)))
    names = [pick.choice([str.upper, str.lower])(" ".join(word() for _ in range(pick.randint(1, 4)))) for _ in range(n)]
    return spark.createDataFrame([(i, t) for i, t in enumerate([*names, names[0], None, "", "ab"])], "app_id int, game_name string").repartition(3), names


def words_table(spark, words):
    return spark.createDataFrame([(w,) for w in words], "w string")


@pytest.mark.parametrize("words", [["ab", "C", "dé", "abcd", "É e", "zzz", "aaaa", "e"], ["x"], [None], [], ["", "q"], ["a" * 40, "ABCDE"]])
def test_equal_to_the_or_form(spark, words):
    table, _ = titles(spark, 300, 1)
    usable = [w for w in words if w is not None]
    want = table.where(contains_any(F.col("game_name"), usable))
    got = containing_any(table, words_table(spark, words))
    assert got.columns == table.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_ten_thousand_words(spark):
    table, names = titles(spark, 1500, 2)
    pick = random.Random(4)
    words = set()
    while len(words) < 10_000:
        words.add("".join(pick.choice("abcdeéxyz ") for _ in range(pick.randint(2, 9))))
    got = {(r.title, r.word) for r in titles_with_words(table.select("game_name"), words_table(spark, sorted(words))).collect()}
    lowered = {n.lower() for n in names} | {"", "ab"}
    assert got == {(t, w) for t in lowered for w in words if w in t}
    hit = {t for t, _ in got}
    rows = containing_any(table, words_table(spark, sorted(words))).collect()
    assert sorted(r.app_id for r in rows) == sorted(r.app_id for r in table.collect() if r.game_name is not None and r.game_name.lower() in hit)
