"""Rows with a weight against the same rows repeated: scaler, fit, cost, silhouette, the complete job."""

import random

import pytest
from pyspark.sql import functions as F

from cohortmill.operators.clustering import k_sweep
from cohortmill.operators.evaluation import assign, cluster_sums, silhouette, wssse
from cohortmill.operators.metadata import attach_metadata, unfold
from cohortmill.operators.scaling import fit_standardizer, scaled_names, standardize
from cohortmill.plans.segmentation import Settings, segment
from cohortmill.storage import materialize

NAMES = ["x", "y"]
SCALED = scaled_names(NAMES)
CENTERS = [[-1.0, -0.5], [1.0, 0.5], [0.0, 2.0]]


@pytest.fixture(scope="module")
def weighted(spark):
    pick = random.Random(4)
    rows = [(i, pick.gauss(i % 3, 0.4), pick.gauss(i % 2, 0.4), pick.choice([1, 1, 2, 9])) for i in range(150)]
    rows += [(900, 1.0, None, 5), (901, float("nan"), 1.0, 5), (902, 9e9, 9e9, 0), (903, 9e9, 9e9, None)]
    return spark.createDataFrame(rows, "app_id int, x double, y double, copies bigint").repartition(4)


def repeated(weighted):
    return unfold(weighted)


def test_unfolding_repeats_rows(spark, weighted):
    counts = {r.app_id: r["count"] for r in repeated(weighted).groupBy("app_id").count().collect()}
    assert counts == {r.app_id: r.copies for r in weighted.collect() if r.copies}
    many = spark.createDataFrame([(1, 2500), (2, 1000), (3, 1001), (4, 0)], "copies int, n int").select(
        F.col("copies").alias("id"), F.col("n").cast("bigint").alias("copies")
    )
    out = unfold(many)
    assert out.columns == ["id"]
    assert sorted(map(tuple, out.groupBy("id").count().collect())) == [(1, 2500), (2, 1000), (3, 1001)]


def test_moments_cost_and_silhouette(weighted):
    rows = repeated(weighted)
    a, b = fit_standardizer(weighted, NAMES, "copies"), fit_standardizer(rows, NAMES)
    assert a.means == pytest.approx(b.means, rel=1e-12) and a.deviations == pytest.approx(b.deviations, rel=1e-12)
    one = assign(standardize(weighted, a), SCALED, CENTERS)
    all_rows = assign(standardize(rows, a), SCALED, CENTERS)
    assert wssse(one, "copies").first()[0] == pytest.approx(wssse(all_rows).first()[0], rel=1e-12)
    pair = [silhouette(one, SCALED, weight="copies").first()[0], silhouette(all_rows, SCALED).first()[0]]
    assert pair[0] == pytest.approx(pair[1], rel=1e-12)
    sums = [{r.cluster_id: r for r in t.collect()} for t in (cluster_sums(one, SCALED, "copies"), cluster_sums(all_rows, SCALED))]
    assert set(sums[0]) == set(sums[1])
    for k, row in sums[0].items():
        assert row.n == sums[1][k].n and list(row.total) == pytest.approx(list(sums[1][k].total), rel=1e-9)


def test_sweep_scores_are_those_of_all_rows(spark, weighted):
    scaler = fit_standardizer(weighted, NAMES, "copies")
    table = materialize(standardize(weighted, scaler), "weighted")
    sweep, centers = k_sweep(table, SCALED, ks=(2, 3), weight="copies")
    for row in sweep.collect():
        rows = assign(repeated(table), SCALED, centers[row.K])
        assert row.WSSSE_Cost == pytest.approx(wssse(rows).first()[0], rel=1e-9)
        assert row.Silhouette_Score == pytest.approx(silhouette(rows, SCALED).first()[0], rel=1e-9)
        # Every center is the mean of the rows that its own weighted rows stand for.
        for found in cluster_sums(rows, SCALED).collect():
            assert list(centers[row.K][found.cluster_id]) == pytest.approx([s / found.n for s in found.total], abs=1e-2)


def test_many_equal_rows_are_one_row_of_the_fit(spark):
    entity = spark.createDataFrame([(1, "n")], "app_id int, review_app_name string")
    row = spark.createDataFrame([(1, "m", 2.0)], "meta_appid int, meta_game_name string, meta_price double")
    out = attach_metadata(entity, row.crossJoin(spark.range(200_000)).drop("id"), "weight").collect()
    assert [(r.app_id, r.game_name, r.price, r.copies) for r in out] == [(1, "m", 2.0, 200_000)]


def test_one_row_and_no_rows(spark):
    one = spark.createDataFrame([(1.0, 2.0, 1)], "x double, y double, copies bigint")
    assert fit_standardizer(one, NAMES, "copies").deviations == (0.0, 0.0)
    three = one.withColumn("copies", F.lit(3).cast("bigint"))
    assert fit_standardizer(three, NAMES, "copies").deviations == (0.0, 0.0)
    assert fit_standardizer(one.limit(0), NAMES, "copies").means == (0.0, 0.0)


def test_the_job_counts_repeated_metadata_rows(spark):
    """Kept duplicates: sizes, statistics and the clustered table hold every row of the plain join."""
    events = spark.range(0, 3000).select(
        (F.col("id") % 40).cast("string").alias("app_id"), F.lit("n").alias("app_name"),
        F.when(F.col("id") % 7 < F.col("id") % 40 % 7, "True").alias("recommended"),
        (F.col("id") % 97).cast("string").alias("author.playtime_forever"),
    )
    meta = spark.range(0, 90).select(
        (F.col("id") % 30).cast("string").alias("appid"), F.concat(F.lit("m"), F.col("id") % 60).alias("name"),
        (F.col("id") % 30).cast("string").alias("price"),
    )
    settings = Settings(duplicates="keep", ks=(2, 3))
    result = segment(events, meta, settings)
    try:
        want = {i: 3 if i < 30 else 1 for i in range(40)}
        assert {r.app_id: r["count"] for r in result.clustered.groupBy("app_id").count().collect()} == want
        assert sum(r.game_count for r in result.sizes.collect()) == sum(want.values())
        assert sum(r["count"] for r in result.statistics.collect()) == sum(want.values())
    finally:
        result.release()
