import itertools

import pytest
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cohortmill.operators import clustering, profile
from cohortmill.operators.clustering import (
    as_vectors,
    best_k,
    center_lists,
    fit_ml_stages,
    k_sweep,
    kmeans,
    select_k,
    stable_layout,
)
from cohortmill.operators.evaluation import (
    assign,
    cluster_sums,
    cost_from_sums,
    fit_checks,
    silhouette,
    wssse,
)
from cohortmill.operators.scaling import (
    fit_standardizer,
    ml_standardize,
    scaled_names,
    standardize,
)
from cohortmill.operators.features import DEFAULT_FEATURES, with_features
from cohortmill.operators.metadata import attach_metadata
from cohortmill.operators.scoring import from_ml_stages, make_model
from cohortmill.storage import materialize
from cohortmill.streaming.scoring import score_rows

COLUMNS = ["a", "b", "c"]
SCALED = scaled_names(COLUMNS)


def points(spark, n=400):
    """Three uneven blobs, from a rule."""
    blob = F.when(F.col("id") % 10 < 6, 0).when(F.col("id") % 10 < 9, 5).otherwise(-7)
    noise = lambda i: (F.pmod(F.xxhash64("id", F.lit(i)), F.lit(1000)) / 500.0 - 1)
    return spark.range(n).select(
        F.col("id").cast("int").alias("app_id"),
        (blob + noise(1)).alias("a"),
        (blob * 2 + noise(2)).alias("b"),
        (noise(3) * 3).alias("c"),
    )


@pytest.fixture(scope="module")
def scaled(spark):
    table = points(spark)
    return materialize(standardize(table, fit_standardizer(table, COLUMNS)), "points")


def test_both_scalers_agree(spark):
    table = points(spark)
    ml = ml_standardize(table, COLUMNS).select(
        "app_id", vector_to_array("scaled_features").alias("z")
    )
    ours = standardize(table, fit_standardizer(table, COLUMNS))
    joined = ours.join(ml, "app_id")
    for i, name in enumerate(SCALED):
        assert joined.where(F.abs(F.col(name) - F.col("z")[i]) > 1e-9).count() == 0


def test_constant_column_scales_to_zero(spark):
    table = points(spark).withColumn("c", F.lit(3.0))
    scaled = standardize(table, fit_standardizer(table, COLUMNS))
    assert scaled.where("scaled_c <> 0").count() == 0


def test_single_row_scales_to_zero(spark):
    table = points(spark, 1)
    row = standardize(table, fit_standardizer(table, COLUMNS)).first()
    assert [row[c] for c in SCALED] == [0.0, 0.0, 0.0]


def test_tie_goes_to_the_lowest_id(spark):
    table = spark.createDataFrame([(1, 0.0)], "app_id int, x double")
    for centers in ([[1.0], [-1.0]], [[float(i)] for i in [-1, 1, *range(2, 140)]]):
        row = assign(table, ["x"], centers).first()
        assert (row["cluster_id"], row["d2"]) == (0, 1.0)


@pytest.mark.parametrize("width", [3, 32, 33, 64])
def test_one_form_for_every_width(spark, width):
    """A NULL and a NaN are left out of the scaler, get no cluster and count in no measure."""
    names = [f"f{i}" for i in range(width)]
    value = lambda i: F.pmod(F.xxhash64("id", F.lit(i)), F.lit(1000)) / 100.0
    full = spark.range(60).select(F.col("id").alias("app_id"), *[value(i).alias(n) for i, n in enumerate(names)])
    bad = full.limit(2).withColumn("app_id", F.col("app_id") + 1000)
    bad = bad.withColumn("f1", F.when(F.col("app_id") == 1000, F.lit(None).cast("double")).otherwise(F.lit(float("nan"))))
    centers = [[0.1 * (i % 5)] * width for i in range(-2, 5)]
    found = []
    for table in (full, full.unionByName(bad)):
        scaled = standardize(table, fit_standardizer(table, names))
        assigned = assign(scaled, scaled_names(names), centers)
        rows = {r["app_id"]: (r["cluster_id"], r["d2"]) for r in assigned.collect()}
        found.append((rows, wssse(assigned).first()[0], silhouette(assigned, scaled_names(names)).first()[0]))
    assert found[1][0].pop(1000) == found[1][0].pop(1001) == (None, None)
    assert {i: r[0] for i, r in found[0][0].items()} == {i: r[0] for i, r in found[1][0].items()}
    assert found[0][1:] == pytest.approx(found[1][1:], abs=1e-9)


def test_unusable_rows_by_policy(spark):
    model = make_model(DEFAULT_FEATURES, [1.0, 2.0, 3.0, 4.0], [1.0] * 4, [[0.1] * 4, [0.2] * 4])
    rows = [(i, "n", p, 50.0, 20, 1.0) for i, p in enumerate((1.0, None, float("nan"), float("inf"), -1.0))]
    table = spark.createDataFrame(
        rows, "app_id int, game_name string, price double, rating_percent double, popularity long, playtime_hours double"
    )
    ids = {r["app_id"]: r["cluster_id"] for r in score_rows(table, model).collect()}
    assert ids.pop(0) is not None and set(ids.values()) == {None}
    assert [r["app_id"] for r in score_rows(table, model, "skip").collect()] == [0]
    with pytest.raises(Exception, match="NULL, NaN or infinite"):
        score_rows(table, model, "error").collect()
    inputs = with_features(table)
    more = inputs.where("app_id = 0").withColumn("price", F.explode(F.array(*[F.lit(float(x)) for x in range(1, 9)])))
    fitted = fit_ml_stages(with_features(more), ["log_price", "rating_percent", "log_popularity", "log_playtime"], 2)
    ids = {r["app_id"]: r["cluster_id"] for r in score_rows(inputs, fitted).collect()}
    assert ids.pop(0) is not None and set(ids.values()) == {None}
    assert score_rows(inputs, fitted, "skip").count() == 1


def test_fit_checks_fail_on_other_centers(scaled):
    centers = center_lists(kmeans(3).fit(as_vectors(stable_layout(scaled, ["app_id"]), SCALED)))
    good = fit_checks(assign(scaled, SCALED, centers), SCALED, centers).first()
    assert good["centers_are_means"] and good["moved_centers_cost_more"] and good["assigned_rows"] == 400
    other = [[x + 0.3 for x in c] for c in centers]
    bad = fit_checks(assign(scaled, SCALED, other), SCALED, other).first()
    assert not bad["centers_are_means"] and not bad["moved_centers_cost_more"]


def test_sweep_holds_one_table(spark, scaled):
    """No fit keeps rows of its own beside the held table, and nothing stays behind."""
    seen = []
    real = clustering.kmeans

    def watched(*args, **kwargs):
        seen.append(len(spark.sparkContext._jsc.getPersistentRDDs()))
        return real(*args, **kwargs)

    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    clustering.kmeans = watched
    try:
        clustering.k_sweep(scaled, SCALED, ks=(2, 3, 4, 5), parallelism=1)
    finally:
        clustering.kmeans = real
    assert max(seen) <= before + 1
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == before


def test_copies_of_one_metadata_row_are_spread(spark):
    entity = spark.createDataFrame([(1, "n")], "app_id int, review_app_name string")
    row = spark.createDataFrame([(1, "m", 2.0)], "meta_appid int, meta_game_name string, meta_price double")
    copies = row.crossJoin(spark.range(20_000)).drop("id")
    out = attach_metadata(entity, copies, "keep")
    parts = out.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in parts) == 20_000 and max(r["count"] for r in parts) <= 12_000


def brute_force_silhouette(rows):
    """Mean over rows of (b - a) / max(a, b), from all pairwise squared distances."""
    scores = []
    for i, (own, x) in enumerate(rows):
        totals = {}
        for j, (other, y) in enumerate(rows):
            if i != j:
                distance = sum((p - q) ** 2 for p, q in zip(x, y))
                total, n = totals.get(other, (0.0, 0))
                totals[other] = (total + distance, n + 1)
        if own not in totals:
            scores.append(0.0)
            continue
        a = totals[own][0] / totals[own][1]
        b = min(t / n for c, (t, n) in totals.items() if c != own)
        scores.append((b - a) / max(a, b))
    return sum(scores) / len(scores)


def test_silhouette_by_definition(scaled):
    """Includes a cluster with one member."""
    assigned = scaled.withColumn(
        "cluster_id", F.when(F.col("app_id") == 17, 2).otherwise((F.col("a") > 2).cast("int"))
    )
    rows = [(r["cluster_id"], [r[c] for c in SCALED]) for r in assigned.collect()]
    assert abs(silhouette(assigned, SCALED).first()[0] - brute_force_silhouette(rows)) < 1e-9


def test_silhouette_equals_the_evaluator(scaled):
    assigned = assign(scaled, SCALED, [[0.5, 0.1, -0.2], [-1.0, 0.0, 0.3]])
    value = ClusteringEvaluator(
        featuresCol="scaled_features", predictionCol="cluster_id"
    ).evaluate(as_vectors(assigned, SCALED))
    assert abs(silhouette(assigned, SCALED).first()[0] - value) < 1e-9


def test_one_cluster_has_no_silhouette(scaled):
    assert silhouette(assign(scaled, SCALED, [[0.0, 0.0, 0.0]]), SCALED).first()[0] is None


def test_kmeans_invariants(scaled):
    n, k = scaled.count(), 3
    model = kmeans(k).fit(as_vectors(stable_layout(scaled, ["app_id"]), SCALED))
    centers = center_lists(model)
    assigned = assign(scaled, SCALED, centers)
    cost = wssse(assigned).first()[0]
    sizes = {r["cluster_id"]: r["game_count"] for r in profile.cluster_sizes(assigned).collect()}
    assert set(sizes) <= set(range(k)) and sum(sizes.values()) == n
    assert 0 <= cost <= (n - 1) * len(SCALED)
    assert abs(cost - cost_from_sums(cluster_sums(assigned, SCALED).collect(), centers)) < 1e-8
    assert abs(cost - model.summary.trainingCost) <= 1e-3 * cost
    predicted = model.transform(as_vectors(scaled, SCALED)).select("app_id", F.col("cluster_id").alias("p"))
    assert assigned.join(predicted, "app_id").where("p <> cluster_id").count() == 0
    assert -1 <= silhouette(assigned, SCALED).first()[0] <= 1


def test_sweep_does_not_depend_on_partitioning(spark, scaled):
    results = []
    for n in (1, 7):
        sweep, centers = k_sweep(
            materialize(scaled.repartition(n), "shuffled"), SCALED, ks=(2, 3, 4)
        )
        results.append([tuple(r) for r in sweep.collect()])
    for (k, cost, score), (k2, cost2, score2) in itertools.zip_longest(*results):
        assert k == k2 and abs(cost - cost2) < 1e-9 and abs(score - score2) < 1e-9
    assert best_k(sweep).first()["K"] == max(results[0], key=lambda r: (r[2], -r[0]))[0]
    assert select_k(centers, sweep, 2) == 2
    with pytest.raises(ValueError):
        select_k(centers, sweep, 9)


def test_null_feature_needs_a_choice(spark):
    table = points(spark).withColumn("c", F.when(F.col("app_id") > 5, F.col("c")))
    with pytest.raises(Exception, match="null|NULL|handleInvalid"):
        fit_ml_stages(table, COLUMNS, 2).transform(table).count()
    kept = fit_ml_stages(table, COLUMNS, 2, handle_invalid="skip").transform(table)
    assert kept.count() == 394


def test_numbers_of_an_ml_model_score_the_same(spark):
    table = points(spark).select(
        "app_id",
        F.lit("n").alias("game_name"),
        F.abs("a").alias("price"),
        F.abs("b").alias("rating_percent"),
        (F.abs("c") * 100).cast("long").alias("popularity"),
        F.abs("a").alias("playtime_hours"),
    )
    inputs = with_features(table)
    names = ["log_price", "rating_percent", "log_popularity", "log_playtime"]
    fitted = fit_ml_stages(stable_layout(inputs, ["app_id"]), names, 3)
    ours = from_ml_stages(fitted).score(table).select("app_id", "cluster_id")
    theirs = fitted.transform(inputs).select("app_id", F.col("cluster_id").alias("p"))
    assert ours.join(theirs, "app_id").where("p <> cluster_id").count() == 0
