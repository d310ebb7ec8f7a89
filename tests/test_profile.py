import pytest
from pyspark.sql import functions as F

from cohortmill import fixed_values as fixed
from cohortmill.operators import profile
from cohortmill.operators.charts import elbow_series, feature_bars, notable_entities
from cohortmill.operators.quality import cross_checks, quality_checks
from cohortmill.operators.sampling import plot_sample
from cohortmill.sources.tables import CLUSTERED_SCHEMA, STATISTICS_SCHEMA, SWEEP_SCHEMA

# The published cluster statistics.
STATS = [
    (0, 56, 3.12, 0.0, 95.63, 97.16, 43872.84, 29982, 36.91, 21.63),
    (1, 117, 22.1, 18.99, 86.41, 89.76, 6638.77, 4570, 53.95, 38.48),
    (2, 30, 7.23, 0.0, 37.15, 38.06, 4399.47, 2860, 59.31, 21.6),
    (3, 115, 24.96, 22.99, 89.69, 91.82, 116563.83, 53546, 224.23, 156.36),
]


@pytest.fixture(scope="module")
def stats(spark):
    return spark.createDataFrame(STATS, STATISTICS_SCHEMA)


def clustered(spark, rows):
    return spark.createDataFrame(rows, CLUSTERED_SCHEMA)


def test_published_statistics_get_the_published_labels(stats):
    labels = {r["cluster_id"]: r["label"] for r in profile.cluster_labels(stats).collect()}
    assert labels == {0: "budget", 1: "mid_tier", 2: "poorly_received", 3: "blockbuster"}
    texts = profile.label_texts(profile.cluster_labels(stats), stats).where("cluster_id = 3").first()
    assert texts["name"] == fixed.LABEL_TEXTS["blockbuster"][0]
    assert texts["description"] == "Means: rating 89.69 %, price 24.96, reviews 116563.83, hours 224.23"


def test_published_shares(spark, stats):
    sizes = stats.select("cluster_id", F.col("count").alias("game_count"))
    assert [r["share_percent"] for r in profile.cluster_share(sizes).collect()] == [17.6, 36.8, 9.4, 36.2]


def test_engagement_gap(stats):
    pair = {r["feature"]: r["ratio"] for r in profile.contrast_between(stats, 3, 0).collect()}
    assert pair["playtime_hours"] == 6.075
    lowest = profile.cluster_contrast(stats).where("feature = 'playtime_hours'").collect()
    assert {(r["cluster_id"], r["lowest_cluster"]) for r in lowest} == {(i, 0) for i in range(4)}


def test_ranks(stats):
    ranks = profile.cluster_ranks(stats).where("feature = 'price'").collect()
    assert {r["cluster_id"]: r["rank"] for r in ranks} == {3: 1, 1: 2, 2: 3, 0: 4}


def test_captions(stats):
    captions = {
        (r["metric"], r["cluster_id"]): r["caption"] for r in feature_bars(stats).collect()
    }
    assert captions["avg_price", 0] == "$3.12"
    assert captions["avg_price", 1] == "22.1"
    assert captions["avg_popularity_reviews", 3] == "116,564"
    assert captions["avg_playtime_hours", 0] == "36.9"


def test_statistics_use_the_lower_median(spark):
    rows = [(i, "n", float(p), 50.0, 20 + i, 1.0, 0) for i, p in enumerate((0, 0.5, 1.5, 9))]
    row = profile.cluster_statistics(clustered(spark, rows)).first()
    assert (row["median_price"], row["avg_price"], row["median_popularity_reviews"]) == (0.5, 2.75, 21)


def test_representatives_limit_rows_before_the_shuffle(spark):
    scored = spark.range(1000).select(
        F.col("id").cast("int").alias("app_id"),
        F.lit("n").alias("game_name"),
        F.when(F.col("id") % 10 == 0, 1).otherwise(0).alias("cluster_id"),
        (F.col("id") % 50).cast("double").alias("d2"),
    )
    found = profile.representatives(scored, 2)
    assert sorted((r["cluster_id"], r["app_id"], r["place"]) for r in found.collect()) == [
        (0, 1, 1),
        (0, 51, 2),
        (1, 0, 1),
        (1, 50, 2),
    ]
    fresh = profile.representatives(scored, 2)
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_sample_is_stable_and_capped_by_n(spark):
    table = spark.range(300).select(F.col("id").cast("int").alias("app_id"))
    one = [r[0] for r in plot_sample(table.repartition(1), 50).collect()]
    many = [r[0] for r in plot_sample(table.repartition(8), 50).collect()]
    assert one == many and len(set(one)) == 50
    assert plot_sample(table, 10000).count() == 300
    assert [r[0] for r in plot_sample(table, 50, seed=7).collect()] != one


def test_elbow_series_marks_one_k(spark):
    sweep = spark.createDataFrame([(2, 9.0, 0.3), (3, 5.0, 0.5), (4, 4.0, 0.5)], SWEEP_SCHEMA)
    marked = elbow_series(sweep, sweep.where("K = 3")).where("is_best").collect()
    assert {(r["K"], r["metric"]) for r in marked} == {(3, "WSSSE_Cost"), (3, "Silhouette_Score")}


def test_quality_finds_each_fault(spark):
    good = (1, "one", 1.0, 50.0, 20, 1.0, 0)
    rows = [
        good,
        good,
        (2, None, 1.0, 50.0, 20, 1.0, 0),
        (3, "n", None, 50.0, 20, 1.0, 0),
        (4, "n", 1.0, 101.0, 19, -1.0, 9),
    ]
    table = clustered(spark, rows)
    actual = {r["check_name"]: r["actual"] for r in quality_checks(table, 4).collect()}
    assert actual == {
        "repeated_keys": 1,
        "null_keys": 0,
        "null_names": 1,
        "null_features": 1,
        "rating_out_of_range": 1,
        "popularity_below_minimum": 1,
        "negative_playtime": 1,
        "negative_price": 1,
        "cluster_id_out_of_range": 1,
    }
    sweep = spark.createDataFrame([(2, 9.0, 0.3), (3, 5.0, 0.5)], SWEEP_SCHEMA)
    checks = cross_checks(table, profile.cluster_sizes(table), sweep, 2).collect()
    assert {r["check_name"]: r["ok"] for r in checks} == {
        "sizes_add_up": True,
        "best_k_is_top_silhouette": False,
    }


def test_notable_words(spark):
    rows = [(1, "THE ELDER SCROLLS V: SKYRIM", 1.0, 1.0, 20, 1.0, 0), (2, "Portal", 1.0, 1.0, 20, 1.0, 0)]
    assert [r["app_id"] for r in notable_entities(clustered(spark, rows)).collect()] == [1]
