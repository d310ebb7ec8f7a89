from pyspark.sql import functions as F

from cohortmill.operators import cleaning, entities, features, metadata
from cohortmill.plans.segmentation import Settings, entity_feature_table

EVENT_COLUMNS = "app_id string, app_name string, recommended string, `author.playtime_forever` string"
META_COLUMNS = "appid string, name string, price string"


def rows_for(key, n, invalid=0, name="n", flag="True", minutes="60"):
    good = [(key, name, flag, minutes)] * n
    return good + [(key, name, flag, "-1")] * invalid


def test_aggregate_values(spark):
    raw = spark.createDataFrame(
        [
            ("1", "b", "True", "60"),
            ("1", "a", "False", "120"),
            ("1", None, None, "30"),
            ("1", "0-rejected", "True", "700000"),
            ("bad", "z", "True", "5"),
            ("2", None, "True", "1"),
            ("3", "only rejects", "True", "x"),
        ],
        EVENT_COLUMNS,
    )
    typed = cleaning.typed_events(raw)
    found = {r["app_id"]: r for r in entities.entity_features(entities.entity_aggregate(typed)).collect()}
    assert set(found) == {1, 2}
    one = found[1]
    assert one["review_app_name"] == "a"
    assert (one["total_reviews"], one["positive_reviews"], one["popularity"]) == (3, 1, 3)
    assert abs(one["rating_percent"] - 100 / 3) < 1e-12
    assert one["avg_playtime_minutes"] == 70.0 and one["playtime_hours"] == 1.17
    assert found[2]["review_app_name"] is None

    clean = cleaning.clean_events(raw)
    assert sorted(map(str, entities.entity_aggregate(clean).collect())) == sorted(
        map(str, entities.entity_aggregate(typed).collect())
    )
    totals = entities.audit_totals(entities.audited_entity_aggregate(typed)).first()
    assert tuple(totals) == (7, 1, 2, 4, 2)


def test_median_is_a_data_value(spark):
    raw = [("1", "n", "True", m) for m in ("1", "2", "3", "100")] + [
        ("2", "n", "True", m) for m in ("5", "7", "9")
    ]
    clean = cleaning.clean_events(spark.createDataFrame(raw, EVENT_COLUMNS))
    assert sorted(map(tuple, entities.entity_medians(clean).collect())) == [(1, 2.0), (2, 7.0)]


def test_popularity_threshold(spark):
    raw = rows_for("19", 19) + rows_for("20", 20) + rows_for("21", 19, invalid=1)
    table = entity_feature_table(
        spark.createDataFrame(raw, EVENT_COLUMNS), spark.createDataFrame([], META_COLUMNS)
    )
    assert [tuple(r) for r in table.collect()] == [(20, "n", 0.0, 100.0, 20, 1.0)]


def test_fallbacks_and_duplicates(spark):
    raw = rows_for("1", 20, name="review one") + rows_for("2", 20, name=None) + rows_for("3", 20)
    events = spark.createDataFrame(raw, EVENT_COLUMNS)
    meta = spark.createDataFrame(
        [
            ("1", None, "5"),
            ("1", None, "5"),
            ("1", "store one", "7"),
            ("2", None, "free"),
            ("9", "unused", "1"),
        ],
        META_COLUMNS,
    )
    first = entity_feature_table(events, meta).select("app_id", "game_name", "price")
    assert sorted(map(tuple, first.collect())) == [
        (1, "store one", 7.0),
        (2, "Unknown Game", 0.0),
        (3, "n", 0.0),
    ]
    every = entity_feature_table(events, meta, Settings(duplicates="keep"))
    assert sorted(map(tuple, every.select("app_id", "game_name", "price").collect())) == [
        (1, "review one", 5.0),
        (1, "review one", 5.0),
        (1, "store one", 7.0),
        (2, "Unknown Game", 0.0),
        (3, "n", 0.0),
    ]


def test_fan_out_equals_plain_left_join_under_skew(spark):
    """One key holds most metadata rows; every duplicate must come back, spread over tasks."""
    per_entity = spark.range(0, 50).select(
        F.col("id").cast("int").alias("app_id"), F.lit("r").alias("review_app_name")
    )
    meta = spark.range(0, 6000).select(
        F.when(F.col("id") < 4000, 7).otherwise(F.col("id") % 60 + 3).cast("int").alias("meta_appid"),
        F.concat(F.lit("v"), (F.col("id") % 1500).cast("string")).alias("meta_game_name"),
        F.when(F.col("id") % 5 > 0, F.col("id") % 3).cast("double").alias("meta_price"),
    )
    plain = per_entity.join(meta, per_entity.app_id == meta.meta_appid, "left").select(
        "app_id", F.coalesce("meta_game_name", "review_app_name").alias("game_name"),
        F.coalesce("meta_price", F.lit(0.0)).alias("price"),
    )
    ours = metadata.attach_metadata(per_entity, meta, "keep").select("app_id", "game_name", "price")
    assert ours.exceptAll(plain).count() == 0 and plain.exceptAll(ours).count() == 0
    assert metadata.attach_metadata(per_entity, meta).count() == 50


def test_hot_key_and_partitioning_do_not_change_results(spark):
    raw = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, "7").otherwise((F.col("id") % 101).cast("string")).alias("app_id"),
        F.concat(F.lit("name "), F.col("id") % 4).alias("app_name"),
        F.when(F.col("id") % 7 < 4, "True").otherwise("False").alias("recommended"),
        (F.col("id") % 977).cast("string").alias("author.playtime_forever"),
    )
    results = [
        sorted(map(str, entities.entity_aggregate(cleaning.typed_events(raw.repartition(n))).collect()))
        for n in (1, 8)
    ]
    assert results[0] == results[1] and len(results[0]) == 101


def test_filter_runs_below_the_metadata_join(spark):
    table = entity_feature_table(
        spark.createDataFrame(rows_for("1", 20), EVENT_COLUMNS),
        spark.createDataFrame([("1", "one", "1")], META_COLUMNS),
    )
    plan = table._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join LeftOuter") < plan.index(">= 20")


def test_feature_order():
    assert features.feature_names() == [
        "log_price",
        "rating_percent",
        "log_popularity",
        "log_playtime",
    ]
