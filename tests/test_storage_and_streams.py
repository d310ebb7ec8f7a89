import pytest
from pyspark.sql import functions as F

from cohortmill.operators import sinks
from cohortmill.operators.features import DEFAULT_FEATURES
from cohortmill.operators.scoring import SegmentModel, make_model
from cohortmill.plans import bindings
from cohortmill.plans.segmentation import Settings, export, segment
from cohortmill.plans.workload import QUERIES
from cohortmill.sources.tables import (
    CLUSTERED_SCHEMA,
    SIZES_SCHEMA,
    STATISTICS_SCHEMA,
    SWEEP_SCHEMA,
    land_as_parquet,
    read_csv_by_header,
    read_result_csv,
)
from cohortmill.storage import materialize, scratch_path, shared_dir
from cohortmill.streaming.scoring import read_feature_stream, score_rows, write_scored

TEXTS = [
    ("1", "comma, inside"),
    ("2", 'a "quoted" word'),
    ("3", "two\nlines"),
    ("4", "Ōkami Ünïcode®"),
    ("5", ""),
    ("6", None),
    ("7", "  padded  "),
    ("8", "back\\slash \\\" mixed"),
]


def test_csv_round_trip(spark):
    table = spark.createDataFrame(TEXTS, "id string, `dotted.name` string")
    path = scratch_path(spark, "csv")
    sinks.write_csv(table, path)
    back = read_csv_by_header(spark, path, multiline=True)
    assert back.columns == ["id", "dotted.name"]
    # A CSV reader gives blank fields as NULL.
    expected = [(key, text or None) for key, text in TEXTS]
    assert sorted(map(tuple, back.collect())) == expected
    parquet = land_as_parquet(back, scratch_path(spark, "landed"))
    assert sorted(map(tuple, parquet.collect())) == expected


def test_line_break_needs_multiline(spark):
    path = scratch_path(spark, "csv")
    sinks.write_csv(spark.createDataFrame([("1", "a\nb")], "id string, t string"), path)
    assert read_csv_by_header(spark, path).count() == 2
    assert read_csv_by_header(spark, path, multiline=True).count() == 1


def test_materialize_cuts_lineage(spark):
    table = materialize(spark.range(10).groupBy((F.col("id") % 3).alias("g")).count(), "t")
    plan = table._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and table.count() == 3


def test_shared_dir_is_the_named_one(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_dir(spark) == shared_dir(spark)
    if named:
        assert shared_dir(spark) == named.rstrip("/")


def test_model_save_and_load(spark):
    model = make_model(DEFAULT_FEATURES, [1.0, 2.0, 3.0, 4.0], [1.0, 0.0, 2.0, 3.0], [[0.1] * 4, [0.2] * 4])
    path = scratch_path(spark, "model")
    model.save(spark, path)
    assert SegmentModel.load(spark, path) == model


def test_stream_equals_batch_and_resumes(spark, folder):
    table = materialize(QUERIES["feature_table"](spark, folder), "features")
    model = make_model(DEFAULT_FEATURES, [3.0, 50.0, 3.0, 3.0], [2.0, 20.0, 1.0, 1.0], bindings.LINE_CENTERS)
    incoming, out, progress = (scratch_path(spark, n) for n in ("in", "out", "progress"))
    table.where("app_id % 2 = 0").write.parquet(incoming)

    def run():
        rows = read_feature_stream(spark, incoming, table.schema, files_per_trigger=1)
        write_scored(score_rows(rows, model), out, progress, once=True).awaitTermination()

    run()
    table.where("app_id % 2 = 1").write.mode("append").parquet(incoming)
    run()
    run()
    streamed = spark.read.schema(CLUSTERED_SCHEMA).parquet(out)
    batch = score_rows(table, model)
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))


@pytest.fixture(scope="module")
def run(spark, folder):
    settings = Settings(
        rules=bindings.LINE_SETTINGS.rules, ks=(2, 3, 4), k=3, notable_words=("ring",)
    )
    result = segment(
        bindings.line_events(spark, folder), bindings.part_metadata(spark, folder), settings
    )
    out = scratch_path(spark, "exports")
    listing = {r["table"]: r["rows"] for r in export(result, out, settings).collect()}
    return result, out, listing


def test_complete_run(spark, folder, run):
    result, out, listing = run
    table = QUERIES["feature_table"](spark, folder)
    assert result.clustered.drop("cluster_id").exceptAll(table).count() == 0
    n = table.count()
    assert listing["clustered_games"] == listing["plot_sample"] == listing["scatter_rows"] == n
    assert listing["elbow_cost"] == 3
    assert listing["cluster_sizes"] == listing["cluster_statistics"] == result.sizes.count()
    totals = result.totals.first()
    assert totals["raw_rows"] == totals["invalid_key"] + totals["invalid_measure"] + totals["kept_rows"]


def test_exports_read_back(spark, run):
    result, out, _ = run
    for name, schema, table in (
        ("clustered_games", CLUSTERED_SCHEMA, result.clustered),
        ("cluster_sizes", SIZES_SCHEMA, result.sizes),
        ("cluster_statistics", STATISTICS_SCHEMA, result.statistics),
        ("elbow_cost", SWEEP_SCHEMA, result.sweep),
    ):
        back = read_result_csv(spark, f"{out}/{name}", schema)
        assert sorted(map(tuple, back.collect())) == sorted(map(tuple, table.collect())), name
    checks = spark.read.option("header", True).csv(f"{out}/quality_checks").collect()
    failed = [r["check_name"] for r in checks if r["ok"] != "true"]
    assert failed in ([], ["best_k_is_top_silhouette"])


def test_report_and_dashboard(spark, run):
    result, out, _ = run
    lines = [r["value"] for r in spark.read.text(f"{out}/metrics_summary").collect()]
    assert lines[0] == "Clustering summary" and "Selected K: 3" in lines
    meta = spark.read.json(f"{out}/dashboard/cluster_meta").collect()
    assert len(meta) == result.sizes.count()
    assert all(1 <= len(r["representative"]) <= 5 for r in meta)
    summary = spark.read.json(f"{out}/dashboard/model_summary").first()
    assert summary["optimal_k"] == 3 and summary["clustered_games"] == result.clustered.count()
    assert SegmentModel.load(spark, f"{out}/model") == result.model


def test_bad_settings_fail_before_any_work(spark):
    for settings in (Settings(k=12), Settings(ks=(1, 2)), Settings(ks=())):
        with pytest.raises(ValueError):
            segment(None, None, settings)


def test_a_run_removes_its_intermediate_tables(spark, folder):
    """After a release, and after a failure in the middle."""
    def left():
        held = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{spark.sparkContext.applicationId}")
        files = held.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        return {str(f.getPath()) for f in files.listStatus(held)} if files.exists(held) else set()

    before = left()
    events, meta = bindings.line_events(spark, folder), bindings.part_metadata(spark, folder)
    settings = Settings(rules=bindings.LINE_SETTINGS.rules, ks=(2,), k=2)
    result = segment(events, meta, settings)
    assert left() > before
    result.release()
    assert left() == before
    spoilt = meta.withColumn("price", F.lit("NaN"))
    with pytest.raises(ValueError, match="NULL, NaN or infinite"):
        segment(events, spoilt, Settings(rules=settings.rules, ks=(2,), unusable="error"))
    assert left() == before


def test_a_run_survives_unusable_prices(spark, folder):
    events, meta = bindings.line_events(spark, folder), bindings.part_metadata(spark, folder)
    bad = F.element_at(F.array(*map(F.lit, ("NaN", "inf", "-1"))), F.pmod(F.length("appid"), F.lit(3)) + 1)
    spoilt = meta.withColumn("price", F.when(F.col("appid").endswith("7"), bad).otherwise(F.col("price")))
    result = segment(events, spoilt, Settings(rules=bindings.LINE_SETTINGS.rules, ks=(2,), k=2))
    assert result.unusable.first()[0] > 0
    assert result.clustered.where("cluster_id IS NULL").count() == 0
    result.release()
