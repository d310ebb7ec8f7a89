"""States kept by a stream against the batch over the same files: steps, restarts, snapshots, late events."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortmill.operators import cleaning, entities
from cohortmill.operators.scoring import make_model
from cohortmill.plans import workload
from cohortmill.plans.segmentation import Settings, entity_feature_table
from cohortmill.storage import scratch_path
from cohortmill.streaming import entities as streamed

SCHEMA = "app_id string, app_name string, recommended string, `author.playtime_forever` string, happened timestamp"
DAY = dt.datetime(2024, 1, 1)
SETTINGS = Settings(min_popularity=3)


def event(key, day=0, name="n", flag="True", minutes="60"):
    return (key, name, flag, minutes, DAY + dt.timedelta(days=day))


@pytest.fixture
def place(spark):
    return {k: scratch_path(spark, k) for k in ("incoming", "states", "progress", "scores")}


def land(spark, place, rows, name):
    """One file of events."""
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(place["incoming"])


def run(spark, place, time="happened", each=None, **more):
    schema = spark.createDataFrame([], SCHEMA).schema
    stream = streamed.read_event_stream(spark, place["incoming"], schema, files_per_trigger=1)
    states = streamed.running_states(stream, SETTINGS, time, **more)
    streamed.write_states(states, place["states"], place["progress"], each, once=True).awaitTermination()


def batch(spark, place):
    raw = spark.read.parquet(place["incoming"])
    return entities.entity_states(cleaning.typed_events(raw, SETTINGS.events, SETTINGS.rules), SETTINGS.rules)


def rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


FILES = [
    [event("1"), event("1", 1, "a", "False", "30"), event("2", 2), event("x"), event(None, 3), event("1", 0, "z", None, "bad")],
    [event("1", 2), event("3", 5, None), event("1", 1)],
    [event("2", 6, "b", "true", "600001"), event("2", 4, "b", "true", "7"), event("3", 5), event("3", 5)],
]


@pytest.mark.parametrize("time", [None, "happened"])
def test_every_step_and_a_restart_equal_the_batch(spark, place, time):
    for i, file in enumerate(FILES):
        land(spark, place, file, f"f{i}")
        # Each call is a new query on the same checkpoint.
        run(spark, place, time, delay="100 days")
        assert rows(streamed.current_states(spark, place["states"])) == rows(batch(spark, place))
    run(spark, place, time, delay="100 days")  # nothing new
    assert rows(streamed.current_states(spark, place["states"])) == rows(batch(spark, place))


def test_all_files_in_one_run_and_snapshots(spark, place, monkeypatch):
    monkeypatch.setattr(streamed, "SNAPSHOT_EVERY", 2)
    for i, file in enumerate(FILES * 2):
        land(spark, place, file, f"f{i}")
    run(spark, place, delay="100 days")
    assert streamed._exists(spark, f"{place['states']}/snapshots/upto=3/_SUCCESS")
    assert rows(streamed.current_states(spark, place["states"])) == rows(batch(spark, place))


def test_a_trigger_that_runs_again_counts_once(spark, place):
    """A failure after the rows were written: the same trigger is run again and overwrites them."""
    land(spark, place, FILES[0], "f0")
    failed = []

    def each(spark, trigger):
        if not failed:
            failed.append(trigger)
            raise RuntimeError("planned failure")

    with pytest.raises(Exception, match="planned failure"):
        run(spark, place, None, each)
    land(spark, place, FILES[1], "f1")
    run(spark, place, None, each)
    assert failed and rows(streamed.current_states(spark, place["states"])) == rows(batch(spark, place))


def test_closed_windows_turn_late_events_away(spark, place):
    land(spark, place, [event("1", 0), event("2", 0)], "f0")
    run(spark, place, delay="1 day")
    land(spark, place, [event("1", 10)], "f1")
    run(spark, place, delay="1 day")
    before = rows(streamed.current_states(spark, place["states"]))
    land(spark, place, [event("2", 0)], "f2")  # its window is closed
    run(spark, place, delay="1 day")
    assert rows(streamed.current_states(spark, place["states"])) == before
    land(spark, place, [event("2", 10)], "f3")
    run(spark, place, delay="1 day")
    counts = {r.app_id: r.raw_reviews for r in streamed.current_states(spark, place["states"]).collect()}
    assert counts == {1: 2, 2: 2}


def test_changed_entities_are_scored(spark, place):
    meta = spark.createDataFrame([("1", "one", "5"), ("2", "two", "free")], "appid string, name string, price string")
    model = make_model(SETTINGS.features, [0.0] * 4, [1.0] * 4, [[0.0] * 4, [0.0, 100.0, 1.0, 1.0]])
    each = streamed.scored_changes(place["states"], place["scores"], meta, model, SETTINGS)
    for i, file in enumerate(FILES):
        land(spark, place, file, f"f{i}")
        run(spark, place, None, each)
    raw = spark.read.parquet(place["incoming"])
    whole = model.score(entity_feature_table(raw, meta, SETTINGS))
    want = whole.select(*streamed.current_scores(spark, place["scores"]).columns)
    assert rows(streamed.current_scores(spark, place["scores"])) == rows(want) and want.count() == 2
    third = spark.read.parquet(place["scores"]).where(F.col("trigger") == 2)
    assert {r.app_id for r in third.collect()} <= {2, 3}


def test_nothing_written_yet(spark, place):
    with pytest.raises(ValueError, match="nothing was written"):
        streamed.current_states(spark, place["states"])


def test_event_files_grow_in_number_and_not_in_size(spark, folder, monkeypatch):
    """Each of the four triggers takes several files, and none holds a quarter of the events."""
    read, seen = streamed.read_event_stream, {}

    def noted(spark, path, schema, files_per_trigger):
        seen.update(path=path, files=files_per_trigger)
        return read(spark, path, schema, files_per_trigger)

    monkeypatch.setattr(workload, "read_event_stream", noted)
    monkeypatch.setattr(workload, "FILE_EVENTS", 200, raising=False)
    path = workload.streamed_lines(spark, folder, "happened")
    per_file = spark.read.parquet(seen["path"]).groupBy(F.input_file_name()).count().collect()
    assert max(r["count"] for r in per_file) < 600 and len(per_file) <= 4 * seen["files"]
    assert streamed.last_trigger(spark, path) == 3
    got = streamed.state_features(streamed.current_states(spark, path), workload.bindings.part_metadata(spark, folder), workload.LINES)
    assert rows(got) == rows(workload.line_features(spark, folder))


def test_states_lie_in_rocksdb_unless_the_session_says_otherwise(spark, place):
    name = "spark.sql.streaming.stateStore.providerClass"
    assert spark.conf.get(name, None) is None

    def store():
        return "".join(r.value for r in spark.read.text(f"{place['progress']}/offsets/0").collect())

    land(spark, place, FILES[0], "f0")
    run(spark, place, None)
    assert "RocksDBStateStoreProvider" in store() and spark.conf.get(name, None) is None
    given = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    place |= {k: scratch_path(spark, k) for k in ("states", "progress")}
    spark.conf.set(name, given)
    try:
        run(spark, place, None)
        assert given in store() and spark.conf.get(name) == given
    finally:
        spark.conf.unset(name)
    assert rows(streamed.current_states(spark, place["states"])) == rows(batch(spark, place))
