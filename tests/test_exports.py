"""Counted writes and committed sets of tables."""

import pytest
from pyspark.sql import functions as F

from cohortmill.operators import sinks
from cohortmill.plans import bindings
from cohortmill.plans.segmentation import Settings, export, publish, segment
from cohortmill.sources.tables import read_csv_by_header
from cohortmill.storage import scratch_path

WRITERS = [sinks.write_csv, sinks.write_json_lines, sinks.write_parquet]


@pytest.mark.parametrize("write", WRITERS)
@pytest.mark.parametrize("rows", [0, 1, 5000])
def test_writers_count_what_they_write(spark, write, rows):
    table = spark.range(rows).select("id", F.lit('two\nlines, "quoted"').alias("text")).repartition(7)
    assert write(table, scratch_path(spark, "counted")) == rows
    assert write(table.where("id % 2 = 0").orderBy("id"), scratch_path(spark, "counted")) == (rows + 1) // 2
    if write is not sinks.write_parquet:
        assert write(table, scratch_path(spark, "counted"), True) == rows


def test_nothing_is_read_again(spark, monkeypatch):
    """The listing comes from the writes alone: with the files gone it is the same."""
    store = sinks.ExportStore(spark, scratch_path(spark, "store"))
    run = store.new_run()
    written = [sinks.Written("a", sinks.write_csv(spark.range(9), f"{run}/a"), f"{run}/a")]
    store._files.delete(store._path(run), True)
    assert [tuple(r) for r in store.manifest(store.commit(written)).collect()] == [("a", 9, f"{run}/a")]


def test_a_set_becomes_visible_at_once_and_a_dead_run_changes_nothing(spark):
    store = sinks.ExportStore(spark, scratch_path(spark, "store"))
    assert store.manifest().collect() == [] and store.numbers() == []

    def write(n):
        run = store.new_run()
        for name in ("a", "b"):
            yield sinks.Written(name, sinks.write_csv(spark.range(n), f"{run}/{name}"), f"{run}/{name}")

    first = store.commit(list(write(3)))
    dying = write(5)
    next(dying)  # one of two tables is written, then the run dies
    assert {r["table"]: r["rows"] for r in store.manifest().collect()} == {"a": 3, "b": 3}
    assert read_csv_by_header(spark, store.path("a")).count() == 3
    # A commit that died before the renaming leaves a file no reader looks at.
    stream = store._files.create(store._path(f"{store.folder}/manifests/.half"), False)
    stream.write(bytearray(b'{"table": "a", "ro'))
    stream.close()
    assert store.numbers() == [first]
    second = store.commit(list(write(7)))
    assert second == first + 1 and store.numbers() == [second, first]
    assert {r["table"]: r["rows"] for r in store.manifest().collect()} == {"a": 7, "b": 7}
    assert read_csv_by_header(spark, store.path("b", first)).count() == 3
    with pytest.raises(KeyError):
        store.path("c")
    # Only runs without a manifest go; with one manifest to keep, the older set goes too.
    assert store.remove_unlisted() == 1 and read_csv_by_header(spark, store.path("b", first)).count() == 3
    assert store.remove_unlisted(keep=1) == 1 and read_csv_by_header(spark, store.path("b")).count() == 7


def test_a_taken_number_is_left_to_the_other_run(spark):
    store = sinks.ExportStore(spark, scratch_path(spark, "store"))
    written = [sinks.Written("a", 1, "x")]
    assert [store.commit(written) for _ in range(3)] == [1, 2, 3]


def test_a_whole_run_is_published(spark, folder):
    settings = Settings(rules=bindings.LINE_SETTINGS.rules, ks=(2, 3))
    result = segment(bindings.line_events(spark, folder), bindings.part_metadata(spark, folder), settings)
    try:
        root = scratch_path(spark, "published")
        listed = publish(result, root, settings).collect()
        again = export(result, scratch_path(spark, "exports"), settings).collect()
        assert [(r["table"], r["rows"]) for r in listed] == [(r["table"], r["rows"]) for r in again]
        for row in listed:
            read = spark.read.json(row["path"]) if row["table"].startswith("dashboard/") else read_csv_by_header(spark, row["path"], True)
            assert read.count() == row["rows"], row["table"]
        names = {r["table"] for r in listed}
        assert {"clustered_games", "cluster_statistics", "dashboard/games", "dashboard/cluster_meta"} <= names
    finally:
        result.release()
