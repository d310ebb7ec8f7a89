"""Entity features that grow as events arrive.

The stream's state store holds one row per entity, or per entity and window of event time; the
watermark then closes windows, drops their state and turns later events away.  Each trigger
writes the rows that changed to a folder of its own, which a repeated trigger writes again, so
an event counts once however often a trigger runs.  Rows of all windows of an entity are states
that merge (``entities.merge_states``): an entity's totals need no event and no open state.

Layout under ``path``: ``changes/trigger=N`` has the rows of one trigger, ``snapshots/upto=N`` the
newest row of every entity and window up to a trigger.  Both folders and the stream's checkpoint belong on
shared storage.

States grow with the entities, so they lie in RocksDB on the executors' disks, not on their heaps, unless the
session names a store itself.  A checkpoint keeps the store it began with.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cohortmill.operators import cleaning, entities, features, metadata
from cohortmill.operators.scoring import SegmentModel, clustered_table
from cohortmill.plans.segmentation import Settings
from cohortmill.storage import held

#: Triggers between two snapshots; a reader merges at most as many folders of changes.
SNAPSHOT_EVERY = 20
WINDOW = "window_start"
_STORE = "spark.sql.streaming.stateStore."
STORE_SETTINGS = {
    _STORE + "providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    _STORE + "rocksdb.boundedMemoryUsage": "true",  # all partitions of an executor together
}


@contextmanager
def _store_settings(spark: SparkSession) -> Iterator[None]:
    """A stream takes the settings of the session when it starts; what the session sets itself stays."""
    added = {} if spark.conf.get(_STORE + "providerClass", None) else STORE_SETTINGS
    before = {name: spark.conf.get(name, None) for name in added}
    for name, value in added.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def read_event_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None
) -> DataFrame:
    """Raw events from the Parquet files that land in a folder."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def running_states(
    events: DataFrame,
    settings: Settings = Settings(),
    time: str | None = None,
    window: str = "1 day",
    delay: str = "1 day",
) -> DataFrame:
    """The state of each entity so far, as a streaming aggregate for update mode.

    With ``time``, a column of event times, there is a state per entity and ``window``.  A window that ended
    more than ``delay`` before the newest event is closed: its state leaves the store, and
    events that still arrive for it are dropped, as are events without a time.  Without ``time`` every
    entity keeps its state.
    """
    kept = cleaning.has_key() & cleaning.has_measure(settings.rules)
    if time is None:
        typed, groups = cleaning.typed_events(events, settings.events, settings.rules), ["app_id"]
    else:
        # A time without a zone is one of the session's zone.
        timed = events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)
        typed = cleaning.typed_events(timed, settings.events, settings.rules, keep=(time,))
        groups = ["app_id", F.window(time, window)]
    states = typed.groupBy(*groups).agg(
        F.min(F.when(kept, F.col("app_name"))).alias("review_app_name"),
        F.count(F.lit(1)).alias("raw_reviews"),
        F.count_if(kept).alias("total_reviews"),
        F.coalesce(F.sum(F.when(kept, F.col("is_recommended"))), F.lit(0)).alias("positive_reviews"),
        F.sum(F.when(kept, F.col("playtime_forever"))).alias("minutes"),
    )
    start = F.lit(None).cast("timestamp") if time is None else F.col("window.start")
    return states.withColumn(WINDOW, start).drop("window")


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def _newest(rows: DataFrame) -> DataFrame:
    """The last row of every entity and window; numbers alone are the buffers of the first aggregate."""
    last = rows.groupBy(F.col("app_id").alias("_id"), F.col(WINDOW).alias("_window")).agg(F.max("trigger").alias("_last"))
    same = F.col("app_id").eqNullSafe(F.col("_id")) & F.col(WINDOW).eqNullSafe(F.col("_window"))
    return rows.join(last, same & (F.col("trigger") == F.col("_last")), "left_semi")


def _last_snapshot(spark: SparkSession, path: str, upto: int) -> int:
    """The newest complete snapshot up to a trigger, -1 without any."""
    complete = (n for n in range(upto, -1, -1) if (n + 1) % SNAPSHOT_EVERY == 0)
    return next((n for n in complete if _exists(spark, f"{path}/snapshots/upto={n}/_SUCCESS")), -1)


def _rows(spark: SparkSession, path: str, upto: int) -> DataFrame:
    """Newest row of every entity and window as of trigger ``upto``."""
    snapshot = _last_snapshot(spark, path, upto)
    later = [f"{path}/changes/trigger={n}" for n in range(snapshot + 1, upto + 1)]
    later = [folder for folder in later if _exists(spark, f"{folder}/_SUCCESS")]
    if not later:
        return spark.read.parquet(f"{path}/snapshots/upto={snapshot}")
    changes = spark.read.option("basePath", f"{path}/changes").parquet(*later)
    if snapshot < 0:
        return _newest(changes)
    return _newest(spark.read.parquet(f"{path}/snapshots/upto={snapshot}").unionByName(changes))


def last_trigger(spark: SparkSession, path: str) -> int:
    """The last trigger that was written, -1 before the first."""
    if not _exists(spark, f"{path}/changes"):
        return -1
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/changes")
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(at)
    names = [f.getPath().getName() for f in files]
    numbers = sorted((int(n.partition("=")[2]) for n in names if n.startswith("trigger=")), reverse=True)
    return next((n for n in numbers if _exists(spark, f"{path}/changes/trigger={n}/_SUCCESS")), -1)


def current_states(spark: SparkSession, path: str, upto: int | None = None) -> DataFrame:
    """One state per entity, over all its windows, as of a trigger or of the last one."""
    upto = last_trigger(spark, path) if upto is None else upto
    if upto < 0:
        raise ValueError(f"nothing was written under {path} yet")
    return entities.merge_states([_rows(spark, path, upto).drop(WINDOW, "trigger")])


def state_features(states: DataFrame, meta: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Feature rows of states, as ``entity_feature_table`` gives them for the same events."""
    per_entity = entities.entity_features(entities.kept_entities(entities.finished_states(states)))
    typed_meta = cleaning.clean_metadata(meta, settings.metadata, settings.rules.key_type)
    joined = metadata.attach_metadata(per_entity, typed_meta, settings.duplicates, settings.fanout_salts)
    return features.feature_table(joined, settings.min_popularity)


def scored_changes(path: str, scored: str, meta: DataFrame, model: SegmentModel, settings: Settings = Settings()):
    """For ``write_states``: scores the entities that a trigger changed, into a folder of that trigger."""

    def each(spark: SparkSession, trigger: int) -> None:
        changed = spark.read.parquet(f"{path}/changes/trigger={trigger}").select(F.col("app_id").alias("changed_id")).distinct()
        states = current_states(spark, path, trigger)
        states = states.join(changed, F.col("app_id").eqNullSafe(F.col("changed_id")), "left_semi")
        table = clustered_table(model.score(state_features(states, meta, settings)))
        table.write.mode("overwrite").parquet(f"{scored}/trigger={trigger}")

    return each


def current_scores(spark: SparkSession, scored: str) -> DataFrame:
    """The newest scored rows of every entity.  Counts never fall, so a scored entity stays scored."""
    rows = spark.read.parquet(scored)
    last = rows.groupBy("app_id").agg(F.max("trigger").alias("trigger"))
    return rows.join(last, ["app_id", "trigger"], "left_semi").drop("trigger")


def write_states(
    states: DataFrame,
    path: str,
    checkpoint: str,
    each: Callable[[SparkSession, int], None] | None = None,
    once: bool = False,
    interval: str = "1 minute",
) -> StreamingQuery:
    """Write what every trigger changed, and call ``each`` with its number.

    A trigger that runs again after a failure overwrites its own folders, so nothing counts twice.  ``once`` takes
    everything that is there in bounded steps and stops.
    """

    def trigger(changed: DataFrame, number: int) -> None:
        spark = changed.sparkSession
        with held(changed) as rows:
            # A trigger that only moves the watermark changes nothing.
            if rows.isEmpty():
                return
            rows.write.mode("overwrite").parquet(f"{path}/changes/trigger={number}")
        if (number + 1) % SNAPSHOT_EVERY == 0:
            _rows(spark, path, number).write.mode("overwrite").parquet(f"{path}/snapshots/upto={number}")
        if each is not None:
            each(spark, number)

    writer = states.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(trigger)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)
    with _store_settings(states.sparkSession):
        return writer.start()
