"""Seconds of the job's parts over many event files with a hot key; prints one JSON line.

The events are the order lines of $BENCH_SF_DIR, each ``--copies`` times over with keys of
their own, a third of all rows on one key.  They are written once as Parquet, 64 files, to a
folder of the session's shared storage, which is removed at the end.
"""

from __future__ import annotations

import argparse
import json
import os
import time

from pyspark.sql import functions as F

from cohortmill.operators.clustering import k_sweep
from cohortmill.operators.features import feature_names, with_features
from cohortmill.operators.scaling import fit_standardizer, scaled_names, standardize
from cohortmill.plans import bindings
from cohortmill.plans.segmentation import entity_feature_table, export, segment
from cohortmill.session import get_session
from cohortmill.storage import Scratch, materialize


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--copies", type=int, default=20)
    copies = parser.parse_args().copies
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "bench-events",
        master=f"local[{cpus}]",
        settings={"spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"},
        log_level="ERROR",
        initial_partitions=4 * int(cpus),
    )
    settings = bindings.LINE_SETTINGS
    scratch = Scratch(spark)
    seconds: dict[str, float] = {}

    def timed(name: str, work):
        start = time.perf_counter()
        result = work()
        seconds[name] = round(time.perf_counter() - start, 2)
        return result

    try:
        lines = bindings.line_events(spark, folder).repartition(64)
        copied = lines.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
        key = F.when(F.xxhash64("app_id", "copy", "app_name") % 3 == 0, "1").otherwise(
            F.concat(F.col("copy").cast("string"), F.lpad("app_id", 7, "0"))
        )
        events = materialize(copied.withColumn("app_id", key).drop("copy"), "events", scratch)
        meta = bindings.part_metadata(spark, folder)
        rows = events.count()
        table = timed(
            "feature_table",
            lambda: materialize(entity_feature_table(events, meta, settings), "feature-table", scratch),
        )
        names = feature_names(settings.features)
        inputs = with_features(table, settings.features)
        scaled = standardize(inputs, fit_standardizer(inputs, names))
        timed("k_sweep", lambda: k_sweep(scaled, scaled_names(names), ("app_id", "game_name", "price")))

        def full_run():
            result = segment(events, meta, settings)
            try:
                export(result, scratch.path("exports"), settings).collect()
            finally:
                result.release()

        timed("full_run", full_run)
        print(json.dumps({"event_rows": rows, "entities": table.count(), "seconds": seconds, "cpus": int(cpus)}))
    finally:
        scratch.release()


if __name__ == "__main__":
    main()
