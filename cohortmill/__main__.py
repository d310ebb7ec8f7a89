"""Command line: read two tables, segment, write all exports."""

from __future__ import annotations

import argparse

from cohortmill.plans.segmentation import Settings, publish, segment
from cohortmill.session import get_session
from cohortmill.sources.multiline import read_multiline_csv
from cohortmill.sources.tables import read_csv_by_header


def main() -> None:
    parser = argparse.ArgumentParser(prog="cohortmill", description=__doc__)
    parser.add_argument("--events", required=True, help="event table, .parquet or CSV with a header")
    parser.add_argument("--metadata", required=True, help="metadata table, .parquet or CSV")
    parser.add_argument("--out", required=True, help="folder for the exports; its manifests list the committed ones")
    parser.add_argument("--format", choices=("csv", "parquet"), default="csv")
    parser.add_argument("--events-multiline", action="store_true")
    parser.add_argument("--k", type=int, default=None, help="default: best silhouette")
    parser.add_argument("--duplicates", choices=("first", "keep"), default="first")
    parser.add_argument("--master", default=None)
    args = parser.parse_args()

    spark = get_session(master=args.master)
    if args.format == "csv":
        read_events = read_multiline_csv if args.events_multiline else read_csv_by_header
        events, meta = read_events(spark, args.events), read_multiline_csv(spark, args.metadata)
    else:
        events, meta = spark.read.parquet(args.events), spark.read.parquet(args.metadata)
    settings = Settings(k=args.k, duplicates=args.duplicates)
    publish(segment(events, meta, settings), args.out, settings).show(50, truncate=False)


if __name__ == "__main__":
    main()
