"""Command line: build the star from trip parquet and a zone CSV.

    spark-submit --py-files trip_star.zip trip_star/__main__.py --trips s3://bucket/trips/ --zones s3://bucket/zones.csv
    python -m trip_star --trips ... --zones ... [--head-rows 100000] [--watch CHECKPOINT]

Prints the load report. A star that is there already is brought up with its
files: appended to where only new last files came, else built anew. With
``--watch`` that happens when new trip files land (the stream's checkpoint folder is the argument).
"""

from __future__ import annotations

import argparse

from trip_star.plans.refresh import refresh_star
from trip_star.session import get_session
from trip_star.sources import read_zones_csv
from trip_star.streaming import rebuild_on_new_files


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="trip_star", description=__doc__.splitlines()[0])
    parser.add_argument("--trips", required=True, help="trip parquet file or folder")
    parser.add_argument("--zones", required=True, help="zone lookup CSV with a header")
    parser.add_argument("--database", default="trip_star", help="target database")
    parser.add_argument("--head-rows", type=int, default=None, help="model only the first N trips")
    parser.add_argument("--watch", metavar="CHECKPOINT", help="re-run whenever new trip files land")
    parser.add_argument("--master", default=None, help="Spark master (spark-submit sets it)")
    args = parser.parse_args(argv)

    spark = get_session(args.master)
    zones = read_zones_csv(spark, args.zones)
    if args.watch:
        query = rebuild_on_new_files(
            spark, args.trips, zones, args.database, args.watch, available_now=False,
            processing_time="1 minute", head_rows=args.head_rows,
        )
        query.awaitTermination()
        return
    report, done = refresh_star(spark, args.trips, zones, args.database, head_rows=args.head_rows)
    print({"none": "Nothing new", "append": "Appended the new files", "build": "Built all tables"}[done])
    for row in report.collect():  # eleven rows
        print(f"Loaded {row['n_rows']} rows and {row['n_cols']} columns to {args.database}.{row['table_name']}")
