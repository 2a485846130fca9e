"""Sources: parquet trips with row positions, the CSV zone lookup, catalog tables,
and the trip-shaped fixture views over the driver tables."""

from trip_star.sources.csv import read_zones_csv
from trip_star.sources.fixtures import fixture_trips, fixture_zones_raw, table
from trip_star.sources.footers import file_profile, file_row_count, footer_counts, trip_files_profile
from trip_star.sources.parquet import (
    conform,
    head_slice,
    prepare_trips,
    preview,
    read_trips,
    with_row_pos,
)
from trip_star.sources.tables import Pin, pin, qualified, read_table

__all__ = [
    "Pin",
    "conform",
    "file_profile",
    "file_row_count",
    "fixture_trips",
    "fixture_zones_raw",
    "footer_counts",
    "head_slice",
    "pin",
    "prepare_trips",
    "preview",
    "qualified",
    "read_table",
    "read_trips",
    "read_zones_csv",
    "table",
    "trip_files_profile",
    "with_row_pos",
]
