"""The ten dimensions of the trip star.

Each dimension is configuration: its natural key, its id column, the public
column order and how the public columns are derived. Building one is

    key index  = first_seen_ids(trips, keys, id, counts=True)   # keys, id, __rows
    public     = decorate(key index)                          # names, parts, zones

The key index (typed keys, id, per-key row count) is what the fact joins to;
the public frame is what is written to the warehouse.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trip_star.functions.casts import timestamp_text
from trip_star.functions.dates import date_parts
from trip_star.functions.lookups import (
    payment_type_name,
    rate_code_name,
    store_and_fwd_bool,
    vendor_name,
)
from trip_star.operators.dedupe import distinct_rows
from trip_star.operators.joins import attach_id
from trip_star.operators.keys import DEFAULT_BUCKET_ROWS, first_seen_ids
from trip_star.schemas import DROPOFF_TS, FARE_COLUMNS, PICKUP_TS, ROW_POS


@dataclass(frozen=True)
class DimSpec:
    table: str
    id_col: str
    keys: tuple[str, ...]
    columns: tuple[str, ...]
    # May hold about as many rows as the fact: joined through the skew-safe
    # shuffled path rather than left to a broadcast.
    large: bool = False
    needs_zones: bool = False


def _datetime_columns(index: DataFrame, zones: DataFrame | None) -> DataFrame:
    parts = {**date_parts(PICKUP_TS, "pickup"), **date_parts(DROPOFF_TS, "dropoff")}
    return index.withColumns(parts).withColumns(
        {PICKUP_TS: timestamp_text(PICKUP_TS), DROPOFF_TS: timestamp_text(DROPOFF_TS)}
    )


def _location_columns(key: str, prefix: str) -> Callable[[DataFrame, DataFrame | None], DataFrame]:
    def derive(index: DataFrame, zones: DataFrame | None) -> DataFrame:
        if zones is None:
            raise ValueError(f"{prefix} locations need the zone lookup")
        lookup = zones.select(
            "LocationID",
            F.col("zone").alias(f"{prefix}_location_zone"),
            F.col("borough").alias(f"{prefix}_location_borough"),
        )
        # A left merge to the de-duplicated lookup; a lookup with a repeated
        # LocationID would repeat dimension rows (the build checks it first).
        return attach_id(
            index,
            lookup,
            [key],
            "LocationID",
            dim_keys=["LocationID"],
            carry=[f"{prefix}_location_zone", f"{prefix}_location_borough"],
        )

    return derive


DERIVE: dict[str, Callable[[DataFrame, DataFrame | None], DataFrame]] = {
    "datetimes": _datetime_columns,
    "rate_codes": lambda d, z: d.withColumn("rate_code_name", rate_code_name("RatecodeID")),
    "payment_types": lambda d, z: d.withColumn("payment_type_name", payment_type_name("payment_type")),
    "dropoff_locations": _location_columns("DOLocationID", "dropoff"),
    "pickup_locations": _location_columns("PULocationID", "pickup"),
    "trip_distances": lambda d, z: d,
    "passenger_counts": lambda d, z: d,
    "vendors": lambda d, z: d.withColumn("vendor_name", vendor_name("VendorID")),
    "fares": lambda d, z: d,
    "store_and_forward_flags": lambda d, z: d.withColumn(
        "store_and_forward_bool", store_and_fwd_bool("store_and_fwd_flag")
    ),
}

DATETIMES = DimSpec(
    "datetimes",
    "datetime_id",
    (PICKUP_TS, DROPOFF_TS),
    (
        "datetime_id",
        PICKUP_TS,
        "pickup_year",
        "pickup_month",
        "pickup_day",
        "pickup_weekday",
        DROPOFF_TS,
        "dropoff_year",
        "dropoff_month",
        "dropoff_day",
        "dropoff_weekday",
    ),
    large=True,
)
RATE_CODES = DimSpec(
    "rate_codes", "rate_code_id", ("RatecodeID",), ("rate_code_id", "RatecodeID", "rate_code_name")
)
PAYMENT_TYPES = DimSpec(
    "payment_types",
    "payment_type_id",
    ("payment_type",),
    ("payment_type_id", "payment_type", "payment_type_name"),
)
DROPOFF_LOCATIONS = DimSpec(
    "dropoff_locations",
    "dropoff_location_id",
    ("DOLocationID",),
    ("dropoff_location_id", "DOLocationID", "dropoff_location_zone", "dropoff_location_borough"),
    needs_zones=True,
)
PICKUP_LOCATIONS = DimSpec(
    "pickup_locations",
    "pickup_location_id",
    ("PULocationID",),
    ("pickup_location_id", "PULocationID", "pickup_location_zone", "pickup_location_borough"),
    needs_zones=True,
)
TRIP_DISTANCES = DimSpec(
    "trip_distances", "trip_distance_id", ("trip_distance",), ("trip_distance_id", "trip_distance")
)
PASSENGER_COUNTS = DimSpec(
    "passenger_counts",
    "passenger_count_id",
    ("passenger_count",),
    ("passenger_count_id", "passenger_count"),
)
VENDORS = DimSpec("vendors", "vendor_id", ("VendorID",), ("vendor_id", "VendorID", "vendor_name"))
FARES = DimSpec("fares", "fare_id", FARE_COLUMNS, ("fare_id", *FARE_COLUMNS), large=True)
STORE_AND_FORWARD_FLAGS = DimSpec(
    "store_and_forward_flags",
    "store_and_forward_id",
    ("store_and_fwd_flag",),
    ("store_and_forward_id", "store_and_forward_bool", "store_and_fwd_flag"),
)

# Fixed values above: table names, id names and column order are the output contract.
# Table order of the reference pipeline.
DIMENSIONS: tuple[DimSpec, ...] = (
    DATETIMES,
    RATE_CODES,
    PAYMENT_TYPES,
    DROPOFF_LOCATIONS,
    PICKUP_LOCATIONS,
    TRIP_DISTANCES,
    PASSENGER_COUNTS,
    VENDORS,
    FARES,
    STORE_AND_FORWARD_FLAGS,
)
BY_TABLE = {spec.table: spec for spec in DIMENSIONS}


def key_index(
    trips: DataFrame, spec: DimSpec, bucket_rows: int = DEFAULT_BUCKET_ROWS, order_col: str = ROW_POS
) -> DataFrame:
    """Typed natural key, first-seen id and per-key row count (``__rows``)."""
    return first_seen_ids(
        trips.select(order_col, *spec.keys),
        list(spec.keys),
        spec.id_col,
        order_col=order_col,
        bucket_rows=bucket_rows,
        counts=True,
    )


def public_columns(spec: DimSpec, index: DataFrame, zones: DataFrame | None = None) -> DataFrame:
    """The dimension as written: decoded names, date parts, zone names, in reference order."""
    return DERIVE[spec.table](index, zones).select(*spec.columns)


def dimension(
    trips: DataFrame,
    spec: DimSpec | str,
    zones: DataFrame | None = None,
    bucket_rows: int = DEFAULT_BUCKET_ROWS,
) -> DataFrame:
    """Build one public dimension from trips (and the raw zone lookup if needed)."""
    spec = BY_TABLE[spec] if isinstance(spec, str) else spec
    lookup = distinct_rows(zones, order_col=None) if (spec.needs_zones and zones is not None) else zones
    return public_columns(spec, key_index(trips, spec, bucket_rows), lookup)
