"""Declared schemas of the two inputs: taxi trips and the zone lookup."""

from __future__ import annotations

from pyspark.sql import types as T

ROW_POS = "row_pos"

PICKUP_TS = "tpep_pickup_datetime"
DROPOFF_TS = "tpep_dropoff_datetime"

FARE_COLUMNS = (
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
    "congestion_surcharge",
    "airport_fee",
)

TRIPS = T.StructType(
    [
        T.StructField("VendorID", T.IntegerType()),
        T.StructField(PICKUP_TS, T.TimestampNTZType()),
        T.StructField(DROPOFF_TS, T.TimestampNTZType()),
        T.StructField("passenger_count", T.IntegerType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("RatecodeID", T.IntegerType()),
        T.StructField("store_and_fwd_flag", T.StringType()),
        T.StructField("PULocationID", T.LongType()),
        T.StructField("DOLocationID", T.LongType()),
        T.StructField("payment_type", T.IntegerType()),
    ]
    + [T.StructField(c, T.DoubleType()) for c in FARE_COLUMNS]
)

TRIP_COLUMNS = tuple(f.name for f in TRIPS.fields)
TIMESTAMP_COLUMNS = (PICKUP_TS, DROPOFF_TS)
FLOAT_COLUMNS = tuple(f.name for f in TRIPS.fields if isinstance(f.dataType, T.DoubleType))

ZONES = T.StructType(
    [
        T.StructField("LocationID", T.LongType()),
        T.StructField("borough", T.StringType()),
        T.StructField("zone", T.StringType()),
    ]
)
ZONE_COLUMNS = tuple(f.name for f in ZONES.fields)
