"""Scalar functions: code lookups, date parts, casts. All built-in JVM expressions."""

from trip_star.functions.casts import (
    cast_timestamps_if_present,
    nan_to_null,
    normalise_float_keys,
    text_timestamps_if_present,
    timestamp_text,
    to_boolean,
)
from trip_star.functions.dates import date_parts, day, hour, month, parse_timestamp, weekday, year
from trip_star.functions.lookups import (
    PAYMENT_TYPE_NAMES,
    RATE_CODE_NAMES,
    STORE_AND_FWD_FLAG_VALUES,
    VENDOR_NAMES,
    decode,
    payment_type_name,
    rate_code_name,
    store_and_fwd_bool,
    vendor_name,
)

__all__ = [
    "PAYMENT_TYPE_NAMES",
    "RATE_CODE_NAMES",
    "STORE_AND_FWD_FLAG_VALUES",
    "VENDOR_NAMES",
    "cast_timestamps_if_present",
    "date_parts",
    "day",
    "decode",
    "hour",
    "month",
    "nan_to_null",
    "normalise_float_keys",
    "parse_timestamp",
    "payment_type_name",
    "rate_code_name",
    "store_and_fwd_bool",
    "text_timestamps_if_present",
    "timestamp_text",
    "to_boolean",
    "vendor_name",
    "weekday",
    "year",
]
