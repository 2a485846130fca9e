"""Code lookups: literal code -> name maps, evaluated as JVM map expressions."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# These code maps must equal the reference's for right results.
RATE_CODE_NAMES = {
    1: "Standard rate",
    2: "JFK",
    3: "Newark",
    4: "Nassau or Westchester",
    5: "Negotiated fare",
    6: "Group ride",
}
PAYMENT_TYPE_NAMES = {
    1: "Credit Card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}
VENDOR_NAMES = {
    1: "Creative Mobile Technologies",
    2: "VeriFone Inc",
}
STORE_AND_FWD_FLAG_VALUES = {
    "N": 0,
    "Y": 1,
}


def literal_map(mapping: Mapping) -> Column:
    """A constant map column; Catalyst folds it to one literal per plan."""
    return F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items()))


def decode(col: Column | str, mapping: Mapping) -> Column:
    """Look a code up in ``mapping``; a code that is missing (or null) gives null."""
    key = F.col(col) if isinstance(col, str) else col
    return F.try_element_at(literal_map(mapping), key)


def rate_code_name(col: Column | str) -> Column:
    return decode(col, RATE_CODE_NAMES)


def payment_type_name(col: Column | str) -> Column:
    return decode(col, PAYMENT_TYPE_NAMES)


def vendor_name(col: Column | str) -> Column:
    return decode(col, VENDOR_NAMES)


def store_and_fwd_bool(col: Column | str) -> Column:
    """'N' -> false, 'Y' -> true, anything else -> null (map, then 0/1 to boolean)."""
    return decode(col, STORE_AND_FWD_FLAG_VALUES).cast("boolean")
