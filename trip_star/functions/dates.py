"""Date functions on zone-less timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_timestamp(col: Column | str) -> Column:
    """Text or timestamp -> zone-less timestamp (wall clock kept as is)."""
    return F.to_timestamp_ntz(_c(col))


def year(col: Column | str) -> Column:
    return F.year(_c(col)).cast("int")


def month(col: Column | str) -> Column:
    return F.month(_c(col)).cast("int")


def day(col: Column | str) -> Column:
    return F.dayofmonth(_c(col)).cast("int")


def weekday(col: Column | str) -> Column:
    """Day of week with Monday = 0 ... Sunday = 6."""
    return F.weekday(_c(col)).cast("int")


def hour(col: Column | str) -> Column:
    return F.hour(_c(col)).cast("int")


def date_parts(col: str, prefix: str) -> dict[str, Column]:
    """``{prefix}_year/_month/_day/_weekday`` for one timestamp column."""
    return {
        f"{prefix}_year": year(col),
        f"{prefix}_month": month(col),
        f"{prefix}_day": day(col),
        f"{prefix}_weekday": weekday(col),
    }
