"""Casts and value normalisation used before grouping or joining on keys."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def nan_to_null(col: Column | str) -> Column:
    """NaN and null are one "missing" value in the reference; Spark keeps them apart."""
    c = F.col(col) if isinstance(col, str) else col
    return F.nanvl(c, F.lit(None).cast("double"))


def timestamp_text(col: Column | str) -> Column:
    """Per-value text of a timestamp: always shows the time, keeps fractions.

    ``cast(... as string)`` of a zone-less timestamp does not depend on the
    session time zone (``date_format`` would).
    """
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("string")


def to_boolean(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("boolean")


def cast_timestamps_if_present(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Parse each listed column to a zone-less timestamp, skipping absent ones."""
    types = {f.name: f.dataType for f in df.schema.fields}
    updates = {}
    for name in columns:
        dtype = types.get(name)
        if dtype is None or isinstance(dtype, T.TimestampNTZType):
            continue
        updates[name] = F.to_timestamp_ntz(F.col(name))
    return df.withColumns(updates) if updates else df


def text_timestamps_if_present(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: timestamp_text(c) for c in present}) if present else df


def normalise_float_keys(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Map NaN -> null in the listed double columns that exist."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: nan_to_null(c) for c in present}) if present else df
