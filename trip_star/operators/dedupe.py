"""Duplicate handling: distinct rows in first-seen order, the duplicate mask and count."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trip_star.functions.casts import nan_to_null
from trip_star.operators.joins import HOT_MAX_KEYS, HOT_MIN_ROWS, attach_id, hot_keys
from trip_star.operators.keys import FIRST, ROWS, counted_checkpoint, first_seen_index
from trip_star.schemas import ROW_POS

# A text or binary of up to this many bytes is its own key; a longer one is
# replaced by a digest of the same order of size.
SHORT_BYTES = 32
# Flagged rows (a position, a hash and a position each) that may be broadcast.
BROADCAST_ROWS = 200_000
_ROW_HASH = "__row_hash"


def bounded_key(column: str, kind: T.DataType) -> Column:
    """A key of at most 33 bytes that is equal exactly where the values are.

    Numbers, dates and flags are their own key (floats folded as grouping would:
    NaN -> null, -0.0 -> 0.0). Text and binary keep their bytes up to ``SHORT_BYTES``;
    a longer value becomes the SHA-256 of all of it, marked so that it cannot read
    like a short one. Nested values go by their JSON text.
    """
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        value = nan_to_null(column)
        return F.when(value == F.lit(0.0), F.lit(0.0)).otherwise(value)
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        data = F.when(F.col(column).isNotNull(), F.to_json(F.struct(F.col(column).alias("v")))).cast("binary")
    elif isinstance(kind, (T.StringType, T.BinaryType)):
        data = F.col(column).cast("binary")
    else:
        return F.col(column)
    digest = F.concat(F.unhex(F.lit("01")), F.unhex(F.sha2(data, 256)))
    return F.when(F.octet_length(data) <= SHORT_BYTES, F.concat(F.unhex(F.lit("00")), data)).otherwise(digest)


def _keys(df: DataFrame, columns: Sequence[str]) -> dict[str, Column]:
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return {f"__key{i}": bounded_key(c, kinds[c]) for i, c in enumerate(columns)}


def distinct_rows(df: DataFrame, order_col: str | None = ROW_POS) -> DataFrame:
    """Full-row ``drop_duplicates``.

    With a position column the first copy's position is kept (one hash
    aggregate with ``min``); without one it is plain ``dropDuplicates``.
    """
    if order_col is None or order_col not in df.columns:
        return df.dropDuplicates()
    others = [c for c in df.columns if c != order_col]
    return df.groupBy(*others).agg(F.min(order_col).alias(order_col)).select(*df.columns)


def duplicate_positions(
    df: DataFrame,
    columns: Sequence[str],
    order_col: str = ROW_POS,
    first_col: str = "first_pos",
    hot_min_rows: int = HOT_MIN_ROWS,
    hot_max_keys: int = HOT_MAX_KEYS,
) -> DataFrame:
    """(position, ``first_col``, a hash of the row's values) of the rows whose ``columns`` repeat an earlier row.

    One scan turns every value into a bounded key (``bounded_key``), so texts are
    hashed in the scan and never shuffled, and narrow columns stay typed. Each row
    gets the first position of its value by a skew-safe join: a value that covers a
    large share of the rows is broadcast and its rows spread out.

    Rows that share a position and a value count as one; a row without a position
    comes after all others, and among themselves those count as one, too.
    """
    keyed = _keys(df, columns)
    keys = list(keyed)
    row_hash = F.xxhash64(*[F.col(k) for k in keys])
    narrow = df.select(order_col, *[c.alias(k) for k, c in keyed.items()])
    narrow = counted_checkpoint(narrow.withColumn(_ROW_HASH, row_hash))[0]  # everything below reads this table
    index = first_seen_index(narrow, keys, order_col, counts=True)
    hot = hot_keys(index, keys, FIRST, hot_min_rows, hot_max_keys)
    tagged = attach_id(narrow, index, keys, FIRST, hot=hot, spread_col=order_col)
    later = F.col(FIRST).isNotNull() & ~F.col(order_col).eqNullSafe(F.col(FIRST))
    return tagged.filter(later).select(order_col, F.col(FIRST).alias(first_col), _ROW_HASH)


def duplicate_rows(
    df: DataFrame,
    columns: Sequence[str],
    order_col: str = ROW_POS,
    first_col: str = "first_pos",
    hot_min_rows: int = HOT_MIN_ROWS,
    hot_max_keys: int = HOT_MAX_KEYS,
    broadcast_rows: int | None = None,
) -> DataFrame:
    """Rows whose ``columns`` repeat an earlier row (``df[df.duplicated(columns)]``).

    Each row gets the first position of its value (``first_col``) and is kept
    when it is not that first row (``duplicate_positions``). Only flagged rows
    meet ``df`` again, by position and value. Up to ``broadcast_rows`` of them,
    counted, are broadcast, so the rows of ``df`` are not shuffled at all; beyond
    that, those columns of ``df`` are shuffled that the caller reads.
    """
    flagged, n = counted_checkpoint(duplicate_positions(df, columns, order_col, first_col, hot_min_rows, hot_max_keys).distinct())
    flagged = flagged.select(F.col(order_col).alias("__at"), first_col, F.col(_ROW_HASH).alias("__flagged"))
    if n <= (BROADCAST_ROWS if broadcast_rows is None else broadcast_rows):
        flagged = F.broadcast(flagged)
    row_hash = F.xxhash64(*_keys(df, columns).values())
    same = F.col(order_col).eqNullSafe(F.col("__at")) & (row_hash == F.col("__flagged"))
    return df.join(flagged, same).select(*df.columns, first_col)


def duplicate_count(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: ``n_rows``, ``n_distinct`` and ``n_duplicates`` (rows after the first copy).

    Two aggregates, both with map-side combine; no join, no window. Values are
    grouped by their bounded keys (``bounded_key``): typed as they are, or, if
    long texts, by a digest.
    """
    keyed = df.select(*[c.alias(k) for k, c in _keys(df, list(columns or df.columns)).items()])
    per_value = keyed.groupBy(*keyed.columns).agg(F.count(F.lit(1)).alias("__n"))
    return per_value.agg(
        F.sum("__n").cast("long").alias("n_rows"),
        F.count(F.lit(1)).cast("long").alias("n_distinct"),
        (F.sum("__n") - F.count(F.lit(1))).cast("long").alias("n_duplicates"),
    ).select(
        F.coalesce("n_rows", F.lit(0).cast("long")).alias("n_rows"),
        "n_distinct",
        F.coalesce("n_duplicates", F.lit(0).cast("long")).alias("n_duplicates"),
    )


__all__ = ["ROWS", "bounded_key", "distinct_rows", "duplicate_count", "duplicate_positions", "duplicate_rows"]
