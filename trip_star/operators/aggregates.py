"""Aggregations behind the reports and the profile: value counts, top-k,
non-null counts and row counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def value_counts(df: DataFrame, col: str, count_col: str = "count", dropna: bool = True) -> DataFrame:
    """``value_counts()``: frequency per value, most frequent first (ties by value)."""
    src = df.filter(F.col(col).isNotNull()) if dropna else df
    return (
        src.groupBy(col)
        .agg(F.count(F.lit(1)).cast("long").alias(count_col))
        .orderBy(F.col(count_col).desc(), F.col(col).asc_nulls_first())
    )


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows in ``order``; plans as TakeOrderedAndProject (k rows per task)."""
    return df.orderBy(*order).limit(k)


def non_null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row, one ``count(col)`` per column: a single scan and a single aggregate."""
    cols = list(columns or df.columns)
    return df.agg(*[F.count(F.col(c)).cast("long").alias(c) for c in cols])


def column_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``info()`` as data: position, name, type and non-null count per column."""
    cols = list(columns or df.columns)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    counts = non_null_counts(df, cols)
    entries = [
        F.struct(
            F.lit(i).cast("int").alias("position"),
            F.lit(c).alias("column_name"),
            F.lit(types[c]).alias("data_type"),
            F.col(c).alias("non_null_count"),
        )
        for i, c in enumerate(cols)
    ]
    return counts.select(F.inline(F.array(*entries)))
