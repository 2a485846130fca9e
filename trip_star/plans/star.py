"""A star to report on: fact ids, public dimensions and which of them are small.

Two sources give the same frames:

* ``star_from_trips``: the key indexes the report needs are computed once,
  checkpointed and counted (as in the build); the fact ids and the public
  dimensions are both derived from those checkpoints, so they agree and no
  dimension is computed twice;
* ``star_from_warehouse``: the written tables of one version, counted from file
  metadata.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trip_star.operators.keys import DEFAULT_BUCKET_ROWS, ROWS
from trip_star.plans.dims import BY_TABLE, DIMENSIONS, public_columns
from trip_star.plans.fact import joined_star
from trip_star.plans.quality import assert_unique_lookup
from trip_star.plans.reports import small_dimensions
from trip_star.schemas import ROW_POS
from trip_star.sources.tables import Pin, pin, read_table


@dataclass(frozen=True)
class Star:
    fact: DataFrame
    dims: dict[str, DataFrame]
    small: frozenset[str]
    freq: dict[str, DataFrame]  # fact rows per id, by table


def star_from_trips(
    trips: DataFrame,
    zones_raw: DataFrame | None,
    tables: Sequence[str] | None = None,
    bucket_rows: int = DEFAULT_BUCKET_ROWS,
    broadcast_max_rows: int | None = None,
) -> Star:
    """The fact (``event_id`` + the ids of ``tables``) and those public dimensions."""
    specs = tuple(BY_TABLE[t] for t in tables) if tables else DIMENSIONS
    if zones_raw is not None and any(s.needs_zones for s in specs):
        assert_unique_lookup(zones_raw)  # a zone with two names would repeat report rows
    indexes, small, joined = joined_star(trips, specs, bucket_rows, broadcast_max_rows)
    fact = joined.withColumn("event_id", F.col(ROW_POS).cast("long")).select(
        "event_id", *[s.id_col for s in specs]
    )
    zones = zones_raw.dropDuplicates() if zones_raw is not None else None
    dims = {s.table: public_columns(s, indexes[s.table], zones if s.needs_zones else None) for s in specs}
    # the location dimensions carry free text: measured, not only counted
    texts = {s.table: dims[s.table] for s in specs if s.needs_zones and s.table in small}
    small = (small - texts.keys()) | small_dimensions(texts, broadcast_max_rows)
    freq = {s.table: indexes[s.table].select(s.id_col, ROWS) for s in specs}
    return Star(fact, dims, small, freq)


def star_from_warehouse(
    spark: SparkSession,
    database: str | None,
    tables: Sequence[str] | None = None,
    fact_table: str = "trips",
    broadcast_max_rows: int | None = None,
    at: Pin | None = None,
) -> Star:
    """The tables of version ``at`` (by default the current one, held on to for all of them)."""
    at = at or pin(spark, database)
    names = list(tables) if tables else [s.table for s in DIMENSIONS]
    dims = {t: read_table(spark, t, database, at) for t in names}
    fact = read_table(spark, fact_table, database, at)
    ids = {t: BY_TABLE[t].id_col for t in names}
    freq = {t: fact.groupBy(c).agg(F.count(F.lit(1)).alias(ROWS)) for t, c in ids.items()}  # read from the stored fact
    return Star(fact, dims, small_dimensions(dims, broadcast_max_rows), freq)
