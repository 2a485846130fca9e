"""Data-quality checks on the star: duplicates, row reconciliation, column
profile, lookup-key uniqueness and foreign-key completeness.

Every check is an aggregate with map-side combine; none needs a join, a window
or a driver-side loop.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trip_star.operators.aggregates import column_profile
from trip_star.plans.fact import FACT_COLUMNS
from trip_star.schemas import TRIP_COLUMNS
from trip_star.sinks.tables import load_metrics
from trip_star.sources.tables import Pin


def row_reconciliation(raw: DataFrame, fact: DataFrame) -> DataFrame:
    """One row: raw rows, fact rows and their difference (0 when no row is lost).

    Both counts come from one aggregate over a tagged union: no join of
    single-row frames.
    """
    tagged = raw.select(F.lit(1).alias("__side")).unionByName(fact.select(F.lit(2).alias("__side")))
    counts = tagged.agg(
        F.count_if(F.col("__side") == 1).cast("long").alias("raw_rows"),
        F.count_if(F.col("__side") == 2).cast("long").alias("fact_rows"),
    )
    return counts.withColumn("difference", F.col("raw_rows") - F.col("fact_rows"))


def trips_profile(trips: DataFrame) -> DataFrame:
    """Column profile of the trip input (name, type, non-null count)."""
    return column_profile(trips, [c for c in TRIP_COLUMNS if c in trips.columns])


def lookup_key_violations(zones: DataFrame, key: str = "LocationID") -> DataFrame:
    """Keys of the de-duplicated lookup that still have more than one row.

    Must be empty: a repeated key would repeat dimension rows and then fact rows.
    """
    distinct = zones.dropDuplicates()
    return (
        distinct.groupBy(key)
        .agg(F.count(F.lit(1)).cast("long").alias("n_rows"))
        .filter(F.col("n_rows") > 1)
    )


def lookup_key_report(zones_raw: DataFrame, key: str = "LocationID") -> DataFrame:
    """One row: raw rows, distinct rows, keys and keys with several distinct rows."""
    per_row = zones_raw.groupBy(*zones_raw.columns).agg(F.count(F.lit(1)).alias("__copies"))
    per_key = per_row.groupBy(key).agg(
        F.sum("__copies").alias("__raw"), F.count(F.lit(1)).alias("__distinct")
    )
    return per_key.agg(
        F.coalesce(F.sum("__raw"), F.lit(0)).cast("long").alias("n_rows"),
        F.coalesce(F.sum("__distinct"), F.lit(0)).cast("long").alias("n_distinct_rows"),
        F.count(F.lit(1)).cast("long").alias("n_keys"),
        F.count_if(F.col("__distinct") > 1).cast("long").alias("n_violating_keys"),
    )


def assert_unique_lookup(zones: DataFrame, key: str = "LocationID") -> None:
    """Fail the build when the lookup would fan out (a bounded peek, not a collect)."""
    bad = lookup_key_violations(zones, key).take(5)
    if bad:
        raise ValueError(f"zone lookup repeats {key} with different rows, e.g. {bad}")


def _metric(table: str, metric: str) -> Column:
    here = (F.col("table_name") == table) & (F.col("metric") == metric)
    return F.coalesce(F.sum(F.when(here, F.col("value"))), F.lit(0)).cast("long")


def written_reconciliation(spark: SparkSession, database: str | None = None, at: Pin | None = None) -> DataFrame:
    """``row_reconciliation`` of a written star, from the numbers its build observed:
    no table of the star is read."""
    counts = load_metrics(spark, database, at).agg(
        _metric("trips_input", "raw_rows").alias("raw_rows"), _metric("trips", "n_rows").alias("fact_rows")
    )
    return counts.withColumn("difference", F.col("raw_rows") - F.col("fact_rows"))


def written_fk_completeness(spark: SparkSession, database: str | None = None, at: Pin | None = None) -> DataFrame:
    """``fk_completeness`` of a written star, from the numbers its build observed."""
    cols = [f"null_{c}" for c in FACT_COLUMNS if c != "event_id"]
    return load_metrics(spark, database, at).agg(
        _metric("trips", "n_rows").alias("fact_rows"), *[_metric("trips", c).alias(c) for c in cols]
    )


def fk_completeness(fact: DataFrame, id_columns: Sequence[str] | None = None) -> DataFrame:
    """One row: fact rows and, per foreign key, the rows whose id is null (all 0 when sound)."""
    cols = list(id_columns or [c for c in FACT_COLUMNS if c != "event_id"])
    return fact.agg(
        F.count(F.lit(1)).cast("long").alias("fact_rows"),
        *[F.count_if(F.col(c).isNull()).cast("long").alias(f"null_{c}") for c in cols],
    )
