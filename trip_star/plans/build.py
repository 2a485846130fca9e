"""The full build: trips + zone lookup -> ten dimension tables + the trips fact.

One driver program instead of a chain of tasks that pass JSON text:

1. check that the lookup cannot fan out (a bounded ``take``);
2. compute the key indexes (typed keys, id, row count) once - one scan for all
   small dimensions, one exchange of the fact per large one - and checkpoint them
   to the reliable checkpoint folder, which cuts the lineage so a lost executor
   re-reads the checkpoint instead of re-scanning trips;
3. write the public dimensions from those checkpoints. They do not depend on each
   other, so their jobs are submitted concurrently (``parallel_jobs`` driver
   threads) and share the cluster;
4. join the fact to the same checkpoints, so fact ids and dimension ids cannot
   diverge; a dimension is broadcast only when its counted size is under
   ``broadcast_max_rows``; large ones join on the exchange that their keys were
   aggregated on;
5. write the fact. The writes observe rows, columns and missing ids themselves;
6. commit all eleven tables, with those numbers, as one version by one catalog
   call (``sinks/versions.py``): readers are on the old star or on the new one;
7. return the load report, which the numbers answer: nothing is read again.
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trip_star.operators.keys import DEFAULT_BUCKET_ROWS, ROWS
from trip_star.plans.dims import DIMENSIONS, VENDORS, public_columns
from trip_star.plans.fact import FACT_COLUMNS, fact_rows, joined_star
from trip_star.plans.quality import assert_unique_lookup
from trip_star.session import ensure_checkpoint_dir
from trip_star.sources.parquet import head_slice
from trip_star.sinks.tables import FILES, ensure_database, load_report, publish
from trip_star.sinks.versions import GRACE, Staged, new_version, stage

FACT_TABLE = "trips"
TABLES = tuple(spec.table for spec in DIMENSIONS) + (FACT_TABLE,)
INPUT = "trips_input"  # the name under which the raw rows are reported


def stage_fact(fact: DataFrame, database: str | None, version: str, part: int = 0) -> Staged:
    """Write the fact; the write counts its rows and, per foreign key, the missing ids."""
    missing = {f"null_{c}": F.count_if(F.col(c).isNull()) for c in FACT_COLUMNS if c != "event_id"}
    return stage(fact, FACT_TABLE, database, version, part, **missing)


def build_star(
    spark: SparkSession,
    trips: DataFrame,
    zones_raw: DataFrame,
    database: str | None = "trip_star",
    strict: bool = True,
    bucket_rows: int = DEFAULT_BUCKET_ROWS,
    broadcast_max_rows: int | None = None,
    parallel_jobs: int = 4,
    head_rows: int | None = None,
    grace: timedelta = GRACE,
    files: DataFrame | None = None,
    extra: Mapping[str, Mapping[str, int]] | None = None,
) -> DataFrame:
    """Write all eleven tables (full refresh) and return the load report.

    The version that is replaced stays readable for ``grace``. ``files`` (path,
    length, modified) are recorded with the version, as are further numbers (``extra``). ``head_rows`` keeps only the first rows in input order (the reference's
    pipeline keeps 100,000); by default the whole input is modelled.
    """
    ensure_checkpoint_dir(spark)
    ensure_database(spark, database)
    if strict:
        assert_unique_lookup(zones_raw)
    zones = zones_raw.dropDuplicates()
    if head_rows is not None:
        trips = head_slice(trips, head_rows)

    indexes, _, joined = joined_star(trips, DIMENSIONS, bucket_rows, broadcast_max_rows, parallel_jobs)

    version = new_version()

    def stage_dimension(spec):
        public = public_columns(spec, indexes[spec.table], zones if spec.needs_zones else None)
        return stage(public, spec.table, database, version)

    with ThreadPoolExecutor(max_workers=max(parallel_jobs, 1)) as pool:
        staged = list(pool.map(stage_dimension, DIMENSIONS))
    staged.append(stage_fact(fact_rows(joined), database, version))
    if files is not None:
        staged.append(stage(files, FILES, database, version))
    publish(spark, staged, database, version, extra={**_input_rows(indexes), **(extra or {})}, grace=grace)
    return load_report(spark, database)


def _input_rows(indexes: Mapping[str, DataFrame]) -> dict[str, dict[str, int]]:
    """Rows of the input: every trip has one vendor key, so the rows per key add up to them."""
    return {INPUT: {"raw_rows": indexes[VENDORS.table].agg(F.coalesce(F.sum(ROWS), F.lit(0))).first()[0]}}


def build_fact(
    spark: SparkSession, trips: DataFrame, database: str | None = "trip_star", grace: timedelta = GRACE, **options
) -> DataFrame:
    """Write the fact alone, as a version of its own database, with the numbers the
    checks read; returns its load report. ``options`` as for ``joined_star``."""
    ensure_database(spark, database)
    indexes, _, joined = joined_star(trips, DIMENSIONS, **options)
    version = new_version()
    fact = stage_fact(fact_rows(joined), database, version)
    publish(spark, [fact], database, version, extra=_input_rows(indexes), grace=grace)
    return load_report(spark, database)
