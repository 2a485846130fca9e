"""Keep a written star up with its trip files: append where that gives the same star, else rebuild.

A star built from files records them (path, length, time of change) as the table
``loaded_files`` of its version. When all of them are still there unchanged, every
further file sorts behind them and the zone lookup is the same, the new
files' rows come after all modelled rows, so first-seen ids continue:

* the key indexes of the new rows are computed as in a build (one scan for the
  small dimensions, one per large one);
* keys the written dimensions lack - an anti join with them - are numbered from
  the dimension's size on, and become one more part of that dimension;
* the other keys take their id from the written dimension;
* the new rows meet those ids as in a build and become one more part of the fact.

The parts are committed together by moving the pointer. The trips that were
modelled before are not read again; the result equals a full build on all files.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import timedelta
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trip_star.operators.joins import null_safe_equal
from trip_star.operators.keys import DEFAULT_BUCKET_ROWS, FIRST, ROWS, counted_checkpoint, number_checkpointed
from trip_star.plans.build import FACT_TABLE, INPUT, build_star, stage_fact
from trip_star.plans.dims import DATETIMES, DIMENSIONS, DimSpec, public_columns
from trip_star.plans.fact import BROADCAST_MAX_ROWS, fact_trips, raw_indexes
from trip_star.plans.quality import assert_unique_lookup
from trip_star.schemas import TRIPS
from trip_star.sinks.tables import FILES, ensure_database, load_metrics, load_report, publish
from trip_star.sinks.versions import GRACE, has_version, stage
from trip_star.sources.parquet import LISTING, read_trips
from trip_star.sources.tables import Pin, pin, read_table

LOOKUP = "zone_lookup"  # the name under which the lookup's hash is kept


def list_files(spark: SparkSession, trips: str | Sequence[str]) -> DataFrame:
    """(path, length, modified) of the trip files; their content is not read."""
    paths = [trips] if isinstance(trips, str) else list(trips)
    listed = spark.read.format("binaryFile").options(**LISTING).load(paths)
    return listed.select("path", "length", F.col("modificationTime").alias("modified"))


def lookup_hash(zones: DataFrame) -> int:
    """Tells two zone lookups apart, whatever the order and repetition of their rows."""
    rows = zones.dropDuplicates()
    return rows.agg(F.coalesce(F.bit_xor(F.xxhash64(*sorted(rows.columns))), F.lit(0))).first()[0]


def new_files(spark: SparkSession, trips: str | Sequence[str], zones: DataFrame, database: str | None) -> list[str] | None:
    """The files to append to the written star, in order; None if it must be rebuilt."""
    if not has_version(spark, database):
        return None
    at = pin(spark, database)
    metrics = {(r["table_name"], r["metric"]): r["value"] for r in load_metrics(spark, database, at).collect()}  # some 40 rows
    if (LOOKUP, "hash") not in metrics or metrics[LOOKUP, "hash"] != lookup_hash(zones):
        return None
    known = {r["path"]: (r["length"], r["modified"]) for r in read_table(spark, FILES, database, at).collect()}  # a row per file, as the listing
    now = {r["path"]: (r["length"], r["modified"]) for r in list_files(spark, trips).collect()}
    if any(now.get(p) != state for p, state in known.items()):
        return None
    paths = [trips] if isinstance(trips, str) else list(trips)
    in_order = [unquote(f) for f in sorted(spark.read.options(**LISTING).parquet(*paths).inputFiles())]
    fresh = [p for p in in_order if _plain(p) not in {_plain(k) for k in known}]
    return fresh if in_order[len(in_order) - len(fresh) :] == fresh else None


def _plain(path: str) -> str:
    """``file:/x`` and ``file:///x`` are one path."""
    return path.replace("file:///", "file:/", 1)


def written_keys(spec: DimSpec, table: DataFrame) -> DataFrame:
    """The typed natural key and the id of a written dimension."""
    if spec is DATETIMES:  # written as text
        table = table.withColumns({k: F.to_timestamp_ntz(F.col(k)) for k in spec.keys})
    return table.select(*spec.keys, spec.id_col)


def _known_and_fresh(
    spec: DimSpec, index: DataFrame, written: DataFrame, bucket_rows: int, small_rows: int | None
) -> tuple[DataFrame, DataFrame, int]:
    """The index of the new rows with ids, the part of it that the dimension lacks, and its keys."""
    keys, tmp = list(spec.keys), [f"__w{i}" for i in range(len(spec.keys))]
    stored = written_keys(spec, written).toDF(*tmp, "__id")
    met, n = counted_checkpoint(index.join(stored, null_safe_equal(keys, tmp), "left").drop(*tmp))
    lacking, n_fresh = counted_checkpoint(met.filter(F.col("__id").isNull()).drop("__id"))
    first_id = written.count()  # from file metadata
    fresh = number_checkpointed(lacking, n_fresh, keys, spec.id_col, bucket_rows, small_rows).drop(FIRST)
    fresh = fresh.withColumn(spec.id_col, F.col(spec.id_col) + F.lit(first_id))
    known = met.filter(F.col("__id").isNotNull()).select(*keys, ROWS, F.col("__id").alias(spec.id_col))
    return known.unionByName(fresh.select(*known.columns)), fresh, n


def append_star(
    spark: SparkSession,
    trips: DataFrame,
    zones_raw: DataFrame,
    database: str | None,
    files: DataFrame,
    bucket_rows: int = DEFAULT_BUCKET_ROWS,
    broadcast_max_rows: int | None = None,
    parallel_jobs: int = 4,
    small_rows: int | None = None,
    grace: timedelta = GRACE,
) -> DataFrame:
    """Append ``trips``, whose positions follow those of the written star, as one more
    part; ``files`` are recorded with it. Returns the load report of the whole star."""
    at = pin(spark, database)
    zones = zones_raw.dropDuplicates()
    raw, _ = raw_indexes(trips, DIMENSIONS, parallel_jobs)
    bound = BROADCAST_MAX_ROWS if broadcast_max_rows is None else broadcast_max_rows
    part = at.part + 1

    def extend(spec: DimSpec):
        written = read_table(spark, spec.table, database, at)
        index, fresh, n = _known_and_fresh(spec, raw[spec.table], written, bucket_rows, small_rows)
        public = public_columns(spec, fresh, zones if spec.needs_zones else None)
        return index, n, stage(public, spec.table, database, at.version, part)

    with ThreadPoolExecutor(max_workers=max(parallel_jobs, 1)) as pool:
        done = dict(zip((s.table for s in DIMENSIONS), pool.map(extend, DIMENSIONS), strict=True))
    indexes = {t: index for t, (index, _, _) in done.items()}
    small = frozenset(t for t, (_, n, _) in done.items() if n <= bound)
    staged = [s for _, _, s in done.values()]
    staged.append(stage_fact(fact_trips(trips, indexes, broadcast=small), database, at.version, part))
    staged.append(stage(files, FILES, database, at.version, part))
    raw_rows = raw["vendors"].agg(F.coalesce(F.sum(ROWS), F.lit(0))).first()[0]
    publish(spark, staged, database, at.version, part, extra={INPUT: {"raw_rows": raw_rows}}, grace=grace)
    return load_report(spark, database)


def refresh_star(
    spark: SparkSession, trips: str | Sequence[str], zones_raw: DataFrame, database: str | None = "trip_star", head_rows: int | None = None, **options
) -> tuple[DataFrame, str]:
    """Bring the written star up with its trip files: (load report, what was done).

    ``none`` if nothing changed, ``append`` if only new last files came, else
    ``build``. With ``head_rows`` the star is always built anew. ``options`` as for
    ``build_star``."""
    ensure_database(spark, database)
    if head_rows is not None:
        return build_star(spark, read_trips(spark, trips, head_rows=head_rows), zones_raw, database, **options), "build"
    fresh = new_files(spark, trips, zones_raw, database)
    listed = list_files(spark, trips)
    if fresh is None:
        extra = {LOOKUP: {"hash": lookup_hash(zones_raw)}}
        return build_star(spark, read_trips(spark, trips), zones_raw, database, files=listed, extra=extra, **options), "build"
    if not fresh:
        return load_report(spark, database), "none"
    assert_unique_lookup(zones_raw)
    rows = load_metrics(spark, database).filter(f"table_name = '{INPUT}' AND metric = 'raw_rows'").first()["value"]
    trips_read = read_trips(spark, fresh, first_pos=rows)
    absent = [f for f in TRIPS.fields if f.name not in trips_read.columns]  # these months lack them, others did not
    trips_read = trips_read.withColumns({f.name: F.lit(None).cast(f.dataType) for f in absent}) if absent else trips_read
    options.pop("strict", None)
    return append_star(spark, trips_read, zones_raw, database, list_files(spark, fresh), **options), "append"


__all__ = ["FACT_TABLE", "FILES", "Pin", "append_star", "list_files", "lookup_hash", "new_files", "refresh_star", "written_keys"]
