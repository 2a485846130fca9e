"""The trips fact: raw trips left-joined to every dimension, ids only.

Physical plan, per dimension:

* a dimension whose counted size is under the bound (``broadcast``) is
  broadcast: no shuffle of the fact;
* a ``large`` one (datetimes, fares: about one row per trip) over the bound is
  staged (``operators/staged.py``): the fact is exchanged once on its key, and
  the key aggregate and the join both read that one exchange;
* any other dimension over the bound goes through the skew-safe shuffled join: the
  bounded set of hot keys is broadcast and their rows are salted over all
  shuffle partitions.

Which large dimensions are staged is settled before any shuffle: no input of at most
``broadcast_max_rows`` trips has a larger dimension (counted from file footers); on
others one narrow scan estimates the keys. The estimate only chooses the route:
sizes are counted before anything is broadcast, and every route gives the same ids.

Every key index is computed once and checkpointed before the joins: the trips
are scanned once for all small dimensions together, once for the estimates, once for
heavy keys and once for the joins. Broadcast joins run first, so the columns they
consume are gone before the two exchanges of the fact, the minimum for two
unrelated near-fact-size dimensions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trip_star.operators.joins import HOT_MAX_KEYS, HOT_MIN_ROWS, attach_id, hot_keys
from trip_star.operators.keys import (
    DEFAULT_BUCKET_ROWS,
    FIRST,
    ROWS,
    counted_checkpoint,
    first_seen_by_sets,
    first_seen_index,
    number_checkpointed,
    row_id,
)
from trip_star.operators.staged import attach_staged, heavy_hashes, key_hash, stage_by_key, staged_index
from trip_star.plans.dims import (
    DATETIMES,
    DIMENSIONS,
    DROPOFF_LOCATIONS,
    PASSENGER_COUNTS,
    PAYMENT_TYPES,
    PICKUP_LOCATIONS,
    RATE_CODES,
    TRIP_DISTANCES,
    VENDORS,
    DimSpec,
    key_index,
)
from trip_star.schemas import FARE_COLUMNS, ROW_POS
from trip_star.session import ensure_checkpoint_dir

# Rows of a dimension that may be broadcast: a key-index row holds numbers and
# codes only (under ~100 bytes, so at most ~20 MB); public dimensions also hold
# texts and are held to the bytes they take.
BROADCAST_MAX_ROWS = 200_000
BROADCAST_MAX_BYTES = 32_000_000

# The column order of both fact tables is the output contract.
FACT_COLUMNS = (
    "event_id",
    "vendor_id",
    "datetime_id",
    "passenger_count_id",
    "trip_distance_id",
    "pickup_location_id",
    "dropoff_location_id",
    "rate_code_id",
    "payment_type_id",
    "store_and_forward_id",
    "fare_id",
)

# Version 1 of the fact: eight dimensions, the flag and the amounts kept as measures.
WIDE_DIMENSIONS = (
    VENDORS,
    DATETIMES,
    RATE_CODES,
    PAYMENT_TYPES,
    DROPOFF_LOCATIONS,
    PICKUP_LOCATIONS,
    TRIP_DISTANCES,
    PASSENGER_COUNTS,
)
WIDE_FACT_COLUMNS = (
    "event_id",
    "vendor_id",
    "datetime_id",
    "passenger_count_id",
    "trip_distance_id",
    "pickup_location_id",
    "dropoff_location_id",
    "rate_code_id",
    "payment_type_id",
    "store_and_fwd_flag",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
    "airport_fee",
    "total_amount",
)
assert set(FARE_COLUMNS) <= set(WIDE_FACT_COLUMNS)


def raw_indexes(
    trips: DataFrame, specs: tuple[DimSpec, ...], parallel_jobs: int = 4
) -> tuple[dict[str, DataFrame], dict[str, int]]:
    """Per dimension the distinct keys with first position and row count, checkpointed, and how many they are.

    All dimensions that are not ``large`` come from one scan of the trips; each
    large one takes its own. The scans run as concurrent jobs."""
    ensure_checkpoint_dir(trips.sparkSession)
    few = {s.table: s.keys for s in specs if not s.large}

    def scan(spec: DimSpec | None):
        if spec is None:
            return first_seen_by_sets(trips, few)
        index, n = counted_checkpoint(first_seen_index(trips.select(ROW_POS, *spec.keys), list(spec.keys), counts=True))
        return {spec.table: index}, {spec.table: n}

    indexes, sizes = {}, {}
    with ThreadPoolExecutor(max_workers=max(parallel_jobs, 1)) as pool:
        for found, n in pool.map(scan, [None] * bool(few) + [s for s in specs if s.large]):
            indexes |= found
            sizes |= n
    return indexes, sizes


def checked_indexes(
    trips: DataFrame,
    specs: tuple[DimSpec, ...],
    bucket_rows: int = DEFAULT_BUCKET_ROWS,
    broadcast_max_rows: int | None = None,
    parallel_jobs: int = 4,
    small_rows: int | None = None,
) -> tuple[dict[str, DataFrame], frozenset[str]]:
    """Key indexes of a counted size, with ids, and the names that may be broadcast.

    Each index is computed once (checkpointed in the reliable checkpoint folder)
    and counted by the same job; only those with at most ``broadcast_max_rows``
    rows are broadcast.
    """
    bound = BROADCAST_MAX_ROWS if broadcast_max_rows is None else broadcast_max_rows
    raw, sizes = raw_indexes(trips, specs, parallel_jobs)

    def number(spec: DimSpec) -> DataFrame:
        return number_checkpointed(raw[spec.table], sizes[spec.table], list(spec.keys), spec.id_col, bucket_rows, small_rows).drop(FIRST)

    with ThreadPoolExecutor(max_workers=max(parallel_jobs, 1)) as pool:
        indexes = dict(zip((s.table for s in specs), pool.map(number, specs), strict=True))
    return indexes, frozenset(t for t, n in sizes.items() if n <= bound)


def attach_dimensions(
    trips: DataFrame,
    specs: tuple[DimSpec, ...],
    indexes: Mapping[str, DataFrame] | None = None,
    broadcast: frozenset[str] = frozenset(),
    bucket_rows: int = DEFAULT_BUCKET_ROWS,
    hot_min_rows: int = HOT_MIN_ROWS,
    hot_max_keys: int = HOT_MAX_KEYS,
) -> DataFrame:
    """Left-join ``trips`` to each dimension key index, adding its id column.

    ``indexes`` maps table name -> key index (keys, id, ``__rows``); missing
    ones are built from ``trips``. ``broadcast`` names dimensions whose size
    the caller has checked.
    """
    indexes = dict(indexes or {})
    ordered = sorted(specs, key=lambda s: s.table not in broadcast)  # broadcast joins first
    fact = trips
    for spec in ordered:
        index = indexes.get(spec.table)
        if index is None:
            index = key_index(trips, spec, bucket_rows)
        keys = list(spec.keys)
        if spec.table in broadcast:
            fact = attach_id(fact, index, keys, spec.id_col, broadcast_dim=True)
        else:
            hot = hot_keys(index, keys, spec.id_col, hot_min_rows, hot_max_keys)
            fact = attach_id(fact, index, keys, spec.id_col, hot=hot, spread_col=ROW_POS, nonnegative_ids=True)
    return fact


def staged_specs(trips: DataFrame, specs: Sequence[DimSpec], bound: int) -> tuple[list[DimSpec], int]:
    """The large dimensions that have more than ``bound`` keys by estimate, and the rows of the trips."""
    large = [s for s in specs if s.large]
    n_rows = trips.select(ROW_POS).count() if large else 0
    if n_rows <= bound:
        return [], n_rows
    keys = trips.agg(*[F.approx_count_distinct(key_hash(s.keys)).alias(s.table) for s in large]).first()
    return [s for s in large if keys[s.table] > bound], n_rows


def joined_star(
    trips: DataFrame,
    specs: Sequence[DimSpec] = DIMENSIONS,
    bucket_rows: int = DEFAULT_BUCKET_ROWS,
    broadcast_max_rows: int | None = None,
    parallel_jobs: int = 4,
    small_rows: int | None = None,
    keep: Sequence[str] = (),
    hot_min_rows: int = HOT_MIN_ROWS,
    hot_max_keys: int = HOT_MAX_KEYS,
) -> tuple[dict[str, DataFrame], frozenset[str], DataFrame]:
    """Key indexes with ids, the names that may be broadcast, and the trips joined to
    all of them: ``row_pos``, the columns to ``keep`` and every id."""
    bound = BROADCAST_MAX_ROWS if broadcast_max_rows is None else broadcast_max_rows
    ensure_checkpoint_dir(trips.sparkSession)
    staged, n_rows = staged_specs(trips, specs, bound)
    plain = tuple(s for s in specs if s not in staged)
    indexes, small = checked_indexes(trips, plain, bucket_rows, bound, parallel_jobs, small_rows) if plain else ({}, frozenset())
    fact = attach_dimensions(trips, plain, indexes, small, bucket_rows, hot_min_rows, hot_max_keys)
    heavy = heavy_hashes(trips, {s.table: s.keys for s in staged}, n_rows, hot_min_rows, hot_max_keys) if staged else {}
    ids = [s.id_col for s in plain]
    for at, spec in enumerate(staged):
        keys, skewed = list(spec.keys), heavy[spec.table] is not None
        wanted = dict.fromkeys([ROW_POS, *ids, *keep, *[k for s in staged[at:] for k in s.keys]])
        rows = stage_by_key(fact.select(*wanted), keys, heavy[spec.table])
        raw, n = counted_checkpoint(staged_index(rows, keys, skewed))
        numbered = number_checkpointed(raw, n, keys, spec.id_col, bucket_rows, small_rows).drop(FIRST)
        fact = attach_staged(rows, numbered, keys, spec.id_col, skewed)
        indexes[spec.table] = numbered.select(*keys, ROWS, spec.id_col)
        small |= {spec.table} if n <= bound else frozenset()
        ids.append(spec.id_col)
    return indexes, small, fact.select(*dict.fromkeys([ROW_POS, *keep, *ids]))


def fact_rows(joined: DataFrame, columns: Sequence[str] = FACT_COLUMNS) -> DataFrame:
    """A fact table from the trips joined to their dimensions."""
    return row_id(joined, "event_id", ROW_POS).select(*columns)


def fact_trips(
    trips: DataFrame,
    indexes: Mapping[str, DataFrame] | None = None,
    broadcast: frozenset[str] | None = None,
    **kw,
) -> DataFrame:
    """Fact table version 2: ``event_id`` and the ten dimension ids.

    Without ``indexes``/``broadcast`` every key index is checkpointed and
    counted first (``joined_star``), so the join strategy does not hang on
    the planner's estimate of an aggregate over a large scan.
    """
    if indexes is None and broadcast is None:
        return fact_rows(joined_star(trips, DIMENSIONS, **kw)[2])
    return fact_rows(attach_dimensions(trips, DIMENSIONS, indexes, broadcast or frozenset(), **kw))


def fact_trips_wide(
    trips: DataFrame,
    indexes: Mapping[str, DataFrame] | None = None,
    broadcast: frozenset[str] | None = None,
    **kw,
) -> DataFrame:
    """Fact table version 1: eight ids, the flag and the nine amounts."""
    if indexes is None and broadcast is None:
        measures = [c for c in WIDE_FACT_COLUMNS if c in trips.columns]
        return fact_rows(joined_star(trips, WIDE_DIMENSIONS, keep=measures, **kw)[2], WIDE_FACT_COLUMNS)
    return fact_rows(attach_dimensions(trips, WIDE_DIMENSIONS, indexes, broadcast or frozenset(), **kw), WIDE_FACT_COLUMNS)


__all__ = [
    "BROADCAST_MAX_ROWS",
    "FACT_COLUMNS",
    "WIDE_DIMENSIONS",
    "WIDE_FACT_COLUMNS",
    "attach_dimensions",
    "checked_indexes",
    "fact_rows",
    "fact_trips",
    "fact_trips_wide",
    "joined_star",
    "staged_specs",
]
