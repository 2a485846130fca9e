"""Reports on the star: the enriched view and the three analyses.

Each report joins only the dimensions it reads. Where the answer is a count
per dimension member, the fact is aggregated on the id first (partial
aggregation, a tiny shuffle) and only the aggregate meets the dimension.
Where every fact row needs a dimension value (the enriched view, the fare by
hour), the lookup is a broadcast when the dimension's counted size allows it,
and otherwise the skew-safe lookup: the most frequent ids are broadcast and
their rows salted, so one hot id cannot land a third of the fact in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trip_star.functions.dates import hour
from trip_star.operators.aggregates import top_k, value_counts
from trip_star.operators.joins import lookup_columns
from trip_star.plans.dims import BY_TABLE, PICKUP_TS
from trip_star.plans import fact as fact_module


def small_dimensions(
    dims: Mapping[str, DataFrame], max_rows: int | None = None, parallel_jobs: int = 4
) -> frozenset[str]:
    """Names of the dimensions with at most ``max_rows`` rows and at most
    ``BROADCAST_MAX_BYTES`` (16 bytes a column and the bytes of its texts),
    counted concurrently."""
    bound = fact_module.BROADCAST_MAX_ROWS if max_rows is None else max_rows

    def fits(dim: DataFrame) -> bool:
        texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in dim.schema.fields if isinstance(f.dataType, T.StringType)]
        width = F.lit(16 * len(dim.columns)).cast("long")
        for text in texts:
            width = width + text
        n, size = dim.agg(F.count(F.lit(1)), F.sum(width)).first()
        return n <= bound and (size or 0) <= fact_module.BROADCAST_MAX_BYTES

    with ThreadPoolExecutor(max_workers=max(parallel_jobs, 1)) as pool:
        small = dict(zip(dims, pool.map(fits, dims.values()), strict=True))
    return frozenset(name for name, yes in small.items() if yes)


def enriched_trips(
    fact: DataFrame,
    dims: Mapping[str, DataFrame],
    attach: Sequence[str],
    columns: Sequence[str] | None = None,
    broadcast: frozenset[str] | None = None,
    freq: Mapping[str, DataFrame] | None = None,
    **hot,
) -> DataFrame:
    """The fact joined by id to the named public dimensions (left joins).

    ``broadcast`` names dimensions whose size was checked; by default they
    are counted here (``small_dimensions``). ``freq`` has the fact's rows per id
    (``Star.freq``); without it they are counted on the frame joined so far.
    """
    if broadcast is None:
        broadcast = small_dimensions({t: dims[t] for t in attach})
    out = fact
    for table in attach:
        spec = BY_TABLE[table]
        dim = dims[table]
        wanted = [c for c in dim.columns if c != spec.id_col and (columns is None or c in columns)]
        spread = "event_id" if "event_id" in out.columns else None
        known = (freq or {}).get(table)
        out = lookup_columns(out, dim, spec.id_col, wanted, broadcast=table in broadcast, spread_col=spread, freq=known, **hot)
    return out.select(*columns) if columns else out


def top_pickup_zones(fact: DataFrame, pickup_locations: DataFrame, k: int = 10) -> DataFrame:
    """Top ``k`` pick-up locations by number of trips; ties by location id."""
    per_location = fact.groupBy("pickup_location_id").agg(F.count(F.lit(1)).cast("long").alias("trip_count"))
    named = per_location.join(pickup_locations, "pickup_location_id", "left").select(
        "PULocationID", "pickup_location_zone", "pickup_location_borough", "trip_count"
    )
    return top_k(named, [F.col("trip_count").desc(), F.col("PULocationID").asc_nulls_first()], k)


def trips_by_passenger_count(fact: DataFrame, passenger_counts: DataFrame) -> DataFrame:
    """Number of trips per passenger count (a missing count is its own group)."""
    per_id = fact.groupBy("passenger_count_id").agg(F.count(F.lit(1)).cast("long").alias("trip_count"))
    return (
        per_id.join(passenger_counts, "passenger_count_id", "left")
        .select("passenger_count", "trip_count")
        .orderBy(F.col("passenger_count").asc_nulls_first())
    )


def avg_fare_by_hour(
    fact: DataFrame,
    datetimes: DataFrame,
    fares: DataFrame,
    broadcast: frozenset[str] | None = None,
    freq: Mapping[str, DataFrame] | None = None,
    **hot,
) -> DataFrame:
    """Average fare amount per pick-up hour of day (rounded to 4 places).

    The hour is attached first; then trips of one hour and fare are counted
    (at most 25 rows per fare, combined on the map side) and only those counts
    meet the fares: one fact-sized join, not two.
    """
    hours = datetimes.select("datetime_id", hour(F.to_timestamp_ntz(F.col(PICKUP_TS))).alias("pickup_hour"))
    amounts = fares.select("fare_id", "fare_amount")
    if broadcast is None:
        broadcast = small_dimensions({"datetimes": hours, "fares": amounts})
    known = (freq or {}).get("datetimes")
    trips = fact.select("datetime_id", "fare_id")
    timed = lookup_columns(trips, hours, "datetime_id", ["pickup_hour"], broadcast="datetimes" in broadcast, freq=known, **hot)
    counts = timed.groupBy("pickup_hour", "fare_id").agg(F.count(F.lit(1)).alias("__n"))
    if "fares" in broadcast:
        amounts = F.broadcast(amounts)
    rows = counts.join(amounts, "fare_id", "left")  # a fare has at most 25 rows on this side
    # six places of the sum are exact; what the order of addition adds beyond them would decide ties
    weighted = F.round(F.sum(F.col("fare_amount") * F.col("__n")), 6)
    counted = F.sum(F.when(F.col("fare_amount").isNotNull(), F.col("__n")))
    return (
        rows.groupBy("pickup_hour")
        .agg(
            F.round(weighted / counted, 4).alias("avg_fare_amount"),
            F.sum("__n").cast("long").alias("trip_count"),
        )
        .orderBy(F.col("pickup_hour").asc_nulls_first())
    )


def flag_value_counts(trips: DataFrame) -> DataFrame:
    """Store-and-forward flag frequencies, missing values dropped, most frequent first."""
    return value_counts(trips, "store_and_fwd_flag", count_col="trip_count")
