"""Trip-shaped views derived from the driver's tables (FIXTURES.md section 3).

The same SQL text runs in Spark (``spark.sql`` with DataFrame arguments) and in
DuckDB (base views of the same name), so the oracle sees identical inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trip_star.sources.parquet import prepare_trips

TRIPS_SQL = """
select event_id as row_pos,
  cast(1 + event_id % 3 as int) as VendorID,
  ts as tpep_pickup_datetime,
  ts + cast(event_id % 90 as int) * interval '1' minute as tpep_dropoff_datetime,
  case when event_id % 11 = 0 then cast(null as int) else cast(event_id % 7 as int) end as passenger_count,
  case when event_id % 23 = 0 then cast('NaN' as double) else cast(floor(value) as double) / cast(2 as double) end as trip_distance,
  cast(1 + event_id % 7 as int) as RatecodeID,
  case when event_id % 13 = 0 then cast(null as varchar(1)) when event_id % 5 = 0 then 'Y' else 'N' end as store_and_fwd_flag,
  case when event_id % 10 = 9 then 1000000000 + user_id else user_id end as PULocationID,
  cast((user_id * 7 + 3) % 150 as bigint) as DOLocationID,
  cast(case event_type when 'click' then 1 when 'view' then 2 when 'purchase' then 3 when 'signup' then 9 end as int) as payment_type,
  value as fare_amount,
  cast(event_id % 3 as double) / cast(2 as double) as extra,
  cast(0.5 as double) as mta_tax,
  cast(floor(value) as double) / cast(4 as double) as tip_amount,
  case when event_id % 17 = 0 then cast(5.5 as double) else cast(0 as double) end as tolls_amount,
  cast(0.25 as double) as improvement_surcharge,
  value + cast(0.75 as double) as total_amount,
  cast(null as double) as congestion_surcharge,
  cast(null as double) as airport_fee
from {events}
"""

ZONES_SQL = """
select c_custkey as LocationID, n_name as borough, c_name as zone
from {customer} join {nation} on c_nationkey = n_nationkey
union all
select c_custkey, n_name, c_name
from {customer} join {nation} on c_nationkey = n_nationkey
"""

BASE_TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fixture_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips derived from ``events``; ``row_pos`` is ``event_id``."""
    events = table(spark, sf_dir, "events")
    return prepare_trips(spark.sql(TRIPS_SQL, events=events))


def fixture_zones_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zone lookup before de-duplication: every row twice (some trips name an id it lacks)."""
    return spark.sql(
        ZONES_SQL,
        customer=table(spark, sf_dir, "customer"),
        nation=table(spark, sf_dir, "nation"),
    )


def duckdb_ctes() -> str:
    """``trips as (...), zones as (...)`` for a DuckDB ``with`` clause."""
    trips = TRIPS_SQL.format(events="events")
    zones = ZONES_SQL.format(customer="customer", nation="nation")
    folded = "case when isnan(trip_distance) then null else trip_distance end as trip_distance"
    return f"trips_raw as ({trips}), trips as (select * replace ({folded}) from trips_raw), zones_raw as ({zones})"
