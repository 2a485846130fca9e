"""DuckDB SQL equivalents of the registered queries (the correctness gate).

Every text runs on DuckDB with the driver's base tables registered as views.
The trip-shaped inputs are the shared fixture SQL, inlined as leading CTEs.
Ids use ``row_number() over (order by min(position), key)``; missing keys match
with ``is not distinct from``, as ``<=>`` does in Spark.
"""

from __future__ import annotations

from typing import NamedTuple

from trip_star.schemas import TRIPS
from trip_star.sources.fixtures import duckdb_ctes

# Written out here once more, not taken from the builders: a wrong map, key or
# column list there must not pass. Fixed values.
RATE_CODE_NAMES = {
    1: "Standard rate", 2: "JFK", 3: "Newark", 4: "Nassau or Westchester", 5: "Negotiated fare", 6: "Group ride",
}
PAYMENT_TYPE_NAMES = {
    1: "Credit Card", 2: "Cash", 3: "No charge", 4: "Dispute", 5: "Unknown", 6: "Voided trip",
}
VENDOR_NAMES = {1: "Creative Mobile Technologies", 2: "VeriFone Inc"}
STORE_AND_FWD_FLAG_VALUES = {"N": 0, "Y": 1}
EVENT_COLUMNS = {
    "event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string", "value": "double", "props": "string",
}


class Dim(NamedTuple):
    table: str
    id_col: str
    keys: tuple[str, ...]
    n_cols: int


FARES = (
    "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
    "improvement_surcharge", "total_amount", "congestion_surcharge", "airport_fee",
)
DIMENSIONS = (
    Dim("datetimes", "datetime_id", ("tpep_pickup_datetime", "tpep_dropoff_datetime"), 11),
    Dim("rate_codes", "rate_code_id", ("RatecodeID",), 3),
    Dim("payment_types", "payment_type_id", ("payment_type",), 3),
    Dim("dropoff_locations", "dropoff_location_id", ("DOLocationID",), 4),
    Dim("pickup_locations", "pickup_location_id", ("PULocationID",), 4),
    Dim("trip_distances", "trip_distance_id", ("trip_distance",), 2),
    Dim("passenger_counts", "passenger_count_id", ("passenger_count",), 2),
    Dim("vendors", "vendor_id", ("VendorID",), 3),
    Dim("fares", "fare_id", FARES, 10),
    Dim("store_and_forward_flags", "store_and_forward_id", ("store_and_fwd_flag",), 3),
)
BY_TABLE = {d.table: d for d in DIMENSIONS}
FACT_COLUMNS = (
    "event_id", "vendor_id", "datetime_id", "passenger_count_id", "trip_distance_id", "pickup_location_id",
    "dropoff_location_id", "rate_code_id", "payment_type_id", "store_and_forward_id", "fare_id",
)
WIDE_DIMENSIONS = tuple(d for d in DIMENSIONS if d.table not in ("fares", "store_and_forward_flags"))
WIDE_FACT_COLUMNS = (
    "event_id", "vendor_id", "datetime_id", "passenger_count_id", "trip_distance_id", "pickup_location_id",
    "dropoff_location_id", "rate_code_id", "payment_type_id", "store_and_fwd_flag", "fare_amount", "extra", "mta_tax",
    "tip_amount", "tolls_amount", "improvement_surcharge", "congestion_surcharge", "airport_fee", "total_amount",
)


def _lit(v) -> str:
    return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)


def _case(col: str, mapping: dict, cast: str | None = None) -> str:
    whens = " ".join(f"when {col} = {_lit(k)} then {_lit(v)}" for k, v in mapping.items())
    expr = f"case {whens} end"
    return f"cast({expr} as {cast})" if cast else expr


def _key_cte(name: str, keys, id_col: str, source: str = "trips", order: str = "row_pos") -> str:
    k = ", ".join(keys)
    ties = ", ".join(f"{c} asc nulls first" for c in keys)
    return (
        f"{name} as (select {k}, cast(row_number() over (order by min({order}), {ties}) - 1 as bigint) as {id_col} "
        f"from {source} group by {k})"
    )


def _idx_name(table: str) -> str:
    return f"idx_{table}"


def _index_ctes() -> str:
    return ", ".join(_key_cte(_idx_name(s.table), s.keys, s.id_col) for s in DIMENSIONS)


def _with(*extra: str) -> str:
    parts = [duckdb_ctes(), "zones as (select distinct * from zones_raw)", _index_ctes(), *extra]
    return "with " + ", ".join(p for p in parts if p)


def _public_dim_select(table: str) -> str:
    spec = BY_TABLE[table]
    i = _idx_name(table)
    if table == "datetimes":
        def parts(c, p):
            return (
                f"cast(year({c}) as int) as {p}_year, cast(month({c}) as int) as {p}_month, "
                f"cast(day({c}) as int) as {p}_day, cast(isodow({c}) - 1 as int) as {p}_weekday"
            )
        return (
            f"select datetime_id, cast(tpep_pickup_datetime as varchar) as tpep_pickup_datetime, "
            f"{parts('tpep_pickup_datetime', 'pickup')}, "
            f"cast(tpep_dropoff_datetime as varchar) as tpep_dropoff_datetime, "
            f"{parts('tpep_dropoff_datetime', 'dropoff')} from {i}"
        )
    if table == "rate_codes":
        return f"select rate_code_id, RatecodeID, {_case('RatecodeID', RATE_CODE_NAMES)} as rate_code_name from {i}"
    if table == "payment_types":
        return (
            f"select payment_type_id, payment_type, {_case('payment_type', PAYMENT_TYPE_NAMES)} as payment_type_name "
            f"from {i}"
        )
    if table in ("dropoff_locations", "pickup_locations"):
        key = spec.keys[0]
        p = "dropoff" if table.startswith("dropoff") else "pickup"
        return (
            f"select d.{spec.id_col}, d.{key}, z.zone as {p}_location_zone, z.borough as {p}_location_borough "
            f"from {i} d left join zones z on d.{key} is not distinct from z.LocationID"
        )
    if table == "vendors":
        return f"select vendor_id, VendorID, {_case('VendorID', VENDOR_NAMES)} as vendor_name from {i}"
    if table == "store_and_forward_flags":
        flag = _case("store_and_fwd_flag", STORE_AND_FWD_FLAG_VALUES, "boolean")
        return f"select store_and_forward_id, {flag} as store_and_forward_bool, store_and_fwd_flag from {i}"
    return f"select {spec.id_col}, {', '.join(spec.keys)} from {i}"


def _fact_select(specs, columns) -> str:
    joins = []
    for s in specs:
        on = " and ".join(f"t.{k} is not distinct from {_idx_name(s.table)}.{k}" for k in s.keys)
        joins.append(f"left join {_idx_name(s.table)} on {on}")
    cols = []
    for c in columns:
        cols.append("t.row_pos as event_id" if c == "event_id" else (c if c.endswith("_id") else f"t.{c}"))
    return f"select {', '.join(cols)} from trips t {' '.join(joins)}"


def fact_sql() -> str:
    return _fact_select(DIMENSIONS, FACT_COLUMNS)


def queries() -> dict[str, str]:
    q: dict[str, str] = {}
    trip_cols = [f.name for f in TRIPS.fields]

    q["head_slice"] = (
        "select event_id, ts, user_id, event_type, value, props, event_id as row_pos "
        "from events where event_id < 777"
    )
    q["preview_rows"] = _with() + " select row_pos, " + ", ".join(trip_cols) + " from trips where row_pos < 5"
    q["cast_if_present"] = _with() + (
        " select row_pos, cast(tpep_pickup_datetime as varchar) as tpep_pickup_datetime, "
        "cast(hour(tpep_pickup_datetime) as int) as pickup_hour from trips"
    )
    q["read_trip_files"] = _with() + (
        " select cast(row_number() over (order by row_pos % 2, row_pos) - 1 as bigint) as row_pos, "
        + ", ".join(trip_cols) + " from trips"
    )
    q["zone_lookup_distinct"] = _with() + " select LocationID, borough, zone from zones"
    q["zone_lookup_csv"] = _with() + (
        " select LocationID, case when LocationID % 7 = 0 then null else borough end as borough, "
        "'The \"' || zone || '\", no. ' || LocationID as zone from zones"
    )
    doubled = (
        "doubled as (select row_pos * 2 as row_pos, " + ", ".join(trip_cols) + " from trips "
        "union all select row_pos * 2 + 1 as row_pos, " + ", ".join(trip_cols) + " from trips)"
    )
    q["distinct_trips"] = _with(doubled) + (
        " select min(row_pos) as row_pos, " + ", ".join(trip_cols) + " from doubled group by " + ", ".join(trip_cols)
    )
    q["duplicate_rows"] = (
        "select doc_id, first_doc_id from (select doc_id, min(doc_id) over (partition by text) as first_doc_id "
        "from documents) where doc_id <> first_doc_id"
    )
    q["duplicate_count"] = (
        "select cast(count(*) as bigint) as n_rows, "
        "cast((select count(*) from (select distinct text from documents)) as bigint) as n_distinct, "
        "cast(count(*) - (select count(*) from (select distinct text from documents)) as bigint) as n_duplicates "
        "from documents"
    )
    repeated = (
        "repeated as (select " + ", ".join(trip_cols) + " from trips union all select " + ", ".join(trip_cols)
        + " from trips where row_pos % 4 = 0)"
    )
    distinct_trips = "(select count(*) from (select distinct " + ", ".join(trip_cols) + " from repeated))"
    q["trip_duplicate_count"] = _with(repeated) + (
        f" select cast(count(*) as bigint) as n_rows, cast({distinct_trips} as bigint) as n_distinct, "
        f"cast(count(*) - {distinct_trips} as bigint) as n_duplicates from repeated"
    )
    q["first_seen_ids_small"] = _with(_key_cte("ids", ["payment_type"], "payment_type_id")) + (
        " select payment_type, payment_type_id from ids"
    )
    q["first_seen_ids_large"] = (
        "with "
        + _key_cte("ids", ["l_partkey", "l_suppkey"], "part_supplier_id", source="lineitem", order="l_orderkey")
        + " select l_partkey, l_suppkey, part_supplier_id from ids"
    )
    for spec in DIMENSIONS:
        q[f"dim_{spec.table}"] = _with() + " " + _public_dim_select(spec.table)
    q["fact_trips"] = _with() + " " + fact_sql()
    q["fact_trips_wide"] = _with() + " " + _fact_select(WIDE_DIMENSIONS, WIDE_FACT_COLUMNS)
    q["enriched_trips"] = _with() + (
        " select t.row_pos as event_id, t.PULocationID, z.zone as pickup_location_zone, "
        "z.borough as pickup_location_borough, t.passenger_count, "
        "cast(t.tpep_pickup_datetime as varchar) as tpep_pickup_datetime, t.fare_amount "
        "from trips t left join zones z on t.PULocationID is not distinct from z.LocationID"
    )
    q["top_pickup_zones"] = _with() + (
        " select t.PULocationID, z.zone as pickup_location_zone, z.borough as pickup_location_borough, "
        "cast(count(*) as bigint) as trip_count "
        "from trips t left join zones z on t.PULocationID is not distinct from z.LocationID "
        "group by t.PULocationID, z.zone, z.borough "
        "order by trip_count desc, t.PULocationID asc nulls first limit 10"
    )
    q["trips_by_passenger_count"] = _with() + (
        " select passenger_count, cast(count(*) as bigint) as trip_count from trips group by passenger_count"
    )
    q["avg_fare_by_hour"] = _with() + (
        " select cast(hour(tpep_pickup_datetime) as int) as pickup_hour, "
        "round(round(sum(fare_amount), 6) / count(fare_amount), 4) as avg_fare_amount, cast(count(*) as bigint) as trip_count "
        "from trips group by 1"
    )
    q["flag_value_counts"] = _with() + (
        " select store_and_fwd_flag, cast(count(*) as bigint) as trip_count from trips "
        "where store_and_fwd_flag is not null group by store_and_fwd_flag"
    )
    profile = " union all ".join(
        f"select cast({i} as int) as position, '{f.name}' as column_name, "
        f"'{f.dataType.simpleString()}' as data_type, cast(count({f.name}) as bigint) as non_null_count from trips"
        for i, f in enumerate(TRIPS.fields)
    )
    q["column_profile"] = _with() + " " + profile
    q["trip_files_profile"] = q["column_profile"]
    q["file_profile"] = " union all ".join(
        f"select cast({i} as int) as position, '{name}' as column_name, '{kind}' as data_type, "
        f"cast(count({name}) as bigint) as non_null_count from events"
        for i, (name, kind) in enumerate(EVENT_COLUMNS.items())
    )
    q["row_reconciliation"] = _with(f"fact as ({fact_sql()})") + (
        " select cast((select count(*) from trips) as bigint) as raw_rows, "
        "cast((select count(*) from fact) as bigint) as fact_rows, "
        "cast((select count(*) from trips) - (select count(*) from fact) as bigint) as difference"
    )
    ambiguous = (
        "ambiguous_raw as (select * from zones_raw union all select LocationID, borough, zone || ' (old)' from zones_raw "
        "where LocationID % 50 = 0), ambiguous as (select distinct * from ambiguous_raw)"
    )
    q["lookup_key_report"] = _with(ambiguous) + (
        " select cast((select count(*) from ambiguous_raw) as bigint) as n_rows, "
        "cast((select count(*) from ambiguous) as bigint) as n_distinct_rows, "
        "cast((select count(*) from (select distinct LocationID from ambiguous)) as bigint) as n_keys, "
        "cast((select count(*) from (select LocationID from ambiguous group by LocationID having count(*) > 1)) "
        "as bigint) as n_violating_keys"
    )
    q["lookup_key_violations"] = _with(ambiguous) + (
        " select LocationID, cast(count(*) as bigint) as n_rows from ambiguous group by LocationID having count(*) > 1"
    )
    nulls = ", ".join(
        f"cast(sum(case when {c} is null then 1 else 0 end) as bigint) as null_{c}"
        for c in FACT_COLUMNS
        if c != "event_id"
    )
    q["fk_completeness"] = _with(f"fact as ({fact_sql()})") + (
        f" select cast(count(*) as bigint) as fact_rows, {nulls} from fact"
    )
    report = " union all ".join(
        f"select '{s.table}' as table_name, cast(count(*) as bigint) as n_rows, cast({s.n_cols} as int) as n_cols "
        f"from {_idx_name(s.table)}"
        for s in DIMENSIONS
    )
    q["load_report"] = _with() + (
        f" {report} union all select 'trips' as table_name, cast(count(*) as bigint) as n_rows, "
        f"cast({len(FACT_COLUMNS)} as int) as n_cols from trips"
    )
    q["enriched_trips_salted"] = q["enriched_trips"]
    q["warehouse_trips"] = q["fact_trips"]
    q["warehouse_avg_fare_by_hour"] = q["avg_fare_by_hour"]
    return q


__all__ = ["fact_sql", "queries"]
