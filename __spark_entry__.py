"""

``entry(spark)`` runs the flagship query (the trips fact) on sf0.001;
each taking ``(spark, sf_dir)``; ``oracle_sql()`` gives the DuckDB text for the
same result. Every query reads the driver tables whole (the trip-shaped views
are derived from ``events``, ``customer`` and ``nation``, see FIXTURES.md).
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from trip_star import oracle  # noqa: E402
from trip_star.operators import (  # noqa: E402
    distinct_rows,
    duplicate_count,
    duplicate_rows,
    first_seen_ids,
)
from trip_star.plans import (  # noqa: E402
    DIMENSIONS,
    Star,
    avg_fare_by_hour,
    build_fact,
    build_star,
    dimension,
    enriched_trips,
    fact_trips,
    fact_trips_wide,
    flag_value_counts,
    lookup_key_report,
    lookup_key_violations,
    star_from_trips,
    star_from_warehouse,
    top_pickup_zones,
    trips_by_passenger_count,
    trips_profile,
    written_fk_completeness,
    written_reconciliation,
)
from trip_star.schemas import ROW_POS, TIMESTAMP_COLUMNS, TRIP_COLUMNS  # noqa: E402
from trip_star.session import ensure_checkpoint_dir  # noqa: E402
from trip_star.functions import cast_timestamps_if_present, text_timestamps_if_present  # noqa: E402
from trip_star.sources import (  # noqa: E402
    file_profile,
    fixture_trips,
    fixture_zones_raw,
    head_slice,
    preview,
    read_table,
    read_trips,
    read_zones_csv,
    table,
    trip_files_profile,
    with_row_pos,
)

try:
    from trip_star.llm import registry as llm_registry
except ImportError as missing:
    # the subpackage, corpus_pipeline.py or a library they need is not there: the star works without them
    print(f"training-data queries are left out: {missing}", file=sys.stderr)
    llm_registry = None

SF_SMOKE = "/root/testdata/sf0.001"
# Rows of the positional slice: under the row count from sf0.001 on, so it cuts.
HEAD_ROWS = 777
CHECK_DATABASE = "trip_star_check"


def _inputs(spark: SparkSession, sf_dir: str):
    return fixture_trips(spark, sf_dir), fixture_zones_raw(spark, sf_dir)


def _star(spark: SparkSession, sf_dir: str, tables: list[str]) -> Star:
    """The fact ids and public dimensions a report reads (same ids as the full star)."""
    trips, zones = _inputs(spark, sf_dir)
    return star_from_trips(trips, zones, tables)


def q_head_slice(spark, sf_dir):
    events = with_row_pos(table(spark, sf_dir, "events"))
    return head_slice(events, HEAD_ROWS)


def q_preview_rows(spark, sf_dir):
    trips, _ = _inputs(spark, sf_dir)
    return preview(trips).select(ROW_POS, *TRIP_COLUMNS)


def q_cast_if_present(spark, sf_dir):
    trips, _ = _inputs(spark, sf_dir)
    # a text column to parse, and no drop-off column at all
    text = text_timestamps_if_present(trips.select(ROW_POS, TIMESTAMP_COLUMNS[0]), TIMESTAMP_COLUMNS)
    typed = cast_timestamps_if_present(text, TIMESTAMP_COLUMNS).withColumn("pickup_hour", F.hour(TIMESTAMP_COLUMNS[0]))
    return text_timestamps_if_present(typed, TIMESTAMP_COLUMNS)


def _staging(spark, name: str) -> str:
    """A folder of its own for every run, on shared storage."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def q_read_trip_files(spark, sf_dir):
    """Month files that differ in physical types and column case, some in a
    subfolder, read back in path order with positions."""
    return read_trips(spark, _month_files(spark, sf_dir)).select(ROW_POS, *TRIP_COLUMNS)


def _month_files(spark, sf_dir) -> str:
    trips, _ = _inputs(spark, sf_dir)
    folder = _staging(spark, "trip_files")
    for rest, name in ((0, "a"), (1, "b/c")):
        part = trips.filter(F.col(ROW_POS) % 2 == rest).select(ROW_POS, *TRIP_COLUMNS)
        if rest:
            part = part.withColumn("passenger_count", F.col("passenger_count").cast("double")).withColumnRenamed("airport_fee", "Airport_fee")
        part.repartitionByRange(3, ROW_POS).sortWithinPartitions(ROW_POS).drop(ROW_POS).write.parquet(f"{folder}/{name}")
    return folder


def q_trip_files_profile(spark, sf_dir):
    """The same files, profiled from their footers but for the float columns."""
    return trip_files_profile(spark, _month_files(spark, sf_dir))


def q_file_profile(spark, sf_dir):
    """The events file as stored, profiled from its footers."""
    return file_profile(spark, f"{sf_dir.rstrip('/')}/events.parquet")


def q_zone_lookup_distinct(spark, sf_dir):
    _, zones = _inputs(spark, sf_dir)
    return distinct_rows(zones, order_col=None).select("LocationID", "borough", "zone")


def q_zone_lookup_csv(spark, sf_dir):
    """The lookup written as a header CSV (with a column the reader must skip,
    placed first; names with quotes and commas; missing markers), read back by name."""
    _, zones = _inputs(spark, sf_dir)
    folder = _staging(spark, "zones_csv")
    zones.select(
        F.lit("Yellow Zone").alias("service_zone"),
        F.concat(F.lit('The "'), "zone", F.lit('", no. '), "LocationID").alias("zone"),
        "LocationID",
        F.when(F.col("LocationID") % 7 == 0, "N/A").otherwise(F.col("borough")).alias("borough"),
    ).write.option("header", True).option("escape", '"').csv(folder)
    return distinct_rows(read_zones_csv(spark, folder), order_col=None)


def q_distinct_trips(spark, sf_dir):
    trips, _ = _inputs(spark, sf_dir)
    cols = [ROW_POS, *TRIP_COLUMNS]
    doubled = trips.select(*cols).withColumn(ROW_POS, F.col(ROW_POS) * 2).unionByName(
        trips.select(*cols).withColumn(ROW_POS, F.col(ROW_POS) * 2 + 1)
    )
    return distinct_rows(doubled, ROW_POS)


def q_duplicate_rows(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return duplicate_rows(docs, ["text"], order_col="doc_id", first_col="first_doc_id").select(
        "doc_id", "first_doc_id"
    )


def q_duplicate_count(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return duplicate_count(docs, ["text"])


def q_trip_duplicate_count(spark, sf_dir):
    """The notebook's raw-data check: full-row duplicates among the trips."""
    trips, _ = _inputs(spark, sf_dir)
    cols = list(TRIP_COLUMNS)
    repeated = trips.select(*cols).unionByName(trips.filter(F.col(ROW_POS) % 4 == 0).select(*cols))
    return duplicate_count(repeated, cols)


def q_first_seen_ids_small(spark, sf_dir):
    trips, _ = _inputs(spark, sf_dir)
    return first_seen_ids(trips, ["payment_type"], "payment_type_id")


def q_first_seen_ids_large(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem")
    return first_seen_ids(lineitem, ["l_partkey", "l_suppkey"], "part_supplier_id", order_col="l_orderkey")


def _q_dim(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark, sf_dir):
        trips, zones = _inputs(spark, sf_dir)
        return dimension(trips, name, zones)

    run.__name__ = f"q_dim_{name}"
    return run


def q_fact_trips(spark, sf_dir):
    trips, _ = _inputs(spark, sf_dir)
    return fact_trips(trips)


def q_fact_trips_wide(spark, sf_dir):
    trips, _ = _inputs(spark, sf_dir)
    return fact_trips_wide(trips)


def q_enriched_trips(spark, sf_dir):
    attach = ["pickup_locations", "passenger_counts", "datetimes", "fares"]
    star = _star(spark, sf_dir, attach)
    cols = [
        "event_id",
        "PULocationID",
        "pickup_location_zone",
        "pickup_location_borough",
        "passenger_count",
        "tpep_pickup_datetime",
        "fare_amount",
    ]
    return enriched_trips(star.fact, star.dims, attach, cols, broadcast=star.small, freq=star.freq)


def q_enriched_trips_salted(spark, sf_dir):
    """The enriched view without any broadcast dimension: frequent ids are hot and salted."""
    attach = ["pickup_locations", "passenger_counts", "datetimes", "fares"]
    star = _star(spark, sf_dir, attach)
    cols = ["event_id", "PULocationID", "pickup_location_zone", "pickup_location_borough", "passenger_count", "tpep_pickup_datetime", "fare_amount"]
    return enriched_trips(star.fact, star.dims, attach, cols, broadcast=frozenset(), freq=star.freq, hot_min_rows=20)


def q_warehouse_trips(spark, sf_dir):
    """The written fact, read back."""
    trips, zones = _inputs(spark, sf_dir)
    build_star(spark, trips, zones, database=f"{CHECK_DATABASE}_fact")
    return read_table(spark, "trips", f"{CHECK_DATABASE}_fact")


def q_warehouse_avg_fare_by_hour(spark, sf_dir):
    """A report on the written tables."""
    trips, zones = _inputs(spark, sf_dir)
    build_star(spark, trips, zones, database=f"{CHECK_DATABASE}_report")
    star = star_from_warehouse(spark, f"{CHECK_DATABASE}_report", ["datetimes", "fares"])
    return avg_fare_by_hour(star.fact, star.dims["datetimes"], star.dims["fares"], broadcast=star.small, freq=star.freq)


def q_top_pickup_zones(spark, sf_dir):
    star = _star(spark, sf_dir, ["pickup_locations"])
    return top_pickup_zones(star.fact, star.dims["pickup_locations"])


def q_trips_by_passenger_count(spark, sf_dir):
    star = _star(spark, sf_dir, ["passenger_counts"])
    return trips_by_passenger_count(star.fact, star.dims["passenger_counts"])


def q_avg_fare_by_hour(spark, sf_dir):
    star = _star(spark, sf_dir, ["datetimes", "fares"])
    return avg_fare_by_hour(star.fact, star.dims["datetimes"], star.dims["fares"], broadcast=star.small, freq=star.freq)


def q_flag_value_counts(spark, sf_dir):
    trips, _ = _inputs(spark, sf_dir)
    return flag_value_counts(trips)


def q_column_profile(spark, sf_dir):
    trips, _ = _inputs(spark, sf_dir)
    return trips_profile(trips)


def q_row_reconciliation(spark, sf_dir):
    """A written fact, checked by the numbers its write observed."""
    trips, _ = _inputs(spark, sf_dir)
    build_fact(spark, trips, database=f"{CHECK_DATABASE}_rows")
    return written_reconciliation(spark, f"{CHECK_DATABASE}_rows")


def _ambiguous_zones(spark, sf_dir):
    """A lookup in which some keys have two different rows."""
    _, zones = _inputs(spark, sf_dir)
    other = zones.filter(F.col("LocationID") % 50 == 0).withColumn("zone", F.concat("zone", F.lit(" (old)")))
    return zones.unionByName(other)


def q_lookup_key_report(spark, sf_dir):
    return lookup_key_report(_ambiguous_zones(spark, sf_dir))


def q_lookup_key_violations(spark, sf_dir):
    """Keys the de-duplicated lookup still repeats (none when the build may run)."""
    return lookup_key_violations(_ambiguous_zones(spark, sf_dir))


def q_fk_completeness(spark, sf_dir):
    trips, _ = _inputs(spark, sf_dir)
    build_fact(spark, trips, database=f"{CHECK_DATABASE}_keys")
    return written_fk_completeness(spark, f"{CHECK_DATABASE}_keys")


def q_load_report(spark, sf_dir):
    trips, zones = _inputs(spark, sf_dir)
    return build_star(spark, trips, zones, database=CHECK_DATABASE)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the trips fact (ten null-safe dimension joins) on sf0.001."""
    return q_fact_trips(spark, SF_SMOKE)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        "head_slice": q_head_slice,
        "preview_rows": q_preview_rows,
        "cast_if_present": q_cast_if_present,
        "read_trip_files": q_read_trip_files,
        "zone_lookup_distinct": q_zone_lookup_distinct,
        "zone_lookup_csv": q_zone_lookup_csv,
        "distinct_trips": q_distinct_trips,
        "duplicate_rows": q_duplicate_rows,
        "duplicate_count": q_duplicate_count,
        "trip_duplicate_count": q_trip_duplicate_count,
        "first_seen_ids_small": q_first_seen_ids_small,
        "first_seen_ids_large": q_first_seen_ids_large,
    }
    for spec in DIMENSIONS:
        q[f"dim_{spec.table}"] = _q_dim(spec.table)
    q.update(
        {
            "fact_trips": q_fact_trips,
            "fact_trips_wide": q_fact_trips_wide,
            "enriched_trips": q_enriched_trips,
            "enriched_trips_salted": q_enriched_trips_salted,
            "warehouse_trips": q_warehouse_trips,
            "warehouse_avg_fare_by_hour": q_warehouse_avg_fare_by_hour,
            "top_pickup_zones": q_top_pickup_zones,
            "trips_by_passenger_count": q_trips_by_passenger_count,
            "avg_fare_by_hour": q_avg_fare_by_hour,
            "flag_value_counts": q_flag_value_counts,
            "column_profile": q_column_profile,
            "trip_files_profile": q_trip_files_profile,
            "file_profile": q_file_profile,
            "row_reconciliation": q_row_reconciliation,
            "lookup_key_report": q_lookup_key_report,
            "lookup_key_violations": q_lookup_key_violations,
            "fk_completeness": q_fk_completeness,
            "load_report": q_load_report,
        }
    )
    if llm_registry:
        q.update(llm_registry.queries())
    return q


def oracle_sql() -> dict[str, str]:
    sql = oracle.queries()
    if llm_registry:
        sql.update(llm_registry.oracle_sql())
    return sql
