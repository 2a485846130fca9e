"""Composite plans: dimensions, facts, reports, quality checks and the full build."""

from trip_star.plans.build import TABLES, build_fact, build_star
from trip_star.plans.dims import (
    BY_TABLE,
    DIMENSIONS,
    DimSpec,
    dimension,
    key_index,
    public_columns,
)
from trip_star.plans.fact import FACT_COLUMNS, WIDE_FACT_COLUMNS, attach_dimensions, fact_trips, fact_trips_wide
from trip_star.plans.quality import (
    assert_unique_lookup,
    fk_completeness,
    lookup_key_report,
    lookup_key_violations,
    row_reconciliation,
    trips_profile,
    written_fk_completeness,
    written_reconciliation,
)
from trip_star.plans.refresh import append_star, refresh_star
from trip_star.plans.star import Star, star_from_trips, star_from_warehouse
from trip_star.plans.reports import (
    avg_fare_by_hour,
    enriched_trips,
    flag_value_counts,
    small_dimensions,
    top_pickup_zones,
    trips_by_passenger_count,
)

__all__ = [
    "BY_TABLE",
    "DIMENSIONS",
    "FACT_COLUMNS",
    "TABLES",
    "WIDE_FACT_COLUMNS",
    "DimSpec",
    "Star",
    "append_star",
    "assert_unique_lookup",
    "attach_dimensions",
    "avg_fare_by_hour",
    "build_fact",
    "build_star",
    "dimension",
    "enriched_trips",
    "fact_trips",
    "fact_trips_wide",
    "fk_completeness",
    "flag_value_counts",
    "key_index",
    "lookup_key_report",
    "lookup_key_violations",
    "public_columns",
    "refresh_star",
    "row_reconciliation",
    "small_dimensions",
    "star_from_trips",
    "star_from_warehouse",
    "top_pickup_zones",
    "trips_by_passenger_count",
    "trips_profile",
    "written_fk_completeness",
    "written_reconciliation",
]
