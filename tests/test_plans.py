"""Dimensions, fact, build and checks: invariants of the star."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from trip_star.plans import (
    DIMENSIONS,
    FACT_COLUMNS,
    assert_unique_lookup,
    build_star,
    dimension,
    fact_trips,
    fk_completeness,
    lookup_key_report,
    row_reconciliation,
)
from trip_star.sources import fixture_trips, fixture_zones_raw


@pytest.fixture(scope="module")
def inputs(spark, sf_dir):
    return fixture_trips(spark, sf_dir), fixture_zones_raw(spark, sf_dir)


def test_every_dimension_has_ids_0_to_n(inputs):
    trips, zones = inputs
    for spec in DIMENSIONS:
        dim = dimension(trips, spec, zones)
        assert tuple(dim.columns) == spec.columns
        ids = sorted(r[0] for r in dim.select(spec.id_col).collect())
        assert ids == list(range(len(ids))), spec.table


def test_fact_is_complete_and_reconciles(inputs):
    trips, _ = inputs
    fact = fact_trips(trips)
    assert tuple(fact.columns) == FACT_COLUMNS
    fk = fk_completeness(fact).first().asDict()
    assert fk.pop("fact_rows") == trips.count()
    assert set(fk.values()) == {0}
    rec = row_reconciliation(trips, fact).first()
    assert rec["difference"] == 0


def test_fact_ids_point_back_to_the_same_values(inputs):
    trips, zones = inputs
    fact = fact_trips(trips)
    rates = dimension(trips, "rate_codes")
    back = fact.join(rates, "rate_code_id").select("event_id", "RatecodeID")
    raw = trips.select(F.col("row_pos").alias("event_id"), "RatecodeID")
    assert back.exceptAll(raw).count() == 0 and raw.exceptAll(back).count() == 0


def test_fan_out_lookup_fails_the_build(spark, inputs):
    trips, _ = inputs
    zones = spark.createDataFrame(
        [(1, "Queens", "A"), (1, "Queens", "B"), (2, "Bronx", "C")], "LocationID long, borough string, zone string"
    )
    with pytest.raises(ValueError, match="repeats LocationID"):
        assert_unique_lookup(zones)
    with pytest.raises(ValueError):
        build_star(spark, trips, zones, database="trip_star_fanout")
    report = lookup_key_report(zones).first().asDict()
    assert report == {"n_rows": 3, "n_distinct_rows": 3, "n_keys": 2, "n_violating_keys": 1}


def test_build_twice_gives_identical_tables(spark, inputs):
    trips, zones = inputs
    first = {r["table_name"]: (r["n_rows"], r["n_cols"]) for r in build_star(spark, trips, zones, "trip_star_a").collect()}
    second = {r["table_name"]: (r["n_rows"], r["n_cols"]) for r in build_star(spark, trips.repartition(5), zones, "trip_star_b").collect()}
    assert first == second and len(first) == 11
    assert first["trips"] == (trips.count(), 11)
    for name in first:
        a, b = spark.table(f"trip_star_a.{name}"), spark.table(f"trip_star_b.{name}")
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name
    # the fact written by the build equals the lazily built one
    lazy = fact_trips(trips)
    written = spark.table("trip_star_a.trips")
    assert lazy.exceptAll(written).count() == 0


def test_build_with_shuffled_large_dimensions(spark, inputs):
    """Force the non-broadcast path for every dimension; the ids must not change."""
    trips, zones = inputs
    build_star(spark, trips, zones, "trip_star_c", broadcast_max_rows=0, bucket_rows=64)
    a, b = fact_trips(trips), spark.table("trip_star_c.trips")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_fact_through_salted_shuffle_joins_matches(spark, inputs):
    """No broadcast at all and a hot threshold of 2 rows: every large-dimension
    join goes through the salted sort-merge path; the ids must not change."""
    trips, _ = inputs
    expected = fact_trips(trips)
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        salted = fact_trips(trips, broadcast=frozenset(), hot_min_rows=2, bucket_rows=100)
        plan = salted._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") >= 2
        assert salted.exceptAll(expected).count() == 0 and expected.exceptAll(salted).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)


def test_write_table_replaces_stale_files_and_reruns(spark):
    from trip_star.sinks import ensure_database, write_table

    ensure_database(spark, "trip_star_sink")
    root = spark.catalog.getDatabase("trip_star_sink").locationUri.rstrip("/")
    spark.range(7).write.mode("overwrite").parquet(f"{root}/stale")  # left by an earlier session
    write_table(spark.range(3), "stale", "trip_star_sink")
    assert spark.table("trip_star_sink.stale").count() == 3
    write_table(spark.range(5), "stale", "trip_star_sink")
    assert spark.table("trip_star_sink.stale").count() == 5


def test_reports_on_the_warehouse_equal_the_in_session_star(spark, inputs):
    from trip_star.plans import (
        avg_fare_by_hour,
        enriched_trips,
        star_from_trips,
        star_from_warehouse,
        top_pickup_zones,
        trips_by_passenger_count,
    )

    trips, zones = inputs
    build_star(spark, trips, zones, "trip_star_wh")
    wh = star_from_warehouse(spark, "trip_star_wh")
    mem = star_from_trips(trips, zones)

    def same(a, b):
        return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0

    assert same(
        top_pickup_zones(wh.fact, wh.dims["pickup_locations"]),
        top_pickup_zones(mem.fact, mem.dims["pickup_locations"]),
    )
    assert same(
        trips_by_passenger_count(wh.fact, wh.dims["passenger_counts"]),
        trips_by_passenger_count(mem.fact, mem.dims["passenger_counts"]),
    )
    assert same(
        avg_fare_by_hour(wh.fact, wh.dims["datetimes"], wh.dims["fares"], broadcast=wh.small),
        avg_fare_by_hour(mem.fact, mem.dims["datetimes"], mem.dims["fares"], broadcast=mem.small),
    )
    cols = ["event_id", "PULocationID", "passenger_count", "fare_amount"]
    attach = ["pickup_locations", "passenger_counts", "fares"]
    assert same(
        enriched_trips(wh.fact, wh.dims, attach, cols, broadcast=frozenset()),  # skew-safe lookups
        enriched_trips(mem.fact, mem.dims, attach, cols, broadcast=mem.small),
    )


def test_a_failed_build_leaves_the_old_star_whole(spark, inputs, monkeypatch):
    from trip_star.plans import build

    trips, zones = inputs
    build_star(spark, trips, zones, "trip_star_swap")
    before = {t: sorted(map(str, spark.table(f"trip_star_swap.{t}").collect())) for t in ("trips", "vendors", "fares")}

    def fail(*args, **kwargs):
        raise RuntimeError("fact write")

    monkeypatch.setattr(build, "fact_rows", fail)
    with pytest.raises(RuntimeError, match="fact write"):
        build_star(spark, trips.filter("row_pos < 10"), zones, "trip_star_swap")
    assert {t: sorted(map(str, spark.table(f"trip_star_swap.{t}").collect())) for t in before} == before
