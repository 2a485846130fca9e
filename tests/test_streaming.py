"""The file-arrival trigger rebuilds the star over every file seen so far."""

from __future__ import annotations

import os

import pyarrow as pa
import pyarrow.parquet as pq

from trip_star.plans import build_star
from trip_star.schemas import ROW_POS, TRIP_COLUMNS
from trip_star.sources import fixture_trips, fixture_zones_raw, read_trips
from trip_star.streaming import rebuild_on_new_files


def _write(pdf, path):
    pq.write_table(pa.Table.from_pandas(pdf, preserve_index=False), path, coerce_timestamps="us")


def test_rebuild_on_new_files(spark, sf_dir, scratch):
    trips = fixture_trips(spark, sf_dir).orderBy(ROW_POS).select(*TRIP_COLUMNS).toPandas()
    zones = fixture_zones_raw(spark, sf_dir)
    folder = os.path.join(scratch, "landing")
    os.makedirs(folder, exist_ok=True)
    ckpt = os.path.join(scratch, "stream-ckpt")

    _write(trips.iloc[:600], os.path.join(folder, "trips-000.parquet"))
    rebuild_on_new_files(spark, folder, zones, "trip_star_stream", ckpt).awaitTermination(120)
    assert spark.table("trip_star_stream.trips").count() == 600

    os.makedirs(os.path.join(folder, "later"))  # "later/..." sorts before "trips-000": both readers list subfolders
    _write(trips.iloc[600:], os.path.join(folder, "later", "trips-001.parquet"))
    rebuild_on_new_files(spark, folder, zones, "trip_star_stream", ckpt).awaitTermination(120)
    fact = spark.table("trip_star_stream.trips")
    assert fact.count() == len(trips)

    # same star as one batch build over the same folder
    build_star(spark, read_trips(spark, folder), zones, "trip_star_batch")
    batch = spark.table("trip_star_batch.trips")
    assert fact.exceptAll(batch).count() == 0 and batch.exceptAll(fact).count() == 0
    # positions run on across the two files
    assert sorted(r[0] for r in fact.select("event_id").collect()) == list(range(len(trips)))


def test_empty_landing_folder_builds_nothing(spark, sf_dir, scratch):
    folder = os.path.join(scratch, "empty_landing")
    os.makedirs(folder, exist_ok=True)
    zones = fixture_zones_raw(spark, sf_dir)
    query = rebuild_on_new_files(spark, folder, zones, "trip_star_empty", os.path.join(scratch, "empty-ckpt"))
    query.awaitTermination(120)
    assert query.exception() is None
    assert not spark.catalog.tableExists("trip_star_empty.trips")


def test_files_that_sort_last_are_appended(spark, sf_dir, scratch):
    """Ids continue: the star equals a full build on the same files after every
    step, with every join shuffled and numbering by ranges, too."""
    from pyspark.sql import functions as F

    from trip_star.plans import TABLES, refresh_star, written_fk_completeness, written_reconciliation
    from trip_star.sources import pin

    trips = fixture_trips(spark, sf_dir).orderBy(ROW_POS).select(*TRIP_COLUMNS).toPandas()
    zones = fixture_zones_raw(spark, sf_dir)
    folder = os.path.join(scratch, "growing")
    os.makedirs(folder, exist_ok=True)
    cuts = [(0, 300), (300, 420), (420, 421), (421, len(trips))]
    done = []
    for i, (a, b) in enumerate(cuts):
        _write(trips.iloc[a:b], os.path.join(folder, f"trips-{i:03d}.parquet"))
        options = {"broadcast_max_rows": 0, "bucket_rows": 32, "small_rows": 0} if i == 3 else {}
        report, how = refresh_star(spark, folder, zones, "trip_star_growing", **options)
        done.append(how)
        rows = {r["table_name"]: r["n_rows"] for r in report.collect()}
        assert set(rows) == set(TABLES) and rows["trips"] == b
    assert done == ["build", "append", "append", "append"]
    assert pin(spark, "trip_star_growing").part == 3
    build_star(spark, read_trips(spark, folder), zones, "trip_star_grown")
    for t in TABLES:
        a, b = spark.table(f"trip_star_growing.{t}"), spark.table(f"trip_star_grown.{t}")
        assert rows[t] == a.count() == b.count()
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, t
    assert tuple(written_reconciliation(spark, "trip_star_growing").first()) == (len(trips), len(trips), 0)
    assert sum(written_fk_completeness(spark, "trip_star_growing").first()) == len(trips)

    # nothing new; then a changed lookup, a changed file and a file that sorts first all need a build
    assert refresh_star(spark, folder, zones, "trip_star_growing")[1] == "none"
    assert refresh_star(spark, folder, zones.withColumn("zone", F.concat("zone", F.lit("!"))), "trip_star_growing")[1] == "build"
    _write(trips.iloc[:10], os.path.join(folder, "a-first.parquet"))
    assert refresh_star(spark, folder, zones.withColumn("zone", F.concat("zone", F.lit("!"))), "trip_star_growing")[1] == "build"
    _write(trips.iloc[5:25], os.path.join(folder, "trips-002.parquet"))
    assert refresh_star(spark, folder, zones.withColumn("zone", F.concat("zone", F.lit("!"))), "trip_star_growing")[1] == "build"


def test_an_append_that_fails_changes_nothing_and_can_be_repeated(spark, sf_dir, scratch, monkeypatch):
    from trip_star.plans import refresh, refresh_star

    trips = fixture_trips(spark, sf_dir).orderBy(ROW_POS).select(*TRIP_COLUMNS).toPandas()
    zones = fixture_zones_raw(spark, sf_dir)
    folder = os.path.join(scratch, "failing")
    os.makedirs(folder, exist_ok=True)
    _write(trips.iloc[:50], os.path.join(folder, "a.parquet"))
    refresh_star(spark, folder, zones, "trip_star_failing")
    _write(trips.iloc[50:90], os.path.join(folder, "b.parquet"))

    from trip_star.sinks import tables, versions

    def fail(*args, **kwargs):
        raise RuntimeError("commit")

    monkeypatch.setattr(tables.versions, "commit", fail)
    try:
        refresh_star(spark, folder, zones, "trip_star_failing")
        raise AssertionError("the commit was refused")
    except RuntimeError:
        pass
    monkeypatch.undo()
    assert refresh.pin(spark, "trip_star_failing").part == 0 and versions.has_version(spark, "trip_star_failing")
    assert spark.table("trip_star_failing.trips").count() == 50
    assert refresh_star(spark, folder, zones, "trip_star_failing")[1] == "append"
    assert spark.table("trip_star_failing.trips").count() == 90
