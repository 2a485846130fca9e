"""Versions of the star behind one pointer: commits are whole, readers can hold on to one."""

from __future__ import annotations

import os
import re
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from trip_star.plans import TABLES, build_star, fk_completeness, row_reconciliation, star_from_warehouse
from trip_star.plans import written_fk_completeness, written_reconciliation
from trip_star.sinks import versions
from trip_star.sources import fixture_trips, fixture_zones_raw, pin, read_table


@pytest.fixture(scope="module")
def inputs(spark, sf_dir):
    trips = fixture_trips(spark, sf_dir)
    return trips.filter("row_pos < 60"), trips.filter("row_pos < 35"), fixture_zones_raw(spark, sf_dir)


def contents(spark, database, at=None):
    return {t: sorted(map(str, read_table(spark, t, database, at).collect())) for t in ("trips", "fares", "vendors", "datetimes")}


class Refuse:
    """Fails the n-th change of the catalog."""

    def __init__(self, n):
        self.n, self.calls, self.real = n, 0, versions.catalog

    def __call__(self, spark, statement):
        self.calls += 1
        if self.calls == self.n:
            raise RuntimeError("catalog")
        return self.real(spark, statement)


def test_a_failure_of_any_catalog_call_leaves_one_whole_version(spark, inputs, monkeypatch):
    """Stage both versions once; then commit the second with each catalog call failing in turn."""
    first, second, zones = inputs
    db = "trip_star_versions"
    build_star(spark, first, zones, db)
    old, old_pin = contents(spark, db), pin(spark, db)
    build_star(spark, second, zones, f"{db}_other")
    new = contents(spark, f"{db}_other")
    assert new != old and len(new["trips"]) == 35
    tables = {t: spark.table(f"{db}_other.{t}") for t in TABLES}
    failed = 0
    for call in range(1, 100):
        version = versions.new_version()
        staged = [versions.stage(df, t, db, version) for t, df in tables.items()] if call in (1, 6, 30) or failed == 0 else staged
        refuse = Refuse(call)
        monkeypatch.setattr(versions, "catalog", refuse)
        try:
            versions.register(spark, staged, db, version)
            versions.commit(spark, db, version)
        except RuntimeError:
            failed += 1
            monkeypatch.undo()
            assert pin(spark, db) == old_pin
            if call in (1, 6, refuse.calls):
                assert contents(spark, db) == old  # by name
            continue
        monkeypatch.undo()
        break
    assert failed >= 2 * len(TABLES)  # every call up to the commit itself was tried
    assert contents(spark, db) == new
    assert contents(spark, db, old_pin) == old  # a reader that holds on to the old version keeps it


def test_first_build_that_fails_shows_no_rows(spark, inputs, monkeypatch):
    first, _, zones = inputs
    monkeypatch.setattr(versions, "commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("commit")))
    with pytest.raises(RuntimeError, match="commit"):
        build_star(spark, first, zones, "trip_star_never")
    assert spark.table("trip_star_never.trips").count() == 0
    with pytest.raises(ValueError, match="no committed version"):
        star_from_warehouse(spark, "trip_star_never")


def test_old_versions_go_after_their_grace(spark, inputs):
    first, second, zones = inputs
    db = "trip_star_grace"
    folder = spark.conf.get("spark.sql.warehouse.dir").replace("file:", "")
    build_star(spark, first, zones, db)
    one = pin(spark, db)
    build_star(spark, second, zones, db)
    two = pin(spark, db)
    assert len(contents(spark, db, one)["trips"]) == 60
    leftover = versions.new_version()  # a build that never committed
    versions.register(spark, [versions.stage(spark.table(f"{db}.vendors"), "vendors", db, leftover)], db, leftover)
    build_star(spark, first, zones, db, grace=timedelta(0))
    root = os.path.join(folder, f"{db}.db", "_versions")
    assert os.listdir(root) == [pin(spark, db).version]
    assert len(contents(spark, db)["trips"]) == 60 and contents(spark, db, two)["trips"] == []


def test_the_current_version_alone_is_listed(spark, inputs):
    """The pointer is folded into the views: a static partition filter, no join."""
    first, second, zones = inputs
    db = "trip_star_listed"
    build_star(spark, first, zones, db)
    build_star(spark, second, zones, db)
    df = spark.table(f"{db}.trips")
    version = pin(spark, db).version
    assert f"(_version = {version})" in re.sub(r"#\d+", "", df._jdf.queryExecution().optimizedPlan().toString())
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Subquery subquery" not in plan
    assert df.rdd.getNumPartitions() >= 1 and df.count() == 35
    assert {f.split("_versions/")[1].split("/")[0] for f in df.inputFiles()} == {version}


def test_other_columns_are_refused(spark, inputs):
    first, _, zones = inputs
    db = "trip_star_columns"
    build_star(spark, first, zones, db)
    version = versions.new_version()
    odd = versions.stage(spark.range(3).select(F.col("id").alias("vendor_id")), "vendors", db, version)
    with pytest.raises(ValueError, match="another database"):
        versions.register(spark, [odd], db, version)


def test_written_checks_equal_those_on_the_tables(spark, inputs):
    first, _, zones = inputs
    db = "trip_star_checks"
    report = {r["table_name"]: (r["n_rows"], r["n_cols"]) for r in build_star(spark, first, zones, db).collect()}
    assert report == {t: (spark.table(f"{db}.{t}").count(), len(spark.table(f"{db}.{t}").columns)) for t in TABLES}
    fact = spark.table(f"{db}.trips")
    assert written_reconciliation(spark, db).first() == row_reconciliation(first, fact).first()
    assert written_fk_completeness(spark, db).first() == fk_completeness(fact).first()
    empty = first.filter("row_pos < 0")
    assert {r["n_rows"] for r in build_star(spark, empty, zones, f"{db}_empty").collect()} == {0}
    assert tuple(written_reconciliation(spark, f"{db}_empty").first()) == (0, 0, 0)
