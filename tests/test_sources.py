"""Sources: row positions over several files, missing columns, CSV by name."""

from __future__ import annotations

import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from trip_star.schemas import ROW_POS
from trip_star.sources import conform, head_slice, preview, read_trips, read_zones_csv, with_row_pos


def test_single_file_position_is_the_row_index(spark, sf_dir):
    events = with_row_pos(spark.read.parquet(f"{sf_dir}/events.parquet"))
    mismatched = events.filter(F.col(ROW_POS) != F.col("event_id")).count()
    assert mismatched == 0


def test_position_runs_on_across_files(spark, sf_dir, scratch):
    table = pq.read_table(f"{sf_dir}/events.parquet")
    folder = os.path.join(scratch, "two_files")
    os.makedirs(folder, exist_ok=True)
    pq.write_table(table.slice(0, 400), os.path.join(folder, "part-0.parquet"), row_group_size=128)
    pq.write_table(table.slice(400), os.path.join(folder, "part-1.parquet"), row_group_size=128)
    events = with_row_pos(spark.read.parquet(folder))
    got = {r["event_id"]: r[ROW_POS] for r in events.select("event_id", ROW_POS).collect()}
    assert got == {i: i for i in range(table.num_rows)}
    assert head_slice(events, 450).count() == 450


def test_read_trips_skips_missing_timestamp_column(spark, scratch):
    folder = os.path.join(scratch, "trips_no_dropoff")
    spark.createDataFrame(
        [(1, "2016-03-01 10:00:00", 2, 1.5)],
        "VendorID long, tpep_pickup_datetime string, payment_type long, fare_amount double",
    ).write.mode("overwrite").parquet(folder)
    trips = read_trips(spark, folder)
    assert "tpep_dropoff_datetime" not in trips.columns
    row = trips.first()
    assert row[ROW_POS] == 0 and row["VendorID"] == 1 and str(row["tpep_pickup_datetime"]) == "2016-03-01 10:00:00"
    assert dict(trips.dtypes)["VendorID"] == "int"


def test_conform_selects_by_name_and_casts(spark):
    df = spark.createDataFrame([(7.0, 3, "x")], "passenger_count double, RatecodeID long, other string")
    out = conform(df)
    assert out.columns == ["passenger_count", "RatecodeID"]
    assert dict(out.dtypes) == {"passenger_count": "int", "RatecodeID": "int"}


def test_zone_csv_is_read_by_header_name(spark, scratch):
    path = os.path.join(scratch, "zones.csv")
    with open(path, "w") as fh:
        fh.write("zone,service_zone,LocationID,borough\n")
        fh.write("Newark Airport,EWR,1,EWR\nJamaica Bay,Boro Zone,2,Queens\n")
    zones = read_zones_csv(spark, path)
    assert zones.columns == ["LocationID", "borough", "zone"]
    assert sorted(map(tuple, zones.collect())) == [(1, "EWR", "Newark Airport"), (2, "Queens", "Jamaica Bay")]


def test_preview_is_first_rows_in_order(spark, sf_dir):
    events = with_row_pos(spark.read.parquet(f"{sf_dir}/events.parquet"))
    assert [r[ROW_POS] for r in preview(events).collect()] == [0, 1, 2, 3, 4]


def test_conform_maps_nan_counts_to_null(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "passenger_count double")
    assert [r[0] for r in conform(df).collect()] == [1, None, None]


def test_positions_exact_when_files_are_split(spark, sf_dir, scratch):
    table = pq.read_table(f"{sf_dir}/events.parquet")
    folder = os.path.join(scratch, "split_files")
    os.makedirs(folder, exist_ok=True)
    for i, (lo, hi) in enumerate([(0, 300), (300, 700), (700, table.num_rows)]):
        pq.write_table(table.slice(lo, hi - lo), os.path.join(folder, f"part-{i}.parquet"), row_group_size=50)
    saved = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")  # several splits per file
    try:
        events = with_row_pos(spark.read.parquet(folder))
        assert events.rdd.getNumPartitions() > 3
        got = {r["event_id"]: r[ROW_POS] for r in events.select("event_id", ROW_POS).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", saved)
    assert got == {i: i for i in range(table.num_rows)}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_column_pruning_reaches_the_parquet_scan(spark, sf_dir):
    from trip_star.sources import fixture_trips

    trips = fixture_trips(spark, sf_dir)
    assert "LessThan(event_id,5)" in _plan(preview(trips))
    assert "ReadSchema: struct<event_id:bigint>" in _plan(trips.select("row_pos", "VendorID"))


def _files(folder, parts):
    for name, table in parts.items():
        path = os.path.join(folder, name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        pq.write_table(table, path)


def test_head_rows_scan_only_the_leading_files(spark, scratch):
    folder = os.path.join(scratch, "months")
    _files(folder, {f"m{i}.parquet": pa.table({"VendorID": list(range(100 * i, 100 * i + 100))}) for i in range(5)})
    head = read_trips(spark, folder, head_rows=150)
    assert {os.path.basename(f) for f in head.inputFiles()} == {"m0.parquet", "m1.parquet"}
    assert sorted(r["VendorID"] for r in head.collect()) == list(range(150))


def test_months_that_differ_in_types_case_and_folder(spark, scratch):
    folder = os.path.join(scratch, "mixed_months")
    _files(
        folder,
        {
            "a.parquet": pa.table({"passenger_count": pa.array([1, 2], pa.int64()), "airport_fee": [0.5, 1.5]}),
            "sub/b.parquet": pa.table({"passenger_count": [3.0, float("nan")], "Airport_fee": [2.5, None]}),
        },
    )
    rows = read_trips(spark, folder).orderBy(ROW_POS).select(ROW_POS, "passenger_count", "airport_fee").collect()
    assert [tuple(r) for r in rows] == [(0, 1, 0.5), (1, 2, 1.5), (2, 3, 2.5), (3, None, None)]


def test_a_fractional_count_is_an_error(spark):
    with pytest.raises(Exception, match="fraction"):
        conform(spark.createDataFrame([(1.9,)], "passenger_count double")).collect()


def test_csv_quotes_commas_and_missing_markers(spark, scratch):
    folder = os.path.join(scratch, "zone_csvs")
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, "1.csv"), "w") as f:
        f.write('LocationID,borough,zone\n1,"The ""Bay"" area, east",N/A\n2,NA,"two\nlines"\n')
    with open(os.path.join(folder, "2.csv"), "w") as f:
        f.write("zone,LocationID,borough\nz,3,b\n")
    got = sorted(tuple(r) for r in read_zones_csv(spark, folder).collect())
    assert got == [(1, 'The "Bay" area, east', None), (2, None, "two\nlines"), (3, "b", "z")]


def _jobs(spark, name, work):
    """What ``work`` returns and the number of Spark jobs it ran."""
    sc = spark.sparkContext
    sc.setJobGroup(name, name)
    try:
        return work(), len(sc.statusTracker().getJobIdsForGroup(name))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def _many_months(folder, n):
    tables = [
        pa.table({"VendorID": pa.array([1, 2], pa.int64()), "passenger_count": pa.array([1, 2], pa.int64())}),
        pa.table({"VendorID": pa.array([1, 2], pa.int32()), "passenger_count": [1.0, 2.0]}),
        pa.table({"VendorID": pa.array([3, 4], pa.int32())}),
    ]
    _files(folder, {f"m {i:05d}%.parquet": tables[i % 3] for i in range(n)})  # a blank and a sign that URIs escape


def test_files_are_grouped_in_one_job(spark, scratch):
    from trip_star.sources.parquet import files_by_schema

    folder = os.path.join(scratch, "many_months")
    _many_months(folder, 600)
    files = sorted(spark.read.parquet(folder).inputFiles())
    (groups, merge), jobs = _jobs(spark, "grouping", lambda: files_by_schema(spark, files))
    assert jobs == 1 and not merge
    assert sorted(map(len, groups)) == [200, 200, 200]
    trips, jobs = _jobs(spark, "reading", lambda: read_trips(spark, folder))
    assert jobs < 20  # listing, positions and one footer per group, however many files
    assert trips.count() == 1200 and trips.filter("passenger_count IS NULL").count() == 400


def test_files_that_only_spark_can_open_are_grouped_by_merging(spark, scratch, monkeypatch):
    from trip_star.sources import parquet

    folder = os.path.join(scratch, "few_months")
    old = pa.table({"VendorID": pa.array([1, 2], pa.int64())})
    new = pa.table({"VendorID": pa.array([1, 2], pa.int64()), "passenger_count": [1.0, 2.0]})
    other = pa.table({"VendorID": [1.0, 2.0]})
    _files(folder, {f"a{i}.parquet": old for i in range(5)} | {f"b{i}.parquet": new for i in range(6)} | {f"c{i}.parquet": other for i in range(5)})
    expected = sorted(map(str, read_trips(spark, folder).collect()))
    monkeypatch.setattr(parquet, "_footer_reader", lambda: lambda batches: (pa.RecordBatch.from_arrays([b.column(0), pa.nulls(b.num_rows, pa.string())], names=["path", "schema"]) for b in batches))
    files = sorted(spark.read.parquet(folder).inputFiles())
    (groups, merge), jobs = _jobs(spark, "merging", lambda: parquet.files_by_schema(spark, files))
    assert merge and jobs < 20
    assert [f for g in groups for f in g] == files and len(groups) < 6
    assert sorted(map(str, read_trips(spark, folder).collect())) == expected


def test_head_slice_stops_reading(spark, scratch):
    """A file of one split is read up to the last row wanted, not to its end."""
    folder = os.path.join(scratch, "one_split")
    _files(folder, {"a.parquet": pa.table({"x": list(range(200_000))})})
    head = head_slice(with_row_pos(spark.read.parquet(folder)), 777)
    assert sorted(r["x"] for r in head.collect()) == list(range(777))
    scan = [m for m in _scans(head)]
    assert scan and max(scan) < 20_000
    assert head_slice(with_row_pos(spark.read.parquet(folder)), 0).count() == 0


def _scans(df):
    """Rows that each file scan of the executed plan put out."""
    todo, out = [df._jdf.queryExecution().executedPlan()], []
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            node = node.executedPlan()
        if node.nodeName().startswith("Scan"):
            out.append(node.metrics().apply("numOutputRows").value())
        children = list(_seq(node.children()))
        if node.nodeName().startswith(("ShuffleQueryStage", "ResultQueryStage", "TableCacheQueryStage", "BroadcastQueryStage")):
            children.append(node.plan())
        todo += children
    return out


def _seq(s):
    return [s.apply(i) for i in range(s.size())]
