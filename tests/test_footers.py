"""Counts from Parquet footers."""

from __future__ import annotations

import pytest
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from trip_star.operators import column_profile
from trip_star.plans import trips_profile
from trip_star.sources import file_profile, file_row_count, footer_counts, footers, read_trips, trip_files_profile


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def _month(folder, name, **columns):
    pq.write_table(pa.table(columns), f"{folder}/{name}.parquet")


def _months(folder):
    """Three months: counts as integers; counts as doubles with NaN and another case; a month that lacks columns."""
    _month(
        folder, "a", VendorID=pa.array([1, None, 2], pa.int32()), passenger_count=pa.array([1, 2, None], pa.int64()),
        trip_distance=[1.0, float("nan"), None], store_and_fwd_flag=["Y", None, "N"],
        tpep_pickup_datetime=pa.array([0, 1, None], pa.timestamp("us")),
    )
    _month(
        folder, "b", vendorid=pa.array([1, 2], pa.int64()), passenger_count=[float("nan"), 3.0], trip_distance=[2.0, 3.0],
        store_and_fwd_flag=pa.array([None, None], pa.string()), tpep_pickup_datetime=["2024-01-01 00:00:00", None],
    )
    _month(folder, "c", VendorID=pa.array([7], pa.int32()))


def test_trip_files_profile_equals_a_scan(spark, folder):
    _months(folder)
    got = trip_files_profile(spark, folder).collect()
    counts = {r["column_name"]: r["non_null_count"] for r in got}
    assert {c: counts[c] for c in ("VendorID", "passenger_count", "trip_distance", "store_and_fwd_flag", "tpep_pickup_datetime", "airport_fee")} == {
        "VendorID": 5, "passenger_count": 3, "trip_distance": 3, "store_and_fwd_flag": 2, "tpep_pickup_datetime": 3, "airport_fee": 0,
    }
    scanned = {r["column_name"]: r["non_null_count"] for r in trips_profile(read_trips(spark, folder)).collect()}
    assert scanned == {c: counts[c] for c in scanned}
    assert [r["position"] for r in got] == list(range(len(got)))


def test_only_float_columns_are_scanned(spark, folder, monkeypatch):
    _months(folder)
    seen = []
    scan = footers._scanned
    monkeypatch.setattr(footers, "_scanned", lambda df, columns: seen.append(sorted(columns)) or scan(df, columns))
    trip_files_profile(spark, folder)
    assert sorted(seen) == [[], ["passenger_count", "tpep_pickup_datetime", "trip_distance"], ["trip_distance"]]


def test_file_profile_equals_column_profile(spark, sf_dir, monkeypatch):
    for name in ("events", "documents", "embeddings", "orders"):
        path = f"{sf_dir}/{name}.parquet"
        want = column_profile(spark.read.parquet(path)).collect()
        assert file_profile(spark, path).collect() == want
        assert file_row_count(spark, path) == spark.read.parquet(path).count()
    monkeypatch.setattr(footers, "_scanned", lambda df, columns: {} if not columns else pytest.fail("scanned"))
    file_profile(spark, f"{sf_dir}/events.parquet")


def test_files_without_statistics_are_scanned(spark, folder):
    pq.write_table(pa.table({"x": [1, None, 3]}), f"{folder}/a.parquet", write_statistics=False)
    assert footer_counts(spark, [folder], ["x"]) is None
    assert file_row_count(spark, folder) == 3
    assert [tuple(r) for r in file_profile(spark, folder).collect()] == [(0, "x", "bigint", 2)]


def test_nan_is_a_value_of_a_file_and_names_may_be_odd(spark, folder):
    rows = [(1.0, [1]), (float("nan"), None), (None, [])]
    spark.createDataFrame(rows, "`a.b c` double, l array<int>").write.mode("overwrite").parquet(folder)
    assert [tuple(r) for r in file_profile(spark, folder).collect()] == [(0, "a.b c", "double", 2), (1, "l", "array<int>", 2)]


def test_no_rows_and_the_callers_settings(spark, folder):
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    spark.range(5).filter(F.col("id") > 9).write.mode("overwrite").parquet(folder)
    assert [tuple(r) for r in file_profile(spark, folder).collect()] == [(0, "id", "bigint", 0)]
    assert file_row_count(spark, folder) == 0
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
    assert spark.getActiveSession() is not None and spark.getActiveSession()._jsparkSession.equals(spark._jsparkSession)
