"""First-seen surrogate keys: bucketed numbering equals the single-window form,
ids are dense, independent of partitioning, and missing values form one key."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from pyspark.sql import Window

from trip_star.operators import first_seen_ids
from trip_star.operators.keys import FIRST, first_seen_index, key_order
from trip_star.sources import fixture_trips, prepare_trips

KEY_SETS = [
    (["payment_type"], "payment_type_id"),
    (["PULocationID"], "pickup_location_id"),
    (["tpep_pickup_datetime", "tpep_dropoff_datetime"], "datetime_id"),
    (["fare_amount", "extra", "tip_amount", "tolls_amount", "congestion_surcharge"], "fare_id"),
]


@pytest.fixture(scope="module")
def trips(spark, sf_dir):
    cached = fixture_trips(spark, sf_dir).cache()
    yield cached
    cached.unpersist()  # the cache would stand in for later scans of the same plan


def as_map(df, keys, id_col):
    return {tuple(r[k] for k in keys): r[id_col] for r in df.collect()}


def single_window(df, keys, id_col):
    """The textbook form: one window over all distinct keys."""
    everything = Window.orderBy(F.col(FIRST).asc(), *key_order(keys))
    index = first_seen_index(df, keys)
    return index.withColumn(id_col, (F.row_number().over(everything) - 1).cast("long")).drop(FIRST)


@pytest.mark.parametrize("keys,id_col", KEY_SETS)
@pytest.mark.parametrize("bucket_rows", [1, 7, 100, 1 << 22])
def test_bucketed_equals_single_window(trips, keys, id_col, bucket_rows):
    single = as_map(single_window(trips, keys, id_col), keys, id_col)
    bucketed = as_map(first_seen_ids(trips, keys, id_col, bucket_rows=bucket_rows), keys, id_col)
    assert bucketed == single


@pytest.mark.parametrize("keys,id_col", KEY_SETS)
def test_ids_are_dense_and_follow_first_appearance(trips, keys, id_col):
    out = first_seen_ids(trips, keys, id_col, bucket_rows=13, keep_first=True).collect()
    ids = sorted(r[id_col] for r in out)
    assert ids == list(range(len(out)))
    by_first = [r[id_col] for r in sorted(out, key=lambda r: r["__first"])]
    assert by_first == list(range(len(out)))


def test_same_ids_whatever_the_partitioning(trips):
    keys, id_col = KEY_SETS[3]
    base = as_map(first_seen_ids(trips, keys, id_col, bucket_rows=50), keys, id_col)
    for n in (1, 13):
        again = as_map(first_seen_ids(trips.repartition(n), keys, id_col, bucket_rows=50), keys, id_col)
        assert again == base


def test_null_and_nan_share_one_key(spark):
    df = spark.createDataFrame(
        [(0, 1.0), (1, None), (2, float("nan")), (3, 2.0), (4, None)], "row_pos long, trip_distance double"
    )
    out = first_seen_ids(prepare_trips(df), ["trip_distance"], "trip_distance_id").collect()
    got = {(None if r[0] is None else r[0]): r[1] for r in out}
    assert got == {1.0: 0, None: 1, 2.0: 2}


def test_signed_zero_is_one_key(spark):
    df = spark.createDataFrame([(0, 0.0), (1, -0.0), (2, 0.0)], "row_pos long, extra double")
    out = first_seen_ids(df, ["extra"], "fare_id").collect()
    assert len(out) == 1 and out[0]["fare_id"] == 0 and math.copysign(1, out[0]["extra"]) in (1, -1)


def test_non_unique_order_breaks_ties_by_key(spark):
    df = spark.createDataFrame([(5, "b"), (5, "a"), (3, "c"), (5, None)], "o long, k string")
    out = {r["k"]: r["i"] for r in first_seen_ids(df, ["k"], "i", order_col="o", bucket_rows=2).collect()}
    assert out == {"c": 0, None: 1, "a": 2, "b": 3}


def test_row_count_is_kept_when_asked(trips):
    out = first_seen_ids(trips, ["VendorID"], "vendor_id", counts=True)
    assert out.agg(F.sum("__rows")).first()[0] == trips.count()


@pytest.mark.parametrize("position", ["id * 1099511627776", "42", "CASE WHEN id < 50 THEN -9223372036854775807 ELSE 9223372036854775806 END"])
def test_sparse_constant_and_far_apart_positions(spark, position):
    df = spark.range(200).selectExpr("id % 97 AS k", f"CAST({position} AS long) AS row_pos")
    out = first_seen_ids(df, ["k"], "kid", bucket_rows=5)
    assert as_map(out, ["k"], "kid") == as_map(single_window(df, ["k"], "kid"), ["k"], "kid")


def test_sorted_and_ranged_numbering_give_the_same_ids(spark):
    df = spark.range(500).select(((F.col("id") * 7919) % 500).alias("row_pos"), (F.col("id") % 83).alias("k"), (F.col("id") % 3).alias("j"))
    for keys in (["k"], ["j"], ["k", "j"]):
        small = first_seen_ids(df, keys, "id", counts=True)
        ranged = first_seen_ids(df, keys, "id", counts=True, small_rows=0, bucket_rows=16)
        assert small.schema == ranged.schema
        assert sorted(map(tuple, small.collect())) == sorted(map(tuple, ranged.collect()))


def test_key_sets_of_one_scan_equal_their_own(spark):
    from trip_star.operators import first_seen_by_sets, first_seen_index, number_checkpointed

    df = spark.createDataFrame(
        [(i, None if i % 5 == 0 else i % 4, None if i % 7 == 0 else "ab"[i % 2], float(i % 3)) for i in range(200)],
        "row_pos long, a int, b string, c double",
    )
    sets = {"one": ["a"], "two": ["b"], "three": ["c"], "four": ["a", "c"]}
    indexes, sizes = first_seen_by_sets(df, sets)
    for name, keys in sets.items():
        own = first_seen_index(df, keys, counts=True)
        assert sizes[name] == own.count()
        assert sorted(map(str, indexes[name].collect())) == sorted(map(str, own.collect()))
        ids = number_checkpointed(indexes[name], sizes[name], keys, "id")
        expected = first_seen_ids(df, keys, "id", counts=True, keep_first=True)
        assert sorted(map(str, ids.collect())) == sorted(map(str, expected.collect()))
