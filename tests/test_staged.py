"""One exchange for the key aggregate and the fact join of a large dimension."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from trip_star.operators.keys import FIRST, ROWS, first_seen_index
from trip_star.operators.staged import HASH, SALT, attach_staged, heavy_hashes, stage_by_key, staged_index
from trip_star.plans import fact_trips, fact_trips_wide, star_from_trips
from trip_star.plans.dims import DATETIMES, DIMENSIONS, FARES
from trip_star.plans.fact import checked_indexes, joined_star, staged_specs
from trip_star.sources import fixture_trips, fixture_zones_raw

KEYS = ["a", "d"]


@pytest.fixture(scope="module")
def skewed(spark):
    """4,000 rows: a third have one key, a third no key at all, others up to 300 keys."""
    third = F.col("id") % 3
    return spark.range(4000, numPartitions=5).select(
        F.col("id").alias("row_pos"),
        F.when(third == 0, 7).when(third == 2, F.col("id") % 300).cast("long").alias("a"),
        F.when(third == 0, F.when(F.col("id") % 2 == 0, F.lit(0.0)).otherwise(F.lit(-0.0))).when(third == 2, F.col("id") % 5).cast("double").alias("d"),
    )


def _index(df):
    return sorted(((r["a"], r["d"], r[FIRST], r[ROWS]) for r in df.collect()), key=str)


def _normal(df):
    return df.withColumn("d", F.col("d") + F.lit(0.0))


@pytest.mark.parametrize("min_rows", [1, 1000, 10_000])
def test_index_and_join_equal_plain_ones(spark, skewed, min_rows):
    heavy = heavy_hashes(skewed, {"x": KEYS}, 4000, min_rows, 100)["x"]
    assert (heavy is None) == (min_rows == 10_000)
    if heavy is not None:
        # one third each for the key (7, 0.0) and the missing one; of the rest none has 1/100 of all rows and 1,000
        assert heavy.count() == 2
    rows = stage_by_key(skewed, KEYS, heavy)
    index = staged_index(rows, KEYS, heavy is not None).checkpoint()
    want = first_seen_index(skewed, KEYS, counts=True)
    assert _index(_normal(index)) == _index(_normal(want))
    named = index.withColumn("k_id", F.col(FIRST) * 10)
    got = {r["row_pos"]: r["k_id"] for r in attach_staged(rows, named, KEYS, "k_id", heavy is not None).collect()}
    keys = {r["row_pos"]: (r["a"], r["d"]) for r in skewed.collect()}
    first = {}
    for pos in sorted(keys):
        first.setdefault(keys[pos], pos)
    assert got == {pos: first[k] * 10 for pos, k in keys.items()}


def test_heavy_rows_are_spread(spark, skewed):
    heavy = heavy_hashes(skewed, {"x": KEYS}, 4000, 1000, 100)["x"]
    rows = stage_by_key(skewed, KEYS, heavy)
    sizes = [r["count"] for r in rows.filter(F.col(SALT) > 0).groupBy(HASH, SALT).count().collect()]
    assert sum(sizes) == 2667 and len(sizes) == 16 and max(sizes) < 300


def test_buckets_are_read_as_they_lie(spark, skewed):
    """Neither the aggregate nor the staged side of the join is exchanged again."""
    rows = stage_by_key(skewed, KEYS)
    index = staged_index(rows, KEYS, False)
    assert "Exchange" not in index._jdf.queryExecution().executedPlan().toString()
    named = index.withColumn("k_id", F.col(FIRST)).checkpoint()
    joined = attach_staged(rows, named.hint("merge"), KEYS, "k_id", False)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
    assert plan.count("Exchange hashpartitioning") <= 1  # the index


def test_equal_hashes_only_route(spark):
    """Keys whose hashes are equal stay apart: nulls do not enter the hash."""
    df = spark.createDataFrame([(0, 1, None), (1, None, 1), (2, 1, None), (3, None, None)], "row_pos long, a long, d long")
    for heavy in (None, heavy_hashes(df, {"x": KEYS}, 4, 1, 4)["x"]):
        rows = stage_by_key(df, KEYS, heavy)
        index = staged_index(rows, KEYS, heavy is not None).checkpoint()
        assert index.select(HASH).distinct().count() < index.count() == 3
        named = index.withColumn("k_id", F.col(FIRST))
        got = attach_staged(rows, named, KEYS, "k_id", heavy is not None)
        assert sorted((r["row_pos"], r["k_id"]) for r in got.collect()) == [(0, 0), (1, 1), (2, 0), (3, 3)]


@pytest.mark.parametrize("hot_min_rows", [1, 100_000])
def test_every_route_gives_the_same_star(spark, sf_dir, hot_min_rows):
    trips = fixture_trips(spark, sf_dir)
    want_indexes, small = checked_indexes(trips, DIMENSIONS)
    want = fact_trips(trips, want_indexes, small).orderBy("event_id").collect()
    staged, n = staged_specs(trips, DIMENSIONS, 5)
    assert staged == [DATETIMES, FARES] and n == len(want)
    indexes, small, joined = joined_star(trips, broadcast_max_rows=5, hot_min_rows=hot_min_rows, hot_max_keys=50, small_rows=10)
    assert not small & {"datetimes", "fares"}
    assert fact_trips(trips, broadcast_max_rows=5, hot_min_rows=hot_min_rows).orderBy("event_id").collect() == want
    assert joined.count() == n
    for spec in (DATETIMES, FARES):
        cols = [*spec.keys, spec.id_col, ROWS]
        assert indexes[spec.table].select(cols).orderBy(spec.id_col).collect() == want_indexes[spec.table].select(cols).orderBy(spec.id_col).collect()


def test_wide_fact_and_reports_by_the_staged_route(spark, sf_dir):
    trips, zones = fixture_trips(spark, sf_dir), fixture_zones_raw(spark, sf_dir)
    want = fact_trips_wide(trips).orderBy("event_id").collect()
    assert fact_trips_wide(trips, broadcast_max_rows=5).orderBy("event_id").collect() == want
    plain, staged = (star_from_trips(trips, zones, ["datetimes", "fares"], broadcast_max_rows=b) for b in (None, 5))
    assert plain.small and not staged.small
    assert plain.fact.orderBy("event_id").collect() == staged.fact.orderBy("event_id").collect()


def test_no_trips(spark, sf_dir):
    trips = fixture_trips(spark, sf_dir).limit(0)
    assert staged_specs(trips, DIMENSIONS, 0) == ([], 0)
    rows = stage_by_key(trips, list(FARES.keys))
    index = staged_index(rows, list(FARES.keys), False).withColumn("fare_id", F.col(FIRST))
    assert index.count() == 0 and attach_staged(rows, index, list(FARES.keys), "fare_id", False).count() == 0
    assert heavy_hashes(trips, {"x": FARES.keys}, 0, 1, 10) == {"x": None}
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("__staged")]
