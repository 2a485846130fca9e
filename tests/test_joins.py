"""Null-safe left joins and the skew-safe path for hot keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from trip_star.operators import attach_id, duplicate_rows, first_seen_ids, hot_keys, lookup_columns


def test_missing_key_matches_missing_key(spark):
    fact = spark.createDataFrame([(0, 1), (1, None), (2, 3)], "row_pos long, k int")
    dim = spark.createDataFrame([(1, 10), (None, 11)], "k int, k_id long")
    out = {r["row_pos"]: r["k_id"] for r in attach_id(fact, dim, ["k"], "k_id").collect()}
    assert out == {0: 10, 1: 11, 2: None}


def _skewed(spark, n=4000):
    # key 7 holds half of all rows, key null a quarter, the rest are spread out
    return spark.range(n).select(
        F.col("id").alias("row_pos"),
        F.when(F.col("id") % 2 == 0, F.lit(7))
        .when(F.col("id") % 4 == 1, F.lit(None))
        .otherwise(F.col("id") % 97 + 100)
        .cast("int")
        .alias("k"),
    )


def test_skew_safe_join_gives_the_same_ids(spark):
    fact = _skewed(spark)
    dim = first_seen_ids(fact, ["k"], "k_id", counts=True)
    plain = {r["row_pos"]: r["k_id"] for r in attach_id(fact, dim, ["k"], "k_id").collect()}
    hot = hot_keys(dim, ["k"], "k_id", min_rows=500, max_keys=5)
    assert hot.count() == 2
    salted = attach_id(fact, dim, ["k"], "k_id", hot=hot, spread_col="row_pos", salts=16)
    got = {r["row_pos"]: r["k_id"] for r in salted.collect()}
    assert got == plain and None not in got.values()


def test_skew_safe_join_spreads_a_hot_key(spark):
    fact = _skewed(spark)
    dim = first_seen_ids(fact, ["k"], "k_id", counts=True)
    hot = hot_keys(dim, ["k"], "k_id", min_rows=500)
    saved = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        salted = attach_id(fact, dim, ["k"], "k_id", hot=hot, spread_col="row_pos", salts=8)
        plan = salted._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "__salt" in plan.split("SortMergeJoin")[1].split("\n")[0]
        per_task = salted.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    biggest = max(r["count"] for r in per_task)
    assert biggest < 2000  # key 7 alone is 2000 rows; unsalted, one task would hold all of them


def test_duplicate_rows_with_a_hot_value(spark):
    df = spark.createDataFrame(
        [(i, "same" if i % 3 else f"u{i}") for i in range(300)], "doc_id long, text string"
    )
    out = duplicate_rows(df, ["text"], order_col="doc_id", first_col="first", hot_min_rows=10)
    got = {r["doc_id"]: r["first"] for r in out.collect()}
    expected = {i: 1 for i in range(300) if i % 3 and i != 1}
    assert got == expected


def test_skew_safe_lookup_carries_columns(spark):
    fact = _skewed(spark).select("row_pos", F.coalesce("k", F.lit(0)).cast("long").alias("k_id"))
    dim = spark.range(0, 200).select(
        F.col("id").alias("k_id"), (F.col("id") * 10).alias("v"), F.concat(F.lit("n"), F.col("id")).alias("name")
    )
    want = {r["row_pos"]: (r["v"], r["name"]) for r in fact.join(dim, "k_id", "left").collect()}
    got = lookup_columns(fact, dim, "k_id", ["v", "name"], hot_min_rows=500, salts=8, spread_col="row_pos")
    assert {r["row_pos"]: (r["v"], r["name"]) for r in got.collect()} == want
    assert set(got.columns) == {"row_pos", "k_id", "v", "name"}
    broadcast = lookup_columns(fact, dim, "k_id", ["v"], broadcast=True)
    assert {r["row_pos"]: r["v"] for r in broadcast.collect()} == {k: v[0] for k, v in want.items()}


def test_duplicates_fold_float_zero_and_nan(spark):
    from trip_star.operators import duplicate_count

    df = spark.createDataFrame(
        [("a", 0.0), ("a", -0.0), ("a", float("nan")), ("a", None), ("b", 1.0)], "s string, x double"
    )
    row = duplicate_count(df, ["s", "x"]).first()
    assert (row["n_rows"], row["n_distinct"], row["n_duplicates"]) == (5, 3, 2)


def test_duplicate_rows_with_negative_positions(spark):
    df = spark.createDataFrame([(-5, "x"), (-3, "y"), (-1, "x"), (2, "y"), (4, "z")], "doc_id long, text string")
    for hot_min in (1, 100):
        out = duplicate_rows(df, ["text"], order_col="doc_id", first_col="first", hot_min_rows=hot_min)
        assert {r["doc_id"]: r["first"] for r in out.collect()} == {-1: -5, 2: -3}


def test_bounded_keys_tell_apart_what_grouping_tells_apart(spark):
    """Microseconds, nulls, NaN, signed zero and separators inside texts."""
    from trip_star.operators import duplicate_count, duplicate_rows

    rows = [
        ("a", "2024-01-01 00:00:00.000001", 0.0, "x"), ("a", "2024-01-01 00:00:00.000002", 0.0, "x"),
        ("a:1", None, float("nan"), "x"), ("a:1", None, None, "x"), ("1", "2024-01-01", -0.0, "2:xy"), ("1", "2024-01-01", 0.0, "2:xy"),
        (None, None, 1.0, "-"), ("-", None, 1.0, None), ("ab", None, 1.0, "c"), ("a", None, 1.0, "bc"),
    ]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "row_pos long, a string, t string, d double, b string")
    df = df.withColumn("t", F.to_timestamp_ntz("t"))
    cols = ["a", "t", "d", "b"]
    assert tuple(duplicate_count(df, cols).first()) == (10, 8, 2)
    assert sorted((r["row_pos"], r["first_pos"]) for r in duplicate_rows(df, cols).collect()) == [(3, 2), (5, 4)]


def test_positions_that_repeat_or_are_missing(spark):
    """Rows at one position count as one; rows without a position come last."""
    from trip_star.operators import duplicate_rows

    df = spark.createDataFrame([(1, "a"), (2, "a"), (2, "a"), (2, "b"), (3, "b"), (None, "a"), (None, "c"), (None, "c")], "p long, t string")
    for broadcast_rows in (0, None):
        out = duplicate_rows(df, ["t"], order_col="p", first_col="first", broadcast_rows=broadcast_rows)
        assert sorted(map(tuple, out.collect()), key=str) == [(2, "a", 1), (2, "a", 1), (3, "b", 2), (None, "a", 1)]


def test_keys_are_typed_or_digests_of_bounded_size(spark):
    from trip_star.operators import bounded_key, duplicate_count

    long = "x" * 5000
    df = spark.createDataFrame([(1, long, "Y"), (2, long + " ", "N"), (3, None, None), (4, long, "Y")], "i int, t string, f string")
    kinds = {f.name: f.dataType for f in df.schema.fields}
    keys = df.select(*[bounded_key(c, kinds[c]).alias(c) for c in df.columns])
    assert keys.schema["i"].dataType.simpleString() == "int"
    got = keys.collect()
    assert [None if r["t"] is None else len(r["t"]) for r in got] == [33, 33, None, 33]
    assert [None if r["f"] is None else bytes(r["f"]) for r in got] == [b"\0Y", b"\0N", None, b"\0Y"]
    assert got[0]["t"] == got[3]["t"] != got[1]["t"]
    assert tuple(duplicate_count(df, ["t", "f"]).first()) == (4, 3, 1)


def test_flagged_rows_meet_the_texts_without_a_shuffle_of_them(spark):
    from trip_star.operators import duplicate_rows

    df = spark.range(400).select(F.col("id").alias("p"), F.concat(F.lit("text " * 20), F.col("id") % 300).alias("t"))
    out = duplicate_rows(df, ["t"], order_col="p")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == 100 and "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
