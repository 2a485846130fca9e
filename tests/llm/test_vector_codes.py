"""Vector codes against the definition, one vector at a time."""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest

from trip_star.llm import vector_codes


def usable(rows):
    return [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]


def brute(rows, parts=8, entries=16, rounds=6):
    rows = usable(rows)
    split = lambda v: [tuple(math.floor(4096 * x) for x in v[p * len(v) // parts : (p + 1) * len(v) // parts]) for p in range(parts)]
    cut = [split(r[1]) for r in rows]
    first = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][1]))[:entries]
    books = [[cut[i][p] for i in first] for p in range(parts)]

    def choose(p, x):
        far = [sum((a - b) ** 2 for a, b in zip(x, e, strict=True)) for e in books[p]]
        return far.index(min(far)), min(far)

    for _ in range(rounds):
        for p in range(parts):
            members = defaultdict(list)
            for v in cut:
                members[choose(p, v[p])[0]].append(v[p])
            books[p] = [
                tuple(sum(c) // len(members[j]) for c in zip(*members[j], strict=True)) if j in members else e for j, e in enumerate(books[p])
            ]
    out, by_label = [], defaultdict(int)
    for r, v in zip(rows, cut, strict=True):
        codes = [choose(p, v[p]) for p in range(parts)]
        error = sum(e for _, e in codes)
        by_label[r[2]] += error
        out.append((r[0], "".join(f"{c:02x}" for c, _ in codes), error, r[2]))
    flat = ",".join(str(x) for book in books for e in book for x in e)
    return sorted(((i, c, e, by_label[label]) for i, c, e, label in out), key=str), hashlib.sha256(flat.encode()).hexdigest()


def run(df, **options):
    codes, books = vector_codes.compress(df, **options)
    rows = vector_codes.with_label_error(codes).select("id", "code", "error", "label_error").collect()
    return sorted((tuple(r) for r in rows), key=str), vector_codes.digest(books)


def clustered(n, length, seed, labels=5):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (10, length))
    rows = []
    for i in range(n):
        v = (centres[rng.integers(10)] + rng.normal(0, 0.1, length)).astype(np.float32)
        rows.append((i * 3, [float(x) for x in v], None if i % labels == 0 else int(i % labels)))
    return rows


SCHEMA = "vec_id long, embedding array<float>, label int"


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    expected, books = brute(rows)
    got = vector_codes.query(spark, sf_dir).collect()
    assert sorted(((r.vec_id, r.code, r.error, r.label_error) for r in got), key=str) == expected
    assert {r.codebooks_sha256 for r in got} == {books}


@pytest.mark.parametrize("length,n", [(8, 300), (24, 200), (128, 60), (1040, 20), (16, 7)])
def test_blocks_and_chunks(spark, length, n):
    """Small blocks and chunks; part widths from 1 to 130; fewer vectors than entries."""
    rows = clustered(n, length, length)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert run(df, block=4, chunk=length * 16) == brute(rows)


def test_messy_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = clustered(60, 16, 1)
    tied = [[0.5] * 16, [0.25] * 16, [-0.5] * 16]
    rows += [(1, None, 1), (2, [nan] + [0.0] * 15, 1), (4, [None] + [0.0] * 15, 2), (5, [inf] * 16, 2), (7, [0.0] * 15 + [-inf], 2)]
    rows += [(8, tied[i % 3], 3) for i in range(9)] + [(None, tied[0], 4), (None, tied[1], None), (-1, [-0.0] * 16, 9), (-2, [1e-9] * 16, 9)]
    df = spark.createDataFrame([(*r, "x", 7, "y") for r in rows], SCHEMA + ", code string, error int, id string").repartition(4)
    assert run(df) == brute(rows)
    assert run(df, block=2, chunk=64) == brute(rows)


def test_empty_and_unusable(spark):
    assert run(spark.createDataFrame([], SCHEMA))[0] == []
    assert run(spark.createDataFrame([(1, None, 1), (2, [None], 1)], SCHEMA))[0] == []


def test_one_vector_many_times(spark):
    rows = [(1, [0.1] * 8, 2)] * 50 + [(2, [0.3] * 8, None)] * 20
    assert run(spark.createDataFrame(rows, SCHEMA).repartition(2)) == brute(rows)


def test_wrong_lengths_are_named(spark):
    with pytest.raises(Exception, match="can't be cut"):
        run(spark.createDataFrame([(1, [0.1] * 9, 2)], SCHEMA))
    with pytest.raises(Exception, match="a vector has 16 components"):
        run(spark.createDataFrame([(1, [0.1] * 8, 2), (2, [0.1] * 16, 2)], SCHEMA))
    with pytest.raises(Exception, match="would not fit"):
        run(spark.createDataFrame([(1, [1e30] * 8, 2)], SCHEMA))


def test_hilbert_steps_are_neighbours():
    """On a full grid, consecutive places differ by one in one component."""
    for d, side in ((2, 16), (3, 8)):
        grid = np.stack(np.meshgrid(*[np.arange(side)] * d, indexing="ij"), -1).reshape(-1, d)
        order = np.argsort(vector_codes.hilbert(grid, int(math.log2(side))))
        assert (np.abs(np.diff(grid[order], axis=0)).sum(1) == 1).all()


def test_shortlists_hold_the_nearest_and_leave_out_others():
    rng = np.random.default_rng(5)
    points = rng.integers(-3000, 3000, (64, 20, 4)) // 8 + rng.integers(-9000, 9000, (64, 1, 4))
    book = rng.integers(-9000, 9000, (16, 4))
    short = vector_codes.shortlists(points.min(1), points.max(1), book)
    away = ((points[:, :, None] - book) ** 2).sum(3)
    for block in range(64):
        assert set(away[block].argmin(1)) <= set(np.flatnonzero(short[block]))
    assert short.mean() < 0.5
