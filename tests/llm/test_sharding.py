"""Balanced shards: the law, the slots, and how many links stay whole."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from trip_star.llm import sharding

from .conftest import prose


def check(rows, out, shards=16):
    """The law and the slots; returns text -> shards -> documents."""
    assert sorted(((r["doc"], r["size"], r["crc"]) for r in out), key=str) == sorted(
        ((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows), key=str
    )
    slots = defaultdict(list)
    for r in out:
        slots[r["shard"]].append(r["slot"])
    assert set(slots) <= set(range(shards))
    sizes = [len(slots[s]) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    where = defaultdict(Counter)
    for r in out:
        where[r["link"]][r["shard"]] += 1
    return where


def cut(where):
    """Links between documents of a group that lie on different shards, and all links."""
    pairs = lambda n: n * (n - 1) // 2
    whole = sum(pairs(sum(c.values())) for c in where.values())
    return whole - sum(pairs(n) for c in where.values() for n in c.values()), whole


def grouped(seed, groups, singles):
    rng = random.Random(seed)
    texts = [prose(seed * 1000 + i, 5) for i, n in enumerate(groups) for _ in range(n)]
    texts += [prose(seed * 1000 + 500 + i, 6) for i in range(singles)]
    rng.shuffle(texts)
    return list(enumerate(texts))


def run(spark, rows, **options):
    df = spark.createDataFrame([(t, d, 0, "x") for d, t in rows], "text string, doc_id long, shard int, row string").repartition(4)
    return check(rows, sharding.assign(df, **options).collect(), options.get("shards", 16))


def test_groups_gather(spark):
    where = run(spark, grouped(1, [2] * 60 + [5] * 20 + [9] * 8, 200))
    assert cut(where)[0] <= 0.02 * cut(where)[1]


def test_all_linked(spark):
    """Without an unlinked document, moves must make room for one another."""
    where = run(spark, grouped(2, [4] * 2000, 0))
    assert cut(where)[0] <= 0.1 * cut(where)[1]


def test_a_group_of_half_the_rows(spark):
    """A group larger than a shard fills several shards but scatters over no more than needed and one."""
    where = run(spark, grouped(3, [1500] + [2] * 300, 900))
    hot = max(where.values(), key=lambda c: sum(c.values()))
    least = -(-1500 // 188)
    assert sum(sorted(hot.values())[-least:]) >= 0.9 * 1500
    others = {k: c for k, c in where.items() if c is not hot}
    assert cut(others)[0] <= 0.1 * cut(others)[1]


def test_messy_rows(spark, messy):
    rows = [(r["doc_id"], r["text"]) for r in messy.collect()]
    where = check(rows, sharding.assign(messy).collect())
    assert len(where) == len({t or "" for _, t in rows})
    check(rows, sharding.assign(messy, shards=3).collect(), 3)


@pytest.mark.parametrize("n", [1, 5, 16, 17])
def test_few_documents(spark, n):
    run(spark, [(i, f"text {i // 2}") for i in range(n)])


def test_empty(spark, empty):
    assert sharding.assign(empty).collect() == []


def test_quotas_keep_to_the_capacity():
    rng = np.random.default_rng(1)
    for _ in range(200):
        shards = int(rng.integers(2, 9))
        loads = rng.integers(0, 100, shards)
        wanted = {
            (a, b, int(v)): int(rng.integers(1, 40))
            for a in range(shards) for b in range(shards) for v in rng.integers(0, 5, 2) if a != b and loads[a]
        }
        capacity = int(loads.mean()) + 5
        allowed = sharding.quotas(wanted, loads, capacity)
        after = loads.astype(float)
        for (a, b, level), share in allowed.items():
            assert 0 < share <= 1
            after[a] -= share * wanted[a, b, level]
            after[b] += share * wanted[a, b, level]
            higher = [k for k in wanted if k[:2] == (a, b) and k[2] > level]
            assert all(allowed.get(k, 0) > 0.999 for k in higher)
        assert (after <= np.maximum(capacity, loads) + 1e-3).all()


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    out = sharding.query(spark, sf_dir).collect()
    shards = defaultdict(list)
    texts = dict(rows)
    assert sorted(r.doc_id for r in out) == sorted(texts)
    for r in out:
        text = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(text) + 1, zlib.crc32(text), "rows", None)
        shards[r.shard].append(r.slot)
    assert max(map(len, shards.values())) - min(len(shards[s]) for s in range(16)) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in shards.values())
