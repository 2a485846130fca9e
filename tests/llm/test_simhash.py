from __future__ import annotations

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from trip_star.llm import simhash
from trip_star.llm.components import connected_components


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def brute_components(prints, bits):
    label = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    return label


def test_messy_rows_against_brute_force(messy):
    found = [r.asDict() for r in simhash.near_duplicates(messy).collect()]
    texts = messy.collect()
    prints = [brute_fingerprint(r["text"]) for r in texts]
    label = brute_components(prints, 4)
    ids = {}
    for r, x in zip(texts, label, strict=True):
        if r["doc_id"] is not None:
            ids[x] = min(ids.get(x, r["doc_id"]), r["doc_id"])
    expected = sorted(
        ((r["doc_id"], f"{p:016x}", ids.get(x)) for r, p, x in zip(texts, prints, label, strict=True)), key=str
    )
    assert sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in found), key=str) == expected
    assert any(r["component_id"] is None for r in found) and any(r["fingerprint"] == "0" * 16 for r in found)


def test_keep_one_leaves_one_row_of_each_component(messy):
    kept = simhash.keep_one(messy)
    assert kept.columns == messy.columns
    left = [r["doc_id"] for r in kept.collect()]
    labels = simhash.near_duplicates(messy)
    named = {r[0] for r in labels.select("component_id").distinct().collect()} - {None}
    assert sorted(x for x in left if x is not None) == sorted(named)
    assert left.count(None) == 1  # the one nameless component: a text of its own


def test_keep_one_leaves_a_row_of_each_component_where_rows_share_an_id(spark):
    rng = random.Random(5)
    a, b, c = (" ".join(f"w{rng.randrange(10**6)}" for _ in range(60)) for _ in range(3))
    rows = [(1, a), (1, b), (1, b), (2, a), (3, c), (3, c.upper()), (4, b)]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r["doc_id"], r["text"].lower()) for r in kept.collect()) == sorted([(1, a), (1, b), (3, c)])


@pytest.mark.parametrize("bits", [0, 1, 2, 3, 4, 6])
@pytest.mark.parametrize("hot_homes", [50_000, 2])
def test_cover_loses_no_link(spark, bits, hot_homes, monkeypatch):
    monkeypatch.setattr(simhash, "VISITORS", 1)
    rng = random.Random(bits)
    prints = []
    for _ in range(25):
        x = rng.getrandbits(64)
        prints.append(x)
        for _ in range(rng.randrange(6)):  # chains of neighbours at the very threshold
            for b in rng.sample(range(64), rng.choice([bits, bits, bits + 1])):
                x ^= 1 << b
            prints.append(x)
    prints = sorted(set(prints))
    signed = [x - (1 << 64) if x >> 63 else x for x in prints]
    fps = spark.createDataFrame([(x,) for x in signed], "fp long")
    edges = simhash.linked_fingerprints(fps, len(prints), bits, hot_homes)
    found = {r["node"]: r["root"] for r in connected_components(edges).collect()}
    label = brute_components(prints, bits)
    groups, expected = {}, {}
    for s, x in zip(signed, label, strict=True):
        groups.setdefault(found.get(s, s), set()).add(s)
        expected.setdefault(x, set()).add(s)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_busy_anchors_are_split_on_both_sides(spark):
    """Six homes and 300 visitors in cells of two homes and 40 members."""
    rows = [(7, x, x < 6) for x in range(306)] + [(8, x, x == 0) for x in range(30)] + [(9, x, False) for x in range(300)]
    cells = {}
    for r in simhash._split(spark.createDataFrame(rows, "key long, fp long, home boolean"), 2).collect():
        cells.setdefault((r["key"], r["salt"]), []).append((r["fp"], r["home"]))
    assert len([k for k in cells if k[0] == 7]) > 10 and len([k for k in cells if k[0] != 7]) == 2
    meetings = set()
    for (key, _), members in cells.items():
        assert len({fp for fp, _ in members}) == len(members)
        assert key != 7 or len(members) <= 80
        meetings |= {(key, a, b) for a, home in members if home for b, _ in members}
    assert {m for m in meetings if m[0] == 7} == {(7, a, b) for a in range(6) for b in range(306)}
    assert {m for m in meetings if m[0] != 7} == {(8, 0, b) for b in range(30)}


def test_every_cover_is_exact_in_its_block():
    rng = random.Random(1)
    for n, t in ((21, 1), (22, 1), (32, 2), (16, 1)):
        code = simhash.BlockCode(n, simhash.BlockCode.radius + t)

        def anchors(x, code=code):
            s = sum((bin(x & c).count("1") % 2) << j for j, c in enumerate(code.checks))
            return [x ^ e for e in code.patterns[s]]

        for _ in range(200):
            x = rng.getrandbits(n)
            home = anchors(x)[0]
            assert (home ^ x).bit_count() <= code.radius
            y = x
            for b in rng.sample(range(n), rng.randint(0, t)):
                y ^= 1 << b
            assert home in anchors(y)


def test_a_dense_group_is_united_without_its_pairs(spark):
    """2,000 fingerprints around one centre: the task returns a tree."""
    rng = random.Random(5)
    prints = {0}
    while len(prints) < 2000:
        prints.add(sum(1 << b for b in rng.sample(range(63), 3)))
    fps = spark.createDataFrame([(x,) for x in prints], "fp long")
    edges = simhash.linked_fingerprints(fps, len(prints), 4)
    n = edges.count()
    assert n <= 8 * len(prints)  # each of the 8 tasks names each fingerprint once at most
    assert connected_components(edges).select("root").distinct().count() == 1


def test_components_of_a_long_chain(spark):
    edges = spark.range(60).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    out = connected_components(edges.unionByName(edges))
    assert out.count() == 61 and out.select("root").distinct().collect()[0][0] == 0


def test_empty_table(empty):
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.keep_one(empty).count() == 0
