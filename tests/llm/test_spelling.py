"""Spelling variants against all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from trip_star.llm import spelling


def _lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute_words(rows, every=spelling.EVERY):
    total = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = _lower(run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 5 and n >= 3}


def is_near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute_variants(words):
    form, near = {}, {}
    for w, n in words.items():
        others = [x for x in words if is_near(w, x)]
        near[w] = len(others)
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n, near[w], words.get(form[w])))
    return out


def result(df):
    rows = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def mutated(seed, n_words=200, uses=6000):
    """Texts of words that differ by few letters, with runs of equal letters and letters beyond ASCII."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("aabbcé÷") for _ in range(rng.randrange(4, 9))) for _ in range(n_words // 3)]
    while len(words) < n_words:
        w = rng.choice(words)
        i = rng.randrange(len(w))
        words.append(rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice("abcé") + w[i:], w[:i] + rng.choice("abcÀ") + w[i + 1 :], w.upper()]))
    weights = [rng.random() ** 3 for _ in words]
    return [" ".join(rng.choices(words, weights, k=30)) for _ in range(uses // 30)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_all_pairs(spark, seed):
    rows = list(enumerate(mutated(seed)))
    rows += [(None, rows[0][1]), (None, None), (5, rows[5][1]), (6, ""), (7, "12 \n--")]
    df = spark.createDataFrame([(t, d, "x", 1) for d, t in rows], "text string, doc_id long, word string, n int").repartition(3)
    expected = brute_variants(brute_words(rows))
    assert result(spelling.variants(df)) == expected
    assert sum(x[1] is not None for x in expected) > 3 and any(x[2] != x[1] for x in expected if x[1])


def test_messy_rows(spark, messy):
    rows = [(r["doc_id"], r["text"]) for r in messy.collect()]
    assert result(spelling.variants(messy)) == brute_variants(brute_words(rows))


def test_long_words_and_hashed_entries(spark):
    """Runs far beyond the length whose entries are texts; with 6 as that length most entries are hashes."""
    rng = random.Random(9)
    base = "".join(rng.choice("abcdefgh") for _ in range(3000))
    twin, shorter = base[:1500] + "z" + base[1501:], base[:-1]
    rows = [(i, f"{base} {base} {twin} {shorter}") for i in range(1, 5)] + list(enumerate(mutated(4), 10))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    expected = brute_variants(brute_words(rows))
    assert result(spelling.variants(df)) == expected
    assert result(spelling.variants(df, long=6)) == expected


def test_entries_meet_once():
    """Two near words share exactly one pair of entries that counts."""
    rng = random.Random(3)
    for _ in range(300):
        a = "".join(rng.choice("aab") for _ in range(rng.randrange(5, 9)))
        i = rng.randrange(len(a))
        for b in {a[:i] + a[i + 1 :], a[:i] + "b" + a[i:], a[:i] + "a" + a[i:], a[:i] + "c" + a[i + 1 :]} - {a}:
            meetings = 0
            for (ka, x), (kb, y) in ((p, q) for p in zip(*spelling.entries(a), strict=True) for q in zip(*spelling.entries(b), strict=True)):
                if ka == kb and (spelling.WHOLE not in (x, y) or {x, y} == {spelling.WHOLE, spelling.FIRST}):
                    meetings += 1
            assert meetings == 1, (a, b)


def test_empty(spark, empty):
    assert spelling.variants(empty).collect() == []


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    words = brute_words(rows)
    got = {r["word"]: r for r in spelling.query(spark, sf_dir).collect()}
    assert {w: r["n"] for w, r in got.items()} == words
    # neighbours by trying every edit: an independent way that is quick enough for the whole table
    letters = sorted({c for w in words for c in w})
    for w, n in words.items():
        edits = {w[:i] + w[i + 1 :] for i in range(len(w))}
        edits |= {w[:i] + c + w[i + k :] for i in range(len(w) + 1) for c in letters for k in (0, 1)}
        near = [x for x in edits - {w} if x in words]
        best = min(near, key=lambda x: (-words[x], x), default=None)
        form = best if best and words[best] >= 2 * n else None
        assert (got[w]["n_near"], got[w]["form"], got[w]["form_n"]) == (len(near), form, words.get(form)), w
        assert got[w]["root"] == (got[form]["root"] if form else w)
