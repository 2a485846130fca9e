"""Operators on whole texts, each against a plain form of its definition."""

from __future__ import annotations

import hashlib
import re
import time
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from trip_star.llm import common, decontaminate, fingerprints, langid, licenses, line_dedup, packing, substring_dedup
from trip_star.llm.common import rolling, winnow

from .conftest import prose

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def by_key(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


# line dedup ---------------------------------------------------------------


def test_lines_against_brute_force(messy):
    source = [(r["doc_id"], r["text"]) for r in messy.collect()]
    holders = defaultdict(set)
    key = lambda line: lower(line.strip(" \t\n\x0b\x0c\r"))
    for doc, text in source:
        for line in (text or "").split("\n"):
            if doc is not None and len(key(line)) >= 40:
                holders[key(line)].add(doc)
    expected = []
    for doc, text in source:
        lines = (text or "").split("\n")
        left = [x for x in lines if doc is None or len(holders[key(x)]) < 5 or doc == max(holders[key(x)])]
        digest = hashlib.sha256("\n".join(left).encode()).hexdigest()
        expected.append((doc, len(lines), len(lines) - len(left), digest))
    out = line_dedup.dedup_lines(messy)
    assert by_key(out, "doc_id", "n_lines", "n_dropped", "kept_sha256") == sorted(expected, key=str)
    assert sum(x[2] for x in expected) > 10
    assert set(messy.columns) <= set(out.columns)
    assert out.filter("text IS NULL").count() == messy.filter("text IS NULL").count()


def test_lines_without_broadcast(messy, monkeypatch):
    before = by_key(line_dedup.dedup_lines(messy), "doc_id", "kept_sha256")
    monkeypatch.setattr(line_dedup, "BROADCAST_KEYS", -1)
    assert by_key(line_dedup.dedup_lines(messy), "doc_id", "kept_sha256") == before
    monkeypatch.setattr(common, "HOT_ROWS", 10)  # the line of 17 places meets its rows by broadcast
    assert by_key(line_dedup.dedup_lines(messy), "doc_id", "kept_sha256") == before
    none = messy.filter("doc_id < 3")
    assert by_key(line_dedup.dedup_lines(none), "doc_id", "n_dropped") == [(-5, 0), (0, 0), (1, 0), (2, 0)]


# decontamination ------------------------------------------------------------


@pytest.fixture(scope="module")
def items(spark, messy):
    texts = {r["doc_id"]: r["text"] for r in messy.collect()}
    words = texts[10].split()
    rows = [
        (1, " ".join(words[5:40])), (1, " ".join(words[5:40])), (2, " ".join(words[50:59])), (3, "THETA1, not there at all"),
        (4, None), (5, ""), (6, "again again"), (7, " ".join(texts[30].split()[-70:-40])), (None, " ".join(words[20:32])), (10, "again " * 10),
    ]
    return spark.createDataFrame(rows, "item_id long, text string")


def brute_contamination(docs, items):
    out = []
    for doc, text in docs:
        words = ALNUM.findall(lower(text))
        hit, found = set(), set()
        for item, item_text in items:
            w = ALNUM.findall(lower(item_text))
            n = min(10, len(w))
            windows = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()
            for i in range(len(words) - n + 1) if w else ():
                if tuple(words[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    found.add(str(item)) if item is not None else None
        out.append((doc, len(words), len(hit), sorted(found), bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("index_chars, hot", [(10**6, False), (300, False), (300, True)])
def test_contamination_against_brute_force(messy, items, index_chars, hot, monkeypatch):
    if hot:  # fingerprints, windows and texts of three rows are salted or broadcast
        monkeypatch.setattr(decontaminate, "SALT_ROWS", 2)
        monkeypatch.setattr(decontaminate, "HOT_ROWS", 2)
    docs = messy.filter("length(text) < 100000 OR text IS NULL")
    out = decontaminate.find_contamination(docs, items, index_chars=index_chars)
    found = by_key(out, "doc_id", "n_words", "n_hit", "item_ids", "contaminated")
    expected = brute_contamination([(r["doc_id"], r["text"]) for r in docs.collect()], [tuple(r) for r in items.collect()])
    assert found == expected and sum(x[4] for x in expected) > 5


def test_a_very_long_document_is_searched_to_its_end(messy, items):
    row = decontaminate.find_contamination(messy.filter("doc_id = 30"), items).first()
    assert row["item_ids"] == ["2", "7"] and row["hit_spans"] == [[30_000, 30_033]]


def test_a_word_over_and_over_takes_linear_time():
    index = decontaminate.Index([("a", b"again " * 20_000)], 10, 5)
    words = decontaminate.word_hashes(b"again " * 200_000)
    covered = np.zeros(len(words), dtype=bool)
    start = time.process_time()
    assert index.hits(words, covered) == {0} and covered.all()
    assert time.process_time() - start < 5


@pytest.mark.parametrize("index_chars", [10**6, -1])
def test_no_items_and_no_documents(messy, empty, items, index_chars):
    none = items.limit(0)
    found = decontaminate.find_contamination(messy, none, index_chars=index_chars)
    assert found.count() == messy.count() and found.filter("contaminated").count() == 0
    assert decontaminate.find_contamination(empty, items, index_chars=index_chars).count() == 0


def test_a_large_benchmark_keeps_further_columns(spark, items, messy):
    odd = messy.withColumn("tags", F.create_map(F.lit("a"), F.lit(1))).withColumn("item_ids", F.lit("clash"))
    out = decontaminate.find_contamination(odd, items, index_chars=300, drop_text=True)
    assert set(out.columns) == (set(odd.columns) | {f.name for f in decontaminate.FIELDS}) - {"text"}
    assert out.filter("tags['a'] = 1 AND contaminated").count() > 5


# substring dedup ------------------------------------------------------------


def brute_substrings(docs):
    first = {}
    split = [(doc if doc is not None else substring_dedup.NO_ID, re.findall(r"[^\x20\x09-\x0D]+", text or "")) for doc, text in docs]
    for doc, words in split:
        for i in range(len(words) - 19):
            seq = tuple(words[i : i + 20])
            first[seq] = min(first.get(seq, (doc, i)), (doc, i))
    out = []
    for (doc, _), (order, words) in zip(docs, split, strict=True):
        gone = {i + k for i in range(len(words) - 19) if first[tuple(words[i : i + 20])] < (order, i) for k in range(20)}
        left = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc, len(words), len(gone), hashlib.sha256(left.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("options", [{}, {"large": 1, "shard_words": 100}])
def test_substrings_against_brute_force(messy, options):
    found = by_key(substring_dedup.dedup_substrings(messy, **options), "doc_id", "n_words", "n_removed", "kept_sha256")
    expected = brute_substrings([(r["doc_id"], r["text"]) for r in messy.collect()])
    assert found == expected and sum(x[2] for x in expected) > 1000


def test_a_large_class_goes_to_no_single_task(spark, monkeypatch):
    """One passage in other words everywhere: the classes at its edges have a segment per document."""
    passage = prose(7, 40)
    rows = [(i, f"{prose(1000 + i, 25, 10**6)} {passage} {prose(5000 + i, 25, 10**6)}") for i in range(300)]
    rows += [(1000 + i, f"{prose(1000 + i % 7, 25, 10**6)} {passage} {prose(9000 + i, 9, 10**6)}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    made, match = [], substring_dedup._match

    def counted(*args):
        run = match(*args)

        def checked(batches):
            for batch in batches:
                shards = batch.column(0).to_pylist()
                assert max(map(shards.count, set(shards)), default=0) <= 20  # of these few rows a class is never split
                yield from run(iter([batch]))

        made.append(args)
        return checked

    monkeypatch.setattr(substring_dedup, "_match", counted)
    found = by_key(substring_dedup.dedup_substrings(docs, large=20), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert made and found == brute_substrings(rows)


@pytest.mark.parametrize("large", [2, 4096])
def test_rows_without_id_are_gathered_one_by_one(spark, monkeypatch, large):
    passage = prose(7, 30)
    texts = [f"{prose(i, 12, 10**6)} {passage} {prose(5000 + i, 12, 10**6)}" for i in range(60)]
    rows = [(None, t) for t in texts] + [(None, texts[0])] * 9 + [(3, t) for t in texts[40:50]] + [(2, texts[5])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    asked = substring_dedup._requested

    def counted(batch, *args):
        sizes = batch.column(batch.schema.get_field_index("__sd_wanted")).to_pylist()
        assert max(map(len, sizes), default=0) <= 54  # words of a text
        return asked(batch, *args)

    monkeypatch.setattr(substring_dedup, "_requested", counted)
    found = by_key(substring_dedup.dedup_substrings(docs, large=large), "n_words", "n_removed", "kept_sha256")
    expected = brute_substrings(rows)
    assert found == sorted((x[1:] for x in expected), key=str) and sum(x[2] for x in expected) > 100


def test_automaton_knows_the_earliest_place():
    import random

    rng = random.Random(2)
    texts = [[rng.choice([b"a", b"b"]) for _ in range(40)] for _ in range(12)]
    automaton = substring_dedup.Automaton(5)
    order = list(range(12))
    rng.shuffle(order)
    for i in order:
        automaton.add(texts[i], i * 1000)
    automaton.finish()
    for words in [*texts, [b"a", b"c"] * 5]:
        expected = [
            min((i * 1000 + j for i, t in enumerate(texts) for j in range(36) if t[j : j + 5] == words[k : k + 5]), default=float("inf"))
            for k in range(len(words) - 4)
        ]
        assert automaton.earliest(words) == expected


# language ID ----------------------------------------------------------------


def test_forward_backward_against_brute_force():
    import numpy as np

    rng = np.random.default_rng(0)
    emit, fresh = rng.random((57, 3)) + 0.01, rng.random(57) < 0.15
    step, start = rng.random((3, 3)), rng.random(3)
    fresh[0] = True
    found = langid.marginals(emit, fresh, step, start)
    ends = [*np.flatnonzero(fresh).tolist(), 57]
    for a, b in zip(ends, ends[1:], strict=False):
        e = emit[a:b]
        total = np.zeros_like(e)
        forward = [start * e[0]]
        for t in range(1, b - a):
            forward.append(forward[-1] @ step * e[t])
        back = [np.ones(3)]
        for t in range(b - a - 2, -1, -1):
            back.append(step @ (e[t + 1] * back[-1]))
        total = np.array(forward) * np.array(back[::-1])
        assert np.allclose(found[a:b], total / total.sum(axis=1, keepdims=True))


def test_languages(spark, sf_dir, messy, empty):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = langid.train_on_folds(docs)
    held = langid.predict(docs, model).filter("crc32(cast(doc_id AS string)) % 3 = 1")
    n, right = held.selectExpr("count(*)", "count_if(lang = lang_pred)").first()
    assert right >= 0.97 * n > 30
    # code-switched text: words are labelled by stretches
    sample = {r["lang"]: r["text"] for r in docs.filter("length(text) BETWEEN 400 AND 900").collect()}
    a, b = langid.words_of(sample["en"])[:60], langid.words_of(sample["de"])[:60]
    mixed = spark.createDataFrame([(" ".join(a + b),)], "text string")
    langs = langid.predict(mixed, model, word_labels=True).first()["word_langs"]
    assert langs[:60].count("en") > 50 and langs[60:].count("de") > 50
    out = langid.predict(messy, model)
    assert out.filter("text IS NULL OR text = ''").select("lang_pred", "score").distinct().collect() == [("und", 0.0)]
    assert out.filter("NOT score BETWEEN 0 AND 1").count() == 0 and out.count() == messy.count()
    assert langid.predict(empty, model).count() == 0
    unlabelled = langid.train(docs.limit(0))
    assert langid.predict(messy, unlabelled).select("lang_pred").distinct().collect() == [("und",)]


def test_copies_and_long_texts_do_not_push_a_language_out_of_the_sample(spark, monkeypatch):
    rows = [(f"der hund {i} " + "ja " * i, "de") for i in range(30)]
    rows += [("the dog runs home", "en")] * 20_000 + [(f"a cat {i} sleeps " + "so " * i, "en") for i in range(30)]
    rows += [("le chien " * (3000 + i), "fr") for i in range(9)]
    monkeypatch.setattr(langid, "fit", lambda sample: sample)
    sample = langid.train(spark.createDataFrame(rows, "text string, lang string").repartition(4), sample_docs=60)
    taken = {x: [text for text, lang in sample if lang == x] for x in ("de", "en", "fr")}
    assert len(set(sample)) == len(sample) <= 60
    assert len(taken["de"]) >= 20 and len(taken["en"]) >= 20 and "le chien " * 3000 in taken["fr"]


def test_every_letter_of_a_long_run_counts():
    model = langid.fit([("abc bca cab " * 40, "x"), ("uvw vwu wuv " * 40, "y")])
    run = "abc" * 10 + "uvw" * 300 + "abc"  # both ends speak for x
    assert "".join(langid.words_of(run)) == run and max(map(len, langid.words_of(run))) <= 40
    (p,) = langid.label(model, [run])
    assert model.languages[int(p.mean(axis=0).argmax())] == "y"


# licenses -------------------------------------------------------------------

NOTICE = """Licensed under the Apache License, Version 2.0. Also CC-BY, see
SPDX-License-Identifier: MIT; CC BY-SA 4.0. The MIT license. the mit-license"""


def test_licenses(spark, messy, empty):
    text = "intro " * 3 + NOTICE
    row = licenses.scan_licenses(spark.createDataFrame([(text,)], "text string")).first()
    words = ALNUM.findall(lower(text))
    places = sorted(
        (i, label) for phrase, label in licenses.BASE.items() for p in [phrase.split()] for i in range(len(words)) if words[i : i + len(p)] == p
    )
    assert (row["n_words"], row["n_base"], row["first_word"], row["last_word"]) == (len(words), len(places), places[0][0], places[-1][0])
    assert row["base_labels"] == "apache,cc-by,mit"
    assert row["labels"] == "apache,apache-2.0,cc-by,cc-by-sa-4.0,mit"
    labels = [(d["label"], d["priority"]) for d in row["detections"]]
    assert ("apache", 40) not in labels and ("apache-2.0", 80) in labels  # the title lies inside the notice
    out = licenses.scan_licenses(messy)
    assert out.filter("text IS NULL AND n_words = 0 AND n_base = 0 AND first_word IS NULL AND labels = '' AND score = 0").count() == 2
    assert licenses.scan_licenses(empty).count() == 0


def test_license_rules_are_ordered_signatures():
    rules = licenses.parse_rules()
    assert len(rules) > 300 and all(0 < r.priority < 100 for r in rules)
    scanner = licenses.Scanner(rules, licenses.BASE)
    gated = {r.keyword for r in rules}
    assert len(gated) > 80
    text = b"GNU General Public License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version."
    assert [x[2] for x in scanner.scan(text)[-1]] == ["gpl-2.0-or-later"]


BSD3 = """Copyright (c) 2020, Someone. All rights reserved. Redistribution and use in source and binary forms, with or
without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must
retain the above copyright notice. 2. Redistributions in binary form must reproduce the above copyright notice. 3. Neither the
name of the copyright holder nor the names of its contributors may be used to endorse products. THIS SOFTWARE IS PROVIDED BY THE
COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"."""


@pytest.mark.parametrize(
    "text,labels",
    [
        (BSD3, "bsd-3-clause"),
        (BSD3.replace("3. Neither the\nname of the copyright holder nor the names of its contributors may be used to endorse products.", ""), "bsd-2-clause"),
        (BSD3.replace("3. Neither", "3. All advertising materials mentioning features or use of this software must display the following acknowledgement: x. 4. Neither"), "bsd-4-clause"),
        ("This work is not in the public domain.", ""),
        ("This work is in the public domain.", "public-domain"),
        ("(c) Someone. All rights reserved.", "proprietary"),
    ],
)
def test_license_texts_have_their_own_label(spark, text, labels):
    row = licenses.scan_licenses(spark.createDataFrame([(text,)], "text string")).first()
    assert row["labels"] == labels


def brute_licenses(text, rules):
    """Every match of every rule, each compared with all that were taken before it."""
    joined = " ".join(ALNUM.findall(lower(text)))
    found = sorted(
        (-r.priority, m.start() - m.end(), m.start(), i, m.end(), r.label)
        for i, r in enumerate(rules) for m in re.finditer(r.pattern.pattern.decode(), joined, re.ASCII)
    )
    taken = []
    for d in found:
        if not any(t[2] <= d[2] and d[4] <= t[4] for t in taken):
            taken.append(d)
    base = {label for phrase, label in licenses.BASE.items() if f" {phrase} " in f" {joined} "}
    score = max([-d[0] / 100 for d in taken] + [licenses.BASE_SCORE] * bool(base), default=0.0)
    return ",".join(sorted(base | {d[5] for d in taken})), score


def test_license_query_against_brute_force(spark, sf_dir):
    rules = licenses.parse_rules()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    got = {r["doc_id"]: (r["labels"], r["score"]) for r in licenses.query(spark, sf_dir).collect()}
    assert got.keys() == texts.keys()
    hinted = [d for d, t in texts.items() if t and re.search("licen|copyright|rights|warrant|public domain|spdx", t, re.IGNORECASE)]
    assert len(hinted) > 3
    for doc in hinted + sorted(texts)[:40]:
        assert got[doc] == brute_licenses(texts[doc], rules), doc


def test_overlapping_licenses_against_brute_force(spark):
    import random

    rng = random.Random(6)
    bits = [NOTICE, BSD3, "GPL v2 or later", "Apache License, Version 2.0, January 2004", "MIT", "All rights reserved", "gnu general public license", "BSD license"]
    rules = licenses.parse_rules()
    scanner = licenses.Scanner(rules, licenses.BASE)
    for _ in range(60):
        words = " ".join(rng.choice(bits) for _ in range(rng.randrange(1, 8))).split()
        cut = sorted(rng.sample(range(len(words) + 1), 2)) if len(words) > 1 else [0, 1]
        text = " ".join(words[cut[0] : cut[1]] + words)
        row = scanner.scan(text.encode())
        assert (row[5], row[6]) == brute_licenses(text, rules)


def test_many_detections_take_linear_time():
    import time

    scanner = licenses.Scanner(licenses.parse_rules("mit | 40 | mit | mit license\nmit | 50 | mit | mit"), licenses.BASE)
    joined = b"mit license " * 50_000
    start = time.time()
    assert len(scanner.detections(joined.strip())) == 100_000  # the word first, then the title that holds it
    assert time.time() - start < 10  # a second where nothing else runs


def test_letters_are_letters_with_their_marks():
    assert langid.words_of("½ ² 12 ①②③ \u00b9 _x_ a1b") == ["x", "a", "b"]
    hindi, thai = "\u0939\u093f\u0928\u094d\u0926\u0940", "\u0e17\u0e35\u0e48\u0e19\u0e35\u0e48"
    assert langid.words_of(f"{hindi} {thai}, été") == [hindi, thai, "été"]
    assert langid.words_of("\u0301 \U0001f600") == []
    model = langid.fit([("abc bca cab " * 40, "x"), ("uvw vwu wuv " * 40, "y")])
    assert [langid.words_of(t) for t in (None, "", "½ ² 12", "①②③")] == [[]] * 4 and model.languages == ["x", "y"]


# fingerprints ---------------------------------------------------------------


def gram_hash(points):
    """The upper half of a mixed polynomial of code points, in plain numbers."""
    h = 0
    for p in points:
        h = (h * 0x9E3779B97F4A7C15 + p) % 2**64
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        h = (h ^ (h >> 33)) * factor % 2**64
    return (h ^ (h >> 33)) >> 32


def brute_winnow(text, gram, window):
    if not text:
        return ""
    points = [ord(c) for c in text]
    k = min(gram, len(points))
    h = [gram_hash(points[i : i + k]) for i in range(len(points) - k + 1)]
    w, chosen = min(window, len(h)), []
    for i in range(len(h) - w + 1):
        p = max(range(i, i + w), key=lambda x: (-h[x], x))
        if not chosen or chosen[-1] != p:
            chosen.append(p)
    return "".join(f"{h[p]:08x}" for p in chosen)


def brute_edited(source, gram, window):
    """Rows of the query for (id, text) in ascending order of the ids."""
    share = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    split = lambda f: {f[i : i + 8] for i in range(0, len(f), 8)}
    expected = []
    for i, (doc, text) in enumerate(source):
        following = source[(i + 1) % len(source)][1]
        tail = len(text) // 4
        edited = text[: len(text) - tail] + following[:tail]
        f, g, h = (brute_winnow(t, gram, window) for t in (text, edited, following))
        digest = hashlib.sha256(edited.encode()).hexdigest()
        expected.append((doc, len(text), digest, f, g, share(split(f), split(g)), share(split(f), split(h))))
    return sorted(expected, key=str)


@pytest.mark.parametrize("options", [{}, fingerprints.FINE])
def test_fingerprints_against_brute_force(messy, options):
    docs = messy.filter("doc_id IS NOT NULL AND doc_id <> 30").dropDuplicates(["doc_id"])
    source = sorted((r["doc_id"], r["text"] or "") for r in docs.collect())
    out = fingerprints.with_edited(docs, **options)
    assert by_key(out, *out.columns) == brute_edited(source, options.get("gram", 16), options.get("window", 48))


def test_fingerprint_query_against_brute_force(spark, sf_dir):
    """The query itself, whole table, with its own parameters: grams of 8, windows of 16."""
    out = fingerprints.query(spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    assert by_key(out, *out.columns) == brute_edited(sorted((r["doc_id"], r["text"] or "") for r in docs.collect()), 8, 16)


def test_fingerprints_of_messy_rows(messy, empty, spark):
    out = fingerprints.with_edited(messy)
    assert out.count() == messy.count() and out.filter("NOT near_edited BETWEEN 0 AND 1").count() == 0
    assert out.filter("doc_id IS NULL AND near_next <> 0").count() == 0
    one = fingerprints.with_edited(spark.createDataFrame([(7, "abcdefgh")], "doc_id long, text string")).first()
    assert one["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest() and one["near_next"] == 1.0
    assert fingerprints.with_edited(empty).count() == 0
    plain = fingerprints.with_fingerprints(messy).filter("doc_id = 4").first()
    assert len(plain["positions"]) * 8 == len(plain["fingerprint"])


def test_query_likens_near_copies_of_short_texts(spark, tmp_path):
    texts = [prose(i, 12)[: 32 + i % 30] for i in range(60)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = fingerprints.query(spark, str(tmp_path))
    assert found.filter("near_edited = 0").count() == 0  # three quarters of them, over 23 code points, are the same


def test_winnowing_guarantee():
    import numpy as np

    rng = np.random.default_rng(4)
    grams = rng.integers(0, 9, 300).astype(np.uint64)  # many ties
    at = winnow(grams, 7).tolist()
    for i in range(294):
        window = grams[i : i + 7].tolist()
        assert i + max(k for k in range(7) if window[k] == min(window)) in at


# packing --------------------------------------------------------------------


@pytest.mark.parametrize("options", [{}, {"bucket_rows": 3}])
def test_packing_round_trip(messy, options):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    out = [r.asDict() for r in packing.pack(messy, with_ids=True, **options).collect()]
    expected = defaultdict(int)
    for r in messy.collect():
        ids = [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 2]
        low, high, piece = 0, (len(ids) - 1) % 1024 + 1, 0
        while low < len(ids):
            part = ids[low:high]
            crc = zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part))
            expected[(r["doc_id"], piece, low, len(part), crc, tuple(part))] += 1
            low, high, piece = high, high + 1024, piece + 1
    found = defaultdict(int)
    for r in out:
        found[(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"], tuple(r["ids"]))] += 1
    assert found == expected
    sequences = defaultdict(list)
    for r in out:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024
    assert len(sequences) <= -(-sum(r["length"] for r in out) // 1024) + 1


def test_packing_of_nothing(empty):
    assert packing.pack(empty).count() == 0


def _sequences(plan):
    return sum(n for _, n in plan)


def _best_fit_alone(histogram):
    import numpy as np

    lengths = np.array(sorted(histogram))
    return sum(packing.best_fit(lengths, np.array([histogram[n] for n in lengths.tolist()]), 1024).values())


def test_plans_hold_every_piece_and_never_lose_to_best_fit():
    """20 random histograms: wide, narrow, few lengths, mostly short, mostly long."""
    import random

    rng = random.Random(3)
    gaps = []
    for i in range(20):
        low, high = [(1, 1025), (300, 700), (1, 200), (200, 1025), (1, 1025)][i % 5]
        lengths = rng.sample(range(low, high), min(high - low, rng.choice([12, 60, 150])))
        histogram = {n: rng.randrange(1, rng.choice([5, 300, 4000])) for n in lengths}
        plan = packing.solve(histogram, rounds=60)
        held = defaultdict(int)
        for config, n in plan:
            assert sum(length * m for length, m in config) <= 1024
            for length, m in config:
                held[length] += m * n
        assert held == histogram
        bound = packing.lower_bound(histogram)
        assert bound >= -(-sum(k * v for k, v in histogram.items()) // 1024)
        assert bound <= _sequences(plan) <= _best_fit_alone(histogram)
        gaps.append(_sequences(plan) / bound - 1)
    assert sum(gaps) / len(gaps) < 0.02


def test_plans_of_nothing_and_of_one_length():
    assert packing.solve({}) == []
    assert _sequences(packing.solve({1024: 7})) == 7
    assert _sequences(packing.solve({300: 10})) == 4
    assert packing.lower_bound({513: 10, 511: 10}) == 10


def test_dual_prices_are_feasible():
    """Whatever fits a sequence costs at most 1 under them."""
    import random

    import numpy as np

    rng = random.Random(8)
    for _ in range(20):
        lengths = np.array(sorted(rng.sample(range(1, 1025), 40)))
        counts = np.array([rng.randrange(1, 500) for _ in lengths])
        value, prices = packing.dual_prices(lengths, counts, 1024)
        assert packing.knapsack(lengths, prices, 1024)[0][1024] <= 1 + 1e-9
        assert value == pytest.approx((counts * prices).sum())


def test_pricing_finds_the_dearest_configuration():
    import itertools

    import numpy as np

    lengths, prices = np.array([3, 5, 7]), np.array([2.0, 3.9, 5.1])
    value, _ = packing.knapsack(lengths, prices, 20)
    best = max(
        (np.dot(c, prices) for c in itertools.product(range(7), range(5), range(3)) if np.dot(c, lengths) <= 20)
    )
    assert value[20] == pytest.approx(best)


def test_tokenizer_ids_of_odd_texts():
    import random

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    encoder = packing.Encoder(packing.default_tokenizer())
    assert encoder.fast is not None
    rng = random.Random(1)
    letters = [*"abcXYZ  \n\t'sdt0129.,!?<|>éßñüкот日本한", "<|endoftext|>", "'ll", "\u2003", "\x1c", "\x85", "\xa0", "½", "\u0301", "\U0001f600"]
    for _ in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(25)))
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert encoder.encode(text) == b"".join(x.to_bytes(4, "little") for x in ids), text


# oracles --------------------------------------------------------------------


@pytest.mark.parametrize("module", [line_dedup, decontaminate, substring_dedup])
def test_queries_against_sql(spark, sf_dir, module):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    found = module.query(spark, sf_dir)
    expected = con.sql(module.SQL).project(", ".join(found.columns)).fetchall()
    assert by_key(found, *found.columns) == sorted(expected, key=str)
