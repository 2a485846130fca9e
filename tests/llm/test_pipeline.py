from __future__ import annotations

import unicodedata
import zlib

import corpus_pipeline
import pytest
from tokenizers import Tokenizer

from llm.test_simhash import brute_components, brute_fingerprint
from llm.test_texts import ALNUM, lower
from trip_star.llm import packing


def test_stages_are_as_dealt():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontamination", "packing"]


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """What each stage returns, collected, and the pipeline's own result."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [[r.asDict() for r in docs.collect()]]
    for _, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, sf_dir)
        out.append([r.asDict() for r in after.collect()])
        if _ != "packing":
            assert after.columns == docs.columns and after.dtypes == docs.dtypes
            docs = spark.createDataFrame([tuple(r.values()) for r in out[-1]], docs.schema)
    return out, sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).collect()))


def test_language_stage_keeps_texts_with_letters(stages):
    before, after = stages[0][0], stages[0][1]
    gone = {r["doc_id"] for r in before} - {r["doc_id"] for r in after}
    assert gone >= {r["doc_id"] for r in before if not any(unicodedata.category(c)[0] == "L" for c in r["text"] or "")}
    assert len(gone) <= 0.01 * len(before)


def test_line_stage_against_brute_force(stages):
    before, after = stages[0][1], {r["doc_id"]: r for r in stages[0][2]}
    holders = {}
    key = lambda x: lower(x.strip(" \t\n\x0b\x0c\r"))
    for r in before:
        for x in (r["text"] or "").split("\n"):
            holders.setdefault(key(x), set()).add(r["doc_id"])
    for r in before:
        kept = [x for x in r["text"].split("\n") if len(key(x)) < 40 or len(holders[key(x)]) < 5 or r["doc_id"] == max(holders[key(x)])]
        assert after[r["doc_id"]]["text"] == "\n".join(kept) and after[r["doc_id"]]["n_chars"] == len("\n".join(kept))


def test_near_dedup_stage_against_brute_force(stages):
    before, after = sorted(stages[0][2], key=lambda r: r["doc_id"]), stages[0][3]
    label = brute_components([brute_fingerprint(r["text"]) for r in before], 4)
    assert sorted(r["doc_id"] for r in after) == [before[x]["doc_id"] for x in sorted(set(label))]
    assert len(after) < len(before)


def test_decontamination_stage_against_brute_force(stages, spark, sf_dir):
    windows = {}
    for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect():
        w = ALNUM.findall(lower(r["text"]))
        n = min(10, len(w))
        for i in range(len(w) - n + 1) if w else ():
            windows.setdefault(n, set()).add(tuple(w[i : i + n]))
    clean = []
    for r in stages[0][3]:
        w = ALNUM.findall(lower(r["text"]))
        if not any(tuple(w[i : i + n]) in seqs for n, seqs in windows.items() for i in range(len(w) - n + 1)):
            clean.append(r["doc_id"])
    assert sorted(r["doc_id"] for r in stages[0][4]) == sorted(clean) and len(clean) < len(stages[0][3])


def test_packing_stage_and_the_whole_run(stages):
    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    expected = set()
    for r in stages[0][4]:
        ids = [*tokenizer.encode(r["text"], add_special_tokens=False).ids, 2]
        low, high, piece = 0, (len(ids) - 1) % 1024 + 1, 0
        while low < len(ids):
            expected.add((r["doc_id"], piece, low, high - low, zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids[low:high]))))
            low, high, piece = high, high + 1024, piece + 1
    columns = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert {tuple(r[c] for c in columns) for r in stages[0][5]} == expected
    assert {r[:5] for r in stages[1]} == expected


def test_pipeline_of_messy_rows(spark, sf_dir, messy):
    """Nulls, repeats and clashing columns pass through every stage."""
    docs = messy.selectExpr(
        "doc_id", "text", "CASE WHEN doc_id % 2 = 0 THEN 'en' END AS lang", "cast(null AS string) AS source", "cast(length(text) AS long) AS n_chars"
    )
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.count() > 0, name
    none = messy.selectExpr("doc_id", "text", "id AS lang", "id AS source", "1L AS n_chars").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        none = stage(spark, none, sf_dir)
    assert none.count() == 0
