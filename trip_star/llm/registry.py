"""The queries of this subpackage and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

import corpus_pipeline
from trip_star.llm import (
    decontaminate,
    fingerprints,
    langid,
    licenses,
    line_dedup,
    packing,
    sharding,
    simhash,
    spelling,
    substring_dedup,
    url_filter,
    vector_codes,
    warc,
)


def queries() -> dict:
    return {
        "op1_simhash_near_dedup": simhash.query,
        "op2_warc": warc.query,
        "op3_license_scan": licenses.query,
        "op4_substring_dedup": substring_dedup.query,
        "op5_language_id": langid.query,
        "op6_line_dedup": line_dedup.query,
        "op7_benchmark_decontamination": decontaminate.query,
        "op8_best_fit_packing": packing.query,
        "op9_url_filter": url_filter.query,
        "op10_document_fingerprints": fingerprints.query,
        "op11_spelling_variants": spelling.query,
        "op12_vector_codes": vector_codes.query,
        "op13_sharding": sharding.query,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_warc": warc.SQL,
        "op4_substring_dedup": substring_dedup.SQL,
        "op6_line_dedup": line_dedup.SQL,
        "op7_benchmark_decontamination": decontaminate.SQL,
        "op9_url_filter": url_filter.SQL,
    }
