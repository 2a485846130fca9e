"""License scans with ordered signature rules.

A text becomes its words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing
A-Z, joined by single spaces. Each rule (see ``license_rules``) has a keyword:
only rules whose keyword the text holds are run. For every license there is
also a rule for its ``SPDX-License-Identifier`` line. Detections are taken in
order of priority, then length, then place; one whose interval lies inside the
interval of a detection already taken is suppressed.

Base phrases are looked up beside the rules: all places where a phrase's words
stand consecutively; their labels are never suppressed.

``score`` is the largest priority taken, over 100; a base phrase alone counts
``BASE_SCORE``; 0 without any.

Edge cases: null counts as empty (no words, no labels); ties in priority and
length go to the earlier place, then to the rule written first; repeated rows
get the same result each; an empty table gives an empty result; further
columns pass through, ones named like a result column are replaced.

At scale: one pass over the texts without a shuffle; the rules are a constant.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from trip_star.llm.common import WORD_BYTES, annotate, process_cache, raw
from trip_star.llm.license_rules import RULES

BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
BASE_SCORE = 0.45
SPDX_PRIORITY = 88


@dataclass
class Rule:
    label: str
    priority: int
    keyword: bytes
    pattern: re.Pattern


def parse_rules(text: str = RULES) -> list[Rule]:
    rows = [tuple(part.strip() for part in line.split("|", 3)) for line in text.splitlines()]
    for label in sorted({label for label, *_ in rows}):  # the identifier line of each license
        words = " ".join(re.findall(r"[0-9a-z]+", label))
        rows.append((label, str(SPDX_PRIORITY), "spdx", f"spdx license identifier {words}"))
    return [
        Rule(label, int(priority), keyword.encode(), re.compile(rb"(?<![^ ])(?:" + pattern.encode() + rb")(?![^ ])"))
        for label, priority, keyword, pattern in rows
    ]


class Scanner:
    def __init__(self, rules: list[Rule], base: dict[str, str]):
        self.by_keyword: dict[bytes, list[tuple[int, Rule]]] = {}
        for i, rule in enumerate(rules):
            self.by_keyword.setdefault(rule.keyword, []).append((i, rule))
        self.base = [(f" {' '.join(phrase.split())} ".encode(), label) for phrase, label in base.items()]

    def base_places(self, padded: bytes) -> list[tuple[int, str]]:
        """(byte place, label) of every base phrase; ``padded`` has a space at both ends."""
        found = []
        for phrase, label in self.base:
            at = padded.find(phrase)
            while at >= 0:
                found.append((at, label))
                at = padded.find(phrase, at + 1)
        return found

    def detections(self, joined: bytes) -> list[tuple[int, int, Rule]]:
        """What is taken: (start, end, rule), by priority."""
        found = [
            (-rule.priority, m.start() - m.end(), m.start(), i, m.end(), rule)
            for keyword, rules in self.by_keyword.items()
            if keyword in joined
            for i, rule in rules
            for m in rule.pattern.finditer(joined)
        ]
        taken: list[tuple[int, int, Rule]] = []
        # of the intervals taken, those that no other one holds: starts and ends both rise
        starts: list[int] = []
        ends: list[int] = []
        for _, _, start, _, end, rule in sorted(found, key=lambda d: d[:4]):
            at = bisect_right(starts, start)
            if at and ends[at - 1] >= end:
                continue  # inside the last one that starts no later
            taken.append((start, end, rule))
            low = at - (at > 0 and starts[at - 1] == start)
            high = bisect_right(ends, end, low)
            starts[low:high], ends[low:high] = [start], [end]
        return taken

    def scan(self, text: bytes | None) -> tuple:
        words = (text or b"").translate(WORD_BYTES).split()
        joined = b" ".join(words)
        padded = b" " + joined + b" "
        places = self.base_places(padded)
        taken = self.detections(joined)
        spaces = np.flatnonzero(np.frombuffer(joined, dtype=np.uint8) == 32) if places or taken else np.empty(0, dtype=np.int64)
        number = lambda at: int(np.searchsorted(spaces, at))  # noqa: E731  words before the one at ``at``
        starts = [number(at) for at, _ in places]  # ``padded`` is one byte ahead, its match begins with a space
        base = {label for _, label in places}
        spans = sorted((number(a), number(b) + 1, rule.label, rule.priority) for a, b, rule in taken)
        score = max([rule.priority / 100 for _, _, rule in taken] + [BASE_SCORE] * bool(base), default=0.0)
        return (
            len(words), len(places), min(starts, default=None), max(starts, default=None),
            ",".join(sorted(base)), ",".join(sorted(base | {rule.label for _, _, rule in taken})), score, spans,
        )


def scan_licenses(
    docs: DataFrame, text_col: str = "text", rules: str = RULES, base: dict[str, str] | None = None, drop_text: bool = False
) -> DataFrame:
    """``docs`` plus ``n_words``, ``n_base``, ``first_word``, ``last_word``,
    ``base_labels``, ``labels``, ``score`` and ``detections`` (word interval, end
    exclusive, label and priority of each)."""
    phrases = BASE if base is None else base

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        cache = process_cache("licenses")
        key = (rules, tuple(phrases.items()))
        if key not in cache:
            cache[key] = Scanner(parse_rules(rules), phrases)
        scanner = cache[key]
        rows = [scanner.scan(text) for text in raw(batch.column(batch.schema.get_field_index(text_col)))]
        columns = list(zip(*rows, strict=True))
        spans = [[dict(zip(("start", "end", "label", "priority"), s, strict=True)) for s in x] for x in columns.pop()]
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64())
        struct = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("label", pa.string()), ("priority", pa.int32())])
        return [*(pa.array(c, t) for c, t in zip(columns, types, strict=True)), pa.array(spans, pa.list_(struct))]

    span = StructType([StructField("start", IntegerType()), StructField("end", IntegerType()), StructField("label", StringType()), StructField("priority", IntegerType())])
    fields = [StructField(c, LongType()) for c in ("n_words", "n_base", "first_word", "last_word")]
    fields += [StructField(c, StringType()) for c in ("base_labels", "labels")]
    fields += [StructField("score", DoubleType()), StructField("detections", ArrayType(span))]
    return annotate(docs, run, fields, drop=[text_col] if drop_text else [], cache="licenses")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scan_licenses(docs, drop_text=True).drop("detections")
