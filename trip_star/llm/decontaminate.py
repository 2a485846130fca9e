"""Benchmark decontamination by winnowing.

Both sides keep the smallest k-gram hash of every ``W`` consecutive word
k-grams (``K + W - 1 = window``), so any shared run of ``window`` words selects
the same gram on both sides: every such run is a hit. Training fingerprints
are joined with the test fingerprints, and each hit is extended to the windows
of ``window`` words that hold its gram; those that also stand in an item (equal
64-bit hash of their words) are marked, so longer runs are marked from end to
end. An item of fewer words (but not none) is one window of its own length and
is looked up by the hash of its whole sequence.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z.

Edge cases: null or empty texts have no words; items without words never hit;
repeated documents are judged one by one, repeated items (same id) count once;
a null item id is reported as no id but its words count; a text of one word
over and over has one window; empty tables give an empty result or no hits.
Further columns pass through; ones named like a result column are replaced.

At scale: the benchmark is measured first. Up to ``INDEX_CHARS`` its
fingerprints and windows are broadcast and documents are never shuffled. A
larger one never passes through the driver: the fingerprints of both sides
meet in a shuffle, those that meet are extended and their windows meet in
another, and the results join the documents by the MD5 of the text. Every
distinct text is looked up once; a fingerprint, window or text of very many
rows is salted, its other side repeated once per salt.
"""

from __future__ import annotations

from itertools import batched

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField

from trip_star.llm.common import HOT_KEYS, HOT_ROWS, WORD_BYTES, annotate, materialise, process_cache, raw, rolling, sliced, winnow
from trip_star.operators.joins import attach_id

WINDOW = 10
GRAM = 5
INDEX_CHARS = 32_000_000
SALT_ROWS = 100_000


def word_hashes(text: bytes | None) -> np.ndarray:
    words = (text or b"").translate(WORD_BYTES).split()
    return np.array([xxhash.xxh3_64_intdigest(w) for w in words], dtype=np.uint64)


def extend(at: np.ndarray, n_words: int, window: int, gram: int) -> np.ndarray:
    """Starts of all windows that hold a gram which starts at one of ``at``."""
    starts = np.unique(at[:, None] - np.arange(window - gram + 1))
    return starts[(starts >= 0) & (starts <= n_words - window)]


class Index:
    """The winnowed fingerprints and the windows of the items."""

    def __init__(self, items: list[tuple[str | None, bytes | None]], window: int, gram: int):
        self.window, self.gram = window, gram
        self.ids: list[str | None] = []
        grams, windows = [np.empty(0, dtype=np.uint64)], {}
        for item_id, text in items:
            words = word_hashes(text)
            if not len(words):
                continue
            size = min(window, len(words))
            whole = np.unique(rolling(words, size))
            windows.setdefault(size, []).append((whole, np.full(len(whole), len(self.ids), dtype=np.int32)))
            self.ids.append(item_id)
            if size == window:
                all_grams = rolling(words, gram)
                grams.append(all_grams[winnow(all_grams, window - gram + 1)])
        self.hashes = np.unique(np.concatenate(grams))
        self.windows = {}
        for size, parts in windows.items():
            whole, item = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(whole, kind="stable")
            self.windows[size] = whole[order], item[order]

    def _starts(self, words: np.ndarray) -> np.ndarray:
        grams = rolling(words, self.gram)
        at = winnow(grams, self.window - self.gram + 1)
        place = np.minimum(np.searchsorted(self.hashes, grams[at]), len(self.hashes) - 1)
        return extend(at[self.hashes[place] == grams[at]], len(words), self.window, self.gram)

    def hits(self, words: np.ndarray, covered: np.ndarray) -> set[int]:
        """Marks the words of one document that are hit; the items that hit."""
        found: set[int] = set()
        for size, (whole, item) in self.windows.items():
            if len(words) < size:
                continue
            starts = self._starts(words) if size == self.window else np.arange(len(words) - size + 1)
            if not len(starts):
                continue
            own = rolling(words, size)[starts]
            low, high = np.searchsorted(whole, own, "left"), np.searchsorted(whole, own, "right")
            hit = high > low
            _cover(covered, starts[hit], size)
            for a, b in set(zip(low[hit].tolist(), high[hit].tolist(), strict=True)):
                found.update(item[a:b].tolist())
        return found


def _cover(covered: np.ndarray, starts: np.ndarray, size: np.ndarray | int) -> None:
    """Marks ``size`` words from each of ``starts`` on."""
    edges = np.zeros(len(covered) + 1, dtype=np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + size, -1)
    covered |= np.cumsum(edges[:-1]) > 0


def _runs(covered: np.ndarray) -> list[list[int]]:
    return np.flatnonzero(np.diff(np.concatenate(([0], covered.view(np.int8), [0])))).reshape(-1, 2).tolist()


FIELDS = [
    StructField("n_words", LongType()),
    StructField("hit_spans", ArrayType(ArrayType(IntegerType()))),
    StructField("n_hit", LongType()),
    StructField("item_ids", ArrayType(StringType())),
    StructField("contaminated", BooleanType()),
]


def _columns(covered: list[np.ndarray], ids: list[list[str]]) -> list[pa.Array]:
    n_hit = [int(c.sum()) for c in covered]
    return [
        pa.array([len(c) for c in covered], pa.int64()),
        pa.array([_runs(c) for c in covered], pa.list_(pa.list_(pa.int32()))),
        pa.array(n_hit, pa.int64()),
        pa.array(ids, pa.list_(pa.string())),
        pa.array([n > 0 for n in n_hit], pa.bool_()),
    ]


def find_contamination(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    index_chars: int = INDEX_CHARS,
    drop_text: bool = False,
) -> DataFrame:
    """``docs`` plus ``n_words``, ``hit_spans`` (word intervals, end exclusive),
    ``n_hit``, ``item_ids`` (sorted strings) and ``contaminated``."""
    bench = items.select(F.col(item_id_col).cast("string").alias("item"), F.col(item_text_col).alias("text"))
    chars = bench.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    drop = [text_col] if drop_text else []
    if chars > index_chars:
        return _judge_shuffled(docs, bench, text_col, window, gram, drop)
    part = bench.collect()  # at most index_chars bytes of text
    index = Index([(r["item"], r["text"].encode() if r["text"] is not None else None) for r in part], window, gram)
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def judge(batch: pa.RecordBatch) -> list[pa.Array]:
        index = shared.value
        marks, ids = [], []
        for text in raw(batch.column(batch.schema.get_field_index(text_col))):
            words = word_hashes(text)
            covered = np.zeros(len(words), dtype=bool)
            ids.append(sorted({index.ids[i] for i in index.hits(words, covered)} - {None}))
            marks.append(covered)
        return _columns(marks, ids)

    return annotate(docs, judge, FIELDS, drop=drop)


def _fingerprints(texts: DataFrame, window: int, gram: int, sizes: list[int] | None) -> DataFrame:
    """(name, text) -> a row per selected gram: its hash ``key``, the ``size`` of a
    window, the first of the windows that hold it and the hash of each. A window
    of fewer words is its own key: for items (``sizes`` None) a text of fewer, for
    documents every run of one of ``sizes`` words."""

    def rows(words: np.ndarray):
        if len(words) >= window:
            grams, whole = rolling(words, gram), rolling(words, window)
            for p in winnow(grams, window - gram + 1).tolist():
                first = max(0, p - (window - gram))
                yield grams[p], window, first, whole[first : p + 1]
        for size in sizes if sizes is not None else [len(words)] if len(words) < window else []:
            for p, h in enumerate(rolling(words, size) if size else ()):
                yield h, size, p, [h]

    def run(batches):
        process_cache("")
        for batch in sliced(batches, 100):
            for name, text in zip(batch.column(0).to_pylist(), raw(batch.column(1)), strict=True):
                for some in batched(rows(word_hashes(text)), 10_000):
                    key, size, first, whole = zip(*some, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([name] * len(key), pa.string()),
                            pa.array(np.array(key, dtype=np.uint64).view(np.int64)),
                            pa.array(size, pa.int32()),
                            pa.array(first, pa.int32()),
                            pa.array([np.asarray(w, dtype=np.uint64).view(np.int64) for w in whole], pa.list_(pa.int64())),
                        ],
                        names=["name", "key", "size", "first", "whole"],
                    )

    return texts.mapInArrow(run, "name string, key long, size int, first int, whole array<long>")


def _meet(rows: DataFrame, table: DataFrame, on: list[str]) -> DataFrame:
    """Inner join in which a value of ``on`` with very many ``rows`` is dealt over
    salts by ``name``. At most HOT_KEYS values are; their rows of ``table`` are
    repeated once per ``SALT_ROWS`` (or more) rows they meet."""
    limit = max(SALT_ROWS, rows.count() // HOT_KEYS)
    hot = rows.groupBy(*on).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > limit)
    hot = F.broadcast(materialise(hot.select(*on, F.ceil(F.col("n") / limit).cast("int").alias("salts")), "decontaminate-hot"))
    salts = F.coalesce("salts", F.lit(1))
    dealt = rows.join(hot, on, "left").withColumn("salt", F.pmod(F.xxhash64("name"), salts).cast("int")).drop("salts")
    repeated = table.join(hot, on, "left").withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("salts")
    return dealt.join(repeated, [*on, "salt"]).drop("salt")


def _judge_shuffled(
    docs: DataFrame, bench: DataFrame, text_col: str, window: int, gram: int, drop: list[str]
) -> DataFrame:
    texts = bench.filter(F.length("text") > 0).select(F.col("item").alias("name"), "text")
    ours = materialise(_fingerprints(texts, window, gram, None), "decontaminate-items")
    sizes = sorted(r["size"] for r in ours.select("size").distinct().collect() if r["size"] < window)
    spread = [F.col(c) for c in docs.columns if "map<" not in docs.schema[c].dataType.simpleString()]
    named = docs.withColumn("__dc_spread", F.xxhash64(*spread)).withColumn("__dc_text", F.md5(F.coalesce(F.col(text_col), F.lit(""))))
    distinct = named.groupBy(F.col("__dc_text").alias("name")).agg(F.first(text_col).alias("text"))
    theirs = materialise(_fingerprints(distinct, window, gram, sizes), "decontaminate-documents")
    met = _meet(theirs, ours.select("key", "size").distinct(), ["key", "size"])
    met = met.select("name", "size", "first", F.posexplode("whole").alias("i", "whole"))
    met = materialise(met.select("name", "size", (F.col("first") + F.col("i")).alias("at"), "whole").distinct(), "decontaminate-windows")
    windows = ours.select(F.col("name").alias("item"), "size", F.explode("whole").alias("whole")).distinct()
    hits = (
        _meet(met, windows, ["whole", "size"])
        .groupBy("name")
        .agg(F.collect_set(F.struct("at", "size")).alias("__dc_at"), F.collect_set("item").alias("__dc_items"))
        .withColumn("__dc_n", F.size("__dc_at"))
    )
    hits = materialise(hits, "decontaminate-hits")
    # the texts of many rows, hit or not, at most HOT_KEYS of them, meet their rows by broadcast
    limit = max(HOT_ROWS, docs.count() // HOT_KEYS)
    copies = named.groupBy(F.col("__dc_text").alias("name")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > limit).drop("n")
    hot = materialise(copies.join(hits, "name", "left").withColumn("__dc_n", F.coalesce("__dc_n", F.lit(0))), "decontaminate-copies")
    found = ["__dc_at", "__dc_items"]
    joined = attach_id(
        named, hits, ["__dc_text"], "__dc_n", dim_keys=["name"], carry=found, hot=hot, spread_col="__dc_spread", nonnegative_ids=True
    )

    def judge(batch: pa.RecordBatch) -> list[pa.Array]:
        column = lambda c: batch.column(batch.schema.get_field_index(c))
        marks = []
        for text, at in zip(raw(column(text_col)), column("__dc_at").to_pylist(), strict=True):
            covered = np.zeros(len((text or b"").translate(WORD_BYTES).split()), dtype=bool)
            if at:
                _cover(covered, np.array([x["at"] for x in at]), np.array([x["size"] for x in at]))
            marks.append(covered)
        return _columns(marks, [sorted(x or ()) for x in column("__dc_items").to_pylist()])

    return annotate(joined, judge, FIELDS, drop=[*drop, "__dc_text", "__dc_spread", "__dc_n", *found])


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return find_contamination(docs, items, drop_text=True).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
        "contaminated",
    )


SQL = r"""
WITH lowered AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
),
docs AS (
  SELECT doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM lowered
),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
),
sized AS (SELECT item_id, w, least(len(w), 10) AS n FROM items WHERE len(w) > 0),
item_windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS seq
  FROM (SELECT item_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM sized)
),
lengths AS (SELECT DISTINCT n FROM sized),
doc_windows AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS seq
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM docs, lengths WHERE len(w) >= n)
),
hits AS (SELECT doc_id, i, n, item_id FROM doc_windows JOIN item_windows USING (n, seq)),
positions AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hits)),
words_hit AS (SELECT doc_id, count(*) AS n_hit FROM positions GROUP BY doc_id),
items_hit AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN words_hit USING (doc_id) LEFT JOIN items_hit USING (doc_id)
"""
