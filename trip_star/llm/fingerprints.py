"""Document fingerprints by winnowing.

Rolling hashes of all ``GRAM`` consecutive code points, the smallest one of
every ``WINDOW`` consecutive hashes chosen (the rightmost on ties), with its
position. Two texts that share a run of ``GRAM + WINDOW - 1`` code points share
a fingerprint entry from that run. A text shorter than a gram is one gram. The
query takes ``FINE`` for all texts: a guarantee of 23 code points instead of 63.
The likeness of two fingerprints is the share of their distinct hashes that
both have (1 if neither has any).

Edge cases: null counts as empty, an empty text has an empty fingerprint;
repeated rows and equal texts have equal fingerprints; further columns pass
through, ones named like a result column are replaced; an empty table gives an
empty result. In ``with_edited`` rows follow each other by id, equal ids by
text; a row without id stands outside that order: its tail is replaced by
nothing and it has likeness 0 to a next document.

At scale: ``with_fingerprints`` is one pass without a shuffle. ``with_edited``
shuffles every text once, into ranges of ids cut at quantiles (several per
shuffle partition); the first row of each range is also sent to the range
before it, so the successor of every row is the next row of its range. Only the
range bounds and first ids pass through the driver.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from trip_star.llm.common import annotate, partitions, rolling, sliced, winnow

GRAM = 16
WINDOW = 48
FINE = {"gram": 8, "window": 16}  # of the query: near copies of short texts share entries too
RANGES = 8


def fingerprint(text: str | None, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Chosen hashes (32 bits each) in text order, and their positions."""
    points = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    if not len(points):
        return np.empty(0, dtype=np.uint32), np.empty(0, dtype=np.int64)
    hashes = (rolling(points, min(gram, len(points))) >> np.uint64(32)).astype(np.uint32)
    at = winnow(hashes, window)
    return hashes[at], at


def as_text(hashes: np.ndarray) -> str:
    return hashes.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """``a``, ``b``: distinct hashes."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    either = len(a) + len(b) - both
    return both / either if either else 1.0


def with_fingerprints(docs: DataFrame, text_col: str = "text", gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """``docs`` plus ``fingerprint`` (8 hex digits per entry) and ``positions``."""

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        found = [fingerprint(t, gram, window) for t in batch.column(batch.schema.get_field_index(text_col)).to_pylist()]
        return [
            pa.array([as_text(h) for h, _ in found], pa.string()),
            pa.array([p.astype(np.int32) for _, p in found], pa.list_(pa.int32())),
        ]

    return annotate(docs, run, [StructField("fingerprint", StringType()), StructField("positions", ArrayType(IntegerType()))])


def _compare_with_next(gram: int, window: int, names: list[str]):
    """Over rows (range, sentinel, id, text) in order, each followed by its successor."""

    def run(batches):
        held = None  # the row before: range, sentinel, id, text, hashes, distinct hashes
        out: list[tuple] = []

        def close(row, following) -> None:
            _, sentinel, key, text, hashes, distinct = row
            if sentinel:
                return
            n = len(text)
            tail = n // 4
            edited = text[: n - tail] + (following[3][:tail] if following else "")
            other, _ = fingerprint(edited, gram, window)
            out.append((
                key, n, hashlib.sha256(edited.encode()).hexdigest(), as_text(hashes), as_text(other),
                likeness(distinct, np.unique(other)), likeness(distinct, following[5]) if following else 0.0,
            ))

        def flush(id_type):
            columns = list(zip(*out, strict=True)) if out else [[]] * len(names)
            types = [id_type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        id_type = pa.int64()
        for batch in sliced(batches):
            id_type = batch.column(2).type
            for part, sentinel, key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                hashes, _ = fingerprint(text, gram, window)
                row = (part, sentinel, key, text or "", hashes, np.unique(hashes))
                if held:
                    close(held, row if held[0] == part and part >= 0 else None)
                held = row
            yield flush(id_type)
        if held:
            close(held, None)
        yield flush(id_type)

    return run


def with_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """One row per document: id, ``n_chars``, the fingerprints of its text and of
    its edited text (the last quarter replaced by the start of the next
    document), and their likeness, also to the next document. Ids are numbers."""
    spark = docs.sparkSession
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    n = partitions(spark)
    m = max(n, min(RANGES * n, 4096))  # several ranges a task, so that their sizes even out
    cuts = narrow.select(F.col("id").cast("double").alias("id")).approxQuantile("id", [i / m for i in range(1, m)], 0.2 / m)
    bounds = np.unique(np.array(cuts, dtype=np.float64))

    def ranges(batch: pa.RecordBatch) -> list[pa.Array]:
        ids = batch.column(0)
        known = np.asarray(ids.is_valid())
        part = np.searchsorted(bounds, np.array(ids.fill_null(0).to_pylist(), dtype=np.float64), side="right")
        return [pa.array(np.where(known, part, -1), pa.int32())]

    dealt = annotate(narrow, ranges, [StructField("part", IntegerType())])
    first_of = annotate(narrow.select("id"), ranges, [StructField("part", IntegerType())]).filter("part >= 0").groupBy("part").agg(F.min("id"))
    firsts = sorted(tuple(r) for r in first_of.collect())  # a row per range
    # the first row of a range is a sentinel of the range before; the very first, of the last range:
    # one row per range, which bounds the broadcast
    sentinels = [(first, firsts[i - 1][0]) for i, (_, first) in enumerate(firsts)]
    also = F.broadcast(spark.createDataFrame(sentinels, StructType([StructField("first", narrow.schema["id"].dataType), StructField("before", IntegerType())])))
    copies = narrow.join(also, F.col("id") == F.col("first")).select(F.col("before").alias("part"), F.lit(1).alias("sentinel"), "id", "text")
    dealt = dealt.select("part", F.lit(0).alias("sentinel"), "id", "text").unionByName(copies)
    names = [id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [docs.schema[id_col].dataType, LongType(), StringType(), StringType(), StringType(), DoubleType(), DoubleType()]
    return (
        dealt.repartition(n, "part")
        .sortWithinPartitions("part", "sentinel", "id", "text")
        .mapInArrow(_compare_with_next(gram, window, names), StructType([StructField(a, b) for a, b in zip(names, kinds, strict=True)]))
    )


def query(spark, sf_dir: str) -> DataFrame:
    return with_edited(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), **FINE)
