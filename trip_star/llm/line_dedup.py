"""Line dedup: explode normalised lines, hash, count distinct documents per
hash, drop lines over the threshold, reassemble by position.

A text is split at every newline (null or empty text: one empty line). A
line's key is the line without ASCII white space at both ends, A-Z
lower-cased. Keys of at least ``min_chars`` code points that occur in at least
``min_docs`` distinct documents lose all their lines, except in the document
with the largest id that holds the key.

Edge cases: rows that share an id count as one document; a row without an id
is no document (its lines are neither counted nor dropped); repeated rows get
the same result each; an empty table gives an empty result; further columns
pass through, ones named like a result column are replaced.

At scale: keys travel as 128-bit hashes, the count per key is partially
aggregated before every shuffle (a line that a third of all documents hold
collapses on the map side), the frequent keys are broadcast only when their
count is under ``BROADCAST_KEYS`` (24 bytes each); else those of very many lines
(at most 10,000) are broadcast and the others joined in a shuffle. A
document's text is shuffled once, to meet the positions of its dropped lines.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from trip_star.llm.common import SPACE, annotate, lookup, materialise, process_cache, sliced, text_key

MIN_CHARS = 40
MIN_DOCS = 5
BROADCAST_KEYS = 200_000


def line_keys(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """One row per line long enough to count: id, text key, position, key hash."""
    narrow = docs.filter(F.col(id_col).isNotNull() & (F.char_length(text_col) >= min_chars)).select(
        F.col(id_col).alias("id"), text_key(text_col).alias("tk"), F.col(text_col).alias("text")
    )
    schema = StructType(
        [
            StructField("id", docs.schema[id_col].dataType),
            StructField("tk", LongType()),
            StructField("pos", IntegerType()),
            StructField("key", BinaryType()),
        ]
    )

    def run(batches):
        process_cache("")
        for batch in sliced(batches):
            at, pos, keys = [], [], []
            for row, text in enumerate(batch.column(2).to_pylist()):
                for i, line in enumerate(text.split("\n")):
                    if len(line) >= min_chars and len(key := line.strip(SPACE)) >= min_chars:
                        at.append(row)
                        pos.append(i)
                        keys.append(xxhash.xxh3_128_digest(key.encode().lower()))
            take = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array(pos, pa.int32()), pa.array(keys, pa.binary())],
                names=["id", "tk", "pos", "key"],
            )

    return narrow.mapInArrow(run, schema)


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    drop_text: bool = False,
) -> DataFrame:
    """``docs`` with ``text`` replaced by what is left (null stays null), plus
    ``n_lines``, ``n_dropped`` and ``kept_sha256`` of the kept text.
    ``drop_text`` leaves the text out of the result."""
    lines = line_keys(docs, id_col, text_col, min_chars)
    frequent = materialise(
        lines.groupBy("key")
        .agg(F.count_distinct("id").alias("n_docs"), F.max("id").alias("last_id"), F.count(F.lit(1)).alias("n_lines"))
        .filter(F.col("n_docs") >= min_docs)
        .select("key", "last_id", "n_lines"),
        "frequent-lines",
    )
    n_keys, n_rows = frequent.agg(F.count(F.lit(1)), F.sum("n_lines")).first()
    if n_keys <= BROADCAST_KEYS:
        repeated = lines.join(F.broadcast(frequent.drop("n_lines")), "key")
    else:
        repeated = lookup(materialise(lines, "line-keys"), frequent, "key", "n_lines", n_rows or 0)
    dropped = (
        repeated.filter(F.col("id") != F.col("last_id"))
        .groupBy(F.col("id").alias("__ld_id"), F.col("tk").alias("__ld_tk"))
        .agg(F.collect_set("pos").alias("__ld_pos"))
    )
    on = (F.col(id_col) == F.col("__ld_id")) & (F.col("__ld_key") == F.col("__ld_tk"))
    joined = docs.withColumn("__ld_key", text_key(text_col)).join(dropped, on, "left")

    def keep(batch: pa.RecordBatch) -> list[pa.Array]:
        texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
        drops = batch.column(batch.schema.get_field_index("__ld_pos")).to_pylist()
        kept, n_lines, n_dropped, digest = [], [], [], []
        for text, drop in zip(texts, drops, strict=True):
            lines = (text or "").split("\n")
            gone = set(drop or ())
            left = text if not gone else "\n".join(x for i, x in enumerate(lines) if i not in gone)
            kept.append(left)
            n_lines.append(len(lines))
            n_dropped.append(len(gone))
            digest.append(hashlib.sha256((left or "").encode()).hexdigest())
        out = [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(digest, pa.string())]
        return out if drop_text else [pa.array(kept, pa.string()), *out]

    fields = [StructField("n_lines", LongType()), StructField("n_dropped", LongType()), StructField("kept_sha256", StringType())]
    if not drop_text:
        fields.insert(0, StructField(text_col, StringType()))
    return annotate(joined, keep, fields, drop=["__ld_id", "__ld_tk", "__ld_key", "__ld_pos", *([text_col] if drop_text else [])])


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs, drop_text=True)


SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(generate_series(1, len(l))) AS pos, unnest(l) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
),
frequent AS (
  SELECT k, max(doc_id) AS last_id FROM keyed
  WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5
),
judged AS (
  SELECT keyed.*, (f.k IS NOT NULL AND doc_id <> f.last_id) AS gone
  FROM keyed LEFT JOIN frequent f ON keyed.k = f.k
)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (gone))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
