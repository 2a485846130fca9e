"""Small helpers shared by the operators of this subpackage.

Every operator reads only the columns it is told to (``id_col``, ``text_col``),
so further columns, also ones named like an operator's internal columns, never
clash. Work on whole texts runs in ``mapInArrow``: a batch of rows at a time,
no state between tasks except caches that only save time.
"""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from trip_star.session import ensure_checkpoint_dir

SPACE = " \t\n\x0b\x0c\r"
# bytes -> the same byte for 0-9, a-z and every non-ASCII byte, a-z for A-Z, else a space
WORD_BYTES = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20
    for b in range(256)
)
BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder under the session's checkpoint folder, which all executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: a lost
    executor re-reads the table instead of repeating the work above it."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def process_cache(name: str) -> dict:
    """A dict that outlives the task in its Python worker (functions are shipped
    by value, so their module globals are new in every task). There is one at a
    time: asking for another name lets go of the last one."""
    store = sys.modules.setdefault("_trip_star_llm_cache", types.ModuleType("_trip_star_llm_cache"))
    if getattr(store, "cache_name", None) != name:
        store.cache_name, store.cache = name, {}
    return store.cache


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches in smaller ones, so that few texts are Python objects at a
    time; what Arrow has set aside goes back after the last one, as the worker
    lives on beside others."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    pa.default_memory_pool().release_unused()


def raw(column: pa.Array) -> list:
    """UTF-8 bytes (or None) of a string column."""
    return column.cast(pa.binary()).to_pylist()


def annotate(
    df: DataFrame,
    fn: Callable[[pa.RecordBatch], Sequence[pa.Array]],
    fields: Sequence[StructField],
    drop: Sequence[str] = (),
    cache: str = "",
) -> DataFrame:
    """Append the arrays ``fn`` returns for each batch as columns ``fields``.

    An input column that bears the name of a new one is replaced; ``drop``
    leaves columns out of the result; ``cache`` names the process cache that
    ``fn`` uses (any other is let go)."""
    new = [f.name for f in fields]
    keep = [c for c in df.columns if c not in drop and c not in new]
    schema = StructType([df.schema[c] for c in keep] + list(fields))

    def run(batches):
        process_cache(cache)
        for batch in sliced(batches):
            arrays = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            yield pa.RecordBatch.from_arrays([*arrays, *fn(batch)], names=[*keep, *new])

    return df.mapInArrow(run, schema)


def powers(n: int, base: int = BASE) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64."""
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def rolling(symbols: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k consecutive symbols (rolling polynomial modulo 2^64, mixed)."""
    n = len(symbols) - k + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    h = np.zeros(n, dtype=np.uint64)
    if k <= 24:
        for j in range(k):
            h = h * np.uint64(BASE) + symbols[j : j + n]
        return mix(h)
    inverse = pow(BASE, -1, 1 << 64)
    prefix = np.concatenate(([np.uint64(0)], np.cumsum(symbols * powers(len(symbols)), dtype=np.uint64)))
    return mix((prefix[k:] - prefix[:-k]) * powers(n, inverse))


def winnow(grams: np.ndarray, w: int) -> np.ndarray:
    """Positions of the smallest hash of every ``w`` consecutive grams, the
    rightmost one on ties (all grams form one window if there are fewer)."""
    n = len(grams)
    if n == 0:
        return np.empty(0, dtype=np.int64)
    width = min(w, n)
    # sparse-table minimum; ``at`` is the position, later ones win ties
    low, at, span = grams, np.arange(n), 1
    while span < width:
        step = min(span, width - span)
        left, right = low[: len(low) - step], low[step:]
        take = right <= left
        at = np.where(take, at[step:], at[: len(at) - step])
        low = np.where(take, right, left)
        span += step
    return at[np.concatenate(([True], at[1:] != at[:-1]))]


def text_key(text_col: str):
    """Tells rows with the same id but other texts apart (0 for null)."""
    return F.coalesce(F.xxhash64(F.col(text_col)), F.lit(0))


HOT_ROWS = 1_000
HOT_KEYS = 10_000


def lookup(rows: DataFrame, table: DataFrame, key: str | list[str], weight: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with ``table`` (one row per value of ``key``, never null) without a hot partition. ``weight`` counts the rows of a key and
    ``total`` all rows: keys of over ``HOT_ROWS`` rows and over 1 / HOT_KEYS of
    all - at most HOT_KEYS keys - meet their rows by broadcast, the others in a
    shuffle. Both frames are read twice, so they should be materialised."""
    limit = max(HOT_ROWS, total // HOT_KEYS)
    hot = F.broadcast(table.filter(F.col(weight) > limit).drop(weight))
    rest = table.filter(F.col(weight) <= limit).drop(weight)
    return rows.join(hot, key).unionByName(rows.join(hot.select(key), key, "left_anti").join(rest, key))
