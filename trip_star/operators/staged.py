"""First-seen ids and their join from one exchange of the rows.

The key aggregate and the join back of ``keys.py`` and ``joins.py`` each shuffle the
rows. For key sets of nearly as many keys as rows the map-side combine saves
nothing, so here the rows are exchanged once, into a staging table bucketed by the
hash of the key, and both the aggregate and the join read those buckets as they lie:

1. ``heavy_hashes`` finds the keys that hold a large share of the rows, exactly and
   without moving the keys: rows are counted per one of 65,536 parts of the hash
   range, and keys only inside the parts that are heavy themselves;
2. ``stage_by_key`` writes the rows in buckets of (hash, salt). The salt is 0, and
   for heavy keys spreads the rows over all buckets;
3. ``staged_index`` aggregates inside the buckets; only the partial rows of heavy
   keys (keys times salts) are shuffled once more;
4. ``attach_staged`` joins the numbered index back: the buckets stay where they are,
   the index alone is exchanged. Heavy keys come from a broadcast of at most
   ``max_keys`` rows. Hashes only route: keys are compared themselves.

Missing equals missing in every step. The staging table lies in the reliable
checkpoint folder, so a lost executor re-reads its buckets.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trip_star.operators.keys import FIRST, ROWS
from trip_star.schemas import ROW_POS
from trip_star.session import ensure_checkpoint_dir, shuffle_partitions

HASH = "__key_hash"
SALT = "__key_salt"
_HEAVY = -1  # salt of a heavy key in the index; no row carries it
_PART_BITS = 16


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def _part(of: Column) -> Column:
    return F.shiftrightunsigned(of, 64 - _PART_BITS)


def _differ(left: Sequence[str], right: Sequence[str]) -> Column:
    """Number of keys that differ. A sum, not an AND of ``<=>``: the planner would
    take those for join keys, which the buckets are not laid out by."""
    unequal = [F.when(F.col(a).eqNullSafe(F.col(b)), 0).otherwise(1) for a, b in zip(left, right, strict=True)]
    return reduce(lambda x, y: x + y, unequal)


def heavy_hashes(
    df: DataFrame, key_sets: Mapping[str, Sequence[str]], n_rows: int, min_rows: int, max_keys: int
) -> dict[str, DataFrame | None]:
    """Per key set the hashes with at least ``min_rows`` rows and 1/``max_keys`` of all
    ``n_rows`` (so at most ``max_keys``), or None if there are none."""
    spark = df.sparkSession
    least = max(min_rows, ceil(n_rows / max_keys), 1)
    hashes = df.select(*[key_hash(keys).alias(name) for name, keys in key_sets.items()])
    heavy: dict[str, DataFrame | None] = dict.fromkeys(key_sets)
    if n_rows < least:
        return heavy
    tagged = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), _part(F.col(name)).alias("part")) for name in key_sets]))
    parts = hashes.select(tagged.alias("p")).groupBy("p.name", "p.part").agg(F.count(F.lit(1)).alias(ROWS))
    found: dict[str, list[tuple[int]]] = {}
    for name, part, _ in parts.filter(F.col(ROWS) >= least).collect():  # at most max_keys per set
        found.setdefault(name, []).append((part,))
    for name, rows in found.items():
        inside = F.broadcast(spark.createDataFrame(rows, "__part long"))
        counts = hashes.select(F.col(name).alias(HASH)).join(inside, _part(F.col(HASH)) == F.col("__part"), "left_semi").groupBy(HASH)
        kept = counts.agg(F.count(F.lit(1)).alias(ROWS)).filter(F.col(ROWS) >= least).select(HASH).checkpoint(eager=True)
        heavy[name] = kept if kept.take(1) else None
    return heavy


def stage_by_key(df: DataFrame, keys: Sequence[str], heavy: DataFrame | None = None, order_col: str = ROW_POS) -> DataFrame:
    """``df`` in buckets of (hash of ``keys``, salt), with both as columns.

    The only exchange of the rows. The table's name leaves the catalog at once; its
    files stay in the checkpoint folder for the frame that is returned."""
    spark = df.sparkSession
    n = max(shuffle_partitions(spark), 2)
    hashed = df.withColumn(HASH, key_hash(keys))
    if heavy is None:
        salted = hashed.withColumn(SALT, F.lit(0))
    else:
        marked = hashed.join(F.broadcast(heavy.select(F.col(HASH).alias("__heavy"))), F.col(HASH) == F.col("__heavy"), "left")
        spread = F.pmod(F.xxhash64(F.col(order_col)), F.lit(n)).cast("int") + F.lit(1)
        salted = marked.withColumn(SALT, F.when(F.col("__heavy").isNull(), F.lit(0)).otherwise(spread)).drop("__heavy")
    name = f"__staged_{uuid.uuid4().hex}"
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}"
    writer = salted.repartition(n, HASH, SALT).write.format("parquet").option("path", path)
    writer.bucketBy(n, HASH, SALT).saveAsTable(name)
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")  # external: the files stay


def staged_index(staged: DataFrame, keys: Sequence[str], any_heavy: bool, order_col: str = ROW_POS) -> DataFrame:
    """One row per key with its first position and row count, hash and salt, from the buckets."""
    inside = [F.min(order_col).alias(FIRST), F.count(F.lit(1)).alias(ROWS)]
    if not any_heavy:
        return staged.groupBy(HASH, SALT, *keys).agg(*inside)
    ordinary = staged.filter(F.col(SALT) == 0).groupBy(HASH, SALT, *keys).agg(*inside)
    spread = staged.filter(F.col(SALT) > 0).groupBy(HASH, SALT, *keys).agg(*inside)
    merged = spread.groupBy(HASH, *keys).agg(F.min(FIRST).alias(FIRST), F.sum(ROWS).alias(ROWS))
    return ordinary.unionByName(merged.withColumn(SALT, F.lit(_HEAVY)))


def attach_staged(staged: DataFrame, index: DataFrame, keys: Sequence[str], id_col: str, any_heavy: bool) -> DataFrame:
    """The staged rows with the id of their key; hash and salt are dropped."""
    tmp = [f"__dk{i}" for i in range(len(keys))]
    dim = index.select(*[F.col(k).alias(t) for k, t in zip(keys, tmp, strict=True)], F.col(HASH).alias("__dh"), F.col(SALT).alias("__ds"), id_col)
    same = (F.col(HASH) == F.col("__dh")) & (F.col(SALT) == F.col("__ds")) & (_differ(keys, tmp) == 0)
    out = staged.join(dim, same, "left").drop(*tmp, "__dh", "__ds")
    if any_heavy:
        few = index.filter(F.col(SALT) == _HEAVY).select(
            *[F.col(k).alias(t) for k, t in zip(keys, tmp, strict=True)], F.col(HASH).alias("__dh"), F.col(id_col).alias("__heavy_id")
        )
        same = (F.col(HASH) == F.col("__dh")) & (F.col(SALT) > 0) & (_differ(keys, tmp) == 0)
        out = out.join(F.broadcast(few), same, "left").drop(*tmp, "__dh")
        out = out.withColumn(id_col, F.coalesce(F.col("__heavy_id"), F.col(id_col))).drop("__heavy_id")
    return out.drop(HASH, SALT)
