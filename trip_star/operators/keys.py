"""Surrogate keys numbered by first appearance.

A dimension id is the 0-based rank of a key's first position in the input:
``drop_duplicates().reset_index()`` on an ordered frame. Spark frames have no
order, so the position is a column (``row_pos``) and the id becomes

1. one hash aggregate: ``min(position)`` (and a row count) per key, with
   map-side partial aggregation, so a hot key costs nothing extra. Its result
   is checkpointed, so the input is scanned and shuffled once; the same job
   counts the keys. Several sets of few keys share one scan (grouping sets);
2. a dense number in the order (first position, key). Up to ``SMALL_KEYS`` keys
   are sorted in one partition. More are range-partitioned by that order and
   sorted inside each partition, numbered there, and shifted by the running
   total of the partition sizes. Sparse, repeated or constant positions make no
   difference: partitions are cut by the number of keys. The offset table has
   one row per partition.

The ids do not depend on partitioning, file splits or task order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from trip_star.schemas import ROW_POS
from trip_star.session import ensure_checkpoint_dir, shuffle_partitions

FIRST = "__first"
ROWS = "__rows"
_PLACE = "__place"
_SET = "__set"

# Keys that one task may sort to number them (under ~100 bytes each).
SMALL_KEYS = 200_000

# Keys per numbering partition that are aimed at beyond the shuffle partitions.
DEFAULT_BUCKET_ROWS = 1 << 22
_ROW_BITS = 33  # monotonically_increasing_id: partition above, row in the partition below


def key_order(keys: Sequence[str]) -> list[Column]:
    """Tie order on the natural key; nulls first in every engine we compare with."""
    return [F.col(k).asc_nulls_first() for k in keys]


def first_seen_index(
    df: DataFrame, keys: Sequence[str], order_col: str = ROW_POS, counts: bool = False
) -> DataFrame:
    """One row per distinct key: the key, its first position and (optionally) its row count."""
    aggs = [F.min(order_col).alias(FIRST)]
    if counts:
        aggs.append(F.count(F.lit(1)).alias(ROWS))
    return df.groupBy(*keys).agg(*aggs)


def counted_checkpoint(df: DataFrame) -> tuple[DataFrame, int]:
    """``df`` computed once into the reliable checkpoint folder, and its rows,
    counted by that same job."""
    ensure_checkpoint_dir(df.sparkSession)
    seen = Observation()
    kept = df.observe(seen, F.count(F.lit(1)).alias("n")).checkpoint(eager=True)
    return kept, seen.get["n"] or 0


def number_checkpointed(
    index: DataFrame, n_keys: int, keys: Sequence[str], id_col: str, bucket_rows: int = DEFAULT_BUCKET_ROWS, small_rows: int | None = None
) -> DataFrame:
    """Dense 0-based id in ``(first position, key)`` order for a checkpointed index of ``n_keys`` rows.

    Up to ``small_rows`` keys are sorted in one partition, where the row number is
    the id; more are numbered by ranges, which are drawn from a sample, so those
    rows are checkpointed again. Both give the same ids."""
    if bucket_rows < 1:
        raise ValueError("bucket_rows must be positive")
    spark = index.sparkSession
    order = [F.col(FIRST).asc(), *key_order(keys)]
    if n_keys <= (SMALL_KEYS if small_rows is None else small_rows):
        return index.coalesce(1).sortWithinPartitions(*order).withColumn(id_col, F.monotonically_increasing_id())
    n = max(shuffle_partitions(spark), -(-n_keys // bucket_rows))
    placed = (
        index.repartitionByRange(n, *order).sortWithinPartitions(*order)
        .withColumn(_PLACE, F.monotonically_increasing_id()).checkpoint(eager=True)
    )
    part = F.shiftright(_PLACE, _ROW_BITS)
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__size"))
        .select("__part", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__offset"))
    )
    row = F.col(_PLACE).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        placed.join(F.broadcast(offsets), part == F.col("__part"))  # at most n rows
        .withColumn(id_col, (F.col("__offset") + row).cast("long"))
        .drop(_PLACE, "__part", "__offset")
    )


def number_first_seen(
    index: DataFrame, keys: Sequence[str], id_col: str, bucket_rows: int = DEFAULT_BUCKET_ROWS, small_rows: int | None = None
) -> DataFrame:
    """Dense 0-based id in ``(first position, key)`` order; ``index`` is computed once."""
    return number_checkpointed(*counted_checkpoint(index), keys, id_col, bucket_rows, small_rows)


def first_seen_by_sets(
    df: DataFrame, key_sets: Mapping[str, Sequence[str]], order_col: str = ROW_POS
) -> tuple[dict[str, DataFrame], dict[str, int]]:
    """The indexes of several key sets (with row counts) from one scan of ``df``:
    an aggregate over grouping sets, checkpointed once and split by set.

    Returns the index and the number of keys of every set. Meant for sets of few
    keys: every row enters the aggregate once per set, and combines on the map side.
    """
    columns = list(dict.fromkeys(c for keys in key_sets.values() for c in keys))
    sets = [[F.col(c) for c in keys] for keys in key_sets.values()]
    grouped = df.select(order_col, *columns).groupingSets(sets, *columns).agg(
        F.grouping_id().alias(_SET), F.min(order_col).alias(FIRST), F.count(F.lit(1)).alias(ROWS)
    )
    absent = {name: sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in keys) for name, keys in key_sets.items()}
    if len(set(absent.values())) < len(absent):
        raise ValueError("two key sets have the same columns")
    ensure_checkpoint_dir(df.sparkSession)
    seen = Observation()
    sizes = [F.count_if(F.col(_SET) == mark).alias(name) for name, mark in absent.items()]
    kept = grouped.observe(seen, *sizes).checkpoint(eager=True)
    indexes = {name: kept.filter(F.col(_SET) == mark).select(*key_sets[name], FIRST, ROWS) for name, mark in absent.items()}
    return indexes, {name: seen.get[name] or 0 for name in absent}


def first_seen_ids(
    df: DataFrame,
    keys: Sequence[str],
    id_col: str,
    order_col: str = ROW_POS,
    bucket_rows: int = DEFAULT_BUCKET_ROWS,
    counts: bool = False,
    keep_first: bool = False,
    small_rows: int | None = None,
) -> DataFrame:
    """Distinct ``keys`` (one or several columns) with their first-seen id.

    Missing equals missing: null keys form one group. ``order_col`` must be an
    integer position; when it is not unique, ties are broken by the key.
    """
    index = first_seen_index(df, keys, order_col, counts)
    out = number_first_seen(index, keys, id_col, bucket_rows, small_rows)
    return out if keep_first else out.drop(FIRST)


def row_id(df: DataFrame, id_col: str = "event_id", pos_col: str = ROW_POS) -> DataFrame:
    """Fact row id = input position (joins to unique keys never fan out)."""
    return df.withColumn(id_col, F.col(pos_col).cast("long"))
