"""Left equi-joins where missing equals missing, with a skew-safe variant.

Every join of the reference is a left merge on one or more keys in which a
missing key matches a missing key. Spark's ``<=>`` keeps such joins hash joins
(the planner hashes ``coalesce(k, default), isnull(k)``).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trip_star.operators.keys import ROWS
from trip_star.session import shuffle_partitions

# A key is "hot" when it alone covers at least HOT_MIN_ROWS rows and at least
# 1 / HOT_MAX_KEYS of all rows. The per-key counts sum to the row total, so at
# most HOT_MAX_KEYS keys can qualify: that is the bound on the broadcast side.
HOT_MIN_ROWS = 100_000
HOT_MAX_KEYS = 10_000


def null_safe_equal(left: Sequence[str], right: Sequence[str]) -> Column:
    pairs = [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right, strict=True)]
    return reduce(lambda x, y: x & y, pairs)


def hot_keys(
    dim: DataFrame,
    keys: Sequence[str],
    id_col: str,
    min_rows: int = HOT_MIN_ROWS,
    max_keys: int = HOT_MAX_KEYS,
    rows_col: str = ROWS,
    carry: Sequence[str] = (),
) -> DataFrame:
    """The heavy keys of a frame that carries per-key row counts (``rows_col``).

    A key qualifies with at least ``min_rows`` rows and at least
    ``1 / max_keys`` of the total (a scalar subquery over the same counts);
    since the counts sum to the total, at most ``max_keys`` keys qualify and
    the result may be broadcast. No cap is applied: every other key is joined
    exactly through the shuffled path.
    """
    total = dim.select(F.sum(rows_col)).scalar()
    threshold = F.greatest(F.lit(min_rows), F.ceil(total / F.lit(max_keys)))
    return dim.filter(F.col(rows_col) >= threshold).select(*keys, id_col, *carry)


def attach_id(
    fact: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    id_col: str,
    *,
    dim_keys: Sequence[str] | None = None,
    carry: Sequence[str] = (),
    hot: DataFrame | None = None,
    spread_col: str | None = None,
    salts: int | None = None,
    broadcast_dim: bool = False,
    nonnegative_ids: bool = False,
) -> DataFrame:
    """Left-join ``fact`` to ``dim`` on ``keys`` (null-safe), adding ``id_col``.

    ``dim_keys`` names the keys on the dimension side when they differ, and
    ``carry`` lists further dimension columns to bring along. ``broadcast_dim``
    must only be set by a caller that has checked the dimension's size.

    With ``hot`` (a bounded frame of the hot keys with their ids and
    ``carry`` columns) the join is skew-safe: hot rows take their values from a
    broadcast of ``hot`` and are given a salt that spreads them over ``salts``
    shuffle partitions (and matches nothing); every other row is shuffled with
    salt 0 and joined to the dimension on ``keys + salt``. ``nonnegative_ids``
    (ids from the first-seen numbering) lets the dimension side derive its
    salt 0 from the id itself instead of from a lookup of the hot set.
    """
    dim_keys = list(dim_keys or keys)
    tmp = [f"__dk{i}" for i in range(len(keys))]
    d = dim.select(
        *[F.col(c).alias(t) for c, t in zip(dim_keys, tmp, strict=True)],
        F.col(id_col),
        *[F.col(c) for c in carry],
    )
    on = null_safe_equal(keys, tmp)
    if hot is None:
        if broadcast_dim:
            d = F.broadcast(d)
        return fact.join(d, on, "left").drop(*tmp)
    htmp = [f"__hk{i}" for i in range(len(keys))]
    hcarry = [f"__hc{i}" for i in range(len(carry))]
    h = F.broadcast(
        hot.select(
            *[F.col(c).alias(t) for c, t in zip(dim_keys, htmp, strict=True)],
            F.col(id_col).alias("__hot_id"),
            *[F.col(c).alias(t) for c, t in zip(carry, hcarry, strict=True)],
        )
    )
    n = salts or max(shuffle_partitions(fact.sparkSession), 2)
    spread = F.xxhash64(F.col(spread_col)) if spread_col else F.xxhash64(*[F.col(c) for c in fact.columns])
    f = (
        fact.join(h, null_safe_equal(keys, htmp), "left")
        .drop(*htmp)
        .withColumn(
            "__salt",
            F.when(F.col("__hot_id").isNull(), F.lit(0)).otherwise(F.pmod(spread, F.lit(n)) + F.lit(1)),
        )
    )
    # Dimension side: salt 0 for ordinary keys and -1 for hot ones (served by
    # the broadcast; no fact row carries -1). The salt comes from a lookup of
    # the hot set, i.e. from the data: a literal 0 would be folded by the
    # optimizer into a filter and the salt would drop out of the shuffle keys.
    if nonnegative_ids:
        d = d.withColumn("__dsalt", (F.col(id_col) < F.lit(0)).cast("long"))  # 0, from the data
    else:
        marks = h.select(*[F.col(t).alias(f"__m{i}") for i, t in enumerate(htmp)], F.lit(-1).alias("__mark"))
        d = (
            d.join(marks, null_safe_equal(tmp, [f"__m{i}" for i in range(len(keys))]), "left")
            .withColumn("__dsalt", F.coalesce(F.col("__mark"), F.lit(0)).cast("long"))
            .drop(*[f"__m{i}" for i in range(len(keys))], "__mark")
        )
    joined = f.join(d, on & (F.col("__salt") == F.col("__dsalt")), "left")
    is_hot = F.col("__hot_id").isNotNull()
    joined = joined.withColumns(
        {
            id_col: F.coalesce(F.col("__hot_id"), F.col(id_col)),
            **{c: F.when(is_hot, F.col(t)).otherwise(F.col(c)) for c, t in zip(carry, hcarry, strict=True)},
        }
    )
    return joined.drop(*tmp, *hcarry, "__hot_id", "__salt", "__dsalt")


def lookup_columns(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    columns: Sequence[str],
    *,
    broadcast: bool = False,
    hot_min_rows: int = HOT_MIN_ROWS,
    hot_max_keys: int = HOT_MAX_KEYS,
    spread_col: str | None = None,
    salts: int | None = None,
    freq: DataFrame | None = None,
) -> DataFrame:
    """Left-join ``columns`` of ``dim`` onto ``fact`` by a non-negative id ``key``
    that is unique in ``dim`` (a star lookup such as fact -> dimension by id).

    ``broadcast`` is for a caller that has checked the dimension's size;
    ``freq`` (``key``, ``__rows``) for one that knows the fact's row counts, so
    that ``fact`` is not computed once more to find them. Otherwise the join is skew-safe: the hot ids are the fact's heavy ones (a
    partial-aggregated count; at most ``hot_max_keys`` can qualify), looked up
    in the dimension through a broadcast of that bounded set, and their rows
    are salted across the shuffle.
    """
    d = dim.select(key, F.col(key).alias("__lookup_id"), *columns)
    if broadcast:
        return fact.join(F.broadcast(d.drop("__lookup_id")), key, "left")
    if freq is None:
        freq = fact.groupBy(key).agg(F.count(F.lit(1)).alias(ROWS))
    hot_ids = hot_keys(freq, [key], key, hot_min_rows, hot_max_keys)
    hot = d.join(F.broadcast(hot_ids), key, "left_semi")
    out = attach_id(
        fact, d, [key], "__lookup_id", carry=columns, hot=hot, spread_col=spread_col, salts=salts,
        nonnegative_ids=True,
    )
    return out.drop("__lookup_id")
