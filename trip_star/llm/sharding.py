"""Sharding by balanced label propagation.

Documents of equal text (``link_col`` of the rows made by ``linked_rows``) are
linked. They start on shards drawn from a hash, so shards start even and groups
scattered. Documents of one group on one shard are interchangeable: they are a
cell (group, shard, number of documents), and a round is joins and aggregates over
cells. In each round

* every group wishes to gather on the shard, among those that have room, where
  most of it is already (ties: by a hash of group and shard), and its other cells
  ask to move there; a group that needs k shards gathers on the k that hold most of
  it. The gain of a move is the number of links it mends;
* the wishes are counted per (from, to, gain) - a small table - and quotas are
  set so that no shard ends over its capacity, counting what leaves it. The
  largest gains go first; where a quota cuts a gain level, groups drawn by a hash
  go, and of a cell that is large against a shard a part goes;
* the moves are applied by one aggregate over cells.

Rounds end when two of them move next to nothing. Then one law holds exactly, ``rows``:
a shard has floor(n / shards) places, n modulo shards shards one more. The
documents of a shard's cells take its places in order, the largest cells first;
those beyond them and all unlinked documents fill the places that are left in all
shards. Places are the slots, gapless from 0.

Edge cases: a null text counts as empty (size 1, crc32 0) and is linked with empty
ones; rows without id and repeated rows are placed like any other; a group of
more documents than a shard has places spans several shards; fewer documents than
shards leave shards empty; an empty table gives an empty result. Only the id and
the text are read. The number of a row is drawn once and written, so that a repeated
task places it alike.

At scale: texts are read once and leave (id, size, crc, SHA-256). Cells are at most
``shards`` rows per group of copies, however large the group; the quotas are at most
shards * shards * 64 counts. Each row is shuffled for the count of its group, to
meet its cells (the largest groups by broadcast) and once to be numbered, which
is done by ranges (``numbering``), never in one task.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trip_star.llm.common import HOT_KEYS, HOT_ROWS, materialise
from trip_star.llm.numbering import running_total

SHARDS = 16
ROUNDS = 8
LAW = "rows"
LARGE_CELL = 8  # a cell of more than 1 / LARGE_CELL of a shard may be split by a quota
SETTLED = 0.002  # two rounds that move a smaller share of the linked documents are the last


def linked_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row`` (any number, one per row), ``doc``, ``size``, ``crc`` and ``link`` (equal for equal texts)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("crc"),
        F.unhex(F.sha2(text, 256)).alias("link"),
    )
    return materialise(rows.withColumn("row", F.monotonically_increasing_id()), "shard-rows")


def start_cells(rows: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(link, shard, n) of the groups of several documents, scattered by a hash of the row."""
    cells = rows.groupBy("link", F.pmod(F.xxhash64("row", "link"), F.lit(shards)).cast("int").alias("shard")).agg(F.count(F.lit(1)).alias("n"))
    groups = cells.groupBy("link").agg(F.collect_list(F.struct("shard", "n")).alias("cells"), F.sum("n").alias("total"))  # at most ``shards`` cells
    return groups.filter("total > 1").select("link", F.explode("cells").alias("c")).select("link", "c.shard", "c.n")


def _loads(cells: DataFrame, shards: int) -> np.ndarray:
    out = np.zeros(shards, dtype=np.int64)
    for shard, n in cells.groupBy("shard").agg(F.sum("n")).collect():  # a row per shard
        out[shard] = n
    return out


def _pick(values, at: str | Column) -> Column:
    """The literal ``values`` by position."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.col(at) if isinstance(at, str) else at) + 1)


def wishes(cells: DataFrame, room: np.ndarray, capacity: int) -> DataFrame:
    """(link, shard, to, n, level): cells that ask to move, how many of their
    documents where, and the level of the gain."""
    most = Window.partitionBy("link").orderBy(F.col("n").desc(), F.xxhash64("link", "shard"), "shard")  # at most ``shards`` rows
    all_of_it = Window.partitionBy("link")
    open_ = F.lit(room.tolist()).cast("array<bigint>")
    space = F.element_at(open_, F.col("shard") + 1)
    ranked = cells.withColumns({"needs": F.ceil(F.sum("n").over(all_of_it) / F.lit(capacity)), "place": F.row_number().over(most), "space": space})
    # a group that fits a shard aims at its fullest open one; a larger one at the open ones among as many as it needs
    ranked = ranked.withColumn("turn", F.row_number().over(Window.partitionBy("link").orderBy(F.col("space") <= 0, "place")))
    aimed = (F.col("space") > 0) & F.when(F.col("needs") == 1, F.col("turn") == 1).otherwise(F.col("place") <= F.col("needs"))
    stays = aimed | ((F.col("needs") > 1) & (F.col("place") <= F.col("needs")))
    ranked = ranked.withColumns({"aimed": aimed, "stays": stays})
    aims = ranked.filter("aimed").select(
        "link", F.col("shard").alias("to"), F.col("n").alias("there"), "space",
        F.sum("space").over(all_of_it).alias("spaces"),
        F.sum("space").over(all_of_it.orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)).alias("upto"),
    )
    moving = ranked.filter(~F.col("stays")).select("link", "shard", "n").join(aims, "link")
    # a cell spreads over the aims as they have room: its documents are cut where the running room is
    until = lambda x: F.floor(F.col("n") * (x / F.col("spaces")))
    part = until(F.col("upto")) - until(F.col("upto") - F.col("space"))
    gain = F.greatest(F.col("there") - F.col("n") + 1, F.lit(1))  # links mended less links cut, for one document
    return moving.select("link", "shard", "to", part.cast("long").alias("n"), F.floor(F.log2(gain)).cast("int").alias("level")).filter("n > 0")


def quotas(wanted: dict[tuple[int, int, int], int], loads: np.ndarray, capacity: int) -> dict[tuple[int, int, int], float]:
    """Shares of the wished moves (from, to, level) that may go: no shard gets over
    ``capacity`` (or, if it is over already, gains anything), high levels first."""
    shards = len(loads)
    asked = np.zeros((shards, shards))
    for (a, b, _), n in wanted.items():
        asked[a, b] += n
    flow = asked.copy()
    for _ in range(1000):  # what comes in shrinks until it fits beside what leaves
        after = loads + flow.sum(0) - flow.sum(1)
        over = (after > np.maximum(capacity, loads)) & (flow.sum(0) > 0)
        if not over.any():
            break
        room = np.maximum(0, np.maximum(capacity, loads) - loads + flow.sum(1))
        incoming = flow.sum(0)
        flow[:, over] *= np.minimum(1, room[over] / incoming[over])
        flow[flow < 1e-6] = 0
    left = flow.copy()
    out = {}
    for a, b, level in sorted(wanted, key=lambda k: -k[2]):
        n = wanted[a, b, level]
        take = min(n, left[a, b])
        left[a, b] -= take
        if take > 0:
            out[a, b, level] = take / n
    return out


def gather(cells: DataFrame, n_rows: int, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """The cells after label propagation; every other round full shards are aimed
    at, too, as others may leave them in that round."""
    spark = cells.sparkSession
    capacity = -(-n_rows // shards)
    cells = materialise(cells, "cells")
    moved = [np.inf, np.inf]
    for turn in range(rounds):
        loads = _loads(cells, shards)
        if sum(moved[-2:]) <= SETTLED * loads.sum():
            break
        room = np.maximum(turn % 2, capacity - loads)
        asking = materialise(wishes(cells, room, capacity), "wishes")
        counted = asking.groupBy("shard", "to", "level").agg(F.sum("n")).collect()  # at most shards * shards * 64
        wanted = {(a, b, v): n for a, b, v, n in counted}
        allowed = quotas(wanted, loads, capacity)
        moved.append(sum(share * wanted[k] for k, share in allowed.items()))
        if not allowed:
            continue
        share = spark.createDataFrame([(*k, float(x)) for k, x in allowed.items()], "shard int, to int, level int, share double")
        drawn = lambda *of: F.pmod(F.xxhash64(*of, F.lit(turn)), F.lit(1 << 20)) / float(1 << 20)  # noqa: E731, B023
        split = F.least(F.col("n"), F.floor(F.col("n") * F.col("share") + drawn("link", "shard", "to")))
        together = F.when(drawn("link") < F.col("share"), F.col("n")).otherwise(0)
        part = F.when(F.col("n") * LARGE_CELL > capacity, split).otherwise(together)
        moves = asking.join(F.broadcast(share), ["shard", "to", "level"]).select("link", "shard", "to", part.cast("long").alias("n"))
        changed = cells.unionByName(moves.select("link", F.col("to").alias("shard"), "n")).unionByName(moves.select("link", "shard", (-F.col("n")).alias("n")))
        cells = materialise(changed.groupBy("link", "shard").agg(F.sum("n").alias("n")).filter("n > 0"), "cells")
    return cells


def place(rows: DataFrame, cells: DataFrame, n_rows: int, shards: int = SHARDS) -> DataFrame:
    """``rows`` plus ``shard`` and ``slot``; every shard gets floor or ceil of n_rows / shards rows."""
    loads = _loads(cells, shards)
    spare = np.argsort(-loads, kind="stable")[: n_rows % shards]  # the extra places go where they are needed
    places = np.full(shards, n_rows // shards, dtype=np.int64)
    places[spare] += 1
    before = np.concatenate(([0], np.cumsum(loads)[:-1]))
    kept = np.minimum(loads, places)
    over = np.concatenate(([0], np.cumsum(loads - kept)))  # linked rows beyond the places, by shard
    free = np.concatenate(([0], np.cumsum(places - kept)))  # places they and the unlinked rows fill

    at = running_total(cells, [F.col("shard"), F.col("n").desc(), F.col("link")], F.col("n"), "at")
    within = Window.partitionBy("link").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # at most ``shards`` rows
    cell = at.select(
        "link", "n", F.struct(F.coalesce(F.sum("n").over(within), F.lit(0)).alias("since"), "shard", (F.col("at") - _pick(before.tolist(), "shard")).alias("slot")).alias("cell")
    )
    groups = cell.groupBy("link").agg(F.sum("n").alias("total"), F.array_sort(F.collect_list("cell")).alias("cells"))
    groups = materialise(running_total(groups, [F.col("link")], F.col("total"), "start"), "groups")
    limit = max(HOT_ROWS, n_rows // HOT_KEYS)
    hot = F.broadcast(groups.filter(F.col("total") > limit))  # at most HOT_KEYS groups
    rest = rows.join(hot.select("link"), "link", "left_anti").join(groups.filter(F.col("total") <= limit), "link", "left")
    tagged = rows.join(hot, "link").unionByName(rest)
    order = [F.col("start").isNull(), F.col("link"), F.col("doc"), F.col("row")]
    numbered = running_total(tagged, order, F.lit(1), "at")

    index = F.col("at") - F.col("start")
    own = F.element_at(F.filter("cells", lambda c: c["since"] <= index), -1)
    found = numbered.withColumn("own", own).withColumn("turn", F.col("own.slot") + index - F.col("own.since"))
    linked = int(loads.sum())
    beyond = F.when(F.col("own").isNull(), F.col("at") - F.lit(linked) + F.lit(int(over[-1]))).when(
        F.col("turn") >= _pick(places.tolist(), "own.shard"), _pick(over[:-1].tolist(), "own.shard") + F.col("turn") - _pick(places.tolist(), "own.shard")
    )
    # the shard whose free places hold that number
    filled = F.size(F.filter(F.array(*[F.lit(int(x)) for x in free[1:]]), lambda x: x <= F.col("beyond")))
    return (
        found.withColumn("beyond", beyond)
        .withColumn("shard", F.when(F.col("beyond").isNull(), F.col("own.shard")).otherwise(filled).cast("int"))
        .withColumn(
            "slot",
            F.when(F.col("beyond").isNull(), F.col("turn"))
            .otherwise(_pick(kept.tolist(), "shard") + F.col("beyond") - _pick(free[:-1].tolist(), "shard"))
            .cast("long"),
        )
        .select(*rows.columns, "shard", "slot")
    )


def assign(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """(row, doc, size, crc, link, shard, slot) per row of ``docs``."""
    rows = linked_rows(docs, id_col, text_col)
    n_rows = rows.count()
    return place(rows, gather(start_cells(rows, shards), n_rows, shards, rounds), n_rows, shards)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return assign(docs).select(
        F.col("doc").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), F.lit(LAW).alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
