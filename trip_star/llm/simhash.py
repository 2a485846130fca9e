"""SimHash near-dedup by anchor-point covering.

The fingerprint: words ``[^\\x20\\x09-\\x0D]+`` of the A-Z lower-cased text,
shingles of ``shingle`` words (fewer words: the whole sequence), each hashed
with XXH64 (UTF-8, seed 42); a bit is 1 if set in over half of the hashes;
no words: zero.

Links (at most ``max_bits`` differing bits) are found by a covering code. The
64 bits are cut into blocks, so a linked pair differs by at most
``t = max_bits // blocks`` bits in some block. In a block of n bits the anchors
are the words of a linear code whose check matrix repeats the columns of a
Hamming code: every point lies within covering radius R = 1 of an anchor. A
fingerprint is at home at its nearest anchor and is replicated to every anchor
within R + t. If x and y differ by at most t bits there, y is present at x's
home, so comparing the homes of an anchor with all that came to it loses no
link. The number of blocks is chosen from the number of distinct
fingerprints: fewer, longer blocks copy more and compare less. Every choice is
exact.

Within an anchor links are united on the spot: a task returns each linked
fingerprint with the smallest one it is connected to there, never the pairs.
Components of those links come from star contraction on the cluster.

Edge cases: null and empty texts have fingerprint zero and link like any
other; equal texts and repeated rows share a fingerprint; a row without id is
grouped like any other but never names a component (``component_id`` is null
if no row of the component has an id); an empty table gives an empty result;
``keep_one`` returns all columns of the rows it keeps, ``near_duplicates`` the id
and its own columns only.

At scale: copies collapse to one fingerprint by a partial aggregate before
anything is compared; where anchors hold more than ``HOT_HOMES`` homes and at
least 1/10,000 of all, they and those of ``VISITORS`` times as many visitors are
split into a grid of cells, a share of the homes against a share of the
visitors (both counts bound the broadcast list of such anchors);
joins back to the documents carry (id, fingerprint) only.
"""

from __future__ import annotations

from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from trip_star.llm.common import annotate, materialise, partitions, raw
from trip_star.llm.components import connected_components

SHINGLE = 4
MAX_BITS = 4
BITS = 64
CHUNK = 1 << 16  # shingles hashed at once
HOT_HOMES = 50_000
VISITORS = 20  # a cell of a busy anchor holds this many times as many visitors as homes
HOT_COPIES = 1_000  # a fingerprint of more documents, and of over 1 / HOT_COPIES_MOST of all, is hot
HOT_COPIES_MOST = 10_000
COMPARES_PER_COPY = 200  # comparisons that cost as much as moving one copy


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    words = (text or b"").lower().split()  # of bytes: ASCII only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, 42)
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(size + 1) - 1
    first, last = (ends - size)[: len(words) - shingle + 1], ends[shingle - 1 :]
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(first), CHUNK):
        spans = zip(first[at : at + CHUNK].tolist(), last[at : at + CHUNK].tolist(), strict=True)
        h = np.array([xxhash.xxh64_intdigest(joined[a:b], 42) for a, b in spans], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8), bitorder="little").reshape(-1, BITS).sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(first), bitorder="little").view("<u8")[0])


def with_fingerprint(
    docs: DataFrame, text_col: str = "text", shingle: int = SHINGLE, drop_text: bool = False, out_col: str = "fp"
) -> DataFrame:
    """``docs`` plus ``out_col``, the fingerprint as a signed long."""

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        texts = raw(batch.column(batch.schema.get_field_index(text_col)))
        fps = np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64)
        return [pa.array(fps.view(np.int64), pa.int64())]

    return annotate(docs, run, [StructField(out_col, LongType())], drop=[text_col] if drop_text else [])


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


class BlockCode:
    """The covering code of one block of ``n`` bits: check matrix columns are
    1, 2, ..., 2^r - 1 over and over, so each syndrome is some column (R = 1)."""

    radius = 1

    def __init__(self, n: int, reach: int):
        r = (n + 1).bit_length() - 1
        columns = [1 + i % (2**r - 1) for i in range(n)]
        self.checks = [sum(1 << i for i, c in enumerate(columns) if c >> j & 1) for j in range(r)]
        # error patterns up to the reach, by syndrome, lightest first: the first one leads to the home
        self.patterns: list[list[int]] = [[] for _ in range(2**r)]
        for weight in range(reach + 1):
            for chosen in combinations(range(n), weight):
                syndrome = 0
                for i in chosen:
                    syndrome ^= columns[i]
                self.patterns[syndrome].append(sum(1 << i for i in chosen))

    def anchors(self, block: Column) -> Column:
        syndrome = F.lit(0)
        for j, check in enumerate(self.checks):
            syndrome = syndrome + (F.bit_count(block.bitwiseAND(F.lit(_signed(check)))) % 2) * (1 << j)
        table = F.lit([[_signed(e) for e in p] for p in self.patterns]).cast("array<array<bigint>>")
        return F.transform(F.element_at(table, (syndrome + 1).cast("int")), lambda e: block.bitwiseXOR(e))


def ball(n: int, radius: int) -> int:
    out, term = 0, 1
    for i in range(radius + 1):
        out += term
        term = term * (n - i) // (i + 1)
    return out


def choose_blocks(n_distinct: int, max_bits: int) -> int:
    """The cheapest number of blocks that leaves a threshold of at least one bit."""

    def cost(m: int) -> float:
        n, reach = BITS // m, BlockCode.radius + max_bits // m
        r = (n + 1).bit_length() - 1
        return m * ball(n, reach) * (2.0**-r + n_distinct * 2.0**-n / COMPARES_PER_COPY)

    return min((m for m in range(1, max_bits + 1) if max_bits // m >= 1 and ball(BITS // m, 1 + max_bits // m) < 1 << 14), key=cost, default=1)


class _Links:
    """Union-find over the linked fingerprints of one task."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        parent = self.parent
        root = x
        while (up := parent.setdefault(root, root)) != root:
            root = up
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    def add(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


PAIRWISE = 64  # members up to which an anchor's comparisons are made all at once


def _compare_small(start: np.ndarray, size: np.ndarray, fp: np.ndarray, home: np.ndarray, t: int, links: _Links) -> None:
    group = np.repeat(np.arange(len(start)), size)
    homes = np.flatnonzero(home)
    n = size[group[homes]]
    a = np.repeat(homes, n)
    b = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start[group[homes]], n)
    near = (np.bitwise_count(fp[a] ^ fp[b]) <= t) & (fp[a] != fp[b])
    for x, y in set(zip(fp[a[near]].tolist(), fp[b[near]].tolist(), strict=True)):
        links.add(x, y)


def _compare_large(fp: np.ndarray, home: np.ndarray, t: int, links: _Links) -> None:
    """Flood fill: what is linked leaves the pool, so a dense group takes few passes."""
    fp, first = np.unique(fp, return_index=True)
    home = home[first]  # a fingerprint is once at an anchor
    open_ = np.ones(len(fp), dtype=bool)
    for seed in np.flatnonzero(home).tolist():
        if not open_[seed]:
            continue
        open_[seed] = False
        queue = [seed]
        while queue:
            x = queue.pop()
            pool = np.flatnonzero(open_ if home[x] else open_ & home)
            near = pool[np.bitwise_count(fp[pool] ^ fp[x]) <= t]
            open_[near] = False
            for y in near.tolist():
                links.add(int(fp[x]), int(fp[y]))
            queue.extend(near.tolist())


def _compare(max_bits: int):
    def run(batches):
        links = _Links()
        held: list[pa.RecordBatch] = []

        def work(table: pa.Table) -> None:
            key, salt, fp, home = (table.column(i).combine_chunks().to_numpy(zero_copy_only=False) for i in range(4))
            fp = fp.view(np.uint64)
            new = np.concatenate(([True], (key[1:] != key[:-1]) | (salt[1:] != salt[:-1])))
            start = np.flatnonzero(new)
            size = np.diff(np.concatenate((start, [len(key)])))
            busy = (np.add.reduceat(home.astype(np.int64), start) > 0) & (size > 1)
            rows = np.repeat(busy & (size <= PAIRWISE), size)
            few = size[busy & (size <= PAIRWISE)]
            if len(few):
                _compare_small(np.cumsum(few) - few, few, fp[rows], home[rows], max_bits, links)
            for g in np.flatnonzero(busy & (size > PAIRWISE)).tolist():
                at = slice(start[g], start[g] + size[g])
                _compare_large(fp[at], home[at], max_bits, links)

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            last = (batch.column(0)[-1].as_py(), batch.column(1)[-1].as_py())
            if (batch.column(0)[0].as_py(), batch.column(1)[0].as_py()) == last:
                continue  # one anchor fills the batch; it may go on
            table = pa.Table.from_batches(held)
            key, salt = (table.column(i).combine_chunks().to_numpy() for i in range(2))
            cut = int(np.flatnonzero((key != last[0]) | (salt != last[1]))[-1]) + 1
            work(table.slice(0, cut))
            held = table.slice(cut).to_batches()
        if held:
            work(pa.Table.from_batches(held))
        nodes = list(links.parent)
        roots = [links.find(x) for x in nodes]
        as_long = lambda x: pa.array(np.array(x, dtype=np.uint64).view(np.int64), pa.int64())
        yield pa.RecordBatch.from_arrays([as_long(nodes), as_long(roots)], names=["u", "v"])

    return run


def _keyed(blocks: int, block: int, anchor: Column, at: Column) -> Column:
    return F.struct((anchor * blocks + block).alias("key"), (at == 0).alias("home"))


def _split(copies: DataFrame, limit: int) -> DataFrame:
    """Busy anchors become a grid: a cell compares a share of the homes with a
    share of all that came there. A home goes to the cells of its row as a home
    and to the other cells of its column as a visitor, so each home meets each
    fingerprint in one cell and none is twice in a cell."""
    grid = copies.groupBy("key").agg(F.count_if("home").alias("homes"), F.count(F.lit(1)).alias("all"))
    grid = grid.filter((F.col("homes") > limit) | ((F.col("homes") > 0) & (F.col("all") > VISITORS * limit))).select(
        F.col("key").alias("hot_key"),
        F.ceil(F.col("homes") / limit).cast("int").alias("n_rows"),
        F.ceil(F.col("all") / (VISITORS * limit)).cast("int").alias("n_columns"),
    )
    grid = F.broadcast(materialise(grid, "hot-anchors"))
    n_rows, n_columns = F.coalesce("n_rows", F.lit(1)), F.coalesce("n_columns", F.lit(1))
    row = F.pmod(F.xxhash64("fp"), F.col("n_rows")).cast("int")
    column = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("n_columns")).cast("int")
    as_home = F.transform(
        F.sequence(F.lit(0), F.col("n_columns") - 1), lambda j: F.struct((row * F.col("n_columns") + j).alias("salt"), F.lit(True).alias("home"))
    )
    as_visitor = F.transform(
        F.filter(F.sequence(F.lit(0), F.col("n_rows") - 1), lambda i: ~F.col("home") | (i != row)),
        lambda i: F.struct((i * F.col("n_columns") + column).alias("salt"), F.lit(False).alias("home")),
    )
    return (
        copies.join(grid, F.col("key") == F.col("hot_key"), "left")
        .withColumns({"n_rows": n_rows, "n_columns": n_columns})
        .select("key", "fp", F.explode(F.when(F.col("home"), F.concat(as_home, as_visitor)).otherwise(as_visitor)).alias("c"))
        .select("key", "c.salt", "fp", "c.home")
    )


def linked_fingerprints(fps: DataFrame, n_distinct: int, max_bits: int = MAX_BITS, hot_homes: int = HOT_HOMES) -> DataFrame:
    """Distinct fingerprints ``fp`` -> edges (u, v) that connect what links connect."""
    spark = fps.sparkSession
    m = choose_blocks(n_distinct, max_bits)
    code, shift, parts = {}, 0, []
    for b in range(m):
        n = BITS // m + (b < BITS % m)
        code[n] = code.get(n) or BlockCode(n, BlockCode.radius + max_bits // m)
        block = F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << n) - 1 if n < 64 else -1))
        key = partial(_keyed, m, b)
        parts.append(F.transform(code[n].anchors(block), lambda a, i: key(a, i)))
        shift += n
    copies = fps.select("fp", F.explode(F.flatten(F.array(*parts))).alias("a")).select("a.key", "fp", "a.home")
    limit = max(hot_homes, m * n_distinct // 10_000)
    hot = (
        copies.filter("home").groupBy("key").count().filter(F.col("count") > limit)
    )
    hot = materialise(hot.select("key"), "busy-anchors")  # at most m * n_distinct / limit rows
    if hot.isEmpty():  # then no anchor has very many visitors either: they live at the few anchors near it
        copies = copies.select("key", F.lit(0).alias("salt"), "fp", "home")
    else:
        copies = _split(copies, limit)
    return (
        copies.repartition(partitions(spark), "key", "salt")
        .sortWithinPartitions("key", "salt")
        .mapInArrow(_compare(max_bits), "u long, v long")
    )


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    hot_homes: int = HOT_HOMES,
) -> DataFrame:
    """One row per document: its id, ``fp``, ``fingerprint`` (16 hex digits) and
    ``component_id``, the smallest id it is connected to."""
    return _labelled(docs, id_col, text_col, shingle, max_bits, hot_homes).drop("root")


def _labelled(
    docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE, max_bits: int = MAX_BITS, hot_homes: int = HOT_HOMES
) -> DataFrame:
    """The rows of ``near_duplicates`` with ``root``, a fingerprint that names the component."""
    prints = materialise(
        with_fingerprint(docs.select(id_col, text_col), text_col, shingle, drop_text=True), "simhash"
    )
    reps = materialise(
        prints.groupBy("fp").agg(F.min(id_col).alias("first_id"), F.count(F.lit(1)).alias("copies")), "simhash-distinct"
    )
    roots = connected_components(linked_fingerprints(reps.select("fp"), reps.count(), max_bits, hot_homes))
    linked = reps.join(roots, F.col("fp") == F.col("node")).select("fp", "root", "first_id")
    low = linked.groupBy("root").agg(F.min("first_id").alias("low"))
    named = linked.join(low, "root").select(F.col("fp").alias("linked_fp"), "low", "root")
    labels = reps.join(named, F.col("fp") == F.col("linked_fp"), "left").select(
        F.col("fp").alias("label_fp"),
        F.when(F.col("linked_fp").isNull(), F.col("first_id")).otherwise(F.col("low")).alias("component_id"),
        F.coalesce("root", "fp").alias("root"),
        "copies",
    )
    labels = materialise(labels, "simhash-labels")
    # the fingerprints of many copies, at most HOT_COPIES_MOST of them, meet their documents by broadcast
    limit = max(HOT_COPIES, prints.count() // HOT_COPIES_MOST)
    hot = F.broadcast(labels.filter(F.col("copies") > limit).select("label_fp", "component_id", "root"))
    rest = labels.filter(F.col("copies") <= limit).select("label_fp", "component_id", "root")
    on = F.col("fp") == F.col("label_fp")
    return prints.join(hot, on).unionByName(prints.join(hot, on, "left_anti").join(rest, on)).select(
        id_col, "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "root"
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without near-duplicates: of each component the document with the
    smallest id stays (rows of that id in several components: one in each;
    repeated rows: one; a component without any id: one row)."""
    labels = _labelled(docs, id_col, text_col, **options)
    kept = labels.filter(F.col(id_col) == F.col("component_id")).select(F.col(id_col).alias("__kept")).distinct()
    with_id = docs.join(kept, F.col(id_col) == F.col("__kept"), "left_semi")
    several = labels.filter(F.col(id_col) == F.col("component_id")).groupBy(id_col).agg(F.min("fp").alias("low"), F.max("fp").alias("high"))
    if several.filter("low <> high").isEmpty():
        with_id = with_id.dropDuplicates([id_col])
    else:  # an id on several texts: of each component the one with the smallest fingerprint
        heads = (
            labels.filter(F.col(id_col) == F.col("component_id")).groupBy("root", F.col(id_col).alias("__kept")).agg(F.min("fp").alias("__kept_fp"))
        )
        with_id = with_fingerprint(with_id, text_col, options.get("shingle", SHINGLE), out_col="__fp")
        own = (F.col(id_col) == F.col("__kept")) & (F.col("__fp") == F.col("__kept_fp"))
        with_id = with_id.join(heads, own, "left_semi").dropDuplicates([id_col, "__fp"]).select(*docs.columns)
    nameless = labels.filter(F.col(id_col).isNull() & F.col("component_id").isNull())
    if nameless.isEmpty():
        return with_id
    # rows without id in components without id: one per component, told apart by fingerprint
    rows = with_fingerprint(docs.filter(F.col(id_col).isNull()), text_col, options.get("shingle", SHINGLE), out_col="__fp")
    prints = nameless.select("fp").distinct()
    roots = connected_components(linked_fingerprints(prints, prints.count(), options.get("max_bits", MAX_BITS)))
    heads = prints.join(roots, F.col("fp") == F.col("node"), "left").filter("root IS NULL OR root = fp").select(F.col("fp").alias("__fp"))
    return with_id.unionByName(rows.join(heads, "__fp", "left_semi").dropDuplicates(["__fp"]).select(*docs.columns))


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs).drop("fp")
