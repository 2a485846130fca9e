"""Vector code compression: product codes with exact integer codebooks.

Components become integers floor(``SCALE`` * x); a vector is cut into ``PARTS``
equal parts, and each part position has a codebook of ``ENTRIES`` entries, first
that part of the smallest ids, then refined in ``ROUNDS`` rounds of assignment and
componentwise floored means, all in exact integers.

The parts are kept in flat blocks. A task gathers some vectors (a chunk), and for
each part position sorts them along a Hilbert curve over the part's
components and cuts the curve into blocks of ``BLOCK`` parts, each stored with the
minimum and maximum per component (its box) and its sums. A round bounds the
distance of every entry to every point of a box from below and above; only
entries whose lower bound is within the smallest upper bound can be nearest to any
part of the block. Where that leaves one entry the block's sums go to it unread;
else a small kernel compares the parts with the shortlist alone. Ties go to the
lower index, since an entry that ties is never left out.

Edge cases: null vectors and vectors with a null or non-finite component are
dropped; all others must have the same length, a multiple of ``PARTS`` (an error
names the vector's length else), and components small enough that a squared
distance fits 64 bits (an error else; for 64 components up to 46,000). Fewer than
``ENTRIES`` vectors give as many entries; ids may repeat (rows with equal ids are
ordered by their vectors) or be null (these come last). An empty table gives an
empty result; only the three columns named are read.

At scale: vectors are never shuffled; blocks are written once and read once per
round. A round returns one row per entry component and task, added up on the
cluster, and the driver holds the codebooks alone (16 x the vector's length).
Codes meet their vector by chunk (a few bytes per part are shuffled), labels
their sums through ``lookup``.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from trip_star.llm.common import lookup, materialise, partitions, sliced

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
BLOCK = 128
CHUNK = 1 << 22  # components of a chunk, 16 MB
BATCH = 256  # blocks compared at once
HILBERT_BITS = 8


def hilbert(points: np.ndarray, bits: int = HILBERT_BITS) -> np.ndarray:
    """Places of ``points`` (one row each) along a Hilbert curve over the box they
    fill; with many components fewer bits each, and the first 63 decide."""
    n, d = points.shape
    d = min(d, 63)
    if not n or not d:
        return np.zeros(n, dtype=np.uint64)
    bits = max(1, min(bits, 63 // d))
    low = points[:, :d].min(0)
    wide = np.maximum(points[:, :d].max(0) - low, 1)
    x = [((points[:, i] - low[i]) * ((1 << bits) - 1) // wide[i]).astype(np.uint64) for i in range(d)]
    # the curve's turns are undone from the coarsest bit down, then the axes are Gray-coded together
    bit = 1 << (bits - 1)
    while bit > 1:
        lower = np.uint64(bit - 1)
        for i in range(d):
            flip = (x[i] & np.uint64(bit)) > 0
            swap = np.where(flip, np.uint64(0), (x[0] ^ x[i]) & lower)
            x[0] = np.where(flip, x[0] ^ lower, x[0] ^ swap)
            if i:
                x[i] = x[i] ^ swap
        bit >>= 1
    for i in range(1, d):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros(n, dtype=np.uint64)
    bit = 1 << (bits - 1)
    while bit > 1:
        turn ^= np.where((x[d - 1] & np.uint64(bit)) > 0, np.uint64(bit - 1), np.uint64(0))
        bit >>= 1
    place = np.zeros(n, dtype=np.uint64)
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            place = (place << np.uint64(1)) | (((x[i] ^ turn) >> np.uint64(b)) & np.uint64(1))
    return place


def largest(length: int) -> int:
    """The largest integer component for which a vector's squared distance fits 64 bits."""
    return min((1 << 31) - 1, math.isqrt(((1 << 63) - 1) // max(length, 1)) // 2)


def whole_numbers(vectors: pa.Array, length: int, scale: int = SCALE) -> np.ndarray:
    """The vectors' floored components, one row each."""
    sizes = np.diff(vectors.offsets.to_numpy())
    if (sizes != length).any():
        raise ValueError(f"a vector has {sizes[sizes != length][0]} components, others have {length}")
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.floor(flat * scale)
    if len(out) and np.abs(out).max() > largest(length):
        raise ValueError(f"a component times {scale} is over {largest(length)}: squared distances would not fit 64 bits")
    return out.astype(np.int64).reshape(len(sizes), length)


BLOCK_FIELDS = [
    StructField("chunk", LongType()),
    StructField("part", IntegerType()),
    StructField("rows", BinaryType()),  # int32: places in the chunk
    StructField("points", BinaryType()),  # int32, row by row
    StructField("low", BinaryType()),  # int64
    StructField("high", BinaryType()),
    StructField("sums", BinaryType()),
]


def _blocks(length: int, parts: int, scale: int, block: int, chunk: int):
    width = length // parts
    most = max(block, chunk // max(length, 1))

    def cut(number: int, vectors: np.ndarray, own: list[pa.Array]):
        n = len(vectors)
        at = np.arange(0, n, block)
        ends = np.append(at[1:], n)
        for p in range(parts):
            points = vectors[:, p * width : (p + 1) * width]
            order = np.argsort(hilbert(points), kind="stable")
            points = points[order]
            data = points.astype("<i4")
            low, high, sums = (f.reduceat(points, at, axis=0) if width else np.zeros((len(at), 0), dtype=np.int64) for f in (np.minimum, np.maximum, np.add))
            as_bytes = lambda pieces: pa.array([x.tobytes() for x in pieces], pa.binary())
            columns = [
                pa.array(np.full(len(at), number, dtype=np.int64)),
                pa.array(np.full(len(at), p, dtype=np.int32)),
                as_bytes(order[a:b].astype("<i4") for a, b in zip(at, ends, strict=True)),
                as_bytes(data[a:b] for a, b in zip(at, ends, strict=True)),
                as_bytes(low), as_bytes(high), as_bytes(sums),
            ]
            offsets = pa.array(np.append(at, n) if p == 0 else np.zeros(len(at) + 1), pa.int32())
            # ids and labels stand beside the first part of their vectors
            columns += [pa.ListArray.from_arrays(offsets, x.take(pa.array(order)) if p == 0 else x.slice(0, 0)) for x in own]
            names = [f.name for f in BLOCK_FIELDS] + ["ids", "labels"]
            whole = pa.RecordBatch.from_arrays(columns, names=names)
            for a in range(0, whole.num_rows, BATCH):
                yield whole.slice(a, BATCH)

    def run(batches):
        held, count, number = [], 0, 0
        for batch in sliced(batches, most):
            held.append(batch)
            count += batch.num_rows
            if count >= most:
                yield from finish(held, number)
                held, count, number = [], 0, number + 1
        if count:
            yield from finish(held, number)

    def finish(held, number):
        table = pa.Table.from_batches(held).combine_chunks()
        ids, vectors, labels, task = (table.column(i).chunk(0) for i in range(4))
        yield from cut((task[0].as_py() << 32) | number, whole_numbers(vectors, length, scale), [ids, labels])

    return run


def shortlists(low: np.ndarray, high: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Per box (rows of ``low``, ``high``) and entry: can the entry be nearest to a point of the box?"""
    below, above = low[:, None] - book[None], book[None] - high[:, None]
    nearest = np.maximum(np.maximum(below, above), 0)
    farthest = np.maximum(np.abs(below), np.abs(above))
    farthest = np.maximum(farthest, np.maximum(high[:, None] - book[None], book[None] - low[:, None]))
    lower, upper = (nearest * nearest).sum(2), (farthest * farthest).sum(2)
    return lower <= upper.min(1)[:, None]


def nearest(points: np.ndarray, box: np.ndarray, short: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance of every point, comparing it with its box's shortlist."""
    code = np.zeros(len(points), dtype=np.int64)
    error = np.full(len(points), np.iinfo(np.int64).max)
    for j in range(len(book)):
        rows = np.flatnonzero(short[box, j])
        away = points[rows] - book[j]
        distance = np.einsum("ij,ij->i", away, away)
        closer = distance < error[rows]
        code[rows[closer]], error[rows[closer]] = j, distance[closer]
    return code, error


def _by_part(batch: pa.RecordBatch, width: int):
    """The blocks of a batch by part: part, rows in the batch, sizes, boxes and sums, and the points on demand."""
    read = lambda name, at, kind: np.frombuffer(b"".join(batch.column(name).take(at).to_pylist()), dtype=kind)
    part = batch.column("part").to_numpy()
    for p in np.unique(part).tolist():
        blocks = np.flatnonzero(part == p)
        at = pa.array(blocks)
        size = np.array([len(x) // 4 for x in batch.column("rows").take(at).to_pylist()])
        boxes = [read(name, at, "<i8").reshape(len(blocks), width) for name in ("low", "high", "sums")]

        def points(chosen: np.ndarray, blocks=blocks, size=size) -> np.ndarray:
            return read("points", pa.array(blocks[chosen]), "<i4").astype(np.int64).reshape(int(size[chosen].sum()), width)

        yield p, blocks, size, boxes, points


def _round(books: np.ndarray):
    parts, entries, width = books.shape

    def run(batches):
        sums, counts = np.zeros(books.shape, dtype=np.int64), np.zeros((parts, entries), dtype=np.int64)
        for batch in sliced(batches, BATCH):
            for p, _, size, (low, high, total), points in _by_part(batch, width):
                short = shortlists(low, high, books[p])
                single = short.sum(1) == 1
                only = short.argmax(1)
                np.add.at(sums[p], only[single], total[single])
                np.add.at(counts[p], only[single], size[single])
                rest = np.flatnonzero(~single)
                if not len(rest):
                    continue
                x = points(rest)
                code, _ = nearest(x, np.repeat(np.arange(len(rest)), size[rest]), short[rest], books[p])
                for j in np.unique(code).tolist():
                    mine = x[code == j]
                    sums[p, j] += mine.sum(0)
                    counts[p, j] += len(mine)
        p, j = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(p, width).astype(np.int32)), pa.array(np.repeat(j, width).astype(np.int32)),
                pa.array(np.tile(np.arange(width), len(p)).astype(np.int32)),
                pa.array(np.repeat(counts[p, j], width)), pa.array(sums[p, j].reshape(-1)),
            ],
            names=["part", "entry", "at", "n", "total"],
        )

    return run


def refine(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: the parts' floored means per entry; unused entries stay."""
    sums = blocks.select("part", "rows", "points", "low", "high", "sums").mapInArrow(
        _round(books), "part int, entry int, at int, n long, total long"
    )
    new = books.copy()
    for part, entry, at, n, total in sums.groupBy("part", "entry", "at").agg(F.sum("n"), F.sum("total")).collect():  # 16 x the vector's length
        new[part, entry, at] = total // n
    return new


def _last(books: np.ndarray):
    width = books.shape[2]

    def run(batches):
        for batch in sliced(batches, BATCH):
            n = batch.num_rows
            codes, errors = [b""] * n, [b""] * n
            for p, blocks, size, (low, high, _), points in _by_part(batch, width):
                x = points(np.arange(len(blocks)))
                code, error = nearest(x, np.repeat(np.arange(len(blocks)), size), shortlists(low, high, books[p]), books[p])
                ends = np.cumsum(size)
                for b, start, end in zip(blocks.tolist(), ends - size, ends, strict=True):
                    codes[b], errors[b] = code[start:end].astype(np.uint8).tobytes(), error[start:end].astype("<i8").tobytes()
            keep = [batch.column(c) for c in ("chunk", "part", "rows", "ids", "labels")]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(codes, pa.binary()), pa.array(errors, pa.binary())],
                names=["chunk", "part", "rows", "ids", "labels", "codes", "errors"],
            )

    return run


def _gather(parts: int):
    """Blocks sorted by chunk -> one row per vector."""

    def work(table: pa.Table):
        table = table.combine_chunks()
        rows = [np.frombuffer(x, dtype="<i4") for x in table.column("rows").to_pylist()]
        n = sum(len(r) for r, p in zip(rows, table.column("part").to_pylist(), strict=True) if p == 0)
        codes, errors = np.zeros((n, parts), dtype=np.uint8), np.zeros(n, dtype=np.int64)
        order = []
        columns = (table.column(c).to_pylist() for c in ("part", "codes", "errors"))
        for at, p, code, error in zip(rows, *columns, strict=True):
            codes[at, p] = np.frombuffer(code, dtype=np.uint8)
            errors[at] += np.frombuffer(error, dtype="<i8")
            if p == 0:
                order.append(at)
        place = np.concatenate(order)
        text = codes.tobytes().hex()
        ids, labels = (pa.concat_arrays([x for c in table.column(k).chunks for x in [c.flatten()]]) for k in ("ids", "labels"))
        return pa.RecordBatch.from_arrays(
            [ids, labels, pa.array([text[2 * parts * i : 2 * parts * (i + 1)] for i in place.tolist()], pa.string()), pa.array(errors[place])],
            names=["id", "label", "code", "error"],
        )

    def run(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([*held, batch])
            chunk = table.column("chunk").combine_chunks().to_numpy()
            edges = np.flatnonzero(np.concatenate(([True], chunk[1:] != chunk[:-1])))
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                yield work(table.slice(a, b - a))
            held = table.slice(int(edges[-1])).to_batches()
        if held:
            yield work(pa.Table.from_batches(held))

    return run


def _usable(vector_col: str) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.col(vector_col).isNotNull() & F.forall(vector_col, lambda x: F.coalesce(finite(x.cast("double")), F.lit(False)))


def compress(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    block: int = BLOCK,
    chunk: int = CHUNK,
) -> tuple[DataFrame, np.ndarray]:
    """(id, label, code, error) per vector, written, and the codebooks (part, entry, component)."""
    spark = vectors.sparkSession
    usable = vectors.filter(_usable(vector_col)).select(
        F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"), F.col(label_col).alias("label")
    )
    first = usable.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).collect()  # a row per entry
    fields = [StructField("id", usable.schema["id"].dataType), StructField("label", usable.schema["label"].dataType)]
    fields += [StructField("code", StringType()), StructField("error", LongType())]
    if not first:
        return spark.createDataFrame([], StructType(fields)), np.zeros((parts, 0, 0), dtype=np.int64)
    length = len(first[0].vector)
    if length % parts:
        raise ValueError(f"vectors of {length} components can't be cut into {parts} equal parts")
    seeds = whole_numbers(pa.array([r.vector for r in first], pa.list_(pa.float64())), length, scale)
    books = np.ascontiguousarray(seeds.reshape(len(first), parts, length // parts).transpose(1, 0, 2))
    own = [StructField("ids", ArrayType(fields[0].dataType)), StructField("labels", ArrayType(fields[1].dataType))]
    blocks = materialise(
        usable.select("id", "vector", "label", F.spark_partition_id().cast("long").alias("task")).mapInArrow(
            _blocks(length, parts, scale, block, chunk), StructType(BLOCK_FIELDS + own)
        ),
        "blocks",
    )
    for _ in range(rounds):
        books = refine(blocks, books)
    coded = [*BLOCK_FIELDS[:3], *own, StructField("codes", BinaryType()), StructField("errors", BinaryType())]
    last = blocks.mapInArrow(_last(books), StructType(coded))
    by_chunk = last.repartition(partitions(spark), "chunk").sortWithinPartitions("chunk")
    return materialise(by_chunk.mapInArrow(_gather(parts), StructType(fields)), "codes"), books


def with_label_error(codes: DataFrame) -> DataFrame:
    """``codes`` (id, label, code, error; written) plus ``label_error``, the sum of the
    errors of the rows with the same label (null ones form one group)."""
    keyed = codes.withColumn("label_key", F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit("")))
    sums = materialise(keyed.groupBy("label_key").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("copies")), "label-errors")
    return lookup(keyed, sums, "label_key", "copies", codes.count()).drop("label_key")


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def query(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    codes, books = compress(vectors)
    return with_label_error(codes).select(
        F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")
    )
