"""Best-fit packing by a configuration linear program.

Documents become token ids (byte-level BPE file, no special tokens added) plus
an end id; longer ones are cut into pieces of ``capacity`` ids of which the
first may be shorter. The lengths of all pieces form a histogram of at most
``capacity`` bins - all that the solver ever sees. The linear program has one
variable per configuration (a multiset of lengths that fits a sequence) and
asks for the fewest sequences that hold every length as often as it occurs.
Multiplicative weights solve it: each round prices the lengths by how far they
are from being covered, a knapsack dynamic program finds the dearest
configurations, and those are used a little more. The prices start from the best of
a family of dual feasible ones, whose value is a bound that no packing
undercuts (``lower_bound``). The fractional solution is rounded down to whole
sequences that are full or tight under those prices; the program is solved again for
what is left, a few times; the rest is placed by best-fit decreasing, also on
the histogram. Of the passes, and of best-fit alone, the one that needs the fewest
sequences counts; a pass that meets the bound is the last.

The plan is a table of rank intervals per length; a piece finds its sequence
from its rank among the pieces of its length.

Edge cases: null and empty texts are the end id alone; repeated rows are packed
one by one (equal rows take any of their places); rows without id are packed
too; an empty table gives an empty result; further columns are left out.

At scale: tokenising needs no shuffle; its result (a few numbers per piece) is
written once. Ranks are counted in buckets of (length, hash), so a length that
a third of all pieces have is split, and shifted by the running counts of the
buckets. Only the histogram and the plan pass through the driver.
"""

from __future__ import annotations

import json
import math
import zlib
from array import array
from bisect import bisect_left, insort
from itertools import pairwise

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from trip_star.llm.common import annotate, materialise, partitions, process_cache, sliced

CAPACITY = 1024
END_ID = 2
ROUNDS = 200
PASSES = 6
COLUMNS = 32
RATE, STEP = 3.0, 0.05
FULL = 0.99  # how full a rounded configuration must be
TIGHT = 0.995  # or how near its dual price to the most that fits a sequence
BUCKET_ROWS, SMALL_BUCKET = 1_000_000, 1_000
# fixed value: how a byte-level BPE vocabulary of this kind cuts a text into words
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Texts of other characters, or with what may be a special token, are encoded whole:
# old letters and signs have the same classes in every Unicode version.
PLAIN = r"(?!.*<\|)[\t\n\r\x20-ſΑ-ωЀ-џ‐-‧ぁ-ゔァ-ヺ一-龥가-힣]*"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[str, int]:
    """How byte-level vocabularies write bytes: visible Latin-1 characters stand
    for themselves, the others follow from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(others)}


class Encoder:
    """Text -> ids as little-endian unsigned 32-bit bytes, by the tokenizer file.

    Plain texts are encoded by tiktoken from the file's own vocabulary: if ids
    rise in the order of the merges (which is checked), lowest rank first and
    first merge first are the same rule. All others, and all texts if the check
    fails, are encoded by the tokenizers library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.plain = regex.compile(PLAIN, regex.DOTALL)
        self.fast = None
        model = json.loads(self.tokenizer.to_str())["model"]
        vocab, letters = model["vocab"], _byte_letters()
        made = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        if all(a < b for a, b in pairwise(made)) and all(c in letters for t in vocab if t not in special for c in t):
            ranks = {bytes(letters[c] for c in t): i for t, i in vocab.items() if t not in special}
            self.fast = tiktoken.Encoding("file", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> bytes:
        if self.fast and self.plain.fullmatch(text):
            ids = self.fast.encode_ordinary(text)
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return array("I", ids).tobytes()


def token_pieces(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    tokenizer: str | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: id, ``piece``, ``start``, ``length``, ``ids_crc32`` and,
    if asked for, the ids themselves."""
    path = tokenizer or default_tokenizer()
    end = np.array([end_id], dtype="<u4").tobytes()
    schema = StructType(
        [docs.schema[id_col]]
        + [StructField(c, LongType()) for c in ("piece", "start", "length", "ids_crc32")]
        + ([StructField("ids", ArrayType(LongType()))] if with_ids else [])
    )

    def run(batches):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # the task has one core
        encoders = process_cache("encoders")
        encoder = encoders.get(path) or encoders.setdefault(path, Encoder(path))
        for batch in sliced(batches):
            at, piece, start, length, crc, ids = [], [], [], [], [], []
            for row, text in enumerate(batch.column(1).to_pylist()):
                buffer = encoder.encode(text or "") + end
                n = len(buffer) // 4
                low = 0
                high = (n - 1) % capacity + 1
                number = 0
                while low < n:
                    part = buffer[4 * low : 4 * high]
                    at.append(row)
                    piece.append(number)
                    start.append(low)
                    length.append(high - low)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(np.frombuffer(part, dtype="<u4").astype(np.int64))
                    low, high, number = high, high + capacity, number + 1
            columns = [batch.column(0).take(pa.array(at, pa.int64())), *(pa.array(x, pa.int64()) for x in (piece, start, length, crc))]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def knapsack(lengths: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For every room: the largest total price that fits, and the bin added last (-1: none)."""
    value = np.zeros(capacity + 1)
    last = np.full(capacity + 1, -1, dtype=np.int64)
    fits = np.searchsorted(lengths, np.arange(capacity + 1), side="right").tolist()
    for room in range(1, capacity + 1):
        k = fits[room]
        value[room] = value[room - 1]
        if k:
            total = value[room - lengths[:k]] + prices[:k]
            best = int(total.argmax())
            if total[best] > value[room]:
                value[room], last[room] = total[best], best
    return value, last


def _configuration(lengths: np.ndarray, last: np.ndarray, room: int, first: int) -> dict[int, int]:
    chosen = {first: 1}
    while room > 0:
        if last[room] < 0:
            room -= 1
        else:
            i = int(last[room])
            chosen[i] = chosen.get(i, 0) + 1
            room -= int(lengths[i])
    return chosen


def dual_prices(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The best dual solution of a family, and its value, which bounds the
    sequences from below. For a threshold t up to half the capacity a length of
    over capacity - t costs 1, one under t nothing and the others their share of the
    capacity: whatever fits a sequence costs 1 at most. t = 0 is the volume."""
    best, prices = 0.0, lengths / capacity
    for t in range(capacity // 2 + 1):
        trial = np.where(lengths > capacity - t, 1.0, np.where(lengths >= t, lengths / capacity, 0.0))
        value = float((counts * trial).sum())
        if value > best:
            best, prices = value, trial
    return best, prices


def lower_bound(histogram: dict[int, int], capacity: int = CAPACITY) -> int:
    """No packing of ``{length: count}`` has fewer sequences."""
    lengths = np.array(sorted(histogram), dtype=np.int64)
    counts = np.array([histogram[n] for n in lengths.tolist()], dtype=np.int64)
    return math.ceil(dual_prices(lengths, counts, capacity)[0] - 1e-6)


def fractional(
    lengths: np.ndarray, counts: np.ndarray, capacity: int, rounds: int = ROUNDS, base: np.ndarray | None = None
) -> dict[tuple, float]:
    """The linear program by multiplicative weights: configuration (pairs of
    bin and multiplicity) -> how often, fractionally, it is used. A round prices
    by one knapsack table and takes the dearest configurations around each of
    ``COLUMNS`` bins. ``base``: the prices to start from (by default the share of the capacity)."""
    base = lengths / capacity if base is None else base
    covered = np.zeros(len(lengths))
    used: dict[tuple, float] = {}
    for _ in range(rounds):
        if covered.min() >= 1:
            break
        prices = base * np.exp(-RATE * (covered - covered.min()))
        value, last = knapsack(lengths, prices, capacity)
        worth = value[capacity - lengths] + prices
        for i in np.argsort(-worth, kind="stable")[:COLUMNS].tolist():
            config = _configuration(lengths, last, capacity - int(lengths[i]), i)
            bins, many = np.array(list(config)), np.array(list(config.values()), dtype=float)
            amount = float((counts[bins] / many).min()) * STEP
            covered[bins] += amount * many / counts[bins]
            key = tuple(sorted(config.items()))
            used[key] = used.get(key, 0.0) + amount
    share = max(1.0, float(covered.mean()))  # lengths are covered a little more than once on average
    return {config: x / share for config, x in used.items()}


def best_fit(lengths: np.ndarray, left: np.ndarray, capacity: int) -> dict[tuple, int]:
    """Best-fit decreasing on a histogram: equal bins are filled together, so
    the work follows the number of different bins, not of pieces."""
    groups: dict[int, dict[tuple, int]] = {}  # room -> configuration -> bins
    rooms: list[int] = []

    def put(room: int, config: tuple, n: int) -> None:
        if room not in groups:
            groups[room] = {}
            insort(rooms, room)
        groups[room][config] = groups[room].get(config, 0) + n

    for i in range(len(lengths) - 1, -1, -1):
        size, count = int(lengths[i]), int(left[i])
        while count:
            at = bisect_left(rooms, size)
            if at == len(rooms):
                many = capacity // size
                full, rest = divmod(count, many)
                if full:
                    put(capacity - many * size, ((i, many),), full)
                if rest:
                    put(capacity - rest * size, ((i, rest),), 1)
                break
            room = rooms[at]
            config, bins = groups[room].popitem()
            if not groups[room]:
                del groups[room], rooms[at]
            many = room // size
            full, rest = divmod(count, many)
            if full >= bins:
                put(room - many * size, (*config, (i, many)), bins)
                count -= bins * many
                continue
            if full:
                put(room - many * size, (*config, (i, many)), full)
            if rest:
                put(room - rest * size, (*config, (i, rest)), 1)
            if bins - full - (rest > 0):
                put(room, config, bins - full - (rest > 0))
            count = 0
    plan: dict[tuple, int] = {}
    for found in groups.values():
        for config, n in found.items():
            key = tuple(sorted(config))
            plan[key] = plan.get(key, 0) + n
    return plan


def solve(histogram: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS) -> list[tuple[list[tuple[int, int]], int]]:
    """``{length: count}`` -> [([(length, multiplicity)], number of sequences)]."""
    lengths = np.array(sorted(histogram), dtype=np.int64)
    left = np.array([histogram[n] for n in lengths.tolist()], dtype=np.int64)
    alone = best_fit(lengths, left, capacity)
    bound = lower_bound(histogram, capacity)
    plan: dict[tuple, int] = {}
    best: tuple[int, dict[tuple, int]] | None = None
    for _ in range(PASSES):
        live = np.flatnonzero(left)
        if not len(live) or (best and best[0] <= bound):
            break
        _, dual = dual_prices(lengths[live], left[live], capacity)
        used = fractional(lengths[live], left[live].astype(float), capacity, rounds, (dual + lengths[live] / capacity) / 2)
        for config, x in sorted(used.items(), key=lambda c: -c[1]):
            worth = sum(dual[i] * m for i, m in config)
            config = tuple((int(live[i]), m) for i, m in config)
            n = min([int(x), *(int(left[i]) // m for i, m in config)])
            if n > 0 and (worth >= TIGHT or sum(int(lengths[i]) * m for i, m in config) >= FULL * capacity):
                for i, m in config:
                    left[i] -= n * m
                plan[config] = plan.get(config, 0) + n
        whole = dict(plan)
        for config, n in best_fit(lengths, left, capacity).items():
            whole[config] = whole.get(config, 0) + n
        if best is None or sum(whole.values()) < best[0]:
            best = (sum(whole.values()), whole)
    if best is None or sum(alone.values()) < best[0]:
        best = (sum(alone.values()), alone)
    return [([(int(lengths[i]), m) for i, m in config], n) for config, n in best[1].items()]


RANK_BITS = 44


def intervals(plan: list[tuple[list[tuple[int, int]], int]]) -> np.ndarray:
    """Rows (length << RANK_BITS | first rank, first sequence, multiplicity,
    offset), sorted: from that rank on, pieces of the length go m to a sequence."""
    rank: dict[int, int] = {}
    rows, sequence = [], 0
    for config, n in plan:
        offset = 0
        for length, m in config:
            rows.append((length << RANK_BITS | rank.get(length, 0), sequence, m, offset))
            rank[length] = rank.get(length, 0) + m * n
            offset += length * m
        sequence += n
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    tokenizer: str | None = None,
    with_ids: bool = False,
    bucket_rows: int | None = None,
) -> DataFrame:
    """The pieces of ``token_pieces`` with ``sequence_id`` and ``offset``."""
    spark = docs.sparkSession
    pieces = materialise(token_pieces(docs, id_col, text_col, capacity, end_id, tokenizer, with_ids), "pieces")
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most ``capacity`` rows
    share = sum(histogram.values()) // partitions(spark)
    rows = bucket_rows or min(BUCKET_ROWS, max(SMALL_BUCKET, share))  # of one length that are ranked together
    buckets = -(-max(histogram.values(), default=1) // rows)
    table = spark.sparkContext.broadcast(intervals(solve(histogram, capacity)))
    order = [id_col, "piece", "start", "ids_crc32"]
    split = pieces.withColumn("bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    ranked = split.withColumn("rank", F.row_number().over(Window.partitionBy("length", "bucket").orderBy(*order)).cast("long") - 1)
    if buckets > 1:
        sizes = split.groupBy("length", "bucket").count()
        before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        sizes = sizes.select("length", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
        ranked = ranked.join(sizes, ["length", "bucket"]).withColumn("rank", F.col("rank") + F.col("before")).drop("before")

    def place(batch: pa.RecordBatch) -> list[pa.Array]:
        plan = table.value
        length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
        row = plan[np.searchsorted(plan[:, 0], (length << RANK_BITS) | rank, side="right") - 1]
        k = rank - (row[:, 0] & ((1 << RANK_BITS) - 1))
        return [pa.array(row[:, 1] + k // row[:, 2], pa.int64()), pa.array(row[:, 3] + length * (k % row[:, 2]), pa.int64())]

    fields = [StructField("sequence_id", LongType()), StructField("offset", LongType())]
    return annotate(ranked, place, fields, drop=["bucket", "rank"]).select(*pieces.columns, "sequence_id", "offset")


def query(spark, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
