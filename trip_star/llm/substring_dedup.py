"""Substring dedup with suffix automata of reference shards.

A window is ``WINDOW`` consecutive words ``[^\\x20\\x09-\\x0D]+`` of a document.
Every word covered by a window whose word sequence also starts earlier (in a
document of smaller id, or earlier in the same one) is removed; windows are
judged on the input.

Routing: the smallest hash of the ``GRAM``-word grams of a window is its
minimiser (rightmost on ties), so equal windows have equal minimisers. The
windows around one minimiser form a segment, a run of words of at most
``2 * WINDOW - GRAM`` words, and all occurrences of a window lie in segments of
one class, its minimiser. A class seen once has nothing to remove.
Equal segments are collapsed to their first occurrence before anything else.

Matching: the distinct segments of the classes that have several are the
reference. They are dealt to shards by class; a shard's segments are built into
a generalised suffix automaton over words whose states know the earliest place
they end at, and are streamed through it: where the matching statistic reaches
``WINDOW`` words, the state says where that window first starts. A copy of a
segment matches its first occurrence from end to end and needs no stream of its
own. Marked windows are united into maximal spans, which are cut out.

Edge cases: null and empty texts have no words; texts of fewer than ``WINDOW``
words stay whole; rows without id count as one last document; rows that share
an id are one document for the order, so a place never removes itself: exact
repeats of a row get the same result; otherwise (id, hash of the text) tells them
apart, so no gathering holds the texts of several; an empty table gives an empty result;
further columns pass through, ones named like a result column are replaced.
Ids are numbers.

At scale: one row of 25 bytes or so per minimiser (every seventh word) is
shuffled once. A task sends on one row per minimiser that repeats within it and
spreads the others over all partitions, so a passage that a third of all
documents hold fills no partition; copies of a frequent segment meet its first
occurrence through ``lookup``, as segments meet the size of their class. A class
of up to ``LARGE_CLASS`` distinct segments goes to one task, so a shard has a
bound, and its automata hold ``SHARD_WORDS`` words each. A larger class goes to
no automaton: each window of its distinct segments is a row of 40 bytes or so,
keyed by a 128-bit hash of all its words; an aggregate finds the smallest place
of every window, which meets its other places through ``lookup``. That is linear
in the class, and no task holds it. Texts are shuffled once, for both the
reference words and the result.
"""

from __future__ import annotations

import hashlib
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField

from trip_star.llm.common import BASE, annotate, lookup, materialise, mix, partitions, powers, raw, rolling, sliced, text_key

WINDOW = 20
GRAM = 8
LARGE_CLASS = 4096
SHARD_WORDS = 100_000
SALTS = 1 << 16
NO_ID = (1 << 63) - 1


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(w) for w in words], dtype=np.uint64)


def minimisers(grams: np.ndarray, width: int) -> np.ndarray:
    """For every ``width`` consecutive grams the place of the smallest, rightmost on ties."""
    low, at, span = grams, np.arange(len(grams)), 1
    while span < width:
        step = min(span, width - span)
        left, right = low[: len(low) - step], low[step:]
        take = right <= left
        at = np.where(take, at[step:], at[: len(at) - step])
        low = np.where(take, right, left)
        span += step
    return at


def segments(hashes: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Minimiser hash, segment hash, first window and number of windows of each segment."""
    if len(hashes) < window:
        return tuple(np.empty(0, dtype=t) for t in (np.uint64, np.uint64, np.int64, np.int64))
    grams = rolling(hashes, gram)
    at = minimisers(grams, window - gram + 1)
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    end = np.concatenate((first[1:], [len(at)]))
    n = len(hashes)
    prefix = np.concatenate(([np.uint64(0)], np.cumsum(hashes * powers(n), dtype=np.uint64)))
    whole = (prefix[end + window - 1] - prefix[first]) * powers(n, pow(BASE, -1, 1 << 64))[first]
    return grams[at[first]], mix(whole + (end - first).astype(np.uint64)), first, end - first


def _as_long(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64), pa.int64())


def _occurrences(window: int, gram: int):
    """(id, text key, text) -> (class, salt, seg, doc, place, text key); place: first window, number of windows, known to repeat."""

    def run(batches):
        for batch in sliced(batches):
            docs, keys = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            parts = [segments(word_hashes((text or b"").split()), window, gram) for text in raw(batch.column(2))]
            sizes = [len(p[0]) for p in parts]
            cls, seg, first, n = (np.concatenate([p[i] for p in parts]) for i in range(4))
            doc, tk = np.repeat(docs, sizes), np.repeat(keys, sizes)
            _, lead, inverse, counts = np.unique(cls, return_index=True, return_inverse=True, return_counts=True)
            known = counts[inverse] > 1
            salt = np.where(known, 1 + mix((doc ^ tk).astype(np.uint64) * np.uint64(BASE) + first.astype(np.uint64)) % np.uint64(SALTS), 0)
            salt[lead] = 0
            yield pa.RecordBatch.from_arrays(
                [_as_long(cls), pa.array(salt.astype(np.int32)), _as_long(seg), pa.array(doc), pa.array(first << 8 | n << 1 | known), pa.array(tk)],
                names=["cls", "salt", "seg", "doc", "place", "tk"],
            )

    return run


def _repeated(batches):
    """Over rows sorted by (class, salt): those whose class has another row, or is known to."""
    held, held_same = None, False
    for batch in chain(batches, [None]):
        if batch is not None and not batch.num_rows:
            continue
        tables = [x for x in (held, batch) if x is not None]
        if not tables:
            return
        table = pa.Table.from_batches(tables).combine_chunks()
        cls, salt, place = (table.column(i).to_numpy() for i in (0, 1, 4))
        same = (cls[1:] == cls[:-1]) & (salt[1:] == salt[:-1])
        before = np.concatenate(([held_same], same))
        after = np.concatenate((same, [False]))
        keep = before | after | (place & 1).astype(bool)
        if batch is not None:  # the last row's successor is not known yet
            keep[-1] = False
            held, held_same = table.slice(len(cls) - 1).to_batches()[0], bool(before[-1])
        out = table.select(["cls", "seg", "doc", "place", "tk"]).filter(pa.array(keep))
        yield from out.to_batches()


class Automaton:
    """A generalised suffix automaton over words; ``low`` is the earliest start
    (an order key) of a window that ends at a place of the state."""

    def __init__(self, window: int):
        self.window = window
        self.step: list[dict[bytes, int]] = [{}]
        self.link, self.size, self.low = [-1], [0], [float("inf")]

    def _new(self, step: dict, link: int, size: int) -> int:
        self.step.append(step)
        self.link.append(link)
        self.size.append(size)
        self.low.append(float("inf"))
        return len(self.size) - 1

    def _split(self, p: int, word: bytes, q: int) -> int:
        """The state of length size[p] + 1 on the way of ``word`` from p to q."""
        if self.size[q] == self.size[p] + 1:
            return q
        clone = self._new(dict(self.step[q]), self.link[q], self.size[p] + 1)
        self.link[q] = clone
        while p >= 0 and self.step[p].get(word) == q:
            self.step[p][word] = clone
            p = self.link[p]
        return clone

    def add(self, words: list[bytes], start: int) -> None:
        last = 0
        for i, word in enumerate(words):
            q = self.step[last].get(word)
            if q is not None:
                now = self._split(last, word, q)
            else:
                now = self._new({}, 0, self.size[last] + 1)
                p = last
                while p >= 0 and word not in self.step[p]:
                    self.step[p][word] = now
                    p = self.link[p]
                if p >= 0:
                    self.link[now] = self._split(p, word, self.step[p][word])
            if i + 1 >= self.window:
                self.low[now] = min(self.low[now], start + i + 1 - self.window)
            last = now

    def finish(self) -> None:
        for state in sorted(range(1, len(self.size)), key=self.size.__getitem__, reverse=True):
            link = self.link[state]
            if self.low[state] < self.low[link]:
                self.low[link] = self.low[state]

    def earliest(self, words: list[bytes]) -> list[float]:
        """For every window of ``words``: where its sequence starts first (infinite: nowhere)."""
        state, matched, out = 0, 0, []
        step, link, size, window = self.step, self.link, self.size, self.window
        for i, word in enumerate(words):
            while (to := step[state].get(word)) is None and state:
                state = link[state]
                matched = size[state]
            if to is not None:
                state, matched = to, matched + 1
            if matched >= window:
                while size[link[state]] >= window:  # the state that holds the last ``window`` words
                    state = link[state]
                matched = window
            if i + 1 >= window:
                out.append(self.low[state] if matched >= window else float("inf"))
        return out


def _requested(batch: pa.RecordBatch, text_col: str, window: int):
    """Document, text key, request (first window, windows, class, seg) and words of
    every segment that the documents of the batch are asked for."""
    docs, keys, texts, requests = (batch.column(batch.schema.get_field_index(c)) for c in ("__sd_id", "__sd_tk", text_col, "__sd_wanted"))
    for doc, tk, text, wanted in zip(docs.to_pylist(), keys.to_pylist(), raw(texts), requests.to_pylist(), strict=True):
        words = (text or b"").split()
        for w in wanted or ():
            part = words[w["first"] : w["first"] + w["n"] + window - 1]
            yield doc, tk, w, part


def _rows(out: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*out, strict=True) if out else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def _reference_words(text_col: str, window: int):
    """Documents with requests -> their segments' words, keyed by class."""

    def run(batches):
        for batch in sliced(batches):
            out = [(w["cls"], doc, tk, w["first"], b" ".join(part)) for doc, tk, w, part in _requested(batch, text_col, window)]
            yield _rows(out, ["shard", "doc", "tk", "first", "words"], [pa.int64()] * 4 + [pa.binary()])

    return run


def _window_keys(text_col: str, window: int):
    """Documents with requests -> a row per window of their segments, keyed by
    the whole window's words (128 bits)."""

    def run(batches):
        for batch in sliced(batches):
            out = [
                (xxhash.xxh3_128_digest(b" ".join(part[low : low + window])), doc, tk, w["first"], low)
                for doc, tk, w, part in _requested(batch, text_col, window)
                for low in range(w["n"])
            ]
            yield _rows(out, ["key", "doc", "tk", "first", "low"], [pa.binary()] + [pa.int64()] * 3 + [pa.int32()])

    return run


def _match(window: int, shard_words: int):
    """Over segments sorted by shard key: the windows of each that start earlier elsewhere."""

    def run(batches):
        group: list[tuple] = []  # rows of whole classes
        size = 0

        def work(rows: list[tuple]):
            split = [row[3].split() for row in rows]
            best = [[float("inf")] * (len(w) - window + 1) for w in split]
            at = 0
            while at < len(rows):
                automaton, filled = Automaton(window), 0
                while at < len(rows) and filled < shard_words:
                    doc, _, first, _ = rows[at]
                    automaton.add(split[at], (doc << 40) + first)
                    filled += len(split[at])
                    at += 1
                automaton.finish()
                for i, words in enumerate(split):
                    best[i] = list(map(min, best[i], automaton.earliest(words)))
            out = []
            for (doc, tk, first, _), found in zip(rows, best, strict=True):
                own = (doc << 40) + first
                mask = sum(1 << i for i, start in enumerate(found) if start < own + i)
                if mask:
                    out.append((doc, tk, first, mask))
            return _rows(out, ["doc", "tk", "first", "mask"], [pa.int64()] * 4)

        now: list[tuple] = []  # rows of the class that is being read
        key = None
        for batch in batches:
            for shard, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if shard != key:
                    if size >= shard_words:
                        yield work(group)
                        group, size = [], 0
                    group += now
                    key, now = shard, []
                now.append(tuple(row))
                size += row[3].count(b" ") + 1
        group += now
        if group:
            yield work(group)

    return run


def _by_window(requested: DataFrame, text_col: str, window: int, repeats: bool, total: int) -> DataFrame:
    """The windows of the requested segments that start earlier elsewhere, one
    mask per window: the smallest place of every window meets all its places.
    Nothing is written here: a run of its own would shuffle the texts again."""
    windows = requested.mapInArrow(_window_keys(text_col, window), "key binary, doc long, tk long, first long, low int")
    windows = windows.distinct() if repeats else windows
    place = F.col("first") + F.col("low")
    heads = windows.groupBy("key").agg(F.min(F.struct("doc", place.alias("place"))).alias("head"), F.count(F.lit(1)).alias("places"))
    heads = heads.filter("places > 1").select("key", F.col("head.doc").alias("head_doc"), F.col("head.place").alias("head_place"), "places")
    later = lookup(windows, heads, "key", "places", total).filter((F.col("doc") != F.col("head_doc")) | (place != F.col("head_place")))
    return later.select("doc", "tk", "first", F.expr("shiftleft(1L, low)").alias("mask"))


def dedup_substrings(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    large: int = LARGE_CLASS,
    shard_words: int = SHARD_WORDS,
    drop_text: bool = False,
) -> DataFrame:
    """``docs`` with ``text`` replaced by the kept words joined by one space (null
    stays null), plus ``n_words``, ``n_removed`` and ``kept_sha256``."""
    if not gram <= window < gram + 63:
        raise ValueError("a segment has at most 63 windows: gram <= window < gram + 63")
    spark = docs.sparkSession
    doc = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))
    # rows that share an id (also null ones) are told apart by their texts
    repeats = docs.select(doc.alias("doc")).groupBy("doc").count().filter("count > 1").limit(1).count() > 0
    tk = text_key(text_col) if repeats else F.lit(0).cast("long")
    narrow = docs.select(doc.alias("doc"), tk.alias("tk"), F.col(text_col).alias("text"))
    found = narrow.mapInArrow(_occurrences(window, gram), "cls long, salt int, seg long, doc long, place long, tk long")
    repeated = (
        found.repartition(partitions(spark), "cls", "salt").sortWithinPartitions("cls", "salt")
        .mapInArrow(_repeated, "cls long, seg long, doc long, place long, tk long")
    )
    repeated = materialise(repeated, "repeated-segments")
    n = F.shiftright("place", 1).bitwiseAND(F.lit(127))
    placed = repeated.select("cls", "seg", "doc", "tk", F.shiftright("place", 8).alias("first"), n.alias("n"))
    distinct = placed.groupBy("cls", "seg").agg(
        F.min(F.struct("doc", "first", "tk")).alias("head"), F.first("n").alias("windows"), F.count(F.lit(1)).alias("copies")
    )
    distinct = materialise(
        distinct.select("cls", "seg", F.expr("head.doc AS head_doc"), F.expr("head.first AS head_first"), F.expr("head.tk AS head_tk"), "windows", "copies"),
        "distinct-segments",
    )
    # copies of a segment match its first occurrence from end to end
    copies = lookup(placed, distinct.filter("copies > 1").drop("windows", "head_tk"), ["cls", "seg"], "copies", repeated.count())
    copies = copies.filter((F.col("doc") != F.col("head_doc")) | (F.col("first") != F.col("head_first"))).select(
        "doc", "tk", "first", (F.expr("shiftleft(1L, cast(n as int))") - 1).alias("mask")
    )
    sizes = materialise(
        distinct.groupBy("cls").agg(F.count(F.lit(1)).alias("members")).filter("members > 1"), "class-sizes"
    )
    n_distinct = distinct.count()
    # the same columns as in the last join, so that all read one shuffle of the documents
    keyed = docs.withColumns({"__sd_id": doc, "__sd_tk": tk})

    on = (F.col("__sd_id") == F.col("__sd_doc")) & (F.col("__sd_tk") == F.col("__sd_key"))

    def requests(classes: DataFrame) -> DataFrame:
        """The documents that hold the first occurrences of the segments of ``classes``, with what they are asked for."""
        request = F.struct(F.col("head_first").alias("first"), F.col("windows").alias("n"), "cls", "seg")
        wanted = (
            lookup(distinct, classes, "cls", "members", n_distinct)
            .groupBy(F.col("head_doc").alias("__sd_doc"), F.col("head_tk").alias("__sd_key"))
            .agg(F.collect_list(request).alias("__sd_wanted"))
        )
        return keyed.join(wanted, on)

    # distinct segments of one class meet in an automaton
    references = requests(sizes.filter(F.col("members") <= large)).mapInArrow(
        _reference_words(text_col, window), "shard long, doc long, tk long, first long, words binary"
    )
    firsts = (
        (references.distinct() if repeats else references)  # repeated rows give the same
        .repartition(partitions(spark), "shard").sortWithinPartitions("shard")
        .mapInArrow(_match(window, shard_words), "doc long, tk long, first long, mask long")
    )
    many = sizes.filter(F.col("members") > large)
    if in_many := many.agg(F.sum("members")).first()[0]:
        firsts = firsts.unionByName(_by_window(requests(many), text_col, window, repeats, in_many))
    gather = F.collect_set if repeats else F.collect_list
    spans = copies.unionByName(firsts).groupBy(F.col("doc").alias("__sd_doc"), F.col("tk").alias("__sd_key"))
    joined = keyed.join(spans.agg(gather(F.struct("first", "mask")).alias("__sd_spans")), on, "left")

    def cut(batch: pa.RecordBatch) -> list[pa.Array]:
        texts = raw(batch.column(batch.schema.get_field_index(text_col)))
        spans = batch.column(batch.schema.get_field_index("__sd_spans"))
        offsets, flat = spans.offsets.to_numpy(), spans.values
        first, mask = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("first", "mask"))
        kept, n_words, n_removed, digest = [], [], [], []
        for row, text in enumerate(texts):
            words = (text or b"").split()
            marks = slice(offsets[row], offsets[row + 1])
            a, bits = first[marks], mask[marks]
            left = words
            if len(a):
                width = int(window - gram + 1)
                starts = (a[:, None] + np.arange(width))[(bits[:, None] >> np.arange(width)) & 1 == 1]
                edges = np.bincount(starts, minlength=len(words) + 1) - np.bincount(starts + window, minlength=len(words) + 1)
                covered = np.cumsum(edges)[: len(words)] > 0
                left = [w for w, gone in zip(words, covered.tolist(), strict=True) if not gone]
            n_words.append(len(words))
            n_removed.append(len(words) - len(left))
            whole = b" ".join(left)
            digest.append(hashlib.sha256(whole).hexdigest())
            kept.append(None if text is None else whole.decode())
        out = [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digest, pa.string())]
        return out if drop_text else [pa.array(kept, pa.string()), *out]

    fields = [StructField("n_words", LongType()), StructField("n_removed", LongType()), StructField("kept_sha256", StringType())]
    if not drop_text:
        fields.insert(0, StructField(text_col, StringType()))
    return annotate(joined, cut, fields, drop=["__sd_id", "__sd_tk", "__sd_doc", "__sd_key", "__sd_spans", *([text_col] if drop_text else [])])


def query(spark, sf_dir: str) -> DataFrame:
    return dedup_substrings(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), drop_text=True)


SQL = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS seq
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS i FROM docs WHERE len(w) >= 20)
),
later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY seq ORDER BY doc_id, i) AS r FROM windows) WHERE r > 1
),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 19)) AS p FROM later),
words AS (SELECT doc_id, unnest(generate_series(1, len(w))) AS p, unnest(w) AS word FROM docs),
kept AS (
  SELECT words.doc_id, count(gone.p) AS n_removed, string_agg(word, ' ' ORDER BY words.p) FILTER (gone.p IS NULL) AS rest
  FROM words LEFT JOIN gone ON words.doc_id = gone.doc_id AND words.p = gone.p GROUP BY words.doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256
FROM docs d LEFT JOIN kept USING (doc_id)
"""
