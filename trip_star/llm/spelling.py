"""Spelling variants by permuterm rotations.

A word gets a terminator and is turned to every rotation. The rotation of
``p a s $`` that starts behind ``a`` is ``s $ p a``: two words that differ in that
place share the prefix ``s $ p``, which skips the edited character, and a word
without the character has ``s $ p`` as a whole rotation. So a word of n letters
has n prefixes that skip one letter and n + 1 whole rotations; sorted, the
entries of one text are a group: at most one whole rotation (its text spells
the word) and at most one word per letter of the alphabet. In a group

* any two skipping words are a replacement apart, and meet nowhere else;
* the whole rotation and a skipping word are one insertion apart. Dropping any
  letter of a run of equal letters gives the same word, so only the entry that
  skips the first of its run counts.

A scan over the sorted entries emits for every member how many neighbours it has
there and the best of them, never the pairs.

Words: maximal runs ``[A-Za-z\\u00C0-\\u00FF]+``, A-Z lower-cased. Where 97 (``EVERY``)
divides the unsigned crc32 of ``<doc_id>:<run>``, the run loses the letter at
that number modulo its length. Words of at least ``MIN_LETTERS`` code points and
``MIN_COUNT`` occurrences in all texts are compared. A word's form is its most
frequent neighbour (ties: the smallest in code-point order) if that is at least
``RATIO`` times as frequent; its root is where the forms end.

Edge cases: null and empty texts have no words; a row without id has an empty id
in the crc's text; repeated rows count each time; a run of any length is
compared (texts of over ``LONG`` letters are grouped by a 127-bit polynomial
hash of theirs, so a run of n letters takes n entries, not n * n bytes); an
empty table gives an empty result. Only the id and the text are read.

At scale: words are counted in the tasks before they are shuffled, so a frequent
word is a few rows; the vocabulary is sorted once, and from there on words are
numbers in code-point order. Groups are bounded by the alphabet, so hashing them
spreads evenly. Forms at least double the count, so chains are shorter than 64
and a few rounds of pointer doubling, each written to the shared folder, end them.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trip_star.llm.common import materialise, partitions, raw, sliced

MIN_LETTERS = 5
MIN_COUNT = 3
EVERY = 97
RATIO = 2
LONG = 64
FLUSH = 100_000  # distinct words held in a task
ENTRIES = 50_000  # entries per batch
END = "$"
_PRIME, _FACTOR = (1 << 127) - 1, 0x1F3D5B79A2C4E68F13579BDF2468ACE1

WHOLE, FIRST, REPEAT = 0, 1, 2  # a whole rotation; a skipped letter: the first of its run, or not


def _counter(every: int):
    def run(batches):
        find = re.compile("[a-zÀ-ÿ]+").findall
        held: Counter = Counter()

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return out

        for batch in sliced(batches, 200):
            for doc, text in zip(raw(batch.column(0)), raw(batch.column(1)), strict=True):
                start = zlib.crc32((doc or b"") + b":")
                for word, n in Counter(find((text or b"").lower().decode("utf-8", "replace"))).items():
                    h = zlib.crc32(word.encode(), start)
                    if h % every == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                    held[word] += n
                if len(held) >= FLUSH:
                    yield flush()
        if held:
            yield flush()

    return run


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = EVERY) -> DataFrame:
    """(word, n): every distinct word of the texts, after deletions, with its occurrences."""
    texts = docs.select(F.col(id_col).cast("string"), F.col(text_col))
    return texts.mapInArrow(_counter(every), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def numbered(words: DataFrame) -> DataFrame:
    """(wid, word, n): numbers that rise in code-point order."""
    counted = materialise(words, "words")
    ordered = counted.repartitionByRange(partitions(words.sparkSession), "word").sortWithinPartitions("word")
    return materialise(ordered.select(F.monotonically_increasing_id().alias("wid"), "word", "n"), "vocabulary")


def entries(word: str, long: int = LONG) -> tuple[list[str], list[int]]:
    """The texts of a word's entries and their kinds."""
    n = len(word)
    kinds = [WHOLE] * (n + 1) + [REPEAT if i and word[i] == word[i - 1] else FIRST for i in range(n)]
    if n <= long:
        turned = [word[i:] + END + word[:i] for i in range(n + 1)]
        return turned + [word[i + 1 :] + END + word[:i] for i in range(n)], kinds
    upto, power = [0], [1]
    for c in word:
        upto.append((upto[-1] * _FACTOR + ord(c)) % _PRIME)
        power.append(power[-1] * _FACTOR % _PRIME)

    def name(start: int, cut: int) -> str:  # of word[start:] + END + word[:cut]
        letters = n - start + cut
        if letters <= long:
            return word[start:] + END + word[:cut]
        head = upto[n] - upto[start] * power[n - start]
        return f"#{letters}:{((head * _FACTOR + ord(END)) * power[cut] + upto[cut]) % _PRIME:x}"

    return [name(i, i) for i in range(n + 1)] + [name(i + 1, i) for i in range(n)], kinds


def _turn(long: int):
    def run(batches):
        keys, kinds, wids, counts = [], [], [], []

        def flush():
            arrays = [pa.array(keys, pa.string()), pa.array(kinds, pa.int32()), pa.array(np.concatenate(wids)), pa.array(np.concatenate(counts))]
            keys.clear(), kinds.clear(), wids.clear(), counts.clear()
            return pa.RecordBatch.from_arrays(arrays, names=["key", "kind", "wid", "n"])

        for batch in sliced(batches):
            for wid, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                key, kind = entries(word, long)
                keys += key
                kinds += kind
                wids.append(np.full(len(key), wid, dtype=np.int64))
                counts.append(np.full(len(key), n, dtype=np.int64))
                if len(keys) >= ENTRIES:
                    yield flush()
        if keys:
            yield flush()

    return run


def _best(group: np.ndarray, n: np.ndarray, wid: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per group: members, and the rows of its most and second most frequent member (-1: none)."""
    order = np.lexsort((wid, -n, group))
    count = np.bincount(group, minlength=groups)
    start = np.cumsum(count) - count
    first = np.where(count > 0, order[np.minimum(start, len(order) - 1)] if len(order) else -1, -1)
    second = np.where(count > 1, order[np.minimum(start + 1, len(order) - 1)] if len(order) else -1, -1)
    return count, first, second


def neighbours(group: np.ndarray, kind: np.ndarray, wid: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
    """Of the members of groups (0, 1, ...), those with neighbours: wid, number of
    neighbours there, count and wid of the best one."""
    groups = int(group[-1]) + 1
    value = lambda of, row: np.where(row >= 0, of[row], -1)
    skip, whole, firsts = np.flatnonzero(kind != WHOLE), np.flatnonzero(kind == WHOLE), np.flatnonzero(kind == FIRST)
    count, first, second = _best(group[skip], n[skip], wid[skip], groups)
    own = group[skip]
    rival = np.where(first[own] == np.arange(len(skip)), second[own], first[own])
    best_n, best = value(n[skip], rival) if len(skip) else rival, value(wid[skip], rival) if len(skip) else rival
    near = count[own] - 1
    # the whole rotation is a neighbour of those that skip the first letter of a run
    at = np.full(groups, -1)
    at[group[whole]] = whole
    row = np.where(kind[skip] == FIRST, at[own], -1)
    whole_n, whole_id = value(n, row), value(wid, row)
    better = (whole_n > best_n) | ((whole_n == best_n) & (whole_n >= 0) & (whole_id < best))
    near = near + (row >= 0)
    best_n, best = np.where(better, whole_n, best_n), np.where(better, whole_id, best)
    # and they are its neighbours
    count, first, _ = _best(group[firsts], n[firsts], wid[firsts], groups)
    top = first[group[whole]]
    out = [
        np.concatenate((wid[skip], wid[whole])),
        np.concatenate((near, count[group[whole]])),
        np.concatenate((best_n, value(n[firsts], top) if len(firsts) else top)),
        np.concatenate((best, value(wid[firsts], top) if len(firsts) else top)),
    ]
    some = out[1] > 0
    return [x[some].astype(np.int64) for x in out]


def _scan(batches):
    """Batches sorted by key -> (wid, near, best_n, best) per group and member; a
    group that a batch cuts waits for the rest of it."""

    def work(table: pa.Table):
        table = table.combine_chunks()
        key = table.column(0)
        new = np.concatenate(([True], pc.not_equal(key.slice(1), key.slice(0, len(key) - 1)).to_numpy())).astype(bool)
        size = np.diff(np.concatenate((np.flatnonzero(new), [len(new)])))
        rows = np.repeat(size > 1, size)
        if not rows.any():
            return None
        group = np.repeat(np.arange(int((size > 1).sum())), size[size > 1])
        kind, wid, n = (table.column(i).to_numpy()[rows] for i in (1, 2, 3))
        return pa.RecordBatch.from_arrays([pa.array(x) for x in neighbours(group, kind, wid, n)], names=["wid", "near", "best_n", "best"])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([*held, batch])
        key = table.column(0).combine_chunks()
        last = pc.equal(key, key[-1]).to_numpy(zero_copy_only=False)
        cut = int(np.argmax(last))  # sorted: the last key's rows stand together
        held = table.slice(cut).to_batches()
        if cut and (out := work(table.slice(0, cut))) is not None:
            yield out
    if held and (out := work(pa.Table.from_batches(held))) is not None:
        yield out


def near_words(vocabulary: DataFrame, long: int = LONG) -> DataFrame:
    """(wid, word, n) -> (wid, n_near, best_n, best) of the words that have neighbours."""
    turned = vocabulary.select("wid", "word", "n").mapInArrow(_turn(long), "key string, kind int, wid long, n long")
    groups = turned.repartition(partitions(vocabulary.sparkSession), "key").sortWithinPartitions("key")
    found = groups.mapInArrow(_scan, "wid long, near long, best_n long, best long")
    best = F.max(F.struct("best_n", (-F.col("best")).alias("minus")))
    return found.groupBy("wid").agg(F.sum("near").alias("n_near"), best.alias("b")).select(
        "wid", "n_near", "b.best_n", (-F.col("b.minus")).alias("best")
    )


def roots(forms: DataFrame) -> DataFrame:
    """(wid, form) -> (wid, root): where following the forms ends."""
    now = materialise(forms.select("wid", F.col("form").alias("root")), "roots")
    while True:
        onward = now.select(F.col("wid").alias("from_id"), F.col("root").alias("onward"))
        stepped = now.join(onward, F.col("root") == F.col("from_id"), "left")
        now = materialise(
            stepped.select("wid", F.coalesce("onward", "root").alias("root"), F.col("onward").isNotNull().alias("went_on")), "roots"
        )
        if now.filter("went_on").isEmpty():
            return now.select("wid", "root")
        now = now.select("wid", "root")


def variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_letters: int = MIN_LETTERS,
    min_count: int = MIN_COUNT,
    every: int = EVERY,
    ratio: int = RATIO,
    long: int = LONG,
) -> DataFrame:
    """One row per word: ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``."""
    counted = word_counts(docs, id_col, text_col, every)
    vocabulary = numbered(counted.filter((F.char_length("word") >= min_letters) & (F.col("n") >= min_count)))
    found = near_words(vocabulary, long)
    chosen = F.col("best_n") >= ratio * F.col("n")
    words = materialise(
        vocabulary.join(found, "wid", "left").select(
            "wid", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(chosen, F.col("best")).alias("form_id"), F.when(chosen, F.col("best_n")).alias("form_n"),
        ),
        "words-near",
    )
    ends = roots(words.filter("form_id IS NOT NULL").select("wid", F.col("form_id").alias("form")))
    name = lambda a, b: vocabulary.select(F.col("wid").alias(a), F.col("word").alias(b))
    named = ends.withColumnRenamed("root", "end").join(name("end_id", "root"), F.col("end") == F.col("end_id"))
    named = named.select(F.col("wid").alias("rooted"), "root")
    return (
        words.join(name("named", "form"), F.col("form_id") == F.col("named"), "left")
        .join(named, F.col("wid") == F.col("rooted"), "left")
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
    )


def query(spark, sf_dir: str) -> DataFrame:
    return variants(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
