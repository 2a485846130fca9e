"""Language ID with a linear-chain conditional random field over words.

Words are runs of letters, runs of over 40 cut into several (unspaced scripts). A word's features are its affixes, its character
n-grams and its entry in a lexicon of words that belong to one language; their
learned weights add up to the word's score for every language, and learned
transition weights tie neighbouring words together, so that stretches of
another language inside a text are labelled as such. Forward-backward gives
each word a probability per language; the text's language is the one with the
largest mean, and that mean is the score.

Training: the field is fitted on a bounded sample of the distinct labelled texts
(at most ``SAMPLE_DOCS`` texts of at most ``SAMPLE_CHARS`` characters, taken
evenly from all languages by a hash of the text; a language has at least one, of
its shortest where none is short enough), cut into runs that are strung together
in random order, so that changes of language are seen. Everything that is
predicted covers all rows and whole texts.

Edge cases: null texts and texts without letters get ``und`` and score 0; rows
without a language are predicted but never learned from; repeated rows get the
same result; without any labelled row every text is ``und``; an empty table
gives an empty result; further columns pass through, ones named like a result
column are replaced.

At scale: prediction is one pass without a shuffle. The model (``BUCKETS``
weights per language, the lexicon, the transitions) has a fixed size and is
broadcast. A batch of texts is one chain with restarts; its messages are
computed in blocks, so a very long text costs no more than many short ones.
"""

from __future__ import annotations

import re
import unicodedata
import uuid
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField

from trip_star.llm.common import annotate, process_cache

SAMPLE_DOCS = 1600
SAMPLE_CHARS = 20_000
BUCKETS = 1 << 17
EPOCHS = 2
SEQUENCE = 64  # words of a training sequence
BATCH = 128  # sequences of a training step
RUN = (4, 40)  # words of one language in a row, in training
LEXICON_MIN = 3  # occurrences that make a lexicon word
LEXICON_SHARE = 0.9  # of them in one language
CACHE_WORDS = 200_000
SLAB = 100_000  # words whose messages are computed at once
UNDETERMINED = "und"
# A word: a letter (Unicode category L, as in the training's filter) with the letters
# and marks that follow; longer runs are cut.
_WORDS = regex.compile(r"\p{L}[\p{L}\p{M}]{0,39}")
# Below U+0250 there are no marks, and the letters make a short class that the faster engine takes.
_LATIN_LETTERS = "".join(chr(c) for c in range(0x250) if unicodedata.category(chr(c)).startswith("L"))
_LATIN_WORDS = re.compile(f"[{_LATIN_LETTERS}]{{1,40}}")
_BEYOND = re.compile("[^\u0000-\u024f]")


def words_of(text: str | None) -> list[str]:
    text = (text or "").lower()
    return (_WORDS if _BEYOND.search(text) else _LATIN_WORDS).findall(text)


def features(word: str, lexicon: dict[str, int]) -> list[int]:
    """Buckets of a word's affixes, n-grams and lexicon entry."""
    names = [f"w{word}" if len(word) <= 3 else "long"]
    if len(word) > 3:  # shorter affixes are among the n-grams
        names += [f"p{word[:3]}", f"s{word[-3:]}", f"s{word[-4:]}"]
    edged = f"^{word}$"
    names += [edged[i : i + n] for n in (2, 3) for i in range(len(edged) - n + 1)]
    if (language := lexicon.get(word)) is not None:
        names.append(f"lexicon {language}")
    return [zlib.crc32(x.encode()) % BUCKETS for x in names]


@dataclass
class Model:
    languages: list[str]
    lexicon: dict[str, int]
    weights: np.ndarray  # (BUCKETS, languages)
    transitions: np.ndarray  # (languages, languages)
    start: np.ndarray
    key: str = field(default_factory=lambda: uuid.uuid4().hex)

    def scores(self, words: list[str]) -> np.ndarray:
        found = [features(w, self.lexicon) for w in words]
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        flat = np.fromiter((b for f in found for b in f), dtype=np.int64, count=int(sizes.sum()))
        return np.add.reduceat(self.weights[flat], np.cumsum(sizes) - sizes, axis=0).astype(np.float32)


def _exp(scores: np.ndarray) -> np.ndarray:
    return np.exp(scores - scores.max(axis=-1, keepdims=True))


def _scan(step: np.ndarray, emit: np.ndarray, fresh: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Normalised messages m[t] = (m[t-1] @ step) * emit[t], or first * emit[t]
    where fresh[t]: blocks of positions side by side, first their transfer
    matrices, then the messages that enter them, then all messages."""
    n, k = emit.shape
    length = max(1, int(n**0.5))
    blocks = -(-n // length)
    pad = blocks * length - n
    emit = np.concatenate((emit, np.ones((pad, k)))).reshape(blocks, length, k)
    fresh = np.concatenate((fresh, np.ones(pad, dtype=bool))).reshape(blocks, length)
    carry = np.broadcast_to(np.eye(k), (blocks, k, k)).copy()
    for t in range(length):
        carry = carry @ step
        carry[fresh[:, t]] = first
        carry *= emit[:, t, None, :]
        carry /= carry.sum(axis=(1, 2), keepdims=True)
    enter = np.empty((blocks, k))
    message = np.full(k, 1.0 / k)
    for b in range(blocks):
        enter[b] = message
        message = message @ carry[b]
        message /= message.sum()
    out = np.empty((blocks, length, k))
    for t in range(length):
        enter = enter @ step
        enter[fresh[:, t]] = first
        enter *= emit[:, t]
        enter /= enter.sum(axis=1, keepdims=True)
        out[:, t] = enter
    return out.reshape(-1, k)[:n]


def marginals(emit: np.ndarray, fresh: np.ndarray, step: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Probabilities (words, languages) of one chain that restarts where ``fresh``."""
    if not len(emit):
        return emit
    fresh = fresh.copy()
    fresh[0] = True
    forward = _scan(step, emit, fresh, start)
    # backward: c[t] = emit[t] * beta[t]; c[t] = (c[t+1] @ step.T) * emit[t], or emit[t] at the end of a text
    ends = np.concatenate((fresh[1:], [True]))
    both = _scan(step.T, emit[::-1], ends[::-1], np.ones(len(start)))[::-1]
    p = forward * both / emit
    return p / p.sum(axis=1, keepdims=True)


def _sequences(docs: list[tuple[list[str], int]], rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Word numbers and labels of the training sequences, and the words."""
    number: dict[str, int] = {}
    runs = []
    for words, language in docs:
        ids = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
        at = 0
        while at < len(ids):
            n = int(rng.integers(*RUN))
            runs.append((ids[at : at + n], language))
            at += n
    order = rng.permutation(len(runs))
    ids = np.concatenate([runs[i][0] for i in order])
    labels = np.concatenate([np.full(len(runs[i][0]), runs[i][1]) for i in order])
    n = max(1, len(ids) // SEQUENCE) * SEQUENCE
    ids, labels = np.resize(ids, n), np.resize(labels, n)  # a sample shorter than one sequence is repeated
    return ids.reshape(-1, SEQUENCE), labels.reshape(-1, SEQUENCE), list(number)


def fit(rows: list[tuple[str, str]], seed: int = 7, epochs: int = EPOCHS) -> Model:
    """(text, language) pairs -> the model: stochastic gradient on the log-likelihood."""
    languages = sorted({language for _, language in rows})
    index = {x: i for i, x in enumerate(languages)}
    docs = [(words, index[language]) for text, language in sorted(rows) if (words := words_of(text))]
    counts: dict[str, Counter] = {}
    for words, language in docs:
        for w in words:
            counts.setdefault(w, Counter())[language] += 1
    lexicon = {}
    for w, c in counts.items():
        language, n = c.most_common(1)[0]
        if (total := c.total()) >= LEXICON_MIN and n >= LEXICON_SHARE * total:
            lexicon[w] = language
    k = len(languages)
    model = Model(languages, lexicon, np.zeros((BUCKETS, k)), np.zeros((k, k)), np.zeros(k))
    if not docs:
        return model
    rng = np.random.default_rng(seed)
    ids, labels, words = _sequences(docs, rng)
    found = [np.array(features(w, lexicon)) for w in words]
    squares, squares_t = np.full((BUCKETS, k), 1e-2), np.full((k, k), 1e-2)
    for _ in range(epochs):
        order = rng.permutation(len(ids))
        for at in range(0, len(order), BATCH):
            rows_ = order[at : at + BATCH]
            x, y = ids[rows_], labels[rows_]
            distinct, where = np.unique(x, return_inverse=True)
            where = where.reshape(x.shape)
            sizes = np.array([len(found[i]) for i in distinct])
            flat = np.concatenate([found[i] for i in distinct])
            emit = _exp(np.add.reduceat(model.weights[flat], np.cumsum(sizes) - sizes, axis=0))[where]
            step = np.exp(model.transitions)
            alpha, beta = np.empty(emit.shape), np.ones(emit.shape)
            alpha[:, 0] = emit[:, 0] / emit[:, 0].sum(axis=1, keepdims=True)
            for t in range(1, SEQUENCE):
                a = alpha[:, t - 1] @ step * emit[:, t]
                alpha[:, t] = a / a.sum(axis=1, keepdims=True)
            for t in range(SEQUENCE - 2, -1, -1):
                b = (beta[:, t + 1] * emit[:, t + 1]) @ step.T
                beta[:, t] = b / b.sum(axis=1, keepdims=True)
            p = alpha * beta
            p /= p.sum(axis=2, keepdims=True)
            pair = alpha[:, :-1, :, None] * step * (emit[:, 1:] * beta[:, 1:])[:, :, None, :]
            pair /= pair.sum(axis=(2, 3), keepdims=True)
            grad = np.eye(k)[y] - p
            per_word = np.stack([np.bincount(where.ravel(), grad[..., i].ravel(), len(distinct)) for i in range(k)], axis=1)
            touched, inverse = np.unique(flat, return_inverse=True)
            per_feature = np.repeat(per_word, sizes, axis=0)
            g = np.stack([np.bincount(inverse, per_feature[:, i], len(touched)) for i in range(k)], axis=1) / len(rows_)
            squares[touched] += g * g
            model.weights[touched] += 0.3 * g / np.sqrt(squares[touched])
            seen = np.bincount((y[:, :-1] * k + y[:, 1:]).ravel(), minlength=k * k).reshape(k, k)
            g = (seen - pair.sum(axis=(0, 1))) / len(rows_)
            squares_t += g * g
            model.transitions += 0.3 * g / np.sqrt(squares_t)
    model.weights = model.weights.astype(np.float32)
    return model


def train(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    where: Column | None = None,
    sample_docs: int = SAMPLE_DOCS,
    sample_chars: int = SAMPLE_CHARS,
) -> Model:
    """Fits on at most ``sample_docs`` distinct labelled texts (of rows that satisfy
    ``where``) of at most ``sample_chars`` characters, spread evenly over the
    languages: each has its share, or all its texts, and at least one. One without
    any so short is learned from its shortest texts."""
    rows = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    if where is not None:
        rows = rows.filter(where)
    rows = rows.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.withColumns({"hash": F.xxhash64("text"), "n": F.char_length("text")})
    # distinct texts of every language, those short enough, and its shortest one: a row per language
    found = (
        rows.groupBy("lang", "hash").agg(F.min("n").alias("n"))
        .groupBy("lang")
        .agg(F.count(F.lit(1)).alias("texts"), F.count_if(F.col("n") <= sample_chars).alias("short"), F.min(F.struct("n", "hash")).alias("least"))
        .collect()
    )
    if not found:
        return fit([])
    sizes = {r["lang"]: r["short"] or r["texts"] for r in found}
    chars = {r["lang"]: sample_chars if r["short"] else 2 * r["least"]["n"] for r in found}
    takes = {x: max(1, n * sample_chars // chars[x]) if chars[x] > sample_chars else n for x, n in quotas(sizes, sample_docs).items()}

    def of_language(values: dict) -> Column:
        return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])[F.col("lang")]

    # a text's turn is uniform below the number of distinct texts of its language; the bound leaves
    # more than are taken, and a language of fewer whole
    turn = F.pmod("hash", F.lit(1 << 40)).cast("double") / (1 << 40) * of_language(sizes)
    least = of_language({r["lang"]: r["least"]["hash"] for r in found})
    near = (F.col("n") <= of_language(chars)) & (F.col("turn") < 2 * of_language(takes) + 50)
    place = F.row_number().over(Window.partitionBy("lang").orderBy((F.col("hash") != least) & (F.col("n") > sample_chars), "turn", "text"))
    sample = (
        rows.withColumn("turn", turn)
        .filter(near | (F.col("hash") == least))
        .distinct()  # copies of a text have the same turn
        .withColumn("place", place)
        .filter(F.col("place") <= of_language(takes))
    )
    return fit([(r["text"], r["lang"]) for r in sample.select("text", "lang").collect()])


def quotas(sizes: dict[str, int], total: int) -> dict[str, int]:
    """Even shares of ``total`` for the languages, at least 1; what small ones leave goes to the larger."""
    out, left = {}, total
    for i, (size, language) in enumerate(sorted((size, language) for language, size in sizes.items())):
        out[language] = min(size, max(1, left // (len(sizes) - i)))
        left -= out[language]
    return out


class _Numbers(dict):
    """Numbers for words in order of appearance; ``new`` are those not yet scored."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        self.new.append(word)
        return number


def _word_scores(model: Model, words: list[str]) -> np.ndarray:
    """Scores of the words, distinct ones computed once per worker while they fit the cache."""
    cache = process_cache("langid")
    if cache.get("key") != model.key or len(cache["number"]) > CACHE_WORDS:
        cache.update(key=model.key, number=_Numbers(), table=np.empty((1024, len(model.languages)), dtype=np.float32))
    number = cache["number"]
    found = np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words))
    if number.new:
        while len(cache["table"]) < len(number):
            cache["table"] = np.concatenate((cache["table"], np.empty_like(cache["table"])))
        cache["table"][len(number) - len(number.new) : len(number)] = model.scores(number.new)
        number.new = []
    return cache["table"][found]


def label(model: Model, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
    """The probabilities (words, languages) of each text, a slab of words at a time."""
    words: list[str] = []
    sizes: list[int] = []
    for text in texts:
        own = words_of(text)
        if words and len(words) + len(own) > SLAB:
            yield from _label_slab(model, words, sizes)
            words, sizes = [], []
        words += own
        sizes.append(len(own))
    yield from _label_slab(model, words, sizes)


def _label_slab(model: Model, words: list[str], sizes: list[int]) -> list[np.ndarray]:
    if not words:
        return [np.empty((0, len(model.languages)))] * len(sizes)
    ends = np.cumsum(sizes)
    fresh = np.zeros(len(words), dtype=bool)
    fresh[(ends - sizes)[np.array(sizes) > 0]] = True
    emit = np.maximum(_exp(_word_scores(model, words).astype(np.float64)), 1e-12)
    return np.split(marginals(emit, fresh, np.exp(model.transitions), np.exp(model.start)), ends[:-1])


def predict(docs: DataFrame, model: Model, text_col: str = "text", drop_text: bool = False, word_labels: bool = False) -> DataFrame:
    """``docs`` plus ``lang_pred`` and ``score``; with ``word_labels`` also
    ``word_langs``, the likeliest language of every word."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        model = shared.value
        texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
        lang, score, labels = [], [], []
        for p in label(model, texts) if model.languages else [np.empty((0, 0))] * len(texts):
            if len(p):
                mean = p.mean(axis=0)
                best = int(mean.argmax())
                lang.append(model.languages[best])
                score.append(min(1.0, float(mean[best])))
            else:
                lang.append(UNDETERMINED)
                score.append(0.0)
            if word_labels:
                labels.append([model.languages[i] for i in p.argmax(axis=1)] if len(p) else [])
        out = [pa.array(lang, pa.string()), pa.array(score, pa.float64())]
        return [*out, pa.array(labels, pa.list_(pa.string()))] if word_labels else out

    fields = [StructField("lang_pred", StringType()), StructField("score", DoubleType())]
    if word_labels:
        fields.append(StructField("word_langs", ArrayType(StringType())))
    return annotate(docs, run, fields, drop=[text_col] if drop_text else [], cache="langid")


def fold(id_col: str = "doc_id") -> Column:
    return F.crc32(F.col(id_col).cast("string")) % 3


def train_on_folds(docs: DataFrame) -> Model:
    """The model of the query and of the pipeline: learned from the rows whose
    id falls in the other two folds (never from a row without id)."""
    return train(docs, where=fold() != 1)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train_on_folds(docs)
    held_out = F.coalesce(fold() == 1, F.lit(False)).alias("held_out")
    return predict(docs.select("doc_id", held_out, "text"), model, drop_text=True)
