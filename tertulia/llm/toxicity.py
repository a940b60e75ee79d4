"""Toxicity scores from bags of subwords.

Each word has the n-grams of its characters (``NGRAMS`` long, blanks at both ends included) and itself as features, hashed
into ``BUCKETS`` embeddings. A window of ``WINDOW`` words is the average of its words, a word the average of its features,
and a linear softmax over that average tells the classes. Embeddings and softmax are trained together, in numpy in one
task, on a bounded sample of labelled texts; the driver gets the model alone. A misspelt word shares most n-grams with the word it stands for, so it is
scored without having been seen. A text is as toxic as its most toxic window, in training and in scoring, so length does
not dilute a short insult.

The softmax of two classes needs one number per feature, the embedding times the difference of the class weights. Tasks get
that table alone (``BUCKETS`` numbers) and score each distinct word once.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tertulia.llm.tables import box, unbox

BUCKETS = 1 << 18
NGRAMS = (3, 4, 5)
WINDOW = 16
# Code points scored at a time, so that the arrays of a huge text stay small.
BLOCK = 1 << 19
# Scores of words that a task remembers.
WORDS_KEPT = 400_000

_P = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


@dataclass(frozen=True)
class Settings:
    """``toxic``, ``clean``: most labelled texts of each class used for training; ``longest``: code points of the longest of them;
    ``ratio``: see ``_telling``."""

    toxic: int = 1000
    clean: int = 3000
    longest: int = 200_000
    ratio: float = 3.0
    dimension: int = 8
    steps: int = 80
    average_steps: int = 20
    rate: float = 4.0
    decay: float = 1e-3
    seed: int = 11


def features(text: str) -> tuple[np.ndarray, np.ndarray, int]:
    """Of words with blanks between: the buckets of all features, the word each belongs to, and the number of words."""
    codes = np.frombuffer((" " + text + " ").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    blank = codes == 32
    starts = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    ends = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    word = np.cumsum(np.concatenate(([False], blank[:-1] & ~blank[1:]))) - 1  # of each place, from the word's start on
    mixed = codes.astype(np.uint64) * _MIX
    mixed ^= mixed >> np.uint64(29)
    buckets, owners = [], []
    with np.errstate(over="ignore"):
        rolled = mixed
        inner = np.zeros(len(codes), bool)  # a blank inside the gram
        for n in range(2, max(NGRAMS) + 1):
            if len(codes) < n:
                break
            m = len(codes) - n + 1
            if n > 2:
                inner = inner[:m] | blank[n - 2 : n - 2 + m]
            rolled = rolled[:m] * _P + mixed[n - 1 :]
            if n in NGRAMS:
                at = np.flatnonzero(~inner[:m] & ~(blank[:m] & blank[1 : 1 + m]))
                buckets.append(_bucket(rolled[at], n))
                owners.append(word[at + 1])
        # whole words: differences of prefix sums, weighted by the place inside the word
        place = np.arange(len(codes), dtype=np.int64) - np.concatenate((starts, starts[-1:]))[np.clip(word, 0, None)]
        weight = _powers(int((ends - starts).max()) + 1)
        inside = ~blank
        term = np.zeros(len(codes), np.uint64)
        term[inside] = mixed[inside] * weight[place[inside]]
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(term, dtype=np.uint64)))
        buckets.append(_bucket(total[ends] - total[starts], 0))
        owners.append(np.arange(len(starts)))
    return np.concatenate(buckets), np.concatenate(owners), len(starts)


def _powers(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.full(n, _P, np.uint64), dtype=np.uint64)


def _bucket(h: np.ndarray, kind: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h + np.uint64(kind)) * _MIX
        return ((h ^ (h >> np.uint64(32))) & np.uint64(BUCKETS - 1)).astype(np.int64)


def _words(text: str) -> Iterator[list[str]]:
    """The words of a text, lower-cased, in pieces of about ``BLOCK`` code points cut at white space where there is any."""
    at = 0
    while at < len(text):
        end = min(len(text), at + BLOCK)
        if end < len(text):
            cut = max(text.rfind(" ", at + 1, end), text.rfind("\n", at + 1, end))
            end = cut if cut > at else end
        yield text[at:end].lower().split()
        at = end


def _means(values: np.ndarray) -> np.ndarray:
    """The mean of each window of ``WINDOW`` words; the last one may be shorter."""
    edges = np.arange(0, len(values), WINDOW)
    return np.add.reduceat(values, edges) / np.minimum(WINDOW, len(values) - edges)


class Model:
    """``table``: the share of each feature in the log odds; ``bias``: those of a text without words."""

    def __init__(self, table: np.ndarray, bias: float):
        self.table, self.bias = table, bias
        self.known: dict[str, float] = {}  # words scored before, at most ``WORDS_KEPT``

    def __getstate__(self) -> tuple:
        return self.table, self.bias

    def __setstate__(self, state: tuple) -> None:
        self.__init__(*state)

    def _learn(self, words: list[str]) -> None:
        new = list(set(words).difference(self.known))
        if new:
            if len(self.known) + len(new) > WORDS_KEPT:
                self.known = {}
                new = list(set(words))
            buckets, owners, n = features(" ".join(new))
            odds = np.bincount(owners, weights=self.table[buckets], minlength=n) / np.bincount(owners, minlength=n)
            self.known.update(zip(new, odds.tolist()))

    def odds(self, text: str | None) -> float:
        odds = [self.bias]
        for words in _words(text or ""):
            if words:
                self._learn(words)
                values = np.fromiter(map(self.known.__getitem__, words), np.float64, len(words))
                odds.append(self.bias + float(_means(values).max()))
        return max(odds[1:] or odds)

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.odds(text), -40, 40))))


def fit(texts: list[str], toxic: list[int], settings: Settings = Settings()) -> Model:
    """Train embeddings and softmax together. With one class only, every score is that class; without texts it is 0.

    The first steps compare whole texts; later ones take the most toxic window of each. Features that are about as frequent
    in both classes stay out, and so do further copies of a text. Every fourth text is held back; the odds are moved to
    where they tell the classes of these apart with the fewest errors.
    """
    y = np.array(toxic, dtype=np.float64)
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(BUCKETS), 30.0 if len(y) and y[0] else -30.0)
    texts, y = _without_copies(texts, y)
    order = np.random.default_rng(settings.seed).permutation(len(texts))
    back, rest = order[::4], np.sort(np.delete(order, np.arange(0, len(order), 4)))
    if min(y[back].sum(), (1 - y[back]).sum()) < 5 or y[rest].min() == y[rest].max():
        back, rest = order[:0], np.arange(len(texts))
    held, held_y = [texts[i] for i in back], y[back]
    texts, y = [texts[i] for i in rest], y[rest]
    known: dict[str, int] = {}
    ids = [np.array([known.setdefault(w, len(known)) for words in _words(t) for w in words], dtype=np.int32) for t in texts]
    vocabulary, words = list(known), len(known)
    del known, texts
    telling, n_features = _telling(ids, y, vocabulary, settings)
    found = [(b[telling[b]].astype(np.int32), o[telling[b]].astype(np.int32)) for b, o in _features_of(vocabulary)]
    del vocabulary
    buckets, owners = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int32), np.zeros(0, np.int32))
    if not len(buckets) or y.min() == y.max():
        return Model(np.zeros(BUCKETS), -30.0)
    share = 1.0 / n_features
    lengths = np.array([len(i) for i in ids])
    per_text = -(-lengths // WINDOW)
    first = np.concatenate(([0], np.cumsum(per_text)[:-1]))  # the first window of each text
    sizes = np.concatenate([np.append(np.full(n - 1, WINDOW), m - WINDOW * (n - 1)) for n, m in zip(per_text, lengths)])
    of_window = np.repeat(np.arange(len(sizes)), sizes)
    flat = np.concatenate(ids)
    text_of = np.repeat(np.arange(len(y)), per_text)
    whole = sizes / lengths[text_of]
    rng = np.random.default_rng(settings.seed)
    table = rng.normal(0, 0.01, (BUCKETS, settings.dimension))
    weights = np.tile([-0.5, 0.5], (settings.dimension, 1)) + rng.normal(0, 0.1, (settings.dimension, 2))
    bias = np.zeros(2)
    balance = np.full(len(y), 1.0 / len(y))
    mass = np.bincount(flat, weights=1.0 / lengths[text_of][of_window], minlength=words) * share
    rarity = 1.0 / np.sqrt(np.bincount(buckets, weights=mass[owners], minlength=BUCKETS) + 1e-3)
    moments = [np.zeros_like(table), np.zeros_like(weights), np.zeros_like(bias)]
    for step in range(settings.steps):
        # of two classes only the difference of the softmax inputs counts
        difference = table @ (weights[:, 1] - weights[:, 0])
        word_odds = np.bincount(owners, weights=difference[buckets], minlength=words) * share
        odds = np.bincount(of_window, weights=word_odds[flat], minlength=len(sizes)) / sizes
        if step < settings.average_steps:
            part = whole
        else:
            top = np.maximum.reduceat(odds, first)
            hits = np.flatnonzero(odds == top[text_of])
            part = np.zeros(len(sizes))
            part[hits[np.unique(text_of[hits], return_index=True)[1]]] = 1.0
        p = 1 / (1 + np.exp(-np.clip(np.add.reduceat(odds * part, first) + bias[1] - bias[0], -40, 40)))
        error = (p - y) * balance
        at_window = error[text_of] * part / sizes
        at_word = np.bincount(flat, weights=at_window[of_window], minlength=words) * share
        at_feature = np.bincount(buckets, weights=at_word[owners], minlength=BUCKETS)
        to_weights = table.T @ at_feature
        scaled = at_feature * rarity
        grads = (
            np.outer(scaled, weights[:, 1] - weights[:, 0]) + settings.decay * np.abs(scaled).max() * table,
            np.stack([-to_weights, to_weights], 1),
            np.array([-error.sum(), error.sum()]),
        )
        rate = settings.rate * (1 - step / settings.steps) * min(1.0, 4 * np.abs(error).sum())
        for x, g, m, pace in zip((table, weights, bias), grads, moments, (1.0, 0.02, 0.3)):
            m *= 0.8
            m += 0.2 * g
            # one step size for all features, in units of how far chance moves them: those that tell the classes apart
            # in many texts move most
            x -= rate * pace * m / (np.abs(m).max() + 1e-12)
    model = Model(table @ (weights[:, 1] - weights[:, 0]), float(bias[1] - bias[0]))
    model.bias -= _boundary(np.array([model.odds(t) for t in held]), held_y)
    return model


def _boundary(odds: np.ndarray, y: np.ndarray) -> float:
    """The middle of the widest gap between odds that splits the classes with the fewest errors; 0 without any."""
    if not len(odds):
        return 0.0
    order = np.argsort(odds, kind="stable")
    odds, y = odds[order], y[order]
    missed = np.cumsum(y)[:-1]  # toxic ones below the gap after each place
    errors = missed + (1 - y).sum() - np.cumsum(1 - y)[:-1]
    gaps = np.where(errors == errors.min(), odds[1:] - odds[:-1], -1)
    at = int(np.argmax(gaps))
    return float((odds[at] + odds[at + 1]) / 2)


def _without_copies(texts: list[str], y: np.ndarray) -> tuple[list[str], np.ndarray]:
    """One text with words of each group that has the same least hash of four neighbouring words: copies would be learnt by heart."""
    seen, kept = set(), []
    for i, text in enumerate(texts):
        words = [w for part in _words(text) for w in part]
        if words:
            least = min(zlib.crc32(" ".join(words[j : j + 4]).encode("utf-8", "surrogatepass")) for j in range(max(1, len(words) - 3)))
            if (least, y[i]) not in seen:
                seen.add((least, y[i]))
                kept.append(i)
    return [texts[i] for i in kept], y[kept]


def _features_of(words: list[str], step: int = 20_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets and owners of many words, a part at a time to bound the memory."""
    for at in range(0, len(words), step):
        buckets, owners, _ = features(" ".join(words[at : at + step]))
        yield buckets, owners + at


def _telling(ids: list[np.ndarray], y: np.ndarray, vocabulary: list[str], settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Buckets that are clearly more frequent in one class, and the number of features of each word.

    Even the low end of the rate in the one class must be ``ratio`` times the high end in the other.
    """
    in_texts = [np.zeros(len(vocabulary)), np.zeros(len(vocabulary))]
    for words, label in zip(ids, y):
        in_texts[int(label)][np.unique(words)] += 1
    counts, n_features = [np.zeros(BUCKETS), np.zeros(BUCKETS)], np.zeros(len(vocabulary), np.int32)
    for buckets, owners in _features_of(vocabulary):
        n_features += np.bincount(owners, minlength=len(vocabulary)).astype(np.int32)
        for c in (0, 1):
            counts[c] += np.bincount(buckets, weights=in_texts[c][owners], minlength=BUCKETS)

    def above(a: int, b: int) -> np.ndarray:
        low = (counts[a] - 2 * np.sqrt(counts[a])) / max(1, in_texts[a].sum())
        return low > settings.ratio * (counts[b] + 2 * np.sqrt(counts[b]) + 1) / max(1, in_texts[b].sum())

    return above(1, 0) | above(0, 1), n_features


def _sampled(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, settings: Settings) -> DataFrame:
    """At most ``toxic`` and ``clean`` labelled texts ``(t, y)`` of the classes, chosen by a hash of the key, beside the key."""
    picked = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(key).agg(F.max(label).cast("int").alias("y"))
    order = [F.xxhash64(key), F.col(key)]
    ids = [picked.filter(F.col("y") == y).orderBy(*order).limit(most) for y, most in ((0, settings.clean), (1, settings.toxic))]
    rows = docs.select(key, F.coalesce(F.col(text), F.lit("")).alias("_text")).filter(F.length("_text") <= settings.longest)
    # rows that repeat a key give one text
    return rows.join(F.broadcast(ids[0].unionByName(ids[1])), key).groupBy(key, "y").agg(F.min("_text").alias("t"))


def sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, settings: Settings) -> tuple[list[str], list[int]]:
    """The texts that :func:`learn` trains on, and their labels, on the driver."""
    found = _sampled(docs, labels, key, text, label, settings).orderBy(F.xxhash64(key), key).collect()
    return [r["t"] for r in found], [r["y"] for r in found]


def learn(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, settings: Settings = Settings()) -> Model:
    """:func:`fit` on the :func:`sample`, in one task."""

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, toxic = [], []
        for batch in batches:
            texts += batch.column(0).to_pylist()
            toxic += batch.column(1).to_pylist()
        model = fit(texts, toxic, settings)
        yield pa.record_batch([pa.array([model.table.tobytes()], pa.binary()), pa.array([model.bias], pa.float64())], names=["table", "bias"])

    found = _sampled(docs, labels, key, text, label, settings).repartition(1).sortWithinPartitions(F.xxhash64(key), key)
    row = found.select("t", "y").mapInArrow(train, "table binary, bias double").first()
    # an empty table may have no task
    return Model(np.frombuffer(row.table, np.float64), row.bias) if row else fit([], [], settings)


def score(docs: DataFrame, model: Model, text: str = "text", into: str = "score") -> DataFrame:
    """All columns of ``docs`` plus the score from 0 to 1. A null, empty or blank text gets the score of no words."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # a fixed size: one number per bucket

    @F.pandas_udf(T.DoubleType())
    def rate(texts: pd.Series) -> pd.Series:
        own = sent.value
        return pd.Series([own.score(t) for t in texts], dtype="float64")

    boxed = box(docs, text=docs[text])
    return unbox(boxed, added={into: rate("text")})
