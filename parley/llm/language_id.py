"""Operator 11, language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

Characters are lower-cased; runs of others than letters become one space. N-grams of one to four characters fall
into ``BUCKETS`` hash buckets. Document frequencies of buckets are counted over all documents of the training
folds (Spark adds up the counts of tasks). The weights of buckets and languages are fitted by the
follow-the-regularised-leader rule with an elastic net, on at most ``FIT_ROWS`` documents, about as many of each language; a temperature
fitted on a fifth of them, which the weights have not seen, calibrates the scores. The fitted model (at most
``BUCKETS`` rows of a weight for each language) goes to the tasks, which score whole texts in numpy.

Defined results: null text, or one without a letter: ``und``, score 0. Null doc_id: not held out, and not learned from. Null lang: scored, never
learned from. No document to learn from: all ``und``, score 0. One language: it, score 1. Repeated rows: one result each. Ties between
languages: the smallest by code point. Empty table: no rows. Extra columns are left out. Inputs of a prediction are the characters of the text alone.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents
from .textops import chunks

#: Documents that the weights are fitted on, at most: of each language the ones of the smallest doc_id hashes.
FIT_ROWS = 6000
BITS, SIZES = 15, (1, 2, 3, 4)
BUCKETS = 1 << BITS
FOLDS, HELD_OUT = 5, 0
#: Learning rate and its offset, penalties of the elastic net, passes over the rows.
ALPHA, BETA, L1, L2, PASSES = 0.5, 1.0, 0.3, 0.1, 3
UNKNOWN = "und"
_SPREAD = np.random.default_rng(11).integers(1, 1 << 63, max(SIZES) + 1, dtype=np.uint64).astype(np.uint32) | np.uint32(1)


@cache
def _letters() -> np.ndarray:
    """Which code points are letters (category L), built once in a worker."""
    return np.array([unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)])


@dataclass
class Bag:
    """A document's buckets, ascending, and how often each occurs."""

    buckets: np.ndarray
    counts: np.ndarray

    def weights(self, idf: np.ndarray) -> np.ndarray:
        """TF-IDF of length one: logarithms of counts times ``idf``."""
        x = (1 + np.log(self.counts)) * idf[self.buckets]
        return x / max(float(np.sqrt(x @ x)), 1e-12)


def bags(column: pa.Array) -> Iterator[Bag | None]:
    """The bag of each text; None for a text without a letter."""
    letters = _letters()
    for c in chunks(pc.utf8_lower(column)):
        points = np.frombuffer(c.raw.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        first = np.concatenate([[0], np.cumsum((c.raw & 0xC0) != 0x80)])[c.offsets]
        letter = letters[points]
        for a, b in zip(first[:-1], first[1:]):
            inside = letter[a:b]
            if not inside.any():
                yield None
                continue
            keep = inside.copy()
            keep[1:] |= inside[:-1]
            text = np.full(int(keep.sum()) + 2, 32, np.uint32)
            text[1:-1] = np.where(inside, points[a:b], 32)[keep]
            text = text[: len(text) - int(text[-2] == 32)]  # a space before the first letter and one after the last
            at, done = np.empty(sum(len(text) - k + 1 for k in SIZES if k <= len(text)), np.intp), 0
            total = np.zeros(len(text), np.uint32)
            for k in range(min(max(SIZES), len(text))):
                total = total[: len(text) - k] + text[k:] * _SPREAD[k]
                if k + 1 in SIZES:
                    mixed = (total ^ (total >> np.uint32(15))) * _SPREAD[-1] + _SPREAD[k]
                    at[done : done + len(total)] = mixed >> np.uint32(32 - BITS)
                    done += len(total)
            if len(at) < BUCKETS // 16:
                yield Bag(*np.unique(at, return_counts=True))
            else:
                count = np.bincount(at, minlength=BUCKETS)
                some = np.flatnonzero(count != 0)
                yield Bag(some, count[some])


def held_out(doc_id: Column, folds: int = FOLDS, fold: int = HELD_OUT) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def frequencies(df: DataFrame) -> tuple[int, np.ndarray]:
    """How many texts have a letter, and how many have each bucket: tasks count, Spark adds up ``BUCKETS`` + 1 numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(BUCKETS + 1, np.int64)
        for b in batches:
            for bag in bags(b.column(0)):
                if bag is not None:
                    count[bag.buckets] += 1
                    count[BUCKETS] += 1
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(count[some])], names=["bucket", "n"])

    count = np.zeros(BUCKETS + 1, np.int64)
    summed = df.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    count[summed["bucket"].to_numpy(np.int64)] = summed["n"].to_numpy(np.int64)
    return int(count[-1]), count[:-1]


# ---- fitting, on the driver, over at most FIT_ROWS texts ----


class Leader:
    """Follow the regularised leader, coordinate by coordinate: weights are a function of summed gradients ``z`` and
    summed squares ``n``, and zero where ``z`` is within the lasso part of the penalty."""

    def __init__(self, features: int, classes: int, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2) -> None:
        self.z, self.n = np.zeros((features, classes)), np.zeros((features, classes))
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return -np.sign(z) * np.maximum(np.abs(z) - self.l1, 0) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(at)
        p = softmax(x @ w)
        p[label] -= 1
        g = x[:, None] * p
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """What the scores are divided by so that the labels' likelihood is the greatest: golden-section search over its logarithm, as
    the loss has one minimum there. A label counts as one miss in as many rows and two, so that separable rows don't drive it to zero."""
    goal = np.full(scores.shape, 1 / (len(labels) + 2) / max(scores.shape[1] - 1, 1))
    goal[np.arange(len(labels)), labels] = 1 - 1 / (len(labels) + 2)

    def loss(t: float) -> float:
        return float(-(goal * np.log(np.maximum(softmax(scores / np.exp(t)), 1e-300))).sum(1).mean())

    a, b, ratio = np.log(0.02), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        c, d = b - ratio * (b - a), a + ratio * (b - a)
        a, b = (a, d) if loss(c) <= loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


@dataclass
class Model:
    """Rows of weights of the buckets that have any, and the row of each bucket (the last row is of zeros)."""

    langs: list[str]
    idf: np.ndarray
    row: np.ndarray
    weights: np.ndarray
    temperature: float

    def scores(self, bag: Bag) -> np.ndarray:
        return bag.weights(self.idf) @ self.weights[self.row[bag.buckets]]

    def predict(self, bag: Bag | None) -> tuple[str, float]:
        if bag is None or not self.langs:
            return UNKNOWN, 0.0
        p = softmax(self.scores(bag) / self.temperature)
        best = int(np.argmax(p))
        return self.langs[best], float(p[best])


def fit(found: list[Bag], labels: list[str], n: int, frequency: np.ndarray, seed: int = 1) -> Model:
    """A fifth of the documents set the temperature; then the weights are fitted on all."""
    langs = sorted(set(labels))
    idf = np.log((1 + n) / (1 + frequency)) + 1
    y, xs = np.array([langs.index(v) for v in labels], int), [b.weights(idf) for b in found]
    rng = np.random.default_rng(seed)

    def passes(rows: np.ndarray) -> np.ndarray:
        leader = Leader(len(frequency), len(langs))
        for _ in range(PASSES):
            for i in rng.permutation(rows):
                leader.learn(found[i].buckets, xs[i], int(y[i]))
        return leader.weights()

    test = rng.random(len(y)) < 0.2
    heat = 1.0
    if len(langs) > 1 and test.any() and not test.all():
        w = passes(np.flatnonzero(~test))
        heat = temperature(np.stack([xs[i] @ w[found[i].buckets] for i in np.flatnonzero(test)]), y[test])
    w = passes(np.arange(len(y))) if langs else np.zeros((len(frequency), 0))
    used = np.flatnonzero(np.abs(w).sum(1) > 0)
    row = np.full(len(frequency), len(used), np.int32)
    row[used] = np.arange(len(used))
    return Model(langs, idf.astype(np.float32), row, np.concatenate([w[used], np.zeros((1, len(langs)))]).astype(np.float32), heat)


def train(df: DataFrame, rows: int = FIT_ROWS) -> Model:
    """Document frequencies of all documents outside the held-out fold with a language, and weights of a bounded sample of them."""
    known = df.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = known.filter(F.col("text").isNotNull()).groupBy("lang").count()
    top = sizes.orderBy(F.col("count").desc(), "lang").limit(rows).collect()  # no more languages than rows to fit
    if not top:
        return Model([], np.zeros(BUCKETS, np.float32), np.zeros(BUCKETS, np.int32), np.zeros((1, 0), np.float32), 1.0)
    each = max(1, rows // len(top))
    share = F.create_map(*(F.lit(v) for r in top for v in (r["lang"], min(1.0, 1.3 * each / r["count"]))))
    some = known.filter(F.col("text").isNotNull() & (F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 30)) < F.coalesce(share[F.col("lang")], F.lit(0.0)) * (1 << 30)))
    got = some.select("text", "lang").orderBy(F.xxhash64("doc_id", F.lit(5)), "doc_id", "lang", "text").limit(rows).toArrow()
    found, labels = [], []
    for bag, lang in zip((x for c in got.column("text").chunks for x in bags(c)), got.column("lang").to_pylist()):
        if bag is not None:
            found.append(bag)
            labels.append(lang)
    n, frequency = frequencies(known)
    return fit(found, labels, n, frequency)


def scorer(model: Model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [model.predict(bag) for bag in bags(b.column("text"))]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array([x[0] for x in made], pa.string()), pa.array([x[1] for x in made], pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    return run


def predict(df: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score."""
    docs = documents(df, "lang").withColumn("lang", F.col("lang").cast("string"))
    model = train(docs, rows)
    asked = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return asked.mapInArrow(scorer(model), "doc_id long, held_out boolean, lang_pred string, score double")
