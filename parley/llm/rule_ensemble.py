"""Operator 1, quality classifier: a sparse rule ensemble over text statistics.

Statistics of whole texts are computed once, in numpy. Boosted trees are grown on a bounded sample
of labelled rows; every path from a root is a conjunctive rule. A logistic model with a lasso
penalty weighs the rules and the clipped statistics; those with a weight other than zero are compiled into
one Spark column expression, which scores all documents without Python.

Defined results: null or empty text: all statistics 0, scored like any other. Null doc_id: not held
out. Rows without a label, or with a null one, are scored but never learned from. Labels of one class
only: the score is their share of label 1 (smoothed); no labels: 0.5. Repeated rows: one result each. Inputs of a score are
the statistics alone, never labels, lang, source or doc_id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, fresh, scratch, store
from .repetition import measure
from .textops import Chunk, chunks, mix

#: Labelled rows that the model is fitted on, at most: the ones of the smallest doc_id hashes.
FIT_ROWS = 12_000
TREES, DEPTH, BINS, RATE, SEED = 40, 3, 32, 0.1, 1
FOLDS, HELD_OUT = 3, 1

_CLASS = {
    "upper": range(65, 91),
    "lower": range(97, 123),
    "digit": range(48, 58),
    "symbol": b"#*$%&|<>{}[]=~^_\\",
    "pipe": b"|",
    "bang": b"!?",
    "stop": b".,;:",
    "white": b" \t\n\v\f\r",
    "high": range(128, 256),
}
_IN = {k: np.isin(np.arange(256), list(v)) for k, v in _CLASS.items()}
STATS = (
    "log_words log_bytes mean_word sd_word upper lower digit symbol pipe bang stop white high symbol_words caps_words "
    "short_words long_words distinct top_word entropy lines_per_word dup_lines dup_line_chars repeat3 covered5 covered10"
).split()


def statistics(chunk: Chunk) -> np.ndarray:
    """A row of STATS for each document of a chunk."""
    n, raw, off = chunk.n, chunk.raw, chunk.offsets
    m = {k: v.astype(float) for k, v in measure(chunk).items()}
    w = chunk.words()
    size = np.diff(off).astype(float)
    words, letters = np.maximum(m["n_words"], 1), np.maximum(size, 1)
    doc = np.repeat(np.arange(n), np.diff(off))
    hist = np.bincount(doc * 256 + raw, minlength=n * 256).reshape(n, 256).astype(float)
    part = {k: hist[:, mask].sum(1) for k, mask in _IN.items()}
    p = hist / letters[:, None]
    entropy = -(p * np.log2(np.where(p > 0, p, 1))).sum(1)
    chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    length = (chars[w.ends] - chars[w.starts]).astype(float)
    has = lambda mask: np.concatenate([[0], np.cumsum(mask[raw])])
    symbols, upper, lower = has(_IN["symbol"]), has(_IN["upper"]), has(_IN["lower"])
    per = lambda x: np.bincount(w.doc, weights=x, minlength=n) / words
    caps = (upper[w.ends] - upper[w.starts] > 1) & (lower[w.ends] == lower[w.starts])
    key = w.hashes ^ mix(w.doc.astype(np.uint64) + np.uint64(1))
    _, first, count = np.unique(key, return_index=True, return_counts=True)
    top = np.zeros(n)
    np.maximum.at(top, w.doc[first], count)
    mean = per(length)
    cols = {
        "log_words": np.log1p(m["n_words"]), "log_bytes": np.log1p(size), "mean_word": mean, "sd_word": np.sqrt(np.maximum(per(length * length) - mean * mean, 0)),
        **{k: part[k] / (words if k in ("symbol", "pipe", "bang", "stop") else letters) for k in _CLASS},
        "symbol_words": per((symbols[w.ends] > symbols[w.starts]).astype(float)), "caps_words": per(caps.astype(float)),
        "short_words": per((length <= 2).astype(float)), "long_words": per((length >= 13).astype(float)),
        "distinct": np.bincount(w.doc[first], minlength=n) / words, "top_word": top / words, "entropy": entropy,
        "lines_per_word": m["n_lines"] / words, "dup_lines": m["n_dup_lines"] / np.maximum(m["n_lines"], 1), "dup_line_chars": m["dup_line_chars"] / np.maximum(m["word_chars"], 1),
        "repeat3": m["n_repeat_words"] / words, "covered5": m["covered_5"] / np.maximum(m["word_chars"], 1), "covered10": m["covered_10"] / np.maximum(m["word_chars"], 1),
    }
    return np.stack([cols[k] for k in STATS], 1)


def with_statistics(df: DataFrame) -> DataFrame:
    """``df`` (with text) without its text, with STATS in the struct ``_stats``."""
    name = fresh(df, "_stats")
    keep = [f for f in df.schema if f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [statistics(c) for c in chunks(b.column("text"))]
            x = np.concatenate(parts) if parts else np.empty((0, len(STATS)))
            made = pa.StructArray.from_arrays([pa.array(x[:, j], pa.float64()) for j in range(len(STATS))], list(STATS))
            yield pa.RecordBatch.from_arrays([*(b.column(f.name) for f in keep), made], names=[*(f.name for f in keep), name])

    fields = ", ".join(f"{k}: double" for k in STATS)
    return df.mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in keep), f"{name} struct<{fields}>"]))


# ---- fitting, on the driver, over at most FIT_ROWS rows ----


@dataclass(frozen=True)
class Rule:
    """A conjunction: each statistic j in (low, high]."""

    bounds: tuple[tuple[int, float, float], ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for j, low, high in self.bounds:
            out &= (x[:, j] > low) & (x[:, j] <= high)
        return out

    def column(self, stat: dict[int, Column]) -> Column:
        out = F.lit(True)
        for j, low, high in self.bounds:
            if low > -np.inf:
                out = out & (stat[j] > F.lit(float(low)))
            if high < np.inf:
                out = out & (stat[j] <= F.lit(float(high)))
        return out


def _narrow(rule: Rule, j: int, low: float, high: float) -> Rule:
    now = {k: (a, b) for k, a, b in rule.bounds}
    a, b = now.get(j, (-np.inf, np.inf))
    now[j] = (max(a, low), min(b, high))
    return Rule(tuple((k, *v) for k, v in sorted(now.items())))


def tree_rules(x: np.ndarray, y: np.ndarray, rng: np.random.Generator) -> list[Rule]:
    """The paths of boosted trees on half samples."""
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], 1)  # bin <= b: x <= edges[b]
    rate = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    f = np.full(len(y), np.log(rate / (1 - rate)))
    found: dict[Rule, None] = {}
    offset = np.arange(x.shape[1]) * BINS

    def grow(rows: np.ndarray, rule: Rule, depth: int, g: np.ndarray, h: np.ndarray, out: list[tuple[Rule, float]]) -> None:
        at = (binned[rows] + offset).ravel()
        sums = [np.bincount(at, weights=np.repeat(v[rows], x.shape[1]), minlength=offset[-1] + BINS).reshape(-1, BINS) for v in (g, h)]
        left = [np.cumsum(s, 1)[:, :-1] for s in sums]
        total = [g[rows].sum(), h[rows].sum()]
        gain = left[0] ** 2 / (left[1] + 1) + (total[0] - left[0]) ** 2 / (total[1] - left[1] + 1) - total[0] ** 2 / (total[1] + 1)
        gain[(left[1] < 0.5) | (total[1] - left[1] < 0.5)] = 0
        j, b = np.unravel_index(int(np.argmax(gain)), gain.shape)
        if depth == DEPTH or gain[j, b] < 1e-3 or b >= len(edges[j]):
            out.append((rule, total[0] / (total[1] + 1)))
            return
        cut = float(edges[j][b])
        goes = binned[rows, j] <= b
        for side, r in ((goes, _narrow(rule, int(j), -np.inf, cut)), (~goes, _narrow(rule, int(j), cut, np.inf))):
            found.setdefault(r)
            grow(rows[side], r, depth + 1, g, h, out)

    for _ in range(TREES):
        p = 1 / (1 + np.exp(-f))
        leaves: list[tuple[Rule, float]] = []
        some = np.sort(rng.choice(len(y), max(1, len(y) // 2), replace=False))
        before = len(found)
        grow(some, Rule(()), 0, y - p, np.maximum(p * (1 - p), 1e-6), leaves)
        for rule, value in leaves:  # the tree was grown on half of the rows and speaks for all
            f[rule.holds(x)] += RATE * value * 4
        if len(found) == before and np.abs(y - p).max() < 0.05:
            break
    return list(found)


def lasso_logistic(a: np.ndarray, y: np.ndarray, penalty: float, start: np.ndarray, steps: int = 200) -> np.ndarray:
    """Accelerated proximal gradient; the last column is the unpenalised intercept."""
    v = np.ones(a.shape[1])
    for _ in range(12):
        v = a.T @ (a @ v)
        v /= np.linalg.norm(v)
    step = 4 * len(y) / max(float(np.linalg.norm(a @ v) ** 2) * 1.05, 1e-9)
    w, z, t = start.copy(), start.copy(), 1.0
    for _ in range(steps):
        grad = a.T @ (1 / (1 + np.exp(-np.clip(a @ z, -30, 30))) - y) / len(y)
        new = z - step * grad
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - step * penalty, 0)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z, w, t = new + (t - 1) / t2 * (new - w), new, t2
    return w


@dataclass
class Model:
    intercept: float
    rules: list[tuple[Rule, float]]
    linear: list[tuple[int, float, float, float]]  # statistic, lower and upper clip, weight

    def column(self, stats: str) -> Column:
        stat = {j: F.col(f"{stats}.{k}") for j, k in enumerate(STATS)}
        z = F.lit(float(self.intercept))
        for rule, weight in self.rules:
            z = z + F.when(rule.column(stat), F.lit(float(weight))).otherwise(F.lit(0.0))
        for j, low, high, weight in self.linear:
            z = z + F.lit(float(weight)) * F.least(F.greatest(stat[j], F.lit(float(low))), F.lit(float(high)))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.intercept)
        for rule, weight in self.rules:
            z += weight * rule.holds(x)
        for j, low, high, weight in self.linear:
            z += weight * np.clip(x[:, j], low, high)
        return 1 / (1 + np.exp(-z))


def fit(x: np.ndarray, y: np.ndarray, seed: int = SEED) -> Model:
    """Rules, then weights; the penalty is the strongest whose loss on a fifth of the rows is
    within a twentieth of the best."""
    if len(set(y.tolist())) < 2:
        rate = (y.sum() + 1) / (len(y) + 2)
        return Model(float(np.log(rate / (1 - rate))), [], [])
    rng = np.random.default_rng(seed)
    rules = [r for r in tree_rules(x, y, rng) if 0.002 < (s := r.holds(x).mean()) < 0.998]
    low, high = np.quantile(x, 0.025, 0), np.quantile(x, 0.975, 0)
    clipped = np.clip(x, low, high)
    centre, scale = clipped.mean(0), np.maximum(clipped.std(0) / 0.4, 1e-9)
    a = np.concatenate([np.stack([r.holds(x) for r in rules], 1).astype(float) if rules else np.empty((len(x), 0)), (clipped - centre) / scale, np.ones((len(x), 1))], 1)
    test = rng.random(len(y)) < 0.2
    tried, w = [], np.zeros(a.shape[1])
    for penalty in (0.03, 0.01, 0.003, 0.001):
        w = lasso_logistic(a[~test], y[~test], penalty, w)
        p = np.clip(1 / (1 + np.exp(-np.clip(a[test] @ w, -30, 30))), 1e-6, 1 - 1e-6)
        tried.append((float(-(y[test] * np.log(p) + (1 - y[test]) * np.log(1 - p)).mean()), penalty, w))
    best = min(t[0] for t in tried)
    _, penalty, start = next(t for t in tried if t[0] <= best * 1.05 + 1e-4)
    w = lasso_logistic(a, y, penalty, start)
    linear = w[len(rules) : -1] / scale
    return Model(
        float(w[-1] - (linear * centre).sum()),
        [(r, float(c)) for r, c in zip(rules, w) if abs(c) > 1e-8],
        [(j, float(low[j]), float(high[j]), float(c)) for j, c in enumerate(linear) if abs(c) > 1e-8],
    )


def held_out(doc_id: Column, folds: int = FOLDS, fold: int = HELD_OUT) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def train(stats: DataFrame, labels: DataFrame, label: str = "quality", rows: int = FIT_ROWS) -> Model:
    """Fit on the labelled rows of ``stats`` (doc_id, _stats) that aren't held out."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("double").alias("label")).filter(F.col("label").isNotNull() & ~held_out(F.col("doc_id")))
    share = min(1.0, 1.3 * rows / max(1, known.count()))  # so that the tasks together offer few rows more than are taken
    known = known.filter(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1 << 30)) < int(share * (1 << 30)))
    some = stats.join(known, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    got = some.select(*(F.col(f"_stats.{k}") for k in STATS), "label").toPandas().to_numpy(float)
    if not len(got):
        return Model(0.0, [], [])
    return fit(got[:, :-1], (got[:, -1] > 0.5).astype(float))


def classify(df: DataFrame, labels: DataFrame, label: str = "quality", rows: int = FIT_ROWS) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    with scratch(df.sparkSession):
        stats = store(with_statistics(documents(df)), "statistics")
        model = train(stats, labels, label, rows)
        scored = stats.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), model.column("_stats").alias("score"))
        return store(scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int")), "scores", keep=True)
