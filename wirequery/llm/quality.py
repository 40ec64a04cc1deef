"""Quality classifier: a sparse ensemble of conjunctive rules over text statistics.

Small trees are grown on a bounded sample of labelled rows; each path from a root becomes a rule, a conjunction of
comparisons; a logistic regression with an L1 penalty keeps a few of them. The fitted ensemble is compiled into one Spark
column expression over the statistics. Statistics come from whole texts; null and empty texts have zeros throughout, so
their score is that of the rules that hold for zeros. Without labels the score is 0.5; with one class only, that class's.
A side of a split has LEAF rows at least, or an eighth of the labelled rows where those are fewer than 8 LEAF.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as T

#: Labelled rows that the ensemble is fitted on, those of the least hash of the id, and of them those drawn for a tree; trees,
#: their depth, least rows of a side, the L1 penalty.
SAMPLE, DRAWN, TREES, DEPTH, LEAF, PENALTY = 20_000, 4000, 40, 3, 10, 1e-3
STATS = ("log_words", "word_length", "upper", "symbols", "bangs", "digits", "non_ascii", "stops", "distinct_words", "repeats", "distinct_pairs", "line_words", "distinct_lines", "letters", "longest_word")

_BYTE = {k: np.zeros(256, np.int64) for k in ("upper", "letter", "symbol", "bang", "digit", "high", "stop")}
_BYTE["upper"][65:91] = 1
_BYTE["letter"][[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_BYTE["symbol"][[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"]] = 1
_BYTE["bang"][[ord(c) for c in "!?"]] = 1
_BYTE["digit"][48:58] = 1
_BYTE["high"][128:] = 1
_BYTE["stop"][[ord(c) for c in ".,;:"]] = 1


def statistics(col: pa.Array) -> pa.StructArray:
    data, offs = T.raw(col)
    out = np.zeros((len(STATS), len(offs) - 1))
    for i, j in T.slices(offs):
        at, part = offs[i : j + 1] - offs[i], data[offs[i] : offs[j]]
        out[:, i:j] = _of(part, at)
    return pa.StructArray.from_arrays([pa.array(x) for x in out], list(STATS))


def _of(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    n = len(offs) - 1

    def per(x: np.ndarray, first: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(x)))
        return (total[first[1:]] - total[first[:-1]]).astype(float)

    def kinds(h: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Distinct values in each text."""
        owner = np.repeat(np.arange(n), np.diff(first))
        return np.bincount(T.distinct(h, owner)[1], minlength=n).astype(float)

    h, starts, ends, first = T.words(data, offs)
    count = {k: per(v[data], offs) for k, v in _BYTE.items()}
    words, size = np.diff(first).astype(float), np.maximum(np.diff(offs), 1)
    w = np.maximum(words, 1)
    owner = np.repeat(np.arange(n), np.diff(first))
    same = np.concatenate(([False], (h[1:] == h[:-1]) & (owner[1:] == owner[:-1]))) if len(h) else np.zeros(0, bool)
    pair, of = T.grams(h, first, 2)
    pairs = np.bincount(T.distinct(pair, of)[1], minlength=n) / np.maximum(np.bincount(of, minlength=n), 1)
    ls, le, lf = T.spans(data != 10, offs)
    lines = np.maximum(np.diff(lf), 1).astype(float)
    longest = np.zeros(n)
    np.maximum.at(longest, owner, (ends - starts).astype(float))
    return np.stack(
        [np.log1p(words), per(ends - starts, first) / w, count["upper"] / np.maximum(count["letter"], 1), count["symbol"] / w, count["bang"] / w, count["digit"] / size, count["high"] / size,
         count["stop"] / w, kinds(h, first) / w, per(same, first) / w, pairs, words / lines, kinds(T.hashes(data, ls, le), lf) / lines, count["letter"] / size, np.log1p(longest)]
    )


@dataclass
class Ensemble:
    """Rules are tuples of (statistic, at_most, threshold); all must hold."""

    bias: float = 0.0
    rules: list[tuple[tuple[int, bool, float], ...]] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)

    def score(self, stats: Column) -> Column:
        z = F.lit(self.bias)
        for rule, w in zip(self.rules, self.weights, strict=True):
            holds = F.lit(True)
            for k, at_most, t in rule:
                holds = holds & (stats[STATS[k]] <= t if at_most else stats[STATS[k]] > t)
            z = z + F.when(holds, w).otherwise(0.0)
        return 1.0 / (1.0 + F.exp(-z))

    def matrix(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.logical_and.reduce([x[:, k] <= t if at_most else x[:, k] > t for k, at_most, t in rule]) for rule in self.rules], 1).astype(float)


def _paths(x: np.ndarray, y: np.ndarray, rng, leaf: int, path=(), depth=DEPTH) -> list[tuple]:
    """The rules of a tree's nodes below its root, splits chosen by Gini gain among a third of the statistics."""
    if depth == 0 or len(y) < 4 * leaf or y.min() == y.max():
        return []
    best = (1e-9,)
    for k in rng.choice(x.shape[1], max(4, x.shape[1] // 3), replace=False):
        for t in np.unique(np.quantile(x[:, k], np.linspace(0.02, 0.98, 25))):
            left = x[:, k] <= t
            n, m = left.sum(), len(y)
            if leaf <= n <= m - leaf:
                a, b, p = y[left].mean(), y[~left].mean(), y.mean()
                gain = p * (1 - p) - n / m * a * (1 - a) - (m - n) / m * b * (1 - b)
                if gain > best[0]:
                    best = (gain, int(k), float(t), left)
    if len(best) == 1:
        return []
    _, k, t, left = best
    out = []
    for side, at_most in ((left, True), (~left, False)):
        rule = (*path, (k, at_most, t))
        out += [rule, *_paths(x[side], y[side], rng, leaf, rule, depth - 1)]
    return out


def ensemble(x: np.ndarray, y: np.ndarray, seed: int = 11) -> Ensemble:
    """Rules from TREES trees on bootstrap samples, weighted by L1-penalised logistic regression (accelerated proximal steps)."""
    if len(y) == 0:
        return Ensemble()
    mean = float(y.mean())
    if mean in (0.0, 1.0):
        return Ensemble(bias=6.0 if mean else -6.0)
    rng = np.random.default_rng(seed)
    rules, leaf = {}, min(LEAF, max(1, len(y) // 8))
    for _ in range(TREES):
        at = rng.integers(0, len(y), min(len(y), DRAWN))
        rules |= dict.fromkeys(_paths(x[at], y[at], rng, leaf))
    out = Ensemble(float(np.log(mean / (1 - mean))), list(rules))
    if not rules:
        return out
    a = out.matrix(x)
    center = a.mean(0)
    a -= center
    step = 4 * len(y) / (np.linalg.norm(a, 2) ** 2 + len(y))
    w = v = np.zeros(a.shape[1])
    b = c = out.bias
    for i in range(400):
        g = 1 / (1 + np.exp(-(a @ v + c))) - y
        new = v - step * (a.T @ g) / len(y)
        new = np.sign(new) * np.maximum(np.abs(new) - step * PENALTY, 0)
        bias = c - step * g.mean()
        v, c = new + i / (i + 3) * (new - w), bias + i / (i + 3) * (bias - b)
        w, b = new, bias
    kept = np.flatnonzero(np.abs(w) > 1e-6)
    return Ensemble(float(b - center @ w), [out.rules[k] for k in kept], [float(w[k]) for k in kept])


def stats_of(text: Column) -> Column:
    """A struct of STATS for a column of texts."""

    @F.arrow_udf("struct<" + ", ".join(f"{s} double" for s in STATS) + ">")
    def stats(col: pa.Array) -> pa.Array:
        return statistics(col)

    return stats.asNondeterministic()(text.cast("string"))


def sample(docs: DataFrame, labels: DataFrame, label: str, limit: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(text, y) of at most `limit` labelled rows, those whose key has the least hash; the rows of a key all come."""
    lab = labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull()).select(F.col(key).alias("__wq_key"), F.col(label).cast("int").alias("y"))
    lab = lab.orderBy(F.xxhash64("__wq_key"), "__wq_key", "y").limit(limit)
    return docs.select(F.col(key).alias("__wq_id"), F.col(text).cast("string").alias("text")).join(F.broadcast(lab), F.col("__wq_id") == F.col("__wq_key")).select("text", "y")


def fit(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE, key: str = "doc_id", text: str = "text", label: str = "quality") -> Ensemble:
    found = sample(docs, labels, label, limit, key, text).select(stats_of(F.col("text")).alias("s"), "y").select(*[f"s.{s}" for s in STATS], "y").toPandas()
    found = found.sort_values([*STATS, "y"])  # the order of rows, and so the fit, is the same each time
    return ensemble(found[list(STATS)].to_numpy(float), found["y"].to_numpy(float))
