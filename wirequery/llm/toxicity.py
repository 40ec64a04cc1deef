"""Toxic passages: maximum-scoring segments over token log-odds, calibrated by extreme-value statistics.

A token's toxic share is estimated under a chain of Dirichlet priors: its 4-byte prefix leans on the base rate, its
5-byte prefix on that, the token on its 5-byte prefix. Its score is the log-odds against the base rate, less a drift, for
every token. A linear scan (Ruzzo and Tompa) finds every maximal segment of positive score; runs of one sign are summed
first, which changes no segment. A segment is a passage if its E-value K * tokens * exp(-lambda * score) is small. The text's score is the chance that it is toxic given the best segment.

Counts are kept in BUCKETS hashed cells, so the model has a fixed size. Null and empty texts have no segment and get the
least score. Without labels every score is 0. Whole texts are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as T
from .common import cut
from .quality import sample

#: Labelled rows that the model is fitted on; hashed cells; strength of the priors; drift; the E-value up to which a segment
#: is a passage; the score of clean texts, as a share of them, from which the tail of their law is fitted.
SAMPLE, BUCKETS, PRIOR, DRIFT, E_VALUE, TAIL = 30_000, 1 << 18, 12.0, 1.2, 0.01, 0.5
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


@dataclass
class Model:
    toxic: np.ndarray  # texts with label 1 by cell
    all: np.ndarray  # texts by cell
    rate: float
    lam: float = 1.0
    log_k: float = 0.0
    prior: float = 0.0


def tokens(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(cells of prefix 4, prefix 5 and token as rows, starts, ends, first token of each text and the total)."""
    starts, ends, first = T.spans(_WORD[data], offs)
    h = np.stack([T.hashes(data, starts, np.minimum(ends, starts + k)) for k in (4, 5)] + [T.hashes(data, starts, ends)])
    h = T.mix(h + np.arange(1, 4, dtype=np.uint64)[:, None])
    return (h >> np.uint64(46)).astype(np.int64), starts, ends, first


def _count(batches):
    n = np.zeros((2, BUCKETS), np.int64)
    for batch in batches:
        data, offs = T.raw(batch.column(0))
        y = batch.column(1).to_numpy(zero_copy_only=False).astype(int)
        for i, j in T.slices(offs):
            cells, _, _, first = tokens(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
            owner = np.tile(np.repeat(np.arange(i, j), np.diff(first)), 3)
            cell, owner = T.distinct(cells.ravel().astype(np.uint64), owner)
            for c in (0, 1):
                n[c] += np.bincount(cell[y[owner] == c].astype(np.int64), minlength=BUCKETS)
    at = np.flatnonzero(n.any(0))
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(n[0, at]), pa.array(n[1, at])], ["cell", "n0", "n1"])


def log_odds(model: Model, cells: np.ndarray) -> np.ndarray:
    share = model.rate
    for row in cells:
        share = (model.toxic[row] + PRIOR * share) / (model.all[row] + PRIOR)
    return np.log(share / (1 - share)) - np.log(model.rate / (1 - model.rate))


def segments(score: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first token, end, score) of a text's token scores.

    A segment begins and ends with a run of positive tokens, so runs are summed and one pass goes over the positive ones;
    each candidate is pushed and merged at most once.
    """
    if not len(score):
        return []
    positive = score > 0
    edge = np.flatnonzero(np.concatenate(([True], positive[1:] != positive[:-1])))
    total = np.concatenate(([0.0], np.cumsum(score)))
    begin, end = edge, np.append(edge[1:], len(score))
    keep = positive[edge]
    stack: list[tuple[int, int, float, float]] = []  # first, end, total before, total after
    for new in zip(begin[keep].tolist(), end[keep].tolist(), total[begin[keep]].tolist(), total[end[keep]].tolist(), strict=True):
        while True:
            i = len(stack) - 1
            while i >= 0 and stack[i][2] >= new[2]:
                i -= 1
            if i < 0 or stack[i][3] >= new[3]:
                break
            new = (stack[i][0], new[1], stack[i][2], new[3])
            del stack[i:]
        stack.append(new)
    return [(a, b, r - l) for a, b, l, r in stack]


def scan(model: Model, data: np.ndarray, offs: np.ndarray):
    """For each text its number of tokens and its segments as (start byte, end byte, score)."""
    for i, j in T.slices(offs):
        part, local = data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
        cells, starts, ends, first = tokens(part, local)
        score = log_odds(model, cells) - DRIFT
        for d in range(j - i):
            found = segments(score[first[d] : first[d + 1]])
            yield int(first[d + 1] - first[d]), [(int(starts[first[d] + a] - local[d]), int(ends[first[d] + b - 1] - local[d]), s) for a, b, s in found]


def _best(held):
    def run(batches):
        for batch in batches:
            data, offs = T.raw(batch.column(0))
            found = [(n, max((s for *_, s in x), default=0.0)) for n, x in scan(held.value, data, offs)]
            yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in found], pa.int64()), pa.array([s for _, s in found], pa.float64()), batch.column(1).cast(pa.int32())], ["n", "s", "y"])

    return run


def fit(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model | None:
    spark = docs.sparkSession
    rows = cut(sample(docs, labels, label, limit, key, text), "toxic-sample")
    n = rows.mapInArrow(_count, "cell int, n0 bigint, n1 bigint").groupBy("cell").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toPandas()
    y0, y1 = (rows.filter(f"y = {k}").count() for k in (0, 1))
    if not y0 or not y1:
        return None
    toxic, all_ = np.zeros(BUCKETS), np.zeros(BUCKETS)
    toxic[n["cell"]], all_[n["cell"]] = n["n1"], n["n0"] + n["n1"]
    model = Model(toxic, all_, rate=(toxic.sum() + 1) / (all_.sum() + 2), prior=y1 / (y0 + y1))
    best = rows.mapInArrow(_best(spark.sparkContext.broadcast(model)), "n bigint, s double, y int").toPandas()
    clean = best[(best["y"] == 0) & (best["n"] > 0)]
    calibrate(model, clean["n"].to_numpy(float), clean["s"].to_numpy(float))
    return model


def calibrate(model: Model, n: np.ndarray, s: np.ndarray) -> None:
    """lambda and log K so that the best segments of clean texts follow the Gumbel law of their lengths.

    With K n exp(-lambda s) segments of score s or more expected in n tokens, lambda comes from the tail of the clean scores
    less what their length adds, and K from the number of clean texts in the tail. lambda is shrunk to 1, which log-odds
    scores have by construction.
    """
    if not len(n):
        return
    for _ in range(20):  # the threshold depends on lambda
        y = s - np.log(np.maximum(n, 1)) / model.lam
        low = np.quantile(y, TAIL)
        above = y[y > low] - low
        model.lam = float((len(above) + 20) / (above.sum() + 20))
    share = max((y > low).mean(), 1 / len(y))
    model.log_k = float(np.log(-np.log1p(-min(share, 0.999)))) + model.lam * float(low)


def posterior(model: Model, n: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Chance of label 1: the prior against the chance that a clean text of n tokens has such a segment."""
    p = np.where(s > 0, -np.expm1(-np.exp(np.minimum(model.log_k - model.lam * s, 50)) * np.maximum(n, 1)), 1.0)
    return model.prior / (model.prior + (1 - model.prior) * np.maximum(p, 1e-12))


def score(model: Model | None, spark, text: Column) -> Column:
    """A column of struct<score, passages: array<struct<start, end, score, e_value>>>; start and end are UTF-8 bytes."""
    held = spark.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("e_value", pa.float64())]))

    @F.arrow_udf("struct<score double, passages array<struct<start bigint, end bigint, score double, e_value double>>>")
    def toxic(col: pa.Array) -> pa.Array:
        m = held.value
        if m is None:
            return pa.StructArray.from_arrays([pa.array(np.zeros(len(col))), pa.array([[]] * len(col), kind)], ["score", "passages"])
        found = list(scan(m, *T.raw(col)))
        n = np.array([x for x, _ in found], float)
        s = np.array([max((z for *_, z in x), default=0.0) for _, x in found], float)
        passages = []
        for size, x in found:
            rated = ((a, b, z, size * float(np.exp(m.log_k - m.lam * z))) for a, b, z in x)
            passages.append([{"start": a, "end": b, "score": z, "e_value": e} for a, b, z, e in rated if e <= E_VALUE])
        return pa.StructArray.from_arrays([pa.array(posterior(m, n, s)), pa.array(passages, kind)], ["score", "passages"])

    return toxic.asNondeterministic()(text.cast("string"))
