"""Language ID with error-correcting output codes over hashed byte trigrams.

Each language has a codeword of +1 and -1. For each bit a binary classifier (log-odds weights of trigram buckets,
languages on either side counting alike) gives a margin; the language with the least weighted logistic loss between its
codeword and the margins wins. The fit counts the trigrams of all training texts; the model is langs x BUCKETS numbers.

Null texts and texts without a letter are `und` with score 0; so is every text if there is nothing to learn from.
Whole texts are read. Equal texts get equal results. A text whose runner-up comes close is flagged as ambiguous.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as T

BUCKETS = 1 << 16
#: Trigrams after which more text makes the margins no surer, and the score under which a result is ambiguous.
CERTAIN, AMBIGUOUS = 40, 0.6
#: Bytes of texts taken at a time; each takes up to some 200 bytes of memory meanwhile.
SLICE = 1 << 18
_LETTER = regex.compile(r"\p{L}")
_FOLD = np.full(256, 32, np.uint32)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


@dataclass
class Model:
    langs: list[str]
    code: np.ndarray  # langs x bits
    weight: np.ndarray  # BUCKETS x bits
    trust: np.ndarray  # bits


def trigrams(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each trigram that lies in one text and has no two blanks in a row, first of each text and the total)."""
    b = _FOLD[data]
    if len(b) < 3:
        return np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    x, y, z = b[:-2], b[1:-1], b[2:]
    ok = ((x != 32) & (y != 32)) | ((y != 32) & (z != 32))
    for back in (1, 2):
        cut = offs[1:-1] - back
        ok[cut[(cut >= 0) & (cut < len(ok))]] = False
    at = np.flatnonzero(ok)
    h = (x * np.uint32(0x9E3779B1) + y * np.uint32(0x85EBCA6B) + z * np.uint32(0xC2B2AE35)).astype(np.uint32)
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return (h[at] >> np.uint32(16)).astype(np.int64), np.searchsorted(at, offs)


def _count(batches):
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        data, offs = T.raw(batch.column(0))
        langs = np.array(batch.column(1).to_pylist(), object)
        for i, j in T.slices(offs, SLICE):
            at = offs[i : j + 1] - offs[i]
            bucket, first = trigrams(data[offs[i] : offs[j]], at)
            owner = np.repeat(langs[i:j], np.diff(first))
            for lang in set(langs[i:j]):
                n = np.bincount(bucket[owner == lang], minlength=BUCKETS)
                total[lang] = total[lang] + n if lang in total else n
    for lang, n in total.items():
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(n[at].astype(np.int64))], ["lang", "bucket", "n"])


def codewords(n: int) -> np.ndarray:
    """n rows of +1 and -1: all two-way splits for up to 5 languages, else 10 log2(n) seeded columns, all rows distinct."""
    if n <= 5:
        bits = [[1 if i == 0 or s >> (i - 1) & 1 else -1 for i in range(n)] for s in range((1 << max(0, n - 1)) - 1)]
        return np.array(bits or [[1] * n], float).T.reshape(n, -1)
    rng = np.random.default_rng(7)
    best, width = None, int(np.ceil(10 * np.log2(n)))
    for _ in range(50):
        code = rng.choice([-1.0, 1.0], (n, width))
        code[0, np.abs(code.sum(0)) == n] *= -1
        gap = min((width - np.delete(code @ c, i).max()) / 2 for i, c in enumerate(code))
        if best is None or gap > best[0]:
            best = (gap, code)
    return best[1]


def fit(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model | None:
    """Learn from all rows of docs that have a language; None if there are none."""
    rows = docs.select(F.col(text).cast("string"), F.col(lang).cast("string")).filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    found = rows.mapInArrow(_count, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(found["lang"].unique())
    if not langs:
        return None
    prob = np.full((len(langs), BUCKETS), 0.05)
    prob[found["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy(int), found["bucket"].to_numpy(int)] += found["n"].to_numpy(float)
    prob /= prob.sum(1, keepdims=True)
    code = codewords(len(langs))
    weight, trust = np.zeros((BUCKETS, code.shape[1]), np.float32), np.ones(code.shape[1])
    for b, column in enumerate(code.T):
        if (column > 0).all():
            continue
        pos, neg = prob[column > 0].mean(0), prob[column < 0].mean(0)
        weight[:, b] = np.log(pos / neg)
        trust[b] = np.sqrt(((pos - neg) * weight[:, b]).sum())  # how far apart the two sides are
    return Model(langs, code, weight, trust / trust.sum() * min(len(trust), 8))


def decode(model: Model, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(best language, its share of the softmax, runner-up) for rows of margins."""
    loss = np.stack([(np.logaddexp(0, -margin * c) * model.trust).sum(1) for c in model.code], 1)
    share = np.exp(loss.min(1, keepdims=True) - loss)
    share /= share.sum(1, keepdims=True)
    order = np.argsort(-share, 1, kind="stable")
    top = order[:, 0]
    return top, share[np.arange(len(top)), top], order[:, min(1, len(model.langs) - 1)]


def predict(model: Model | None, col: pa.Array) -> pa.StructArray:
    data, offs = T.raw(col)
    n = len(offs) - 1
    langs, score, second = np.full(n, "und", object), np.zeros(n), np.full(n, None, object)
    letters = np.zeros(n, bool)
    for i, j in T.slices(offs, SLICE) if model else ():
        at = offs[i : j + 1] - offs[i]
        part = data[offs[i] : offs[j]]
        ascii_ = np.concatenate(([0], np.cumsum((part | 32) - 97 < 26)))  # uint8 wraps below 'a'
        letters[i:j] = ascii_[at[1:]] > ascii_[at[:-1]]
        for k in np.flatnonzero(~letters[i:j]):
            letters[i + k] = bool(_LETTER.search(bytes(part[at[k] : at[k + 1]]).decode("utf-8", "replace")))
        bucket, first = trigrams(part, at)
        total = np.zeros((len(bucket) + 1, model.weight.shape[1]))
        np.cumsum(model.weight[bucket], 0, out=total[1:], dtype=np.float64)
        count = np.diff(first)
        margin = (total[first[1:]] - total[first[:-1]]) / np.maximum(count, 1)[:, None] * np.minimum(count, CERTAIN)[:, None]
        top, share, runner = decode(model, margin)
        langs[i:j], score[i:j], second[i:j] = np.array(model.langs, object)[top], share, np.array(model.langs, object)[runner]
    langs[~letters], score[~letters], second[~letters] = "und", 0.0, None
    return pa.StructArray.from_arrays(
        [pa.array(langs, pa.string()), pa.array(score), pa.array(second, pa.string()), pa.array(letters & (score < AMBIGUOUS))],
        ["lang_pred", "score", "runner_up", "ambiguous"],
    )


def identify(model: Model | None, spark, text: Column) -> Column:
    """A column of struct<lang_pred, score, runner_up, ambiguous> for a column of texts."""
    held = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred string, score double, runner_up string, ambiguous boolean>")
    def lang_of(col: pa.Array) -> pa.Array:
        return predict(held.value, col)

    return lang_of.asNondeterministic()(text.cast("string"))  # else a filter on it could run it twice
