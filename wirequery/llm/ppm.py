"""Language-model scoring by prediction by partial matching over bytes, beside a unigram word model.

The model is the trie of all byte contexts of up to ORDER bytes with the bytes that follow them in the training texts.
A byte's probability is taken in its longest context; unseen there, the coder escapes (method D: half the distinct
followers / occurrences; a seen byte loses half a count) to the next shorter context, in which the bytes already ruled out are excluded, and at last to
a uniform choice. What is coded is the sequence of a text's words, the same that the word model scores: A-Z as a-z, one blank
between two words. Texts are framed by a start byte (0xFE, ORDER times) and an end byte (0xFF), which UTF-8 never uses.

How it scales: docs are written once, with the partition of each row as its block, so any docs will do and lost executors
change nothing. A block's distinct (context, byte) pairs and words are counted once;
pairs are grouped by the last three context bytes, so contexts of 3 and more bytes are complete there, while the tables
of shorter contexts have a fixed bound (2^24 pairs) and are broadcast. Log-probabilities go back to the blocks that asked
and are cogrouped with their texts: memory follows the block, never the corpus. A pair that is missing at the end
raises an error.

Null texts count as empty: their score is that of the end alone. Without training texts every byte is uniform. Rows that
share a key each have a result; equal texts get equal scores. Only the key and the text are read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import text as T
from .common import cut

ORDER, START, STOP, ALPHABET, UNIT = 5, 0xFE, 0xFF, 256, 1e7
#: Bytes of texts taken at a time; each takes up to some 100 bytes of memory meanwhile.
SLICE = 1 << 18
_U8 = np.uint64(8)
#: Bits of a key below its last two, and its last three, context bytes.
_LOW, _GROUP = np.uint64(8 * (ORDER - 1)), np.uint64(8 * (ORDER - 2))


def spell(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts as words with one blank between two, A-Z as a-z: (bytes, offsets)."""
    starts, ends, first = T.spans(~T.SPACE[data], offs)
    keep = ~T.SPACE[data]
    last = np.zeros(len(ends), bool)
    last[first[1:][np.diff(first) > 0] - 1] = True
    blank = ends[~last]  # a word that isn't its text's last is followed by a blank
    keep[blank] = True
    out = data.copy()
    out[blank] = 32
    upper = (out >= 65) & (out <= 90)
    out[upper] += 32
    at = np.concatenate(([0], np.cumsum(keep)))
    return out[keep], at[offs]


def pairs(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, text) of every byte and end of the spelled texts: the context's bytes, last one first, then the byte; 8 bits each."""
    data, offs = spell(data, offs)
    n, sizes = len(offs) - 1, np.diff(offs)
    frame = np.full(len(data) + n * (ORDER + 1), START, np.uint64)
    at = offs[:-1] + np.arange(n) * (ORDER + 1) + ORDER
    owner = np.repeat(np.arange(n), sizes)
    frame[np.arange(len(data)) + owner * (ORDER + 1) + ORDER] = data
    frame[at + sizes] = STOP
    owner = np.repeat(np.arange(n), sizes + 1)
    place = np.arange(len(owner)) + owner * ORDER + ORDER
    key = frame[place - 1]
    for k in range(2, ORDER + 1):
        key = (key << _U8) | frame[place - k]
    return (key << _U8) | frame[place], owner


def _tally(key: np.ndarray, learn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys, training occurrences); the flag goes in a lowest bit, so one plain sort does."""
    x = (key << np.uint64(1)) | learn
    x.sort()
    new = np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1]))) if len(x) else np.zeros(0, np.int64)
    u, n = x[new], np.diff(np.append(new, len(x)))
    n[(u & np.uint64(1)) == 0] = 0
    return _merge(u >> np.uint64(1), n)


def _merge(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum n by key; keys come out sorted."""
    order = np.argsort(key, kind="stable")  # merges sorted runs
    key, n = key[order], n[order]
    if not len(key):
        return key, n
    new = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    return key[new], np.add.reduceat(n, new)


class Table:
    """Lookup of sorted keys through a hash table of their places; keys that collide are searched for."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.keys, self.values = keys, values
        self.shift = np.uint64(64 - max(10, int(8 * len(keys) + 1).bit_length()))
        self.place = np.zeros(1 << (64 - int(self.shift)), np.int32)
        self.place[self._slot(keys)] = np.arange(len(keys), dtype=np.int32)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, wanted: np.ndarray) -> np.ndarray:
        if not len(wanted):
            return self.values[:0]
        if len(self.keys):
            k = self.place[self._slot(wanted)]
            lost = np.flatnonzero(self.keys[k] != wanted)
            k[lost] = np.minimum(np.searchsorted(self.keys, wanted[lost]), len(self.keys) - 1)
            if (self.keys[k[lost]] == wanted[lost]).all():
                return self.values[k]
        raise RuntimeError("docs changed its partitions between two reads; write it to a table first")


def _count(batches):
    """(block, kind, key, n): kind 0 pairs, 1 words, 2 pairs of order 2, 3 texts; n: their training occurrences."""
    held: dict[tuple[int, int], list] = {}
    for batch in batches:
        blocks = batch.column(0).to_numpy()
        data, offs = T.raw(batch.column(1))
        train = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
        runs = np.flatnonzero(np.concatenate(([True], blocks[1:] != blocks[:-1]))).tolist() if len(blocks) else []
        spans = [(a + i, a + j, int(blocks[a])) for a, b in zip(runs, [*runs[1:], len(blocks)]) for i, j in T.slices(offs[a : b + 1], SLICE)]
        for i, j, block in spans:
            if held and (block, 3) not in held:  # the block before is through
                yield from _emit(held)
                held = {}
            part, local = data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
            key, owner = pairs(part, local)
            h, _, _, first = T.words(part, local)
            word_owner = np.repeat(np.arange(j - i), np.diff(first))
            low = ((key >> _LOW) << _U8) | (key & np.uint64(255))
            learn = train[i:j]
            for kind, k, o in ((0, key, owner), (1, _word(h), word_owner), (2, low[learn[owner]], owner[learn[owner]])):
                parts = held.setdefault((block, kind), [])
                parts.append(_tally(k, learn[o]))
                if len(parts) == 12:
                    parts[:] = [_merge(*map(np.concatenate, zip(*parts, strict=True)))]
            held.setdefault((block, 3), []).append((np.zeros(1, np.uint64), np.array([learn.sum()])))
    yield from _emit(held)


def _emit(held: dict[tuple[int, int], list]):
    for (block, kind), parts in held.items():
        u, n = _merge(*map(np.concatenate, zip(*parts, strict=True)))
        for i in range(0, len(u), 100_000):
            m = len(u[i : i + 100_000])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(m, block, np.int32)), pa.array(np.full(m, kind, np.int32)), pa.array(u[i : i + 100_000].view(np.int64)), pa.array(n[i : i + 100_000])], ["block", "kind", "key", "n"])


def _word(h: np.ndarray) -> np.ndarray:
    """63 bits of a word's hash, which leave room for a flag."""
    return h >> np.uint64(1)


def _groups(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct ids, index of each) of sorted ids."""
    if not len(ids):
        return ids, np.zeros(0, np.int64)
    new = np.concatenate(([True], ids[1:] != ids[:-1]))
    return ids[new], np.cumsum(new) - 1


def _at(sorted_: np.ndarray, wanted: np.ndarray, values: np.ndarray) -> np.ndarray:
    """values at the places of wanted in sorted_, 0 where there is none."""
    if not len(sorted_):
        return np.zeros(len(wanted))
    k = np.minimum(np.searchsorted(sorted_, wanted), len(sorted_) - 1)
    return np.where(sorted_[k] == wanted, values[k], 0)


class Trie:
    """Contexts of up to 2 bytes, from training counts of (last byte, byte before, byte) keys."""

    def __init__(self, key: np.ndarray, n: np.ndarray):
        order = np.argsort(key)
        self.key, self.n = [key[order]], [n[order].astype(float)]  # orders 2, 1, 0
        for shorter in (1, 0):
            k = self.key[-1]
            low = (((k >> np.uint64(16)) << _U8) if shorter else np.uint64(0)) | (k & np.uint64(255))
            u, inverse = np.unique(low, return_inverse=True)
            self.key.append(u)
            self.n.append(np.bincount(inverse, self.n[-1], len(u)))
        self.ctx, self.total, self.kinds, self.out_n = [], [], [], []
        for level in range(3):
            ctx, g = _groups(self.key[level] >> _U8)
            self.ctx.append(ctx)
            self.total.append(np.bincount(g, self.n[level], len(ctx)))
            self.kinds.append(np.bincount(g, minlength=len(ctx)).astype(float))
            if level < 2:  # what this context's followers weigh in the next shorter one
                shorter = ((ctx >> _U8) if level == 0 else ctx * np.uint64(0))[g]
                weigh = _at(self.key[level + 1], (shorter << _U8) | (self.key[level] & np.uint64(255)), self.n[level + 1])
                self.out_n.append(np.bincount(g, weigh, len(ctx)))

    def log(self, ctx: np.ndarray, sym: np.ndarray, gone_n: np.ndarray, gone_d: np.ndarray) -> np.ndarray:
        """log10 probability of sym after ctx (last byte, byte before), gone_n, gone_d: weight and number of the bytes
        that a longer context has excluded there."""
        out, todo = np.zeros(len(ctx)), np.arange(len(ctx))
        for level in range(3):
            c = ctx[todo] if level == 0 else ctx[todo] >> _U8 if level == 1 else ctx[todo] * np.uint64(0)
            total, kinds = _at(self.ctx[level], c, self.total[level]), _at(self.ctx[level], c, self.kinds[level])
            n = _at(self.key[level], (c << _U8) | sym[todo], self.n[level])
            hit, rest = step(out, todo, n, total - gone_n, kinds - gone_d)
            gone_n = (_at(self.ctx[level], c, self.out_n[level]) if level < 2 else gone_n)[rest]
            todo, gone_d = todo[rest], kinds[rest]
        out[todo] -= np.log10(ALPHABET - gone_d)
        return out


def step(out: np.ndarray, todo: np.ndarray, n: np.ndarray, total: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code what a context has seen, escape for the rest; total, kinds: without what is excluded."""
    hit, rest = n > 0, n <= 0
    out[todo[hit]] += np.log10((n[hit] - 0.5) / total[hit])
    esc = rest & (kinds > 0)  # a context with nothing left to offer is skipped at no cost
    out[todo[esc]] += np.log10(kinds[esc] / (2 * total[esc]))
    return hit, rest


def logs(trie: Trie, key: np.ndarray, n: np.ndarray) -> np.ndarray:
    """log10 probability of each pair; key: sorted, distinct, all that share three last context bytes; n: training counts."""
    byte = np.uint64(255)
    pair, count, at = key, n.astype(float), np.arange(len(key))  # of the order at hand; at: the pair of each key there
    out, todo = np.zeros(len(key)), np.arange(len(key))
    gone_n, gone_d = np.zeros(len(key)), np.zeros(len(key))  # what the longer context of each key has excluded
    for order in range(ORDER, 2, -1):
        ctx, g = _groups(pair >> _U8)
        total, kinds = np.bincount(g, count, len(ctx)), np.bincount(g, count > 0, len(ctx)).astype(float)
        low = ((pair >> np.uint64(16)) << _U8) | (pair & byte)
        if order > 3:
            shorter, inverse = np.unique(low, return_inverse=True)
            weight = np.bincount(inverse, count, len(shorter))
            seen = weight[inverse]
        else:
            seen = _at(trie.key[0], low, trie.n[0])
        gone = np.bincount(g, np.where(count > 0, seen, 0), len(ctx))
        of = g[at[todo]]
        _, rest = step(out, todo, count[at[todo]], total[of] - gone_n[todo], kinds[of] - gone_d[todo])
        todo, of = todo[rest], of[rest]
        gone_n[todo], gone_d[todo] = gone[of], kinds[of]
        if order > 3:
            pair, count, at = shorter, weight, inverse[at]
    out[todo] += trie.log(key[todo] >> _LOW, key[todo] & byte, gone_n[todo], gone_d[todo])
    return out


def _price(held):
    """(block, kind, key, value, keys, values): keys and values of a block's pairs, packed; they come sorted by key, and a
    group of three context bytes is worked on as a whole."""

    def done(block, key, n):
        u, g = _groups(key)
        value = np.rint(-logs(held.value, u, np.bincount(g, n, len(u))) * UNIT).astype(np.int32)[g]
        order = np.argsort(block, kind="stable")  # each block's pairs in one row
        blocks, first = np.unique(block[order], return_index=True)
        ends = np.append(first[1:], len(block))[: len(first)].tolist()
        packed = [[x[order][a:b].tobytes() for a, b in zip(first.tolist(), ends, strict=True)] for x in (key, value)]
        columns = [pa.array(blocks.astype(np.int32)), pa.array(np.zeros(len(blocks), np.int32)), *[pa.nulls(len(blocks), pa.int64())] * 2, *[pa.array(x, pa.binary()) for x in packed]]
        return pa.RecordBatch.from_arrays(columns, ["block", "kind", "key", "value", "keys", "values"])

    def run(batches):
        rest: list[list[np.ndarray]] = []
        for batch in batches:
            if not len(batch):
                continue
            block, key, n = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            key = key.view(np.uint64)
            split = int(np.searchsorted(key, (key[-1] >> _GROUP) << _GROUP))
            if split == 0 and rest and rest[-1][1][-1] >> _GROUP == key[-1] >> _GROUP:
                rest.append([block, key, n])
                continue
            yield done(*(np.concatenate(x) for x in zip(*rest, [block[:split], key[:split], n[:split]], strict=True)))
            rest = [[block[split:], key[split:], n[split:]]]
        if rest:
            yield done(*(np.concatenate(x) for x in zip(*rest, strict=True)))

    return run


SCHEMA = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


def _sum(tokens: int, kinds: int, ends: int):
    bottom = tokens + kinds + 1

    def run(docs: pa.Table, model: pa.Table) -> pa.Table:
        pair = model.filter(pc.equal(model.column("kind"), 0))
        key, value = (np.frombuffer(b"".join(pair.column(c).to_pylist()), t) for c, t in (("keys", np.uint64), ("values", np.int32)))
        order = np.argsort(key)
        price = Table(key[order], value[order].astype(np.int64))
        word = model.filter(pc.equal(model.column("kind"), 1))
        key, value = word.column("key").to_numpy().view(np.uint64), word.column("value").to_numpy()
        order = np.argsort(key)
        count = Table(key[order], value[order])
        out: list[list] = [[] for _ in range(4)]
        for batch in docs.select(["text"]).to_batches(max_chunksize=1000):
            data, offs = T.raw(batch.column(0))
            for i, j in T.slices(offs, SLICE):
                part, local, m = data[offs[i] : offs[j]], offs[i : j + 1] - offs[i], j - i
                k, owner = pairs(part, local)
                score = -np.bincount(owner, price.find(k), m) / UNIT
                h, _, _, first = T.words(part, local)
                owner = np.repeat(np.arange(m), np.diff(first))
                c = count.find(_word(h))
                base = np.bincount(owner, np.log10((c + 1) / bottom), m) + math.log10((ends + 1) / bottom)
                for o, x in zip(out, (np.diff(first) + 1, np.bincount(owner, c > 0, m) + (ends > 0), base, score), strict=True):
                    o.append(x)
        n_tokens, n_known, base, score = (np.concatenate(o) if o else np.zeros(0) for o in out)
        return pa.table({
            "doc_id": docs.column("doc_id"), "held_out": docs.column("held_out"), "n_tokens": n_tokens.astype(np.int64), "n_known": n_known.astype(np.int64),
            "train_tokens": np.full(len(score), tokens, np.int64), "base_score": base, "score": score,
        })

    return run


def score(docs: DataFrame, held_out: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Score all docs with the models of those that aren't held_out."""
    spark = docs.sparkSession
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    texts = cut(docs.select(F.spark_partition_id().alias("block"), F.col(key).cast("long").alias("doc_id"), body.alias("text"), held_out.alias("held_out")), "texts")
    rows = texts.select("block", "text", (~F.col("held_out")).alias("train"))
    counts = cut(rows.mapInArrow(_count, "block int, kind int, key bigint, n bigint"), "counts")
    low = counts.filter("kind = 2").groupBy("key").agg(F.sum("n").alias("n")).toPandas()
    trie = spark.sparkContext.broadcast(Trie(low["key"].to_numpy(np.int64).view(np.uint64), low["n"].to_numpy(np.int64)))
    ends = counts.filter("kind = 3").agg(F.sum("n")).first()[0] or 0
    words = counts.filter("kind = 1")
    tokens = (words.agg(F.sum("n")).first()[0] or 0) + ends
    kinds = words.filter("n > 0").select("key").distinct().count() + (ends > 0)
    # One exchange: a word has one row a block, and the rows of a word get its sum.
    word = words.select("block", "kind", "key", F.sum("n").over(Window.partitionBy("key")).alias("value"), *[F.lit(None).cast("binary").alias(c) for c in ("keys", "values")])
    pair = counts.filter("kind = 0").select("block", "key", "n")
    pair = pair.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1), F.shiftright("key", int(_GROUP))).sortWithinPartitions("key")
    price = pair.mapInArrow(_price(trie), "block int, kind int, key bigint, value bigint, keys binary, values binary")
    return texts.groupBy("block").cogroup(price.unionByName(word).groupBy("block")).applyInArrow(_sum(tokens, kinds, ends), SCHEMA)
