"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment of words.

Words are runs of letters and digits, A-Z as a-z; each character of a script written without spaces (Chinese, kana, Hangul,
Thai, Lao) is a word. Every SEED-word gram of a test item is counted over all documents;
an item keeps its rare ones. A document that holds a kept seed is aligned with the item around the seeds: +2 for equal
words, -1 for a differing, missing or added word. The score is the alignment's over that of an exact copy.

An item of fewer words than a seed is a seed as a whole, found wherever its words follow each other. If that is in more
documents than a rare seed may be (a plain "yes"), it is no evidence and matches only a text of just these words.

Each passage of an item gives a match; of overlapping ones the best stays, and passages so near that their diagonals differ
by less than a third of the item may count as one. The test items are worked through in blocks of BLOCK bytes, each small
enough to broadcast, against all documents. Null and empty texts match nothing, nor do items without words. Repeated
documents and items each give rows of their own. Whole texts are read, however long, in slices. Only the named columns are
read; all others of docs may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as T

#: Words in a seed; bytes of items in a block; score from which a document is contaminated.
SEED, BLOCK, CONTAMINATED = 3, 4 << 20, 0.45
#: A seed is rare in up to this share of the documents (10 at least), or in up to 4 times as many as the item's lower
#: quartile, so an item that is itself often copied keeps its seeds; the 8 rarest are kept in any case.
RARE, RARE_COUNT, TIMES, LEAST = 1e-3, 10, 4, 8
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
#: First bytes, in UTF-8, of U+3000 to U+DFFF and of all above U+FFFF: their characters are words of their own.
_ALONE = np.zeros(256, bool)
_ALONE[[*range(0xE3, 0xEE), *range(0xF0, 0xF5)]] = True


@dataclass
class Block:
    ids: list
    words: list[np.ndarray]
    seeds: np.ndarray  # distinct, sorted
    where: list[list[tuple[int, int]]] = field(default_factory=list)  # by seed: (item, position)
    sizes: tuple[int, ...] = ()  # words in its seeds
    common: frozenset[int] = frozenset()  # items that match only a text of just their words
    table: np.ndarray | None = None

    def find(self, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions in g that are seeds, index of the seed)."""
        if self.table is None:
            self.table = np.zeros(1 << 20, bool)
            self.table[(self.seeds >> np.uint64(44)).astype(np.int64)] = True
        at = np.flatnonzero(self.table[(g >> np.uint64(44)).astype(np.int64)])
        k = np.searchsorted(self.seeds, g[at])
        ok = k < len(self.seeds)
        ok[ok] = self.seeds[k[ok]] == g[at[ok]]
        return at[ok], k[ok]


def tokens(data: np.ndarray, offs: np.ndarray):
    """(hashes, starts, ends, first word of each text and the total) of the words."""
    lead = _ALONE[data]
    thai = np.flatnonzero(data[:-1] == 0xE0)
    lead[thai[(data[thai + 1] >= 0xB8) & (data[thai + 1] <= 0xBB)]] = True
    at, edges = np.flatnonzero(lead), offs
    if len(at):
        edges = np.concatenate((offs, at, np.minimum(at + 3 + (data[at] >= 0xF0), len(data))))
    starts, ends, _ = T.spans(_WORD[data], edges)
    return T.hashes(data, starts, ends), starts, ends, np.searchsorted(starts, offs)


def grams(h: np.ndarray, first: np.ndarray, sizes: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text, first word in it) of the grams of each of these sizes."""
    counts = np.diff(first)
    doc = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(h)) - first[:-1][doc]
    parts = [(np.zeros(0, np.uint64), doc[:0], place[:0])]
    for n in sizes:
        if len(h) < n:
            continue
        m = len(h) - n + 1
        acc = np.full(m, n, np.uint64)
        for k in range(n):
            acc = acc * np.uint64(0xD6E8FEB86659FD93) + h[k : m + k]
        ok = doc[:m] == doc[n - 1 :]
        parts.append((T.mix(acc[ok]), doc[:m][ok], place[:m][ok]))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def blocks(bench: DataFrame, key: str = "item_id", text: str = "text", size: int = BLOCK) -> Iterator[Block]:
    """The items in blocks of about `size` bytes."""
    held, total = [], 0
    for row in bench.select(key, F.col(text).cast("string")).filter(F.col(text).isNotNull()).toLocalIterator():
        held.append(tuple(row))
        total += len(row[1])
        if total >= size:
            yield _block(held)
            held, total = [], 0
    if held:
        yield _block(held)


def _block(rows: list[tuple]) -> Block:
    data, offs = T.raw(pa.array([t for _, t in rows], pa.string()))
    h, _, _, first = tokens(data, offs)
    words = [h[first[i] : first[i + 1]] for i in range(len(rows))]
    size = np.minimum(np.diff(first), SEED)  # of an item's seeds
    sizes = tuple(n for n in range(1, SEED + 1) if (size == n).any())
    g, owner, place = grams(h, first, sizes)
    long = np.repeat(sizes, [int(np.maximum(np.diff(first) - n + 1, 0).sum()) for n in sizes]).astype(int)  # words of each gram
    own = long == size[owner]
    g, owner, place = g[own], owner[own], place[own]
    seeds, inverse = np.unique(g, return_inverse=True)
    where: list[list[tuple[int, int]]] = [[] for _ in seeds]
    for s, o, p in zip(inverse.tolist(), owner.tolist(), place.tolist(), strict=True):
        where[s].append((o, p))
    return Block([k for k, _ in rows], words, seeds, where, sizes)


def rare(docs: DataFrame, block: Block, text: str = "text") -> Block:
    """The block with only rare seeds, by their document counts over all docs."""
    held = docs.sparkSession.sparkContext.broadcast(block)

    def count(batches):
        b = held.value
        n, total = np.zeros(len(b.seeds), np.int64), 0
        for batch in batches:
            data, offs = T.raw(batch.column(0))
            total += len(offs) - 1
            for i, j in T.slices(offs):
                h, _, _, first = tokens(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
                g, owner, _ = grams(h, first, b.sizes)
                at, k = b.find(g)
                k, _ = T.distinct(k.astype(np.uint64), owner[at])
                n += np.bincount(k.astype(np.int64), minlength=len(n))
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(n[at], total))], ["seed", "n"])

    found = docs.select(F.col(text).cast("string")).mapInArrow(count, "seed bigint, n bigint").groupBy("seed").agg(F.sum("n").alias("n")).toPandas()
    n = np.zeros(len(block.seeds) + 1, np.int64)  # the last is the number of documents
    n[found["seed"].to_numpy(int)] = found["n"].to_numpy(int)
    mine: list[list[int]] = [[] for _ in block.ids]
    for s, places in enumerate(block.where):
        for item, _ in places:
            mine[item].append(s)
    kept: set[tuple[int, int]] = set()
    common = set()
    rarely = max(RARE * n[-1], RARE_COUNT)
    for item, seeds in enumerate(mine):
        counts = n[seeds]
        if len(seeds):
            most = max(rarely, TIMES * np.quantile(counts, 0.25))
            kept |= {(item, s) for s, c in zip(seeds, counts, strict=True) if c <= most} | {(item, seeds[k]) for k in np.argsort(counts, kind="stable")[:LEAST]}
        if len(block.words[item]) < SEED and counts.max(initial=0) > rarely:
            common.add(item)
    where = [[(i, p) for i, p in places if (i, s) in kept] for s, places in enumerate(block.where)]
    at = [s for s, places in enumerate(where) if places]
    return Block(block.ids, block.words, block.seeds[at], [where[s] for s in at], block.sizes, frozenset(common))


def align(item: np.ndarray, window: np.ndarray) -> tuple[int, int]:
    """(best local alignment score, end of it in the window), row by row; gaps along a row by a running maximum."""
    n = len(window)
    slope, h, best, end = np.arange(n), np.zeros(n + 1, np.int64), 0, 0
    for w in item:
        x = np.maximum(np.maximum(h[:-1] + np.where(window == w, 2, -1), h[1:] - 1), 0)
        x = np.maximum.accumulate(x + slope) - slope
        h[1:] = x
        k = int(x.argmax())
        if x[k] > best:
            best, end = int(x[k]), k + 1
    return best, end


def matches(block: Block, col: pa.Array, least: float) -> list[list[dict]]:
    """For each text its matches {item, score, start, end}; start and end are UTF-8 bytes."""
    data, offs = T.raw(col)
    out: list[list[dict]] = [[] for _ in range(len(offs) - 1)]
    for i, j in T.slices(offs):
        local = offs[i : j + 1] - offs[i]
        h, starts, ends, first = tokens(data[offs[i] : offs[j]], local)
        g, owner, place = grams(h, first, block.sizes)
        at, seed = block.find(g)
        if not len(at):
            continue
        counts = np.diff(first)
        by: dict[tuple[int, int], list[int]] = {}
        for d, at_, s in zip(owner[at].tolist(), place[at].tolist(), seed.tolist(), strict=True):
            for item, p in block.where[s]:
                if item not in block.common or counts[d] == len(block.words[item]):
                    by.setdefault((d, item), []).append(at_ - p)
        for (d, item), diagonals in by.items():
            words, size = block.words[item], len(block.words[item])
            doc, slack = h[first[d] : first[d + 1]], len(block.words[item]) // 3 + 4
            passages = []
            diagonals.sort()
            k = 0
            while k < len(diagonals):
                last = k
                while last + 1 < len(diagonals) and diagonals[last + 1] - diagonals[last] <= slack:
                    last += 1
                lo, hi = max(0, diagonals[k] - slack), min(len(doc), diagonals[last] + size + slack)
                for at_ in range(lo, hi, max(1, 8 * size + 64)):  # a long run of near diagonals is aligned in overlapping parts
                    part = doc[at_ : min(hi, at_ + 11 * size + 64)]  # a passage spans less than 3 times the item
                    score, end = align(words, part)
                    if score >= least * 2 * size:
                        back, length = align(words[::-1], part[:end][::-1])
                        passages.append((-score, at_ + end - length, at_ + end))
                k = last + 1
            taken: list[tuple[int, int, int]] = []
            for p in sorted(set(passages)):
                if all(p[2] <= q[1] or q[2] <= p[1] for q in taken):
                    taken.append(p)
            for score, a, b in sorted(taken, key=lambda p: p[1]):
                a, b = first[d] + a, first[d] + b - 1
                out[i + d].append({"item": item, "score": -score / (2 * size), "start": int(starts[a] - local[d]), "end": int(ends[b] - local[d])})
    return out


def _hits(held, least: float):
    named = pa.list_(pa.struct([("item", pa.string()), ("score", pa.float64()), ("start", pa.int64()), ("end", pa.int64())]))

    @F.arrow_udf("array<struct<item string, score double, start bigint, end bigint>>")
    def hits(col: pa.Array) -> pa.Array:
        ids = held.value.ids
        return pa.array([[m | {"item": None if ids[m["item"]] is None else str(ids[m["item"]])} for m in x] for x in matches(held.value, col, least)], named)

    return hits


def found(docs: DataFrame, bench: DataFrame, text: str = "text", key: str = "item_id", item_text: str = "text", least: float = CONTAMINATED) -> Column:
    """A column of array<struct<item_id, score, start, end>> for docs: the items that each text holds."""
    spark = docs.sparkSession
    kind = bench.schema[key].dataType
    columns = []
    for block in blocks(bench, key, item_text):
        held = spark.sparkContext.broadcast(rare(docs, block, text))
        hits = _hits(held, least)
        hit = hits.asNondeterministic()(F.col(text).cast("string"))
        columns.append(F.transform(hit, lambda x: F.struct(x["item"].cast(kind).alias("item_id"), *[x[k].alias(k) for k in ("score", "start", "end")])))
    empty = F.array().cast(f"array<struct<item_id {kind.simpleString()}, score double, start bigint, end bigint>>")
    return F.concat(empty, *columns) if columns else empty
