"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text is cut into small paragraphs: at line ends, and after words whose hash is 0 modulo WORDS and after LONGEST words, so
an edit changes only paragraphs near it. Each paragraph's digest (and its number, if it is repeated) goes to HASHES cells, one in each part of the table; a cell holds a
count, a sum of digests and a sum of checks. Two sketches of a size are subtracted cell by cell; peeling cells of count
+1 or -1 whose check fits recovers the digests that differ. If cells are left over, the sketches are made again twice as
large, up to a size at which peeling is sure for all but vanishing odds; what even that leaves is counted exactly.
Likeness is common / all paragraphs of the two texts (1 for two texts without words). Null counts as empty.
The fingerprint is the sketch of CELLS cells as text, led by the number of digests.

All pairs of a batch are subtracted and peeled together in NumPy.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .common import partitions

WORDS, LONGEST, HASHES, CELLS, LARGEST = 4, 8, 3, 24, 1 << 22
_SALT = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def paragraphs(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(digest, text), by text; the k-th copy of a paragraph has its own digest. A text without words has none."""
    h, starts, ends, first = T.words(data, offs)
    if not len(h):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(offs) - 1), np.diff(first))
    lines = np.concatenate(([0], np.cumsum(data == 10)))[starts]
    new = np.concatenate(([True], (owner[1:] != owner[:-1]) | (lines[1:] != lines[:-1]) | (h[:-1] % np.uint64(WORDS) == 0)))
    at = np.flatnonzero(new)
    place = np.arange(len(h)) - np.repeat(at, np.diff(np.append(at, len(h))))
    at, place = np.flatnonzero(place % LONGEST == 0), (place % LONGEST).astype(np.uint64)
    digest, owner = T.mix(np.add.reduceat(T.mix(h + place * _SALT[0]), at)), owner[at]
    order = np.lexsort((digest, owner))
    digest, owner = digest[order], owner[order]
    run = np.flatnonzero(np.concatenate(([True], (digest[1:] != digest[:-1]) | (owner[1:] != owner[:-1]))))
    nth = np.arange(len(digest)) - np.repeat(run, np.diff(np.append(run, len(digest))))
    return T.mix(digest + nth.astype(np.uint64) * _SALT[1]), owner


def cells(digest: np.ndarray, base: np.ndarray, size: np.ndarray) -> np.ndarray:
    """HASHES rows: the cell of each digest in its table, which begins at base and has size cells (a multiple of HASHES)."""
    part = (size // HASHES).astype(np.uint64)
    return np.stack([base + k * part.astype(np.int64) + (T.mix(digest ^ _SALT[k]) % part).astype(np.int64) for k in range(HASHES)])


def sketch(digest: np.ndarray, owner: np.ndarray, sign: np.ndarray, base: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells (count, sum of digests, sum of checks) of all tables in a row; base, size: by table, owner: a digest's table."""
    n = int(base[-1] + size[-1]) if len(base) else 0
    count, total, check = np.zeros(n, np.int64), np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    at, u = cells(digest, base[owner], size[owner]), sign.astype(np.uint64)
    for row in at:
        np.add.at(count, row, sign)
        np.add.at(total, row, digest * u)
        np.add.at(check, row, T.mix(digest + _SALT[2]) * u)
    return count, total, check


def peel(count, total, check, base, size) -> tuple[np.ndarray, np.ndarray]:
    """(recovered digests of each table, whether all were), from subtracted cells, which are used up."""
    table = np.repeat(np.arange(len(base)), size)
    found = np.zeros(len(base), np.int64)
    at = np.arange(len(count))
    while True:
        at = at[np.abs(count[at]) == 1]
        sign = count[at].astype(np.uint64)
        digest = total[at] * sign
        ok = check[at] * sign == T.mix(digest + _SALT[2])
        at, digest = at[ok], digest[ok]
        if not len(at):
            break
        order = np.lexsort((digest, table[at]))
        at, digest = at[order], digest[order]
        keep = np.concatenate(([True], (digest[1:] != digest[:-1]) | (table[at[1:]] != table[at[:-1]])))
        at, digest = at[keep], digest[keep]
        s, owner = count[at].copy(), table[at]
        found += np.bincount(owner, minlength=len(base))
        touched = cells(digest, base[owner], size[owner])
        u = s.astype(np.uint64)
        for row in touched:
            np.subtract.at(count, row, s)
            np.subtract.at(total, row, digest * u)
            np.subtract.at(check, row, T.mix(digest + _SALT[2]) * u)
        at = np.unique(touched)
    left = np.bincount(table[(count != 0) | (total != 0)], minlength=len(base)) if len(table) else np.zeros(len(base), int)
    return found, left == 0


def differences(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], n: int) -> np.ndarray:
    """For each of n pairs of texts the number of digests that one has and the other has not; a, b: (digest, text), by text."""
    out = np.zeros(n, np.int64)
    todo, size = np.arange(n), np.full(n, CELLS, np.int64)
    first = [np.searchsorted(x[1], np.arange(n + 1)) for x in (a, b)]
    while len(todo):
        table = np.full(n, -1)
        table[todo] = np.arange(len(todo))
        base = np.cumsum(size[todo]) - size[todo]
        owner = [table[x[1]] for x in (a, b)]
        digest = np.concatenate([x[0][o >= 0] for x, o in zip((a, b), owner, strict=True)])
        sign = np.concatenate([np.full((o >= 0).sum(), s, np.int64) for o, s in zip(owner, (1, -1), strict=True)])
        found, done = peel(*sketch(digest, sign=sign, owner=np.concatenate([o[o >= 0] for o in owner]), base=base, size=size[todo]), base, size[todo])
        out[todo[done]] = found[done]
        todo = todo[~done]
        size[todo] *= 2
        for k in todo[size[todo] > LARGEST]:  # larger than any table: compared as they are
            out[k] = len(np.setxor1d(*[x[0][f[k] : f[k + 1]] for x, f in zip((a, b), first, strict=True)]))
        todo = todo[size[todo] <= LARGEST]
    return out


def prints(p: tuple[np.ndarray, np.ndarray], n: int) -> list[str]:
    """Each text's sketch of CELLS cells as text."""
    size = np.full(n, CELLS, np.int64)
    base = np.arange(n, dtype=np.int64) * CELLS
    count, total, check = sketch(p[0], p[1], np.ones(len(p[0]), np.int64), base, size)
    rows = np.zeros(n * CELLS, np.dtype([("c", "<i4"), ("t", "<u8"), ("k", "<u4")]))
    rows["c"], rows["t"], rows["k"] = count, total, check & np.uint64(0xFFFFFFFF)
    raw, step, digests = rows.tobytes(), CELLS * 16, np.bincount(p[1], minlength=n)
    return [f"{d}:" + base64.b85encode(raw[i * step : (i + 1) * step]).decode() for i, d in enumerate(digests.tolist())]


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], n: int) -> np.ndarray:
    both = np.bincount(a[1], minlength=n) + np.bincount(b[1], minlength=n)
    d = differences(a, b, n)
    return np.where(both == 0, 1.0, (both - d) / np.maximum(both + d, 1))


def digests(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    data, offs = T.raw(pa.array(texts, pa.large_string()))
    parts = [(0, np.zeros(0, np.uint64), np.zeros(0, np.int64))]
    for i, j in T.slices(offs):
        parts.append((i, *paragraphs(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i])))
    return np.concatenate([d for _, d, _ in parts]), np.concatenate([o + i for i, _, o in parts])


def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by as many first ones of the following text, or all."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


def compare(rows: list[tuple]) -> pa.RecordBatch:
    """The result for (key, text, following text) rows."""
    texts, nexts = [t for _, t, _ in rows], [x for *_, x in rows]
    edits = [edited(t, x) for t, x in zip(texts, nexts, strict=True)]
    n = len(rows)
    a, e, f = digests(texts), digests(edits), digests(nexts)
    return pa.RecordBatch.from_arrays(
        [pa.array([k for k, *_ in rows], pa.int64()), pa.array([len(t) for t in texts], pa.int64()), pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edits]),
         pa.array(prints(a, n), pa.string()), pa.array(prints(e, n), pa.string()), pa.array(likeness(a, e, n)), pa.array(likeness(a, f, n))],
        ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    )


def neighbours(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each text, its edited text and their likeness; see op8's contract for the columns.

    The next document is the next in descending key (long); null keys come last, ties by hash and text; after the last
    comes the first. Keys are cut into ranges; a range gets a copy of the first row of the range after it, so texts are
    shuffled once and no range is longer than its share. A single row is its own neighbour; empty input gives no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("k"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))
    n, total = rows.agg(F.count(F.lit(1)), F.sum(F.octet_length("t"))).first()
    parts = min(partitions(spark, total or 0, 16 << 20), max(1, (n or 0) // 4))
    cuts = rows.agg(F.percentile_approx("k", F.array(*[F.lit(i / parts) for i in range(1, parts)]), 100 * parts)).first()[0] if parts > 1 else []
    edges = np.unique(np.array(cuts or [], np.int64))

    def place(col: pa.Array) -> pa.Array:  # range 0 has the largest keys; null keys are in the last
        none = np.array(col.is_null())
        found = len(edges) - np.searchsorted(edges, col.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), "left")
        return pa.array(np.where(none, len(edges), found).astype(np.int32))

    @F.arrow_udf("int")
    def range_of(col: pa.Array) -> pa.Array:
        return place(col)

    tops = sorted(rows.select(range_of("k").alias("r"), "k").groupBy("r").agg(F.max("k").alias("k")).collect(), key=lambda x: x.r)
    before = {x.r: tops[i - 1].r for i, x in enumerate(tops)}  # the first range follows the last
    first = {x.k: x.r for x in tops}  # bounded by the number of ranges

    def also(batches):
        """Each row in its range, the rows of a range's first key once more in the range before."""
        for batch in batches:
            r = np.array(place(batch.column(0)))
            extra = [i for i, k in enumerate(batch.column(0).to_pylist()) if k in first and first[k] == r[i]]
            yield pa.RecordBatch.from_arrays([pa.array(r), pa.array(np.zeros(len(r), bool)), batch.column(0), batch.column(1).cast(pa.string())], ["r", "guard", "k", "t"])
            if extra:
                to = pa.array([before[r[i]] for i in extra], pa.int32())
                yield pa.RecordBatch.from_arrays([to, pa.array([True] * len(extra)), batch.column(0).take(pa.array(extra)), batch.column(1).cast(pa.string()).take(pa.array(extra))], ["r", "guard", "k", "t"])

    def run(batches) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # the row whose next is to come
        out: list[tuple] = []
        size = 0
        for batch in batches:
            for r, guard, k, t in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if held and held[0] == r:
                    out.append((held[1], held[2], t))
                    size += len(t) + len(held[2])
                held = None if guard else (r, k, t)
                if size > 1 << 20:
                    yield compare(out)
                    out, size = [], 0
        if out:
            yield compare(out)

    placed = rows.mapInArrow(also, "r int, guard boolean, k bigint, t string").repartition(parts, "r")
    placed = placed.sortWithinPartitions("r", "guard", F.col("k").desc_nulls_last(), F.xxhash64("t"), "t")
    return placed.mapInArrow(run, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
