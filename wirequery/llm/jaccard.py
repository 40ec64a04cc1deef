"""Exact n-gram Jaccard join with components: a size-aware heavy-light join.

A text's set is its distinct SHINGLE-word shingles; texts with equal sets form a class, and classes are joined. With a
threshold t, two sets of sizes n and m that link share at least two shingles among the first n - ceil(t n) + 2 of either,
in any common order, and one among the first n - ceil(t n) + 1. Light sets (up to a boundary size) enumerate the
two-element subsets of their prefix as keys; heavy sets, and light ones near enough in size to link with them, put their
single prefix shingles into inverted lists. The boundary is the size that costs least, by the sizes found and the mean
length of the lists. The order takes rarer shingles first, by counts of all classes in 2^BITS hashed buckets, then the
hash: any order is exact, this one keeps widespread shingles out of the prefixes.

Lists are not turned into all pairs. In ROUNDS rounds each class is checked with up to three partners that its lists vote
for, which joins groups of copies with a number of checks in proportion to their size. Only then are the
pairs listed that share a key, fit in size, position and parity, and are still in different components. Parity: each
shingle flips one of 64 * PARITY bits of its class, so no more bits differ between two classes than shingles do, and a
pair with more differing bits than a link allows is no link. Sets of more than WIDE shingles, of which that rules out
little, have sketches too: the same with two to four bits a shingle, compared before texts are fetched. All candidates are
checked exactly on their whole texts; no link between different components is lost, so the components are exact.

Hot keys: a list of HOT classes or more, by the counts, is dealt over SALTS tasks when lists are told from single keys (it
is a list for sure); votes are taken in random parts of PART classes of a list, other ones each round; the last join has
written tables on both sides, which Spark's adaptive skew join splits. Texts are fetched only for classes of pairs that
are to be checked. Tables written in between are removed when they are used up.

Texts without words are linked with nothing. Null counts as empty. 64-bit hashes stand for shingles and classes (a false
merger among 10^9 classes has odds below 10^-1). Rows that repeat a text, or a key, are members of their classes. An empty
table gives no rows. Only the key and the text are read, so other columns may have any names.
"""

from __future__ import annotations

from functools import lru_cache, reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import text as T
from .common import Scope, small
from .components import components

SHINGLE, LIGHTEST, HEAVIEST, ROUNDS, PARITY = 5, 4, 64, 2, 8
#: Largest set whose parity words are all it has; larger ones have a sketch too.
WIDE = 32 * PARITY
#: Buckets of shingle counts, and of them those in a chunk.
BITS, CHUNK = 22, 1 << 14
#: Counted length from which a list is dealt over SALTS tasks (64 times the mean of a bucket at least); classes of a list
#: that vote together; share of a set's shingles in its prefix, about, for the mean length of a list.
HOT, SALTS, PART, RAREST = 100_000, 256, 4096, 0.27


def needed(n, percent: int):
    """Least overlap of a set of size n with any set that it links to."""
    return -(-percent * n // 100)


def sets(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct shingles, their text, sizes, class of each text): by text, then shingle; class 0 is the empty set."""
    h, _, _, first = T.words(data, offs)
    value, owner = T.distinct(*T.grams(h, first, SHINGLE))
    n = np.bincount(owner, minlength=len(offs) - 1)
    at = np.concatenate(([0], np.cumsum(n)))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(T.mix(value ^ np.uint64(0x5BD1E9955BD1E995)))))
    cls = T.mix(total[at[1:]] - total[at[:-1]] + n.astype(np.uint64))
    cls[n == 0] = 0
    return value, owner, n, cls.view(np.int64)


def parity(value: np.ndarray, owner: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, list[bytes | None]]:
    """(a row of PARITY words for each set, its sketch: None up to WIDE shingles); n: sizes.

    A sketch has two to four parity bits a shingle. Their number is a power of two, and what it folds to are the PARITY words.
    """
    blocks = np.exp2(np.ceil(np.log2(np.maximum(n / WIDE, 1)))).astype(np.int64)
    at = PARITY * np.concatenate(([0], np.cumsum(blocks)))
    out = np.zeros(at[-1], np.uint64)
    bit = T.mix(value + np.uint64(0x2545F4914F6CDD1D)) & (64 * PARITY * blocks[owner] - 1).astype(np.uint64)
    np.bitwise_xor.at(out, at[owner] + (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
    rows = np.bitwise_xor.reduceat(out.reshape(-1, PARITY), at[:-1] // PARITY, axis=0) if len(n) else np.zeros((0, PARITY), np.uint64)
    return rows, [out[i:j].tobytes() if j - i > PARITY else None for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def _pack(count: np.ndarray) -> bytes:
    """Counts in the least width that holds them; their number tells the width."""
    return count.astype(next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if count.max(initial=0) <= np.iinfo(t).max)).tobytes()


def _unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(data, {1: np.uint8, 2: np.uint16, 4: np.uint32, 8: np.uint64}[len(data) // CHUNK]).astype(np.int64)


def _profile(batches):
    """(id, hash, n, cls, bits, wide) of each row, and (chunk, counts) of the shingles of a partition's classes, in one pass."""
    count, seen = np.zeros(1 << BITS, np.int64), set()
    names, kinds = ["id", "th", "n", "cls", "bits", "wide", "chunk", "counts"], [pa.int64()] * 4 + [pa.list_(pa.int64()), pa.binary(), pa.int32(), pa.binary()]
    for batch in batches:
        data, offs = T.raw(batch.column(0))
        sizes, classes, bits, wide = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros((0, PARITY), np.uint64)], []
        for i, j in T.slices(offs):
            value, owner, n, cls = sets(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
            new = np.array([not (c in seen or seen.add(c)) for c in cls.tolist()], bool)
            np.add.at(count, (value[new[owner]] >> np.uint64(64 - BITS)).astype(np.int64), 1)
            sizes.append(n)
            classes.append(cls)
            rows, more = parity(value, owner, n)
            bits.append(rows)
            wide += more
        m = len(batch)
        ends = np.arange(0, m * PARITY + 1, PARITY, dtype=np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(bits).view(np.int64).ravel()))
        columns = [batch.column(1), batch.column(2), pa.array(np.concatenate(sizes).astype(np.int64)), pa.array(np.concatenate(classes)), lists, pa.array(wide, kinds[5])]
        yield pa.RecordBatch.from_arrays([*columns, pa.nulls(m, kinds[6]), pa.nulls(m, kinds[7])], names)
    for k in range(0, (1 << BITS) // CHUNK, 16):
        chunks = [(c, count[c * CHUNK : (c + 1) * CHUNK]) for c in range(k, k + 16)]
        chunks = [(c, x) for c, x in chunks if x.any()]
        yield pa.RecordBatch.from_arrays([*[pa.nulls(len(chunks), t) for t in kinds[:6]], pa.array([c for c, _ in chunks], kinds[6]), pa.array([_pack(x) for _, x in chunks], kinds[7])], names)


def _levels(batches):
    """(chunk, level of each bucket, classes in all, sum of their squares) of chunks that are in one partition each."""
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        for c, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            held[c] = held[c] + _unpack(x) if c in held else _unpack(x)
    at = list(held)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array([level(held[c]).tobytes() for c in at], pa.binary())], ["chunk", "levels"])


def level(count: np.ndarray) -> np.ndarray:
    """Counts on a scale of eight steps a doubling, one byte each."""
    return np.minimum(np.rint(8 * np.log2(1 + count)), 255).astype(np.uint8)


def list_length(rank: np.ndarray) -> tuple[float, float]:
    """(mean length of the lists of prefix shingles, those of the rarest buckets; mean count of a bucket), from levels."""
    count = np.bincount(rank, minlength=256)
    size = np.exp2(np.arange(256) / 8) - 1
    held = count * size  # occurrences by level
    total = held.sum()
    if not total:
        return 1.0, 0.0
    rarest = np.minimum(held, np.maximum(RAREST * total - (np.cumsum(held) - held), 0))
    mean = total / len(rank)
    return max(1.0, float((rarest * size).sum() / rarest.sum() - mean)), float(mean)


def boundary(sizes: list[tuple[int, int]], length: float, percent: int) -> int:
    """The largest light size that costs least; sizes: (size, sets of it); length: mean length of an inverted list."""
    best = (float("inf"), LIGHTEST)
    for b in range(LIGHTEST, HEAVIEST + 1):
        cost = 0.0
        for n, m in sizes:
            p = n - needed(n, percent) + 1
            if n <= b:
                cost += m * (p + 1) * p / 2
            if n > b or 100 * n >= percent * (b + 1):
                cost += m * p * (1 + length)
        best = min(best, (cost, b))
    return best[1]


@lru_cache(256)
def _two(p: int) -> tuple[np.ndarray, np.ndarray]:
    return np.triu_indices(p, 1)


def _keys(held, light: int, percent: int, hot: int):
    """(key, cls, n, pos, hot) of the prefixes; a class once a partition. hot: level of buckets from which lists are hot."""

    def run(batches):
        rank, seen = held.value, set()
        for batch in batches:
            data, offs = T.raw(batch.column(0))
            for i, j in T.slices(offs):
                value, owner, n, cls = sets(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
                new = np.array([c != 0 and not (c in seen or seen.add(c)) for c in cls.tolist()], bool)
                keep = new[owner]
                value, owner = value[keep], owner[keep]
                rare = rank[(value >> np.uint64(64 - BITS)).astype(np.int64)]
                order = np.lexsort((value, rare, owner))
                value, owner, rare = value[order], owner[order], rare[order]
                first = np.searchsorted(owner, np.arange(len(n)))
                pos = np.arange(len(value)) - first[owner]
                size = n[owner]
                single = ((size > light) | (100 * size >= percent * (light + 1))) & (pos < size - needed(size, percent) + 1)
                parts = [(value[single], cls[owner[single]], size[single], pos[single], rare[single] >= hot)]
                for d in np.flatnonzero(new & (n <= light) & (n > 1)).tolist():
                    a, b = _two(int(min(n[d], n[d] - needed(n[d], percent) + 2)))
                    v, r = value[first[d] : first[d] + n[d]], rare[first[d] : first[d] + n[d]]
                    x, y = v[a], v[b]
                    pair = T.mix(np.minimum(x, y) * np.uint64(0x9E3779B97F4A7C15) + np.maximum(x, y))
                    parts.append((pair, np.full(len(a), cls[d]), np.full(len(a), n[d]), b - 1, np.minimum(r[a], r[b]) >= hot))
                key, c, s, p, h = (np.concatenate(x) for x in zip(*parts, strict=True))
                columns = [pa.array(key.view(np.int64)), pa.array(c), pa.array(s.astype(np.int32)), pa.array(p.astype(np.int32)), pa.array(h)]
                yield pa.RecordBatch.from_arrays(columns, ["key", "cls", "n", "pos", "hot"])

    return run


def overlaps(percent: int):
    """A column function: whether two texts link."""

    @F.arrow_udf("boolean")
    def link(left: pa.Array, right: pa.Array) -> pa.Array:
        (da, oa), (db, ob) = T.raw(left), T.raw(right)
        out = np.zeros(len(oa) - 1, bool)
        for i, j in T.slices(oa + ob):
            m = j - i
            a, aw, an, _ = sets(da[oa[i] : oa[j]], oa[i : j + 1] - oa[i])
            b, bw, bn, _ = sets(db[ob[i] : ob[j]], ob[i : j + 1] - ob[i])
            value, owner = np.concatenate((a, b)), np.concatenate((aw, bw))
            order = np.lexsort((value, owner))
            value, owner = value[order], owner[order]
            same = (value[1:] == value[:-1]) & (owner[1:] == owner[:-1])
            both = np.bincount(owner[1:][same], minlength=m)
            out[i:j] = (both > 0) & (100 * both >= percent * (an + bn - both))
        return pa.array(out)

    return link


def sketched(percent: int):
    """A column function: whether sketches let two sets of so many shingles in all link; null sketches do."""

    @F.arrow_udf("boolean")
    def may(left: pa.Array, right: pa.Array, both: pa.Array) -> pa.Array:
        out = np.ones(len(left), bool)
        for i, (a, b, n) in enumerate(zip(left.to_pylist(), right.to_pylist(), both.to_pylist(), strict=True)):
            if a is not None and b is not None:
                a, b = sorted((np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)), key=len)
                differ = np.bitwise_count(a ^ np.bitwise_xor.reduce(b.reshape(-1, len(a)), axis=0))
                out[i] = (100 + percent) * int(differ.sum()) <= (100 - percent) * n
        return pa.array(out)

    return may


def _near(a: Column, b: Column, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _alike(n: Column, bits1: Column, bits2: Column, percent: int) -> Column:
    """Whether parity lets two sets of n shingles in all link."""
    differ = reduce(add, [F.bit_count(bits1[i].bitwiseXOR(bits2[i])) for i in range(PARITY)])
    return (100 + percent) * differ <= (100 - percent) * n


class _Join:
    """The tables of one join: rows (text, id, th) and classes (cls, n, id, th, bits)."""

    def __init__(self, rows: DataFrame, percent: int, scope: Scope):
        self.rows, self.percent, self.scope = rows, percent, scope
        self.link, self.may = overlaps(percent), sketched(percent)

    def lists(self) -> DataFrame:
        """(key, cls, n, pos, parts) of the keys that several classes have, near enough in size to link, and with enough
        left of the sets if this is what they share first; parts: how many parts of a list vote apart."""
        spark, by = self.rows.sparkSession, Window.partitionBy("key", "salt")
        found = self.found.filter("chunk is not null").select("chunk", "counts").repartition("chunk").mapInArrow(_levels, "chunk int, levels binary").collect()
        rank = np.zeros(1 << BITS, np.uint8)
        for r in found:
            rank[r.chunk * CHUNK : (r.chunk + 1) * CHUNK] = np.frombuffer(r.levels, np.uint8)
        sizes = self.classes.groupBy(F.when(F.col("n") <= 200, F.col("n")).otherwise(F.pow(2.0, F.ceil(F.log2("n"))).cast("long")).alias("n")).count().collect()
        length, mean = list_length(rank)
        light = boundary([(x["n"], x["count"]) for x in sizes], length, self.percent)
        hot = int(level(np.array([max(HOT, 64 * mean)]))[0])
        keys = self.rows.select("text").mapInArrow(_keys(spark.sparkContext.broadcast(rank), light, self.percent, hot), "key bigint, cls bigint, n int, pos int, hot boolean")
        keys = keys.withColumn("salt", F.when(F.col("hot"), F.pmod("cls", F.lit(SALTS))).otherwise(F.lit(0)).cast("int"))
        size = by.orderBy("n", "cls")
        keys = keys.withColumn("twin", F.lag("cls").over(size)).filter("twin is null or twin <> cls")  # of a class, by another partition
        me = F.struct(F.col("n").cast("long").alias("n"), (F.col("n") - F.col("pos")).cast("long").alias("left"))
        keys = keys.withColumns({"me": me, "before": F.lag(me).over(size), "after": F.lead(me).over(size), "least": F.min("n").over(by), "c": F.count(F.lit(1)).over(by)})
        near = lambda o: _near(F.col("me.n"), F.col(f"{o}.n"), self.percent)
        first = lambda left, other: (100 + self.percent) * left >= self.percent * (F.col("me.n") + other)
        pair = F.greatest(*[near(o) & first(F.least("me.left", f"{o}.left"), F.col(f"{o}.n")) for o in ("before", "after")])
        more = F.greatest(near("before"), near("after")) & first(F.col("me.left"), F.when(F.col("before").isNull(), F.col("after.n")).otherwise(F.col("least")))
        keys = keys.filter(F.col("hot") | F.when(F.col("c") == 2, pair).otherwise(more))
        parts = F.ceil(F.col("c") * F.when(F.col("hot"), SALTS).otherwise(1) / PART).cast("int")
        return self.scope.cut(keys.select("key", "cls", "n", "pos", parts.alias("parts")), "lists")

    def close(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that sketches let link."""
        asked = self.scope.cut(pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct(), "asked")
        held = self.found.filter("wide is not null").select("cls", "n", "wide").join(small(asked), "cls")
        held = self.scope.cut(held.groupBy("cls").agg(F.first("n").alias("n"), F.first("wide").alias("wide")), "sketches")
        a, b = (held.select(F.col("cls").alias(k), F.col("n").alias(f"n{k}"), F.col("wide").alias(f"w{k}")) for k in ("a", "b"))
        may = self.may.asNondeterministic()("wa", "wb", F.col("na") + F.col("nb"))
        out = self.scope.cut(pairs.select("a", "b").join(a, "a", "left").join(b.hint("merge"), "b", "left").select("a", "b", may.alias("ok")).filter("ok").select("a", "b"), "close")
        self.scope.free(asked, held)
        return out

    def check(self, pairs: DataFrame) -> DataFrame | None:
        """The pairs (a, b) that link, None if none does; texts are fetched only for classes of pairs that are close."""
        if not pairs.limit(1).count():
            return None
        pairs = self.close(pairs)
        if not pairs.limit(1).count():
            return None
        both = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
        wanted = self.scope.cut(both.join(self.classes, "cls").select("cls", F.col("id").alias("wid"), F.col("th").alias("wth")), "wanted")
        texts = self.rows.join(small(wanted), F.col("id").eqNullSafe(F.col("wid")) & (F.col("th") == F.col("wth")))
        texts = self.scope.cut(texts.groupBy("cls").agg(F.first("text").alias("text")), "texts")
        a, b = (texts.select(F.col("cls").alias(k), F.col("text").alias(f"t{k}")) for k in ("a", "b"))
        out = self.scope.cut(pairs.select("a", "b").join(a, "a").join(b.hint("merge"), "b").select("a", "b", self.link.asNondeterministic()("ta", "tb").alias("ok")).filter("ok").select("a", "b"), "linked")
        self.scope.free(wanted, texts)
        return out if out.limit(1).count() else None

    def apart(self, lists: DataFrame, roots: DataFrame | None) -> DataFrame:
        """The rows of lists whose key has classes of several components, with each class's component; they replace lists,
        since components only grow."""
        if roots is None:
            return lists.withColumn("root", F.col("cls"))
        held = lists.select("key", "cls", "n", "pos", "parts")
        placed = self.scope.cut(held.join(small(roots), F.col("cls") == F.col("node"), "left").select(*held.columns, F.coalesce("root", "cls").alias("root")), "placed")
        keys = self.scope.cut(placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("key"), "open")
        out = self.scope.cut(placed.join(keys.hint("merge"), "key", "left_semi"), "apart")
        self.scope.free(lists, placed, keys)
        return out

    def vote(self, placed: DataFrame, tried: DataFrame | None, round_: int) -> DataFrame:
        """For each class up to three partners of another component: by shared keys, among the smallest sets of its part of
        the lists, the next smaller ones, and the next ones in a random order; and whether parity lets them link."""
        by = Window.partitionBy("key", "part")
        me, size, chance = F.struct("cls", "n", "root"), by.orderBy("n", "cls"), by.orderBy(F.xxhash64("cls", F.lit(round_)), "cls")
        ways = F.array(F.first(me).over(size), F.lag(me).over(size), F.lag(me).over(chance))
        placed = placed.withColumn("part", F.pmod(F.xxhash64("cls", F.lit(round_ + 100)), F.col("parts")))
        voted = placed.select("cls", "n", "root", ways.alias("ways")).select("cls", "n", "root", F.posexplode("ways").alias("way", "o"))
        voted = voted.filter((F.col("root") != F.col("o.root")) & _near(F.col("n"), F.col("o.n"), self.percent))
        voted = voted.select("cls", "n", "way", F.col("o.cls").alias("other"), F.col("o.n").alias("m"))
        voted = voted.groupBy("cls", "other", "way").agg(F.count(F.lit(1)).alias("count"), F.first("n").alias("n"), F.first("m").alias("m"))
        voted = voted.withColumn("a", F.least("cls", "other")).withColumn("b", F.greatest("cls", "other"))
        voted = voted.join(tried.select("a", "b"), ["a", "b"], "left_anti") if tried is not None else voted
        voted = voted.groupBy("cls", "way").agg(F.max_by(F.struct("a", "b", (F.col("n") + F.col("m")).alias("both")), F.struct("count", "other")).alias("o"))
        pairs = self.scope.cut(voted.select("o.*").distinct(), "pairs")
        with_bits = pairs
        for k in ("a", "b"):
            with_bits = with_bits.join(self.classes.select(F.col("cls").alias(k), F.col("bits").alias(f"bits{k}")), k)
        out = self.scope.cut(with_bits.select("a", "b", _alike(F.col("both"), F.col("bitsa"), F.col("bitsb"), self.percent).alias("alike")), "voted")
        self.scope.free(pairs)
        return out

    def rest(self, placed: DataFrame, tried: DataFrame) -> DataFrame:
        """All pairs of a list that fit, are not together and not tried."""
        placed = self.scope.cut(placed.join(self.classes.select("cls", "bits"), "cls").select("key", "cls", "n", "pos", "root", "bits"), "listed")
        x, y = (placed.select("key", *[F.col(c).alias(f"{c}{k}") for c in ("cls", "n", "pos", "root", "bits")]) for k in (1, 2))
        both = F.col("n1") + F.col("n2")
        most = 1 + F.least(F.col("n1") - F.col("pos1") - 1, F.col("n2") - F.col("pos2") - 1)  # if this is the first shared shingle
        fits = (100 + self.percent) * most >= self.percent * both
        may = _near(F.col("n1"), F.col("n2"), self.percent) & fits & _alike(both, F.col("bits1"), F.col("bits2"), self.percent)
        pairs = x.join(y.hint("merge"), "key").filter((F.col("cls1") < F.col("cls2")) & (F.col("root1") != F.col("root2")) & may)
        pairs = pairs.select(F.col("cls1").alias("a"), F.col("cls2").alias("b")).distinct().join(tried.select("a", "b"), ["a", "b"], "left_anti")
        return self.scope.cut(pairs, "rest")

    def roots(self) -> DataFrame | None:
        """(node, root): the component of each class that isn't its component's least class; None if nothing links."""
        lists, tried, roots = self.lists(), None, None
        for round_ in range(ROUNDS + 1):
            placed = self.apart(lists, roots)
            lists = placed if roots is not None else lists
            if round_ < ROUNDS:  # votes, which join most of what belongs together
                new = self.vote(placed, tried, round_)
                ok, tried = self.check(new.filter("alike")), new if tried is None else tried.unionByName(new)
            else:
                ok = self.check(self.rest(placed, tried))
            if ok is not None:
                ties = ok if roots is None else ok.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b")))
                roots = components(ties, self.scope)
        return roots

    def members(self) -> DataFrame:
        """(id, th, n, cls, low_id, low_th) of each row, from tables of its own: low_*: id and text hash of the component's
        least row, by id (null last), then hash."""
        scope = self.scope
        self.found = scope.cut(self.rows.mapInArrow(_profile, "id bigint, th bigint, n bigint, cls bigint, bits array<bigint>, wide binary, chunk int, counts binary"), "sets")
        members = self.found.filter("chunk is null").select("id", "th", "n", "cls")
        lowest = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "th"))
        least = members.filter("n > 0").groupBy("cls").agg(F.first("n").alias("n"), lowest.alias("o")).select("cls", "n", F.col("o.id").alias("id"), F.col("o.th").alias("th"))
        bits = self.found.filter("n > 0").groupBy("cls").agg(F.first("bits").alias("bits"))
        self.classes = scope.cut(least.join(bits, "cls"), "classes")
        roots = self.roots()
        if roots is None:
            roots = self.classes.select(F.col("cls").alias("node"), F.col("cls").alias("root")).limit(0)
        placed = self.classes.select("cls", "id", "th").join(roots, F.col("cls") == F.col("node"), "left").withColumn("root", F.coalesce("root", "cls"))
        joined = roots.select(F.col("root").alias("r")).distinct().join(placed, F.col("r") == F.col("root")).groupBy("root").agg(lowest.alias("low"))
        # The least row of each class that isn't alone or has several members; all other rows are their own component.
        of = placed.join(joined, "root", "left").select("cls", F.coalesce("low.id", F.when(F.col("low").isNull(), F.col("id"))).alias("low_id"), F.coalesce("low.th", "th").alias("low_th"))
        out = scope.cut(members.join(of.hint("merge"), "cls", "left").select("id", "th", "n", "cls", "low_id", "low_th"), "members")
        scope.close(out)
        return out


def _members(docs: DataFrame, percent: int, key: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(body.alias("text"), F.col(key).cast("long").alias("id"), F.xxhash64(body).alias("th"))
    return _Join(rows, percent, Scope(docs.sparkSession)).members()


def groups(docs: DataFrame, percent: int = 75, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of docs: the least key that is reachable by links, itself included.

    A null key is no least key where another is reachable. A text without words is a component of its own.
    """
    out = _members(docs, percent, key, text)
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("low_id")).alias("component_id"))


def one_each(docs: DataFrame, percent: int = 75, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with one row of each component: that of the least key (null last), then text hash. Rows without words all stay.

    Rows are told apart by key and text, so of unrelated texts with the same key none goes; of several rows with the same
    key and text the one with the least hash of all its columns stays. The columns are those of docs.
    """
    out = _members(docs, percent, key, text)
    same = F.col("id").eqNullSafe(F.col("low_id")) & (F.col("th") == F.col("low_th"))
    gone = Scope(docs.sparkSession)
    drop = gone.cut(out.filter((F.col("n") > 0) & ~same).select(F.col("id").alias("__wq_id"), F.col("th").alias("__wq_th")).distinct(), "dropped")
    twice = gone.cut(out.filter((F.col("n") > 0) & same).groupBy("id", "th").count().filter("count > 1").select(F.col("id").alias("__wq_id"), F.col("th").alias("__wq_th")), "repeated")
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.withColumns({"__wq_i": F.col(key).cast("long"), "__wq_t": F.xxhash64(body)})
    on = F.col("__wq_i").eqNullSafe(F.col("__wq_id")) & (F.col("__wq_t") == F.col("__wq_th"))
    kept = rows.join(small(drop), on, "left_anti")
    if twice.limit(1).count():  # else no row need be looked for among others
        order = Window.partitionBy("__wq_i", "__wq_t").orderBy(F.xxhash64(*[F.to_json(F.struct(F.col(f"`{c}`"))) for c in docs.columns]))
        again = kept.join(small(twice), on, "left_semi").withColumn("__wq_n", F.row_number().over(order)).filter("__wq_n = 1").drop("__wq_n")
        kept = kept.join(small(twice), on, "left_anti").unionByName(again)
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
