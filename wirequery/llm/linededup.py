"""Line dedup with a log-template tree of fixed depth, as a distributed computation.

A line goes down the tree by its number of tokens and its LEAD leading tokens, in which tokens with digits count as
variable; this gives its leaf. In leaves that many texts reach, the support of a token at a later position is the number of
texts that share it there. The support of a line is the greatest that a CONSTANT share of its tokens reaches, which bounds
the texts of its template from above. A line of GENERAL tokens or more whose support is `min_texts` or more has the template
of its constant tokens, those with SHARE of the line's support: so the values of a variable field stay variable however many
texts each has, as long as none has nearly all. Any other line has its own tokens, digits generalised. A template that occurs
in `min_texts` distinct texts recurs; it stays in the text of the smallest key and is dropped in all others. A line of LONG
words without digits hardly stands in two texts by chance: whatever its leaf and template, it recurs from LONG_TEXTS distinct
texts that have its own tokens, digits generalised.

How it scales: one pass over the texts tokenises in NumPy and writes a row of hashes a line (with its token hashes where it
is long enough to be generalised); all later tables are read from that one. Leaves with too few lines go before texts are told
apart. Groups are counted with partial aggregation. Joins that a common line may dominate, on (leaf, line) or (leaf,
template), have written tables on both sides: the narrow one is broadcast if its counted size allows, else Spark's adaptive
skew join splits the other. The join of drops with the texts is a merge join that the same rule splits where one text is
much copied.

Exact copies of a text count once, so copies of a document do not make its lines recur. Blank lines stay. Null and empty
texts stay as they are; null keys come last where the smallest key is asked for. Results don't depend on the order or
partitioning of rows; equal texts get equal results. An empty table gives no rows. 64-bit hashes stand for tokens, lines and
leaves, 128 bits for texts. Only the key and the text are read, so other columns may have any names but those that begin
with __wq_.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from . import text as T
from .common import Scope, small

#: Leading tokens on the tree's path; least tokens of a line for statistical templates and least share of constants; share of
#: a line's support that makes a token constant.
LEAD, GENERAL, CONSTANT, SHARE = 3, 8, 0.75, 0.9
#: Support of tokens on the path.
PATH = 1 << 48
#: Distinct texts from which a template recurs.
MIN_TEXTS = 5
#: Words without digits that make a line long; distinct texts from which a long line recurs.
LONG, LONG_TEXTS = 50, 2

_DIGIT = np.zeros(256, np.int64)
_DIGIT[48:58] = 1
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: The hash of a variable token.
VARIABLE = T.hashes(np.frombuffer(b"<*>", np.uint8), np.array([0]), np.array([3]), False)[0]


def _between(total: np.ndarray, first: np.ndarray) -> np.ndarray:
    return total[first[1:]] - total[first[:-1]]


def parse(data: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    """The lines that aren't blank, by text: text, raw (hash of the line), leaf, line (hash of its tokens), long, first (token
    of each line and the total); and tokens: the token hashes, variable ones as VARIABLE."""
    starts, ends, _ = T.spans(~T.SPACE[data], offs)
    token = T.hashes(data, starts, ends, False)
    digits = np.concatenate(([0], np.cumsum(_DIGIT[data])))
    token[digits[ends] > digits[starts]] = VARIABLE
    ls, le, lf = T.spans(data != 10, offs)  # runs without a line end, blank ones included
    first = np.searchsorted(starts, np.append(ls, len(data)))
    size = np.diff(first)
    text = np.repeat(np.arange(len(offs) - 1), np.diff(lf))
    keep = size > 0
    ls, le, size, text = ls[keep], le[keep], size[keep], text[keep]
    first = np.append(first[:-1][keep], first[-1])
    place = (np.arange(len(token)) - np.repeat(first[:-1], size)).astype(np.uint64)
    mixed = np.concatenate((np.zeros(1, np.uint64), np.cumsum(T.mix(token + place * _STEP))))
    fixed = np.concatenate(([0], np.cumsum(token != VARIABLE)))
    leaf = size.astype(np.uint64)
    for k in range(LEAD):
        has = size > k
        leaf[has] = T.mix(leaf[has] * _STEP + token[first[:-1][has] + k])
    return {
        "text": text, "raw": T.hashes(data, ls, le, False), "leaf": leaf, "line": T.mix(_between(mixed, first) + size.astype(np.uint64)),
        "long": _between(fixed, first) >= LONG, "first": first, "tokens": token,
    }


def _lines():
    """Rows (k1, k2, id, raw, leaf, line, long, tokens), a line of a text once; tokens are null for short lines. A text that
    came before in the partition, with a key that isn't larger, is left out: it would add nothing."""
    names = ["k1", "k2", "id", "raw", "leaf", "line", "long", "tokens"]

    def run(batches):
        least: dict[tuple[int, int], tuple] = {}
        for batch in batches:
            new = np.zeros(len(batch), bool)
            for i, (a, b, k) in enumerate(zip(*[batch.column(c).to_pylist() for c in range(3)], strict=True)):
                mine, known = (k is None, k), least.get((a, b))
                if known is None or (mine[0] < known[0] or mine[0] == known[0] and not mine[0] and mine[1] < known[1]):
                    least[a, b], new[i] = mine, True
            batch = batch.filter(pa.array(new))
            data, offs = T.raw(batch.column(3))
            for i, j in T.slices(offs):
                x = parse(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
                size = np.diff(x["first"])
                _, once = np.unique(np.stack([x["text"].astype(np.uint64), x["raw"]]), axis=1, return_index=True) if len(size) else (None, np.zeros(0, np.int64))
                once.sort()
                general = size[once] >= GENERAL
                take = np.repeat(np.where(general, x["first"][:-1][once], 0), np.where(general, size[once], 0))
                ends = np.concatenate(([0], np.cumsum(np.where(general, size[once], 0)))).astype(np.int32)
                within = np.arange(ends[-1]) - np.repeat(ends[:-1], np.diff(ends))
                tokens = pa.ListArray.from_arrays(pa.array(ends), pa.array(x["tokens"][take + within].view(np.int64)), mask=pa.array(~general))
                at = pa.array(x["text"][once] + i)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), batch.column(2).take(at), *[pa.array(x[c][once].view(np.int64)) for c in ("raw", "leaf", "line")], pa.array(x["long"][once]), tokens], names
                )

    return run


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    body = F.col(text).cast("string")
    return docs.select(F.xxhash64(body).alias("k1"), F.xxhash64(F.lit("second"), body).alias("k2"), F.col(key).alias("id"), body.alias("text"))


def recurring(docs: DataFrame, scope: Scope, min_texts: int = MIN_TEXTS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(k1, k2, raw): for each distinct text, by its hashes, the hashes of the lines to drop there."""
    kind = docs.schema[key].dataType
    rows = _texts(docs, key, text).filter(F.length("text") > 0)
    schema = f"k1 bigint, k2 bigint, id {kind.simpleString()}, raw bigint, leaf bigint, line bigint, long boolean, tokens array<bigint>"
    every = scope.cut(rows.mapInArrow(_lines(), schema), "lines")
    # Leaves of enough texts: first by lines, which are as many at least.
    full = small(scope.cut(every.groupBy("leaf").count().filter(F.col("count") >= min_texts).select("leaf"), "full"), 24)
    hot = every.select("leaf", "k1", "k2").join(full, "leaf", "left_semi").distinct().groupBy("leaf").count().filter(F.col("count") >= min_texts)
    hot = small(scope.cut(hot.select("leaf"), "leaves"), 24)
    seen = scope.cut(every.join(hot, "leaf", "left_semi"), "hot-lines")
    # Constant tokens, only for lines long enough to be generalised.
    wide = seen.filter("tokens is not null")
    counts = wide.select("leaf", "line", "k1", "k2").distinct().groupBy("leaf", "line").agg(F.count(F.lit(1)).alias("texts"))
    long = wide.groupBy("leaf", "line").agg(F.first("tokens").alias("tokens"))
    tokens = scope.cut(long.join(counts, ["leaf", "line"]).select("leaf", "line", "texts", F.posexplode("tokens").alias("pos", "token")), "tokens")
    support = tokens.filter(F.col("pos") >= LEAD).groupBy("leaf", "pos", "token").agg(F.sum("texts").alias("n")).filter(F.col("n") >= min_texts)
    support = small(scope.cut(support, "support"), 40)
    tokens = tokens.join(support, ["leaf", "pos", "token"], "left").withColumn("n", F.when(F.col("pos") < LEAD, PATH).otherwise(F.coalesce("n", F.lit(0))))
    lines = tokens.groupBy("leaf", "line").agg(F.sort_array(F.collect_list(F.struct("pos", "n", "token"))).alias("ts"))  # as many as a line has tokens
    lines = lines.withColumn("support", F.get(F.sort_array("ts.n", False), (F.ceil(F.size("ts") * CONSTANT) - 1).cast("int")))
    own = F.transform("ts", lambda t: F.when(t["n"] >= F.col("support") * SHARE, t["token"]).otherwise(F.lit(int(VARIABLE.astype(np.int64)))))
    template = small(scope.cut(lines.filter(F.col("support") >= min_texts).select("leaf", "line", F.xxhash64(own).alias("template")), "templates"), 40)
    placed = seen.join(template, ["leaf", "line"], "left").select("k1", "k2", "id", "raw", "leaf", F.coalesce("template", "line").alias("form"))
    placed = scope.cut(placed, "placed")
    by_words = every.filter("long").select("k1", "k2", "id", "raw", "leaf", F.col("line").alias("form"))
    return _drops(scope, placed, min_texts, "recurring").union(_drops(scope, by_words, min(LONG_TEXTS, min_texts), "long-lines"))


def _drops(scope: Scope, seen: DataFrame, least: int, name: str) -> DataFrame:
    """(k1, k2, raw) of the lines of seen whose form stands in `least` texts, except in the text of the smallest key."""
    per = seen.groupBy("leaf", "form", "k1", "k2").agg(F.min("id").alias("id"))
    order = F.struct(F.col("id").isNull().alias("none"), "id", "k1", "k2")
    again = per.groupBy("leaf", "form").agg(F.count(F.lit(1)).alias("texts"), F.min(order).alias("o")).filter(F.col("texts") >= least)
    again = again.select("leaf", "form", F.col("o.k1").alias("o1"), F.col("o.k2").alias("o2"))
    drop = seen.join(small(scope.cut(again, name), 48), ["leaf", "form"]).filter((F.col("k1") != F.col("o1")) | (F.col("k2") != F.col("o2")))
    return drop.select("k1", "k2", "raw")


def without(texts: pa.Array, drops: pa.Array) -> pa.Array:
    """Each text without the lines whose hash is in its list; texts without a list stay as they are."""
    out = texts.cast(pa.string()).to_pylist()
    at = [i for i, d in enumerate(drops.is_valid().to_pylist()) if d and out[i] is not None]
    gone = drops.to_pylist()
    data, offs = T.raw(texts.take(pa.array(at, pa.int64())))
    for i, j in T.slices(offs):
        part, local = data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
        starts, ends, first = T.spans(part != 10, local)
        raw = T.hashes(part, starts, ends, False).view(np.int64)
        for k in range(i, j):
            a, b = first[k - i], first[k - i + 1]
            bad = np.isin(raw[a:b], gone[at[k]])
            if bad.any():
                lines, n = out[at[k]].split("\n"), 0
                kept = []
                for line in lines:
                    if line:
                        n += 1
                    if not line or not bad[n - 1]:
                        kept.append(line)
                out[at[k]] = "\n".join(kept)
    return pa.array(out, pa.string())


@F.arrow_udf(StringType())
def _rest(texts: pa.Array, drops: pa.Array) -> pa.Array:
    return without(texts, drops)


def dedup(docs: DataFrame, min_texts: int = MIN_TEXTS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with recurring lines dropped from the text, and a column n_dropped: how many distinct lines went.

    All rows and other columns stay; a column n_dropped of docs is replaced. A text may end up empty.
    """
    scope = Scope(docs.sparkSession)
    drops = scope.cut(recurring(docs, scope, min_texts, key, text).groupBy("k1", "k2").agg(F.collect_set("raw").alias("__wq_raw")), "drops")
    scope.close(drops)
    drops = drops.select(F.col("k1").alias("__wq_k1"), F.col("k2").alias("__wq_k2"), "__wq_raw").hint("merge")
    kept = [c for c in docs.columns if c.lower() != "n_dropped"]
    body = F.col(text).cast("string")
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.xxhash64(body).alias("__wq_1"), F.xxhash64(F.lit("second"), body).alias("__wq_2"))
    rows = rows.join(drops, (F.col("__wq_1") == F.col("__wq_k1")) & (F.col("__wq_2") == F.col("__wq_k2")), "left")
    rest = F.when(F.col("__wq_raw").isNotNull(), _rest(body, F.col("__wq_raw"))).otherwise(body)
    return rows.select(*[rest.alias(c) if c == text else F.col(f"`{c}`") for c in kept], F.coalesce(F.size("__wq_raw"), F.lit(0)).alias("n_dropped"))
