"""Mixing sources to target weights by Poisson replication, in DataFrame functions only.

A source of size z with target share w is repeated at the rate r = w * total / z. Each document's count is the inverse
of a Poisson(r) distribution at a uniform number taken from a hash of the seed and the document's id: the same input
gives the same mix, whatever the partitioning. Rates above PIECE are dealt as a sum of independent Poisson pieces, so
the inversion table has a fixed length and a tiny, much repeated source is exploded in two bounded steps. The result is
put in a global random order: rows go to partitions by a hash and are sorted by it there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

#: The largest Poisson mean that is inverted at once; exp(-PIECE) and the tail beyond TERMS are safe in doubles.
PIECE, TERMS = 16.0, 96
#: Sources up to which their rates are broadcast (one row of about 1 kB each); beyond it the join is shuffled and salted.
SOURCES, SALTS = 20_000, 64


def unit(*parts: Column) -> Column:
    """A uniform number in (0, 1) from md5 of the parts: 52 bits and a half."""
    h = F.md5(F.concat_ws("|", *parts).cast("binary"))
    return (F.conv(F.substring(h, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def rates(docs: DataFrame, weights: dict[str, float] | None = None, alpha: float = 0.5, source: str = "source", text: str = "text") -> DataFrame:
    """Per source: its size in characters and its repetition rate.

    weights: target shares by source, scaled to sum to 1 over the sources that are there; sources not named get none.
    Without weights a share is in proportion to size ** alpha. The mix has as many characters as the input, on average.
    A null source is a source of its own; a source of size 0 counts each document as one character.
    """
    src = F.col(source).cast("string")
    sizes = docs.groupBy(src.alias("source")).agg(F.sum(F.greatest(F.coalesce(F.length(text), F.lit(0)), F.lit(1))).alias("size"))
    sizes = cut(sizes, "sizes")
    if weights is None:
        share = F.pow(F.col("size").cast("double"), F.lit(float(alpha)))
    else:
        share = F.lit(0.0)
        for name, w in sorted(weights.items()):
            share = F.when(F.col("source") == name, F.lit(float(w))).otherwise(share)
    total, shares = sizes.agg(F.sum("size").cast("double"), F.sum(share)).first()
    rate = share / F.lit(shares) * F.lit(total) / F.col("size") if shares else F.lit(0.0)
    return sizes.select("source", "size", rate.alias("rate"))




def cdf(mean: Column) -> Column:
    """The distribution function at 0 to TERMS - 1, as an array: its terms are summed in order."""
    step = lambda a, k: F.struct((a["p"] * mean / k).alias("p"), F.concat(a["c"], F.array(F.element_at(a["c"], -1) + a["p"] * mean / k)).alias("c"))
    start = F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("c"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS - 1)).cast("array<double>"), start, step, lambda a: a["c"])


def mix(docs: DataFrame, weights: dict[str, float] | None = None, alpha: float = 0.5, seed: int = 17, key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """docs with each row repeated by its Poisson count, in a global random order.

    Returns the columns of docs, then mix_rate, mix_copy (1, 2, ...) and mix_order (32 hex digits: the order; rows are
    partitioned by its hash and sorted by it). Columns of docs with these names are replaced. A null key counts as the
    empty text; rows that share a key share their count. Empty input gives an empty result.
    """
    kept = [c for c in docs.columns if c.lower() not in ("mix_rate", "mix_copy", "mix_order")]
    table = cut(
        rates(docs, weights, alpha, source, text)
        .withColumn("pieces", F.greatest(F.lit(1.0), F.ceil(F.col("rate") / PIECE)).cast("int"))
        .withColumn("cdf", cdf(F.col("rate") / F.col("pieces"))),
        "rates",
    ).select(F.col("source").alias("__wq_source"), F.col("rate").alias("mix_rate"), F.col("pieces").alias("__wq_pieces"), F.col("cdf").alias("__wq_cdf"))
    rows = docs.select(*kept, F.coalesce(F.col(key).cast("string"), F.lit("")).alias("__wq_key"))
    same = F.col(source).cast("string").eqNullSafe(F.col("__wq_source"))
    if table.limit(SOURCES + 1).count() <= SOURCES:
        rows = rows.join(F.broadcast(table), same)
    else:
        rows = rows.withColumn("__wq_salt", F.pmod(F.xxhash64("__wq_key"), F.lit(SALTS)).cast("int"))
        salted = table.withColumn("__wq_salt2", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = rows.join(salted, same & (F.col("__wq_salt") == F.col("__wq_salt2")))
    # The counts of all pieces are known before any row is repeated, so most rows of a thin source end here.
    u = lambda j: unit(F.lit(str(seed)), F.col("__wq_key"), j.cast("string"))
    below = lambda x: F.size(F.filter("__wq_cdf", lambda c: c < x))
    first = rows.withColumn("__wq_n", below(u(F.lit(1)))).filter((F.col("__wq_pieces") > 1) | (F.col("__wq_n") > 0))
    dealt = first.withColumn("__wq_piece", F.explode(F.sequence(F.lit(1), F.col("__wq_pieces"))))
    dealt = dealt.withColumn("__wq_n", F.when(F.col("__wq_piece") == 1, F.col("__wq_n")).otherwise(below(u(F.col("__wq_piece"))))).filter(F.col("__wq_n") > 0)
    copies = dealt.withColumn("__wq_i", F.explode(F.sequence(F.lit(1), F.col("__wq_n"))))
    copy = ((F.col("__wq_piece") - 1) * TERMS + F.col("__wq_i")).cast("long")
    out = copies.select(*kept, "mix_rate", copy.alias("mix_copy"), F.md5(F.concat_ws("|", F.lit(f"{seed}o"), "__wq_key", copy.cast("string")).cast("binary")).alias("mix_order"))
    return out.repartition(F.xxhash64("mix_order")).sortWithinPartitions("mix_order")
