"""The registered queries of the training-data operators, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, fingerprint, jaccard, langid, linededup, mixing, ppm, quality, toxicity, warc
from .common import fold, scratch, table


def op1_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, test item) pair whose alignment reaches the contamination score."""
    docs = table(spark, sf_dir, "documents")
    hits = decontam.found(docs, table(spark, sf_dir, "benchmark"))
    return docs.select("doc_id", F.explode(hits).alias("x")).select("doc_id", "x.item_id", "x.score", "x.start", "x.end")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by the rule ensemble, learned from labels outside the held-out fold."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels.filter(fold("doc_id", 5) != 0))
    out = docs.select("doc_id", quality.stats_of(F.col("text")).alias("stats")).select("doc_id", model.score(F.col("stats")).alias("score"))
    return out.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.filter(fold("doc_id", 3) != 1))
    out = docs.select("doc_id", langid.identify(model, spark, F.col("text")).alias("x"))
    return out.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "x.lang_pred", "x.score", "x.runner_up", "x.ambiguous")


def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents linked at a Jaccard similarity of 0.75 of 5-word shingles."""
    return jaccard.groups(table(spark, sf_dir, "documents"), percent=75)


OP4_SQL = r"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
s as (select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')] else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as s from w),
c as (select s, len(s) as n, min(doc_id) as id, list(doc_id) as ids from (select doc_id, list_sort(s) as s from s) group by s),
t as (select id, n, unnest(s) as t from c),
i as (select a.id as a, b.id as b, any_value(a.n) as n, any_value(b.n) as m, count(*) as x from t a join t b on a.t = b.t and a.id < b.id and 4 * a.n >= 3 * b.n and 4 * b.n >= 3 * a.n group by 1, 2),
l as (select a, b from i where 100 * x >= 75 * (n + m - x)),
e as (select a, b from l union select b, a from l),
r(node, root) as (select a, a from e union select e.b, r.root from r join e on r.node = e.a where r.root < e.b),
roots as (select node, min(root) as root from r group by node)
select c2.doc_id, c2.n as n_shingles, case when c2.n = 0 then c2.doc_id else coalesce(roots.root, c2.id) end as component_id
from (select id, n, unnest(ids) as doc_id from c) c2 left join roots on c2.id = roots.node
"""


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from labels outside the held-out fold."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.filter(fold("doc_id", 3) != 1))
    out = docs.select("doc_id", toxicity.score(model, spark, F.col("text")).alias("x"))
    return out.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "x.score", (F.col("x.score") >= 0.7).cast("int").alias("predicted"), F.size("x.passages").alias("n_passages"))


def op6_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines whose template recurs."""
    return linededup.dedup(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_dropped")


#: Templates as in linededup: support of tokens and lines in leaves of 5 texts, long lines from 2 texts.
OP6_SQL = r"""
with lines as (select text as body, doc_id, l, list_transform(string_split_regex(trim(regexp_replace(l, '[ \t\r\f\v]+', ' ', 'g')), ' '), lambda x: case when regexp_matches(x, '[0-9]') then '<*>' else x end) as tokens
 from (select doc_id, text, unnest(string_split(text, chr(10))) as l from documents where length(text) > 0) where regexp_matches(l, '[^ \t\r\f\v]')),
seen as (select len(tokens) as n, tokens[1] as a, tokens[2] as b, tokens[3] as c, tokens, l, body, min(doc_id) as id from lines group by all),
hot as (select n, a, b, c from seen group by all having count(distinct body) >= 5),
s as (select seen.* from seen join hot on seen.n = hot.n and seen.a = hot.a and seen.b is not distinct from hot.b and seen.c is not distinct from hot.c),
counts as (select n, a, b, c, tokens, count(distinct body) as texts from s where n >= 8 group by all),
toks as (select *, unnest(tokens) as token, unnest(range(0, n)) as pos from counts),
sup as (select n, a, b, c, pos, token, sum(texts) as t from toks where pos >= 3 group by all having sum(texts) >= 5),
flags as (select toks.*, case when toks.pos < 3 then 1::bigint << 48 else coalesce(sup.t, 0) end as w from toks left join sup on toks.n = sup.n and toks.a = sup.a and toks.b = sup.b and toks.c = sup.c and toks.pos = sup.pos and toks.token = sup.token),
supports as (select tokens, list(w order by w desc)[cast(ceil(any_value(n) * 0.75) as bigint)] as support, list(w order by pos) as ws from flags group by tokens),
templ as (select tokens, list_transform(range(1, len(tokens) + 1), lambda i: case when ws[i] >= support * 0.9 then tokens[i] else '<*>' end) as template from supports where support >= 5),
st as (select s.*, coalesce(templ.template, s.tokens) as template from s left join templ on s.tokens = templ.tokens),
rec as (select n, a, b, c, template, arg_min(body, id) as owner from st group by all having count(distinct body) >= 5),
long as (select * from seen where len(list_filter(tokens, lambda x: x <> '<*>')) >= 50),
again as (select tokens, arg_min(body, id) as owner from long group by all having count(distinct body) >= 2),
drops as (select st.body, st.l from st join rec on st.template = rec.template and st.n = rec.n and st.a = rec.a and st.b is not distinct from rec.b and st.c is not distinct from rec.c where st.body <> rec.owner
 union select long.body, long.l from long join again on long.tokens = again.tokens where long.body <> again.owner),
gone as (select body, list(l) as ls from drops group by body)
select doc_id, case when ls is null then text else array_to_string(list_filter(string_split(text, chr(10)), lambda x: not list_contains(ls, x)), chr(10)) end as text, coalesce(cast(len(ls) as integer), 0) as n_dropped from documents left join gone on text = body
"""


def op8_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, and their likeness."""
    return fingerprint.neighbours(table(spark, sf_dir, "documents"))


def op9_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by the byte model and the word model of those outside the held-out fold."""
    return ppm.score(table(spark, sf_dir, "documents"), fold("doc_id", 7) == 2)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC archives and read back by the salvage reader."""
    path = scratch(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), path, min_bytes=0)
    number = lambda c: F.regexp_extract(c, warc.URN + r"(-?\d+)>", 1).try_cast("long")
    kind = F.when(F.col("type") == "gap", F.raise_error(F.concat(F.lit("gap in a fresh archive: "), "reason"))).otherwise(F.col("type"))
    return warc.read(spark, path).select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", kind.alias("record_type"), number("refers_to").alias("refers_to"))


OP7_SQL = """
with p as (select page_id, coalesce(html, '') as html from pages),
h as (select page_id, strlen(html) as payload_bytes, sha1(html) as h from p),
d as (select page_id, cast(payload_bytes as bigint) as payload_bytes, h,
 array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast((cast(('0x' || substr(h, cast(1 + 5 * (i // 4) as bigint), 5)) as bigint) >> (15 - 5 * (i % 4))) & 31 as bigint) + 1, 1)), '') as payload_digest from h),
m as (select *, min(page_id) over (partition by h) as first from d)
select page_id, payload_bytes, payload_digest, case when page_id = first then 'response' else 'revisit' end as record_type, case when page_id = first then null else first end as refers_to from m
"""


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to shares in proportion to the square root of each source's characters."""
    out = mixing.mix(table(spark, sf_dir, "documents"), alpha=0.5, seed=17)
    return out.withColumn("mix_rate", F.round("mix_rate", 9))


OP10_SQL = """
with sizes as (select source, sum(greatest(coalesce(length(text), 0), 1)) as size from documents group by 1),
shares as (select source, size, pow(cast(size as double), 0.5) as share from sizes),
rates as (select source, share / (select sum(share) from shares) * (select cast(sum(size) as double) from shares) / size as rate from shares),
pieces as (select *, cast(greatest(1, ceil(rate / 16.0)) as integer) as pieces from rates),
terms as (select source, rate, pieces, k, exp(-(rate / pieces)) * list_product([1.0::double] || list_transform(range(1, k + 1), lambda x: (rate / pieces) / x)) as p from pieces, range(0, 96) t(k)),
steps as (select source, rate, pieces, k, sum(p) over (partition by source order by k) as c from terms),
cdfs as (select source, any_value(rate) as rate, any_value(pieces) as pieces, list(c order by k) as cdf from steps group by source),
dealt as (select d.*, c.rate, c.cdf, unnest(range(1, c.pieces + 1)) as piece from documents d join cdfs c on d.source is not distinct from c.source),
counted as (select *, len(list_filter(cdf, lambda v: v < (cast(('0x' || substr(md5('17|' || coalesce(cast(doc_id as varchar), '') || '|' || piece), 1, 13)) as bigint) + 0.5) / 4503599627370496.0)) as n from dealt),
copies as (select *, (piece - 1) * 96 + unnest(range(1, n + 1)) as mix_copy from counted)
select doc_id, text, lang, source, n_chars, round(rate, 9) as mix_rate, cast(mix_copy as bigint) as mix_copy, md5('17o|' || coalesce(cast(doc_id as varchar), '') || '|' || mix_copy) as mix_order from copies
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_decontam, op2_quality, op3_langid, op4_jaccard, op5_toxicity, op6_linededup, op7_warc, op8_fingerprint, op9_ppm, op10_mixing)}
SQL: dict[str, str] = {"op4_jaccard": OP4_SQL, "op6_linededup": OP6_SQL, "op7_warc": OP7_SQL, "op10_mixing": OP10_SQL}
