"""The engine's registered queries and, for comparison, their SQL for another engine."""

from __future__ import annotations

import re
from collections.abc import Callable

import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .engine import Engine
from .functions import codec
from .operators import joins
from .plans import sqltext
from .sources import formats
from .streaming import windows

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


_views: dict[tuple[str, str], str] = {}


def engine(spark: SparkSession, sf_dir: str, text: str) -> Engine:
    """An engine with the tables that a text names as views; a table is opened once for a session and folder."""
    for name in TABLES:
        if re.search(rf"\b{name}\b", text):
            held = (spark.sparkContext.applicationId + str(id(spark)), name)
            if _views.get(held) != sf_dir or not spark.catalog.tableExists(name):
                spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)
                _views[held] = sf_dir
    return Engine(spark, exact_uniq=True)


def run(spark: SparkSession, sf_dir: str, text: str, params: dict | None = None) -> DataFrame:
    return engine(spark, sf_dir, text).sql(text, params)


# name: (dialect SQL, other SQL or None if the same text runs there)
PAIRS: dict[str, tuple[str, str | None]] = {
    "select_star_where": ("select * from orders where o_orderkey=42", None),
    "project_arith": ("select event_id, event_id*2 as doubled from events", None),
    "sys_numbers": ("SELECT number, number*2 AS doubled FROM system.numbers LIMIT 10000", "select range as number, range*2 as doubled from range(0,10000)"),
    "agg_avg": ("select o_orderstatus, round(avg(o_totalprice),4) as avg_price from orders group by o_orderstatus", None),
    "agg_sum": ("select l_returnflag, sum(cast(l_quantity as decimal(18,2))) as q from lineitem group by l_returnflag", None),
    "avg_state_merge": ("with st as (select o_orderstatus, month(o_orderdate) as m, avgState(cast(o_totalprice as decimal(18,2))) as s from orders group by o_orderstatus, month(o_orderdate)) select o_orderstatus, round(avgMerge(s), 4) as avg_price from st group by o_orderstatus", "select o_orderstatus, round(cast(sum(cast(o_totalprice as decimal(18,2))) as double)/count(*), 4) as avg_price from orders group by 1"),
    "uniq_exact": ("select event_type, uniq(user_id) as uniq_users from events group by event_type", "select event_type, count(distinct user_id) as uniq_users from events group by 1"),
    "group_by_array": ("select array(o_orderstatus, o_orderpriority) as k, count(*) as n from orders group by array(o_orderstatus, o_orderpriority)", "select [o_orderstatus, o_orderpriority] as k, count(*) as n from orders group by 1"),
    "has_nested": ("select conv_id, size(t) as n from (select conv_id, collect_list(named_struct('turn',turn,'role',role)) as t from conversations group by conv_id) where has(t.turn, cast(3 as bigint))", "select conv_id, cast(count(*) as integer) as n from conversations group by 1 having bool_or(turn=3)"),
    "map_literal": ("select event_id, map('type',event_type,'user',cast(user_id as string)) as m from events", "select event_id, map(['type','user'],[event_type,cast(user_id as varchar)]) as m from events"),
    "tuple": ("select event_id, (value, user_id)::Tuple(x Float64, y Int64) as p from events", "select event_id, struct_pack(x:=value,y:=user_id) as p from events"),
    "array_literal": ("select event_id, [event_type, 'it\\'s', 'a\\\\b'] as a from events", "select event_id, [event_type, 'it''s', 'a\\b'] as a from events"),
    "quoted_alias": ("select event_id as \"{not_a_param}\" from events", "select event_id as \"{not_a_param}\" from events"),
    "array": ("select label, sort_array(collect_list(vec_id)) as ids from embeddings group by label", "select label, list_sort(list(vec_id)) as ids from embeddings group by 1"),
    "join_inner": ("select n_name, count(*) as n from customer join nation on c_nationkey=n_nationkey group by n_name", None),
    "join_left": ("select c_custkey, count(o_orderkey) as n from customer left join orders on c_custkey=o_custkey group by c_custkey", None),
    "join_semi": ("select c_custkey from customer left semi join (select * from orders where o_totalprice>250000) o on c_custkey=o_custkey", "select c_custkey from customer semi join (select * from orders where o_totalprice>250000) o on c_custkey=o_custkey"),
    "join_anti": ("select c_custkey from customer left anti join (select * from orders where o_totalprice>250000) o on c_custkey=o_custkey", "select c_custkey from customer anti join (select * from orders where o_totalprice>250000) o on c_custkey=o_custkey"),
    "join_full": ("select n_nationkey, s_suppkey from nation full outer join supplier on n_nationkey=s_nationkey and s_acctbal>5000", None),
    "limit_n_by": ("select o_custkey, o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 2 by o_custkey", "select o_custkey, o_orderkey, o_totalprice from (select *, row_number() over(partition by o_custkey order by o_totalprice desc,o_orderkey) rn from orders) where rn<=2"),
    "qualify": ("select event_id, user_id from events qualify row_number() over(partition by user_id order by ts desc, event_id)=1", None),
    "join_cross": ("select n_name, r_name from nation cross join region", None),
    "cte_recursive": ("with recursive t(k) as (select 1 union all select k+1 from t where k<50) select n_nationkey, k from nation join t on k<=n_nationkey", None),
    "rollup": ("select l_returnflag, l_linestatus, count(*) as n from lineitem group by rollup(l_returnflag,l_linestatus)", None),
    "cube": ("select l_returnflag, l_linestatus, count(*) as n from lineitem group by cube(l_returnflag,l_linestatus)", None),
    "having": ("select o_custkey, count(*) as n from orders group by o_custkey having count(*)>15", None),
    "win_rank": ("select event_id, rank() over(partition by user_id order by ts) as r, lag(event_id) over(partition by user_id order by ts,event_id) as p from events", "select event_id, cast(rank() over(partition by user_id order by ts) as integer) as r, lag(event_id) over(partition by user_id order by ts,event_id) as p from events"),
    "win_frame": ("select event_id, count(*) over(partition by user_id order by ts,event_id rows between 2 preceding and current row) as c from events", None),
    "topk": ("select o_orderkey,o_totalprice from orders order by o_totalprice desc, o_orderkey limit 10", None),
    "limit_by": ("select o_custkey,o_orderkey from (select *, row_number() over(partition by o_custkey order by o_totalprice desc,o_orderkey) rn from orders) where rn<=2", None),
    "union_all": ("select n_nationkey as k from nation union all select r_regionkey from region", None),
    "union": ("select n_nationkey as k from nation union select r_regionkey from region", None),
    "intersect": ("select c_nationkey as k from customer intersect select s_nationkey from supplier", None),
    "except": ("select c_custkey as k from customer except select o_custkey from orders where o_totalprice>250000", None),
    "strings": ("select c_custkey, upper(c_name) as u, substring(c_name,1,8) as s, length(c_name) as l from customer", "select c_custkey, upper(c_name) as u, substring(c_name,1,8) as s, cast(length(c_name) as integer) as l from customer"),
    "dates": ("select o_orderkey, year(o_orderdate) as y, month(o_orderdate) as m, cast(date_trunc('month',o_orderdate) as timestamp_ntz) as t from orders", "select o_orderkey, cast(year(o_orderdate) as integer) as y, cast(month(o_orderdate) as integer) as m, date_trunc('month',o_orderdate) as t from orders"),
    "quantile": ("select event_type, percentile(value,0.5) as med from events group by event_type", "select event_type, quantile_cont(value,0.5) as med from events group by 1"),
    "explode": ("select vec_id, pos, round(cast(x as double),6) as x from embeddings lateral view posexplode(embedding) e as pos,x", "select vec_id, cast(generate_subscripts(embedding,1)-1 as integer) as pos, round(cast(unnest(embedding) as double),6) as x from embeddings"),
    "tpch_q1": ("select l_returnflag,l_linestatus,cast(sum(cast(l_quantity as decimal(18,2))) as double) as sum_qty,count(*) as n from lineitem where l_shipdate<=timestamp_ntz'1998-09-02' group by l_returnflag,l_linestatus", "select l_returnflag,l_linestatus,cast(sum(cast(l_quantity as decimal(18,2))) as double) as sum_qty,count(*) as n from lineitem where l_shipdate<=timestamp'1998-09-02' group by 1,2"),
}


def _sql(text: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: run(spark, sf_dir, text)


def with_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = run(spark, sf_dir, "SELECT event_type, count() AS n FROM events GROUP BY event_type WITH TOTALS")
    return out.withColumnRenamed(sqltext.TOTALS, "is_total")


def where_param(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, "select c_custkey, c_name from customer where c_mktsegment={segment}", {"segment": "BUILDING"})


def with_totals_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = run(spark, sf_dir, "SELECT event_type, count() AS n FROM events GROUP BY event_type WITH TOTALS ORDER BY n DESC, event_type LIMIT 2")
    return out.withColumnRenamed(sqltext.TOTALS, "is_total")


def join_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = run(spark, sf_dir, "select user_id, event_id, ts from events")
    pairs = joins.within(t, t.select("user_id", F.col("ts").alias("before")), "user_id", "ts", "before", 3600)
    return pairs.groupBy("event_id").agg(F.count(F.lit(1)).alias("n"))


def join_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = run(spark, sf_dir, "select user_id, event_id, event_type, ts from events")
    return joins.asof(t.select("user_id", "event_id", "ts"), t.filter("event_type='purchase'"), "user_id", "ts", "event_id", "prev_id").filter("prev_id is not null").select("event_id", "prev_id")


def nullable_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = run(spark, sf_dir, "select event_id, case when event_type<>'error' then event_type end as v from events")
    return t.select("event_id", codec.decode(codec.encode(F.col("v"), t.schema["v"].dataType, False, True), "Nullable(String)").alias("v"))


def _again(t: DataFrame, **kinds: str) -> DataFrame:
    """Columns of t encoded to wire text and decoded by type strings."""
    return t.select(*[codec.decode(codec.encode(F.col(c), t.schema[c].dataType, False, True), k).alias(c) for c, k in kinds.items()])


def uuid_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = run(spark, sf_dir, "select event_id, md5(cast(event_id as string)) as h from events")
    t = t.select("event_id", F.upper(F.regexp_replace("h", "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")).alias("u"))
    return _again(t, event_id="Int64", u="Nullable(UUID)")


def wide_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = run(spark, sf_dir, "select o_orderkey, concat('-00', o_orderkey + 1, repeat('9', 30)) as small, concat(o_orderkey + 1, repeat('0', 60)) as large from orders")
    return _again(t, o_orderkey="Int64", small="Int128", large="UInt256")


def decimal_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = run(spark, sf_dir, "select o_orderkey, cast(o_totalprice as decimal(12,2)) as price, cast(o_totalprice as decimal(12,2)) as wide, o_totalprice as real from orders")
    return _again(t, o_orderkey="UInt64", price="Decimal(12, 2)", wide="Decimal128(4)", real="Float64").withColumn("o_orderkey", F.col("o_orderkey").cast("long"))


def date_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = run(spark, sf_dir, "select o_orderkey, cast(o_orderdate as date) as d, o_orderdate as at from orders")
    return _again(t, o_orderkey="Int64", d="Nullable(Date)", at="LowCardinality(DateTime)")


def ip_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = run(spark, sf_dir, "select c_custkey, concat_ws('.', 10, floor(c_custkey / 256) % 256, c_custkey % 256, 1) as a, concat('2001:db8::', lower(hex(c_custkey))) as b from customer")
    return _again(t, c_custkey="Int32", a="IPv4", b="IPv6").withColumn("c_custkey", F.col("c_custkey").cast("long"))


def map_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = run(spark, sf_dir, "select conv_id, map('role', role, 'te:xt', text) as m, turn from conversations")
    return _again(t, conv_id="Int64", turn="Int64", m="Map(String, String)").select("conv_id", "turn", F.col("m")["role"].alias("role"), F.col("m")["te:xt"].alias("text"))


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quoted fields with doubled quotes, written as text and read as CSV."""
    t = run(spark, sf_dir, "select c_custkey, c_name from customer")
    path = formats.folder(spark)
    t.select(F.format_string('%d,"%s, ""x"""', "c_custkey", "c_name")).write.text(path)
    return formats.read(spark, "CSV", path, t.schema)


def mv_avg_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Averages kept as states by a view that hangs on an insert, merged on read."""
    e = engine(spark, sf_dir, "orders")
    for name in ("wq_mv_source", "wq_mv_target"):
        e.execute(f"DROP TABLE IF EXISTS {name}")
    e.execute("CREATE TABLE wq_mv_source (k String, v Decimal(18, 2)) ENGINE = Memory")
    e.execute("CREATE TABLE wq_mv_target (k String, s AggregateFunction(avg, Decimal(18, 2))) ENGINE = AggregatingMergeTree() ORDER BY k")
    e.execute("CREATE MATERIALIZED VIEW wq_mv TO wq_mv_target AS SELECT k, avgState(v) AS s FROM wq_mv_source GROUP BY k")
    for odd in (0, 1):
        e.execute(f"INSERT INTO wq_mv_source SELECT o_orderstatus AS k, cast(o_totalprice as decimal(18,2)) AS v FROM orders WHERE o_orderkey % 2 = {odd}")
    return e.sql("SELECT k AS o_orderstatus, round(avgMerge(s), 4) AS avg_price FROM wq_mv_target FINAL GROUP BY k")


def udf_surface(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An Arrow function called by name in a query."""
    e = engine(spark, sf_dir, "events")
    e.register("wq_twice", F.arrow_udf(lambda c: pc.multiply(c, 2), "bigint"))
    return e.sql("select event_id, wq_twice(event_id) as v from events")


def enc_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = run(spark, sf_dir, "select o_orderkey, struct(o_orderkey, o_orderpriority, o_orderdate) as r from orders")
    return t.select("o_orderkey", codec.encode(F.col("r"), t.schema["r"].dataType).alias("lit"))


def enc_row_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = run(spark, sf_dir, "select page_id, struct(page_id, html) as r from pages")
    return t.select("page_id", codec.encode(F.col("r"), t.schema["r"].dataType).alias("lit"))


def enc_tsv_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = run(spark, sf_dir, "select doc_id, text from documents")
    return t.select("doc_id", codec.encode(F.col("text"), t.schema["text"].dataType, False, True).alias("tsv"))


def tsv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents encoded to wire text and decoded again."""
    t = run(spark, sf_dir, "select doc_id, text, lang from documents")
    wire = t.select(*[codec.encode(F.col(f.name), f.dataType, False, True).alias(f.name) for f in t.schema])
    return wire.select(codec.decode(F.col("doc_id"), "Int64").alias("doc_id"), codec.decode(F.col("text"), "Nullable(String)").alias("text"), codec.decode(F.col("lang"), "LowCardinality(Nullable(String))").alias("lang"))


def nested_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of conversations as nested rows, encoded to wire text, parsed again and counted."""
    t = run(spark, sf_dir, "select conv_id, collect_list(named_struct('turn', turn, 'text', text)) as r from conversations group by conv_id")
    back = t.select("conv_id", codec.decode(codec.encode(F.col("r"), t.schema["r"].dataType, True, True), "Nested(turn Int64, text String)").alias("r"))
    return back.select("conv_id", F.explode("r").alias("x")).select("conv_id", "x.turn", "x.text")


def esc_adv(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Engine(spark).sql("select id, s from values (1,'a\\'b'),(2,'a\\\\b'),(3,'\\\\\\''),(4,'') t(id,s)")
    return t.select("id", codec.quote(F.col("s")).alias("lit"))


def json_each_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return formats.json_lines(run(spark, sf_dir, "select event_id, event_type from events"))


def json_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, "select event_id, cast(get_json_object(props,'$.k') as int) as k from events")


def tumble(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.tumbling(run(spark, sf_dir, "select ts from events"))


def slide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.sliding(run(spark, sf_dir, "select ts from events"), "2 hours", "1 hour")


def session(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.sessions(run(spark, sf_dir, "select user_id, ts from events"), "30 minutes", "user_id")


OWN: dict[Callable[[SparkSession, str], DataFrame], str] = {
    with_totals: "select event_type, cast(grouping(event_type) as tinyint) as is_total, count(*) as n from events group by grouping sets((event_type),())",
    with_totals_limit: "select * from (select event_type, 0::tinyint as is_total, count(*) as n from events group by 1 order by n desc, event_type limit 2) union all select null, 1::tinyint, count(*) from events",
    join_range: "select a.event_id, count(*) as n from events a join events b on a.user_id=b.user_id and b.ts between a.ts - interval 1 hour and a.ts group by a.event_id",
    join_asof: "select e.event_id, p.event_id as prev_id from events e asof join (select * from events where event_type='purchase') p on e.user_id=p.user_id and e.ts>=p.ts",
    nullable_decode: "select event_id, case when event_type='error' then null else event_type end as v from events",
    uuid_round_trip: "select event_id, regexp_replace(md5(cast(event_id as varchar)), '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\\1-\\2-\\3-\\4-\\5') as u from events",
    wide_round_trip: "select o_orderkey, '-'||(o_orderkey+1)||repeat('9', 30) as small, (o_orderkey+1)||repeat('0', 60) as large from orders",
    decimal_round_trip: "select o_orderkey, cast(o_totalprice as decimal(12,2)) as price, cast(cast(o_totalprice as decimal(12,2)) as decimal(38,4)) as wide, o_totalprice as real from orders",
    date_round_trip: "select o_orderkey, cast(o_orderdate as date) as d, o_orderdate as at from orders",
    ip_round_trip: "select c_custkey, '10.'||((c_custkey//256)%256)||'.'||(c_custkey%256)||'.1' as a, '2001:db8::'||lower(to_hex(c_custkey)) as b from customer",
    map_round_trip: "select conv_id, turn, role, text from conversations",
    csv_round_trip: "select c_custkey, c_name || ', \"x\"' as c_name from customer",
    mv_avg_merge: "select o_orderstatus, round(cast(sum(cast(o_totalprice as decimal(18,2))) as double)/count(*), 4) as avg_price from orders group by 1",
    udf_surface: "select event_id, event_id*2 as v from events",
    slide: "select w, count(*) as n from (select unnest([time_bucket(interval '1 hour', ts), time_bucket(interval '1 hour', ts) - interval '1 hour']) as w from events) group by 1",
    session: "with x as (select user_id, ts, case when ts - lag(ts) over(partition by user_id order by ts) <= interval 30 minute then 0 else 1 end as s from events), y as (select *, sum(s) over(partition by user_id order by ts rows unbounded preceding) as g from x) select user_id, min(ts) as w, max(ts) + interval 30 minute as e, count(*) as n from y group by user_id, g",
    where_param: "select c_custkey, c_name from customer where c_mktsegment='BUILDING'",
    enc_row: r"select o_orderkey, '('||o_orderkey||','''||replace(replace(o_orderpriority,'\','\\'),'''','\''')||''','''||strftime(o_orderdate,'%Y-%m-%d %H:%M:%S')||''')' as lit from orders",
    enc_row_html: r"select page_id, '('||page_id||','''||replace(replace(html,'\','\\'),'''','\''')||''')' as lit from pages",
    enc_tsv_text: r"select doc_id, replace(replace(replace(replace(replace(text,'\','\\'),chr(9),'\t'),chr(10),'\n'),chr(13),'\r'),'''','\''') as tsv from documents",
    tsv_round_trip: "select doc_id, text, lang from documents",
    nested_round_trip: "select conv_id, turn, text from conversations",
    esc_adv: r"select id, ''''||replace(replace(s,'\','\\'),'''','\''')||'''' as lit from (values (1,'a''b'),(2,'a\b'),(3,'\'''),(4,'')) t(id,s)",
    json_each_row: "select cast(to_json(struct_pack(event_id:=event_id,event_type:=event_type)) as varchar) as line from events",
    json_decode: "select event_id, cast(json_extract_string(props,'$.k') as int) as k from events",
    tumble: "select time_bucket(interval '1 hour', ts) as w, count(*) as n from events group by 1",
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: _sql(a) for k, (a, _) in PAIRS.items()} | {f.__name__: f for f in OWN}
SQL: dict[str, str] = {k: b or a for k, (a, b) in PAIRS.items()} | {f.__name__: q for f, q in OWN.items()}
