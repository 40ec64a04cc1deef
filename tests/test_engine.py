import asyncio
import datetime as dt
import io
import ipaddress
import uuid
from decimal import Decimal

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wirequery import verify
from wirequery.aio import AsyncEngine
from wirequery.engine import Engine
from wirequery.errors import EngineError
from wirequery.functions import codec
from wirequery.operators import joins
from wirequery.plans import sqltext
from wirequery.rows import Record
from wirequery.sources import formats
from wirequery.streaming import windows
from wirequery.types import parse, spark_type


@pytest.fixture(scope="module")
def engine(spark):
    return Engine(spark)


def one(spark, text, kind):
    return spark.range(1).select(codec.decode(F.lit(text), kind).alias("v")).first().v


@pytest.mark.parametrize(
    "text,kind,value",
    [
        ("true", "Bool", True), ("250", "UInt8", 250), ("18446744073709551615", "UInt64", Decimal(2**64 - 1)), ("-7", "Int8", -7), ("1.5", "Float64", 1.5),
        ("a\\tb\\\\n\\'\\q", "String", "a\tb\\n'q"), ("\\N", "Nullable(String)", None), ("NULL", "Nullable(String)", "NULL"), ("2018-09-07", "Date", dt.date(2018, 9, 7)), ("0000-00-00", "Date", None),
        ("2018-09-07 10:32:23.000001", "DateTime64(6, 'UTC')", dt.datetime(2018, 9, 7, 10, 32, 23, 1)), ("12.345", "Decimal(6, 3)", Decimal("12.345")), ("007", "UInt256", "7"),
        ("{'a:b':1,'c':2}", "Map(String, UInt8)", {"a:b": 1, "c": 2}), ("{}", "Map(String, UInt8)", {}), ("[[[1,2],[]],[]]", "Array(Array(Array(Int32)))", [[[1, 2], []], []]),
        ("['x\\'),',NULL]", "Array(Nullable(String))", ["x'),", None]), ("5", "SimpleAggregateFunction(sum, Int64)", 5),
    ],
)
def test_decode(spark, text, kind, value):
    assert one(spark, text, kind) == value


def test_decode_nested(spark):
    assert one(spark, "(1.500,'a')", "Tuple(x Decimal(6, 3), y String)").asDict() == {"x": Decimal("1.500"), "y": "a"}
    assert [tuple(r) for r in one(spark, "[('a',1),('b',2)]", "Nested(k String, v UInt8)")] == [("a", 1), ("b", 2)]


@pytest.mark.parametrize("text,kind", [("yes", "Bool"), ("256", "UInt8"), ("-1", "UInt64"), ("[1", "Array(Int8)")])
def test_decode_errors(spark, text, kind):
    with pytest.raises(Exception):
        one(spark, text, kind)


def test_types():
    assert spark_type(parse("AggregateFunction(avg, Nullable(Float64))")).simpleString() == "struct<sum:double,count:bigint>"
    assert spark_type(parse("AggregateFunction(count)")).simpleString() == "bigint"
    for bad in ("Date32", "Foo(Int8)", "Array()"):
        with pytest.raises(EngineError):
            parse(bad)


text = st.text(st.sampled_from("ab'\\\t\n\r\b\f\0,()[]{}:é"), max_size=8)


@given(st.lists(st.tuples(text, st.dictionaries(text, st.lists(st.integers(-9, 9), max_size=3), max_size=3)), max_size=4))
def test_parser_round_trip(rows):
    t = parse("Array(Tuple(String, Map(String, Array(Int8))))")

    def wire(v):
        if isinstance(v, str):
            return "'" + "".join({v: "\\" + k for k, v in codec.ESCAPES.items()}.get(c, "\\\\" if c == "\\" else c) for c in v) + "'"
        if isinstance(v, dict):
            return "{" + ",".join(f"{wire(k)}:{wire(x)}" for k, x in v.items()) + "}"
        return str(v) if isinstance(v, int) else ("(%s)" if isinstance(v, tuple) else "[%s]") % ",".join(map(wire, v))

    assert [(r["_1"], dict(r["_2"])) for r in codec.value(wire(rows), t)] == rows


def test_escaping_round_trip(spark):
    words = ["", "a\\nb", "\\", "it's", "tab\there", "\0x", "\\\\t", "é\n"]
    df = spark.createDataFrame([(w,) for w in words], "s string")
    out = df.select("s", codec.decode(codec.encode(F.col("s"), df.schema["s"].dataType, False, True), "String").alias("t"))
    assert all(r.s == r.t for r in out.collect())


def test_statements():
    assert sqltext.statement("/* x */ select 1 FORMAT JSONEachRow ;").format == "JSONEachRow"
    assert sqltext.statement("with a as (select 1) select * from a").kind == "SELECT"
    assert not sqltext.statement("insert into t values").fetches
    assert sqltext.named("select {a}, '{a}' -- {a}\n", {"a": 1}) == ("select :a, '{a}' -- {a}\n", ["a"])
    assert sqltext.rewrite("SELECT ['a', [1][0]]") == "SELECT array('a', array(1)[0])"


def test_literals():
    assert codec.rows_literal((1, "it's", None, True), ([1.5], {"a": dt.date(2018, 9, 7)})) == "(1,'it\\'s',NULL,1),([1.5],{'a':'2018-09-07'})"
    with pytest.raises(EngineError):
        codec.literal(object())


def test_fetching(engine):
    assert engine.is_alive()
    assert engine.fetchval("SELECT {a}", params={"a": "x' OR \\ 1"}) == "x' OR \\ 1"
    assert engine.fetchval("SELECT {a}", params={"a": dt.date(2018, 9, 7)}) == dt.date(2018, 9, 7)
    assert engine.fetchval("SELECT {a}", params={"a": [1, 2]}) == [1, 2]
    row = engine.fetchrow("SELECT 1 AS a, 'x' AS b")
    assert row["a"] == row[0] == 1 and row[:] == (1, "x") and dict(row) == {"a": 1, "b": "x"} and row.get("z") is None
    with pytest.raises(KeyError):
        row["z"]
    assert engine.fetch("SELECT number*2 AS d FROM system.numbers LIMIT 2", json=True) == [{"d": 0}, {"d": 2}]
    assert engine.fetchval("SELECT 1.5", decode=False) == b"1.5"
    assert engine.fetchrow("SELECT 1 WHERE false") is None
    assert engine.fetchval("SELECT CAST(23.432 AS FLOAT)") == 23.432
    for bad in (lambda: engine.execute("SELECT FROM x y z"), lambda: engine.execute("SELECT 1", 1), lambda: engine.fetch("SELECT 1 FORMAT Foo")):
        with pytest.raises(EngineError):
            bad()
    with pytest.raises(TypeError):
        engine.fetch("SELECT {a}", params=[1])
    with pytest.warns(PendingDeprecationWarning):
        engine.fetchone("SELECT 1")


def test_totals(engine):
    rows = engine.fetch("SELECT k, count() AS n FROM VALUES ('a'), ('a'), ('b') t(k) GROUP BY k WITH TOTALS")
    assert [len(r) for r in rows] == [2, 2, 0, 2] and not rows[2] and rows[3]["n"] == 3
    with pytest.raises(KeyError, match="TOTALS"):
        rows[2]["k"]
    assert Record({"a": 0}, (None,))


def test_tables(engine):
    for t in ("agg", "src", "typed"):
        engine.execute(f"DROP TABLE IF EXISTS {t}")
    engine.execute("CREATE TABLE typed (a UInt8, f FixedString(4), e Enum8('x'=1,'y'=2), n Nullable(Int32), m Map(String, Int8), nested Nested(v1 Int8, v2 String)) ENGINE = Memory")
    assert engine.fetchval("EXISTS TABLE typed") == 1 and engine.fetchval("EXISTS TABLE nope") == 0
    assert [r["type"] for r in engine.fetch("DESCRIBE TABLE typed")][:2] == ["UInt8", "FixedString(4)"]
    assert "typed" in [r[0] for r in engine.fetch("SHOW TABLES")]
    engine.execute("INSERT INTO typed VALUES", (1, "ab", "x", None, {"k": 1}, [(1, "p"), (2, "q")]))
    engine.execute("INSERT INTO typed FORMAT JSONEachRow", {"a": 2, "f": "cd"})
    engine.execute("INSERT INTO typed (a, e) VALUES (3, 'y')")
    rows = engine.fetch("SELECT * FROM typed ORDER BY a")
    assert rows[0]["f"] == "ab\0\0" and rows[1]["e"] == "x" and rows[1]["n"] is None and rows[2]["m"] == {}
    assert engine.fetchval("SELECT nested.v1 FROM typed WHERE has(nested.v1, 2)") == [1, 2]
    with pytest.raises(EngineError):
        engine.execute("INSERT INTO typed VALUES", (300, "ab", "x", None, {}, []))
    engine.execute("CREATE TABLE src (k String, v Float64) ENGINE = Memory")
    engine.execute("CREATE TABLE agg (k String, s AggregateFunction(avg, Float64), n SimpleAggregateFunction(sum, Int64)) ENGINE = AggregatingMergeTree() ORDER BY k")
    engine.execute("CREATE MATERIALIZED VIEW mv TO agg AS SELECT k, avgState(v) AS s, count() AS n FROM src GROUP BY k")
    engine.execute("INSERT INTO src VALUES", ("a", 1.0), ("a", 2.0), ("b", 5.0))
    engine.execute("INSERT INTO src VALUES", ("a", 6.0))
    assert {r["k"]: (r["m"], r["n"]) for r in engine.fetch("SELECT k, avgMerge(s) AS m, sum(n) AS n FROM agg GROUP BY k")} == {"a": (3.0, 3), "b": (5.0, 1)}
    assert engine.catalog.merged("agg").count() == 2


def test_files(engine):
    engine.execute("DROP TABLE IF EXISTS ingest")
    engine.execute("CREATE TABLE ingest (a UInt32, s String) ENGINE = Memory")
    engine.insert_file("INSERT INTO ingest FORMAT CSV", b"a,s\n  1,x\n  2,y\n")
    engine.insert_file("INSERT INTO ingest FORMAT TabSeparated", b"a\ts\n3\tz\\tz\n4\tw")
    engine.insert_file("INSERT INTO ingest FORMAT JSONEachRow", b'[{"a": 5, "s": "j"}]')
    engine.insert_file("INSERT INTO ingest FORMAT TSVWithNamesAndTypes", b"a\ts\nUInt32\tString\n6\tk\n")
    assert [(r["a"], r["s"]) for r in engine.fetch("SELECT * FROM ingest ORDER BY a")] == [(1, "x"), (2, "y"), (3, "z\tz"), (4, "w"), (5, "j"), (6, "k")]
    for query, data in (("INSERT INTO ingest FORMAT CSV", b'{"a": 1}'), ("SELECT 1 FORMAT CSV", b""), ("INSERT INTO ingest", b""), ("INSERT INTO ingest FORMAT Foo", b"")):
        with pytest.raises(EngineError):
            engine.insert_file(query, data)


def test_async(spark):
    async def main():
        async with AsyncEngine(spark) as e:
            assert await asyncio.gather(*[e.fetchval(f"SELECT {k} + 0") for k in range(4)]) == [0, 1, 2, 3]
            return [r[0] async for r in e.iterate("SELECT * FROM VALUES (1), (2) t(a)", query_id="q")]

    assert asyncio.run(main()) == [1, 2]


def test_stream_matches_batch(spark, tmp_path):
    from wirequery.streaming.windows import tumbling

    spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(id as int) * 7) AS ts FROM range(100)").write.parquet(str(tmp_path / "e"))
    events = spark.read.parquet(str(tmp_path / "e"))
    stream = tumbling(spark.readStream.schema(events.schema).parquet(str(tmp_path / "e")), late="1 hour")
    q = stream.writeStream.format("memory").queryName("tumbled").outputMode("complete").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted(map(tuple, spark.table("tumbled").collect())) == sorted(map(tuple, tumbling(events).collect()))


def test_literal_queries_take_all_rows(spark, tmp_path):
    base = dt.datetime(2020, 1, 1)
    events = [(k, base, k % 7, f"t{k % 3}", k / 4) for k in (*range(150), 10**6)] + [(None, base, None, "t", None)]
    spark.createDataFrame(events, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double").write.parquet(str(tmp_path / "events.parquet"))
    vectors = [(k, [k / 2, 1.0]) for k in (*range(20), 10**6)] + [(30, []), (31, None)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = {n: [tuple(r) for r in verify.QUERIES[n](spark, str(tmp_path)).collect()] for n in ("map_literal", "tuple", "array_literal", "explode")}
    by = lambda rows: sorted(rows, key=repr)
    assert by(got["map_literal"]) == by((e, {"type": t, "user": None if u is None else str(u)}) for e, _, u, t, _ in events)
    assert by((e, tuple(p)) for e, p in got["tuple"]) == by((e, (v, u)) for e, _, u, _, v in events)
    assert by(got["array_literal"]) == by((e, [t, "it's", "a\\b"]) for e, _, _, t, _ in events)
    assert by(got["explode"]) == by((v, k, round(x, 6)) for v, xs in vectors for k, x in enumerate(xs or ()))


def test_headers_go_by_position(spark, tmp_path):
    schema = spark.createDataFrame([], "name string").schema
    for kind, head in (("TSVWithNamesAndTypes", ["name", "String"]), ("TSVWithNames", ["name"])):
        folder = tmp_path / kind
        folder.mkdir()
        for k in range(2):
            (folder / f"{k}.tsv").write_text("\n".join([*head, "String", "name", f"v{k}", "", "name"]) + "\n")
        one = [r.name for r in formats.read(spark, kind, str(folder / "0.tsv"), schema).collect()]
        assert one == ["String", "name", "v0", "", "name"]
        both = [r.name for r in formats.read(spark, kind, str(folder), schema).collect()]
        assert sorted(both) == sorted(["String", "name", "v0", "", "name", "String", "name", "v1", "", "name"])


COLUMNS = """uint8 UInt8, uint16 UInt16, uint32 UInt32, uint64 UInt64, uint128 UInt128, uint256 UInt256, int8 Int8, int16 Int16, int32 Int32, int64 Int64, int128 Int128,
int256 Int256, float32 Float32, float64 Float64, string String, fixed_string FixedString(32), date Nullable(Date), datetime Nullable(DateTime),
enum8 Enum8('hello' = 1, 'world' = 2), enum16 Enum16('hello' = 1000, 'world' = 2000), array_uint8 Array(UInt8), tuple Tuple(UInt8, String), nullable Nullable(Int8),
array_nullable_string Array(Nullable(String)), array_tuple Array(Tuple(String, UInt8, String)), uuid Nullable(UUID), array_uuid Array(UUID), array_date Array(Date),
low_cardinality_str LowCardinality(String), decimal32 Decimal32(4), decimal128 Decimal128(6), decimal Decimal(6, 3), array_array_int Array(Array(Int32)),
ipv4 Nullable(IPv4), ipv6 Nullable(IPv6), datetime64 DateTime64(3, 'Europe/Moscow'), bool Bool, map_map_array_uuid Map(String, Map(String, Array(UUID))),
nested_int Nested(value1 Integer, value2 Integer), nested_str_date Nested(value1 String, value2 Date)"""
ID = uuid.UUID("123e4567-e89b-12d3-a456-426655440000")
VALUES = (
    1, 65535, 2**32 - 1, 2**64 - 1, 2**128 - 1, 2**256 - 1, -128, -5, -6, -(2**63), -(2**127), 2**255 - 1, 23.432, -1e20, "it's\t\\", "fixed", dt.date(2018, 9, 21), None,
    "hello", "world", [1, 2], (4, "x"), None, ["a", None], [("a", 1, "b")], ID, [ID, ID], [dt.date(2018, 9, 21)], "low", Decimal("1.5"), Decimal("1234.56"), Decimal("12.345"), [[1], []],
    ipaddress.IPv4Address("10.0.0.1"), ipaddress.IPv6Address("2001:db8::1"), dt.datetime(2018, 9, 21, 10, 32, 23, 999000), True, {"k": {"q": [ID]}}, [(0, 1)], [("hello", dt.date(2018, 9, 21))],
)


@pytest.fixture
def everything(engine):
    for t in ("all_types", "test_cache", "test_insert_file"):
        engine.execute(f"DROP TABLE IF EXISTS {t}")
    engine.execute(f"CREATE TABLE all_types ({COLUMNS}) ENGINE = Memory")
    engine.execute("CREATE TABLE test_cache (key String, int32Cache AggregateFunction(avg, Int32), float32Cache SimpleAggregateFunction(sum, Float64)) ENGINE = AggregatingMergeTree() ORDER BY key")
    engine.execute("CREATE MATERIALIZED VIEW IF NOT EXISTS test_cache_mv TO test_cache AS SELECT avgState(int32), sum(float32) FROM all_types")
    engine.execute("CREATE TABLE test_insert_file (uint32 UInt32, string String, date Date) ENGINE = Memory")
    engine.execute("INSERT INTO all_types VALUES", VALUES)
    return engine


def test_every_type_comes_back(everything):
    row = everything.fetchrow("SELECT * FROM all_types")
    want = [*VALUES]
    want[15] += "\0" * 27
    assert [*row[:]] == want and isinstance(row["uint64"], int) and isinstance(row["ipv4"], ipaddress.IPv4Address)
    assert everything.fetchval("SELECT count() FROM test_cache") == 1 and everything.fetchval("SELECT key FROM test_cache") == ""
    with pytest.raises(EngineError):
        everything.execute("INSERT INTO all_types (uint128) VALUES", (2**128,))


def test_absent_fields_get_defaults(everything):
    everything.execute("INSERT INTO all_types FORMAT JSONEachRow", {"decimal32": 32}, {"fixed_string": "s", "nullable": 3})
    rows = everything.fetch("SELECT * FROM all_types WHERE string = ''")
    assert sorted(r["decimal32"] for r in rows) == [0, 32] and {r["fixed_string"].strip("\0") for r in rows} == {"", "s"} and {r["nullable"] for r in rows} == {None, 3}
    assert all(r["uint8"] == 0 and r["date"] is None and r["tuple"] == (0, "") and r["array_uint8"] == [] and r["enum8"] == "hello" for r in rows)
    everything.insert_file("INSERT INTO test_insert_file FORMAT JSONEachRow", b'[\n  {"uint32": 1},\n  {"string": "x",\n "date": "2024-01-03"}\n]')
    assert sorted(r[:] for r in everything.fetch("SELECT * FROM test_insert_file")) == [(0, "x", dt.date(2024, 1, 3)), (1, "", dt.date(1970, 1, 1))]


def test_csv_rules(everything):
    everything.insert_file("INSERT INTO test_insert_file FORMAT CSV", io.BytesIO(b'uint32,string,date\n  1,"say ""hi"", you",2024-01-03\n  2,,2024-01-03\n  3,"",2024-01-03\n'))
    assert sorted(r[:2] for r in everything.fetch("SELECT * FROM test_insert_file")) == [(1, 'say "hi", you'), (2, ""), (3, "")]


def test_views_hold_for_every_engine(spark, engine):
    for t in ("vs", "vt", "vu"):
        engine.execute(f"DROP TABLE IF EXISTS {t}")
    engine.execute("CREATE TABLE vs (k String, v Int64) ENGINE = Memory")
    engine.execute("CREATE TABLE vt (k String, n SimpleAggregateFunction(sum, Int64)) ENGINE = AggregatingMergeTree() ORDER BY k")
    engine.execute("CREATE MATERIALIZED VIEW vm TO vt AS SELECT k, count() AS n FROM vs GROUP BY k")
    Engine(spark).execute("INSERT INTO vs VALUES", ("a", 1), ("a", 2))
    engine.execute("INSERT INTO vs VALUES", ("a", 3))
    assert engine.fetch("SELECT k, n FROM vt FINAL")[0][:] == ("a", 3) and len(engine.fetch("SELECT * FROM vt")) == 2
    engine.execute("CREATE TABLE vu (k Int8) ENGINE = Memory")
    engine.execute("CREATE MATERIALIZED VIEW vn TO vu AS SELECT CAST(k AS INT) AS k FROM vs")
    with pytest.raises(EngineError):  # the second view can't take the row, so no table has it
        engine.execute("INSERT INTO vs VALUES", ("b", 1))
    assert engine.fetchval("SELECT count() FROM vs") == 3 and engine.fetchval("SELECT sum(n) FROM vt") == 3
    engine.execute("DROP TABLE vn")
    engine.execute("INSERT INTO vs VALUES", ("b", 1))
    assert engine.fetchval("SELECT count() FROM vs") == 4


def test_totals_come_after_the_limit(engine):
    query = "SELECT k, count() AS n FROM VALUES ('a'), ('a'), ('b'), ('c') t(k) GROUP BY k WITH TOTALS"
    assert [r["n"] if r else None for r in engine.fetch(f"{query} ORDER BY n DESC LIMIT 1")] == [2, None, 4]
    assert [r["n"] if r else None for r in engine.fetch(f"{query} HAVING n > 1")] == [2, None, 4]
    assert len(engine.fetch(f"{query} LIMIT 2")) == 4
    with pytest.raises(EngineError):
        engine.fetch(f"{query} LIMIT 2, 3")


def test_sessions_and_sliding_windows_of_streams(spark, tmp_path):
    spark.sql("SELECT id % 3 AS user_id, timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(id * id as int)) AS ts FROM range(60)").write.parquet(str(tmp_path / "e"))
    events = spark.read.parquet(str(tmp_path / "e"))
    for name, f in (("slid", lambda e, late=None: windows.sliding(e, "2 hours", "1 hour", late=late)), ("sat", lambda e, late=None: windows.sessions(e, "40 minutes", "user_id", late=late))):
        stream = f(spark.readStream.schema(events.schema).parquet(str(tmp_path / "e")), "1 hour")
        q = stream.writeStream.format("memory").queryName(name).outputMode("complete").option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        q.awaitTermination(120)
        assert sorted(map(tuple, spark.table(name).collect())) == sorted(map(tuple, f(events).collect()))
    q = windows.running(spark.readStream.schema(events.schema).parquet(str(tmp_path / "e")), "user_id").writeStream.format("memory").queryName("ran").outputMode("update").option("checkpointLocation", str(tmp_path / "r")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert {r.user_id: r.n for r in spark.sql("SELECT user_id, max(n) AS n FROM ran GROUP BY user_id").collect()} == {0: 20, 1: 20, 2: 20}


def test_late_rows_are_left_out(spark, tmp_path):
    schema = "ts timestamp_ntz"
    for k, times in enumerate((["2024-01-01 10:00:00", "2024-01-01 20:00:00"], ["2024-01-01 20:10:00"], ["2024-01-01 10:30:00"], ["2024-01-02 20:00:00"])):
        spark.createDataFrame([(dt.datetime.fromisoformat(t),) for t in times], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / f"e/{k}"))
    stream = windows.tumbling(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(tmp_path / "e")), late="1 hour")
    q = stream.writeStream.format("memory").queryName("late").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert {r.w.hour: r.n for r in spark.table("late").collect()} == {10: 1, 20: 2}


def test_asof_and_range_joins(spark):
    left = spark.createDataFrame([(1, 5, "a"), (1, 1, "b"), (None, 5, "c"), (2, 5, "d"), (1, None, "e")], "k int, t int, row string")
    right = spark.createDataFrame([(1, 2, 10), (1, 5, 20), (1, 5, 21), (None, 1, 30), (2, 6, 40)], "k int, t int, v int")
    assert {r.row: r.v for r in joins.asof(left, right, "k", "t", "v", "v").collect()} == {"a": 21, "b": None, "c": None, "d": None, "e": None}


def test_udf_and_udtf(engine):
    class Pairs:
        def eval(self, n: int):
            for k in range(n):
                yield (k,)

    engine.register("wq_pairs", F.udtf(Pairs, returnType="k int"))
    engine.register("wq_plus", F.pandas_udf(lambda s: s + 1, "long"))
    assert [r[0] for r in engine.fetch("SELECT wq_plus(k) FROM wq_pairs(3) ORDER BY k")] == [1, 2, 3]
