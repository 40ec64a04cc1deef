"""Times headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

import json
import os
import time

from pyspark.sql import SparkSession

from wirequery import verify
from wirequery.engine import Engine
from wirequery.functions import codec
from wirequery.sources import formats


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "8g").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    took: dict[str, float] = {}
    run = lambda df: df.write.format("noop").mode("overwrite").save()
    run(verify.QUERIES["select_star_where"](spark, sf))  # warm-up
    for name in ("with_totals", "avg_state_merge", "uniq_exact", "join_inner", "join_left", "join_semi", "join_asof", "join_range", "rollup", "win_rank", "limit_by", "topk", "tpch_q1", "tumble", "enc_row", "enc_tsv_text", "tsv_round_trip", "nested_round_trip", "json_each_row"):
        t = time.time()
        run(verify.QUERIES[name](spark, sf))
        took[name] = round(time.time() - t, 3)
    # The three shapes of the baseline on its 11-column row: raw fetch, typed fetch and INSERT, by the engine's own calls,
    # and encode, decode and append as plans. Every column depends on the row, so none is folded to a constant.
    # The row of the baseline.
    n, calls = 500_000, 100_000
    engine = Engine(spark)
    row = "id AS a, cast(id % 3 AS int) AS b, concat('hello', id) AS c, 23.432 + id AS d, -23.432 - id AS e, concat('world', id) AS f, date_add(DATE'2018-09-21', cast(id % 9 AS int)) AS g, TIMESTAMP_NTZ'2018-09-21 10:32:23' + make_dt_interval(0, 0, 0, id % 60) AS h, concat('hello man', id) AS i, array(1, 2, cast(id AS int)) AS j, nullif(concat('', id % 2), '0') AS k"
    spark.sql(f"SELECT {row} FROM range({n})").write.mode("overwrite").saveAsTable("bench_rows")
    rows = spark.table("bench_rows")

    def timed(name: str, f) -> None:
        t = time.time()
        f()
        took[name] = round(time.time() - t, 3)

    timed("wire_encode_500k", lambda: run(formats.lines(rows)))
    kinds = ("UInt64", "Int32", "String", "Float64", "Float64", "String", "Date", "DateTime", "String", "Array(Int32)", "Nullable(String)")
    wire = rows.select(*[codec.encode(rows[f.name], f.dataType, False, True).alias(f.name) for f in rows.schema])
    wire.write.mode("overwrite").saveAsTable("bench_wire")
    wire = spark.table("bench_wire")
    timed("wire_decode_500k", lambda: run(wire.select(*[codec.decode(wire[c], k).alias(c) for c, k in zip(wire.columns, kinds, strict=True)])))
    timed("fetch_raw_100k", lambda: engine.fetch(f"SELECT * FROM bench_rows LIMIT {calls}", decode=False))
    timed("fetch_typed_100k", lambda: [r[0] for r in engine.fetch(f"SELECT * FROM bench_rows LIMIT {calls}")])
    engine.execute("DROP TABLE IF EXISTS bench_append")
    engine.execute("CREATE TABLE bench_append (a Int64, b Int32, c String, d Float64, e Float64, f String, g Date, h DateTime, i String, j Array(Int32), k Nullable(String)) ENGINE = Memory")
    timed("append_500k", lambda: engine.catalog.append("bench_append", rows))
    values = [tuple(r) for r in rows.limit(calls).collect()]
    timed("insert_100k", lambda: engine.execute("INSERT INTO bench_append VALUES", *values))
    for name in ("bench_append", "bench_rows", "bench_wire"):
        engine.execute(f"DROP TABLE {name}")
    print(json.dumps({"metric": "total seconds of headline queries", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": sf}))


if __name__ == "__main__":
    main()
