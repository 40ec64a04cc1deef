"""Tables of the dialect: CREATE TABLE, DESCRIBE, SHOW, EXISTS, insert hooks and aggregate-state tables."""

from __future__ import annotations

import json
import re
import uuid
from decimal import Decimal

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as S

from ..errors import EngineError
from ..functions import codec
from ..plans import sqltext
from ..types import WIDE, Type, field_of, inner_texts, parse, split_args

_PROPERTY = "wirequery.columns"
_CREATE = re.compile(r"\s*CREATE\s+(?:TEMPORARY\s+)?TABLE\s+(IF\s+NOT\s+EXISTS\s+)?([\w.`\"]+)\s*\((.*)\)\s*ENGINE\s*=\s*(\w+)(?:\(\s*\))?\s*(.*)", re.S | re.I)
_VIEW = re.compile(r"\s*CREATE\s+MATERIALIZED\s+VIEW\s+(IF\s+NOT\s+EXISTS\s+)?([\w.`\"]+)\s+TO\s+([\w.`\"]+)\s+AS\s+(.*)", re.S | re.I)
_COLUMN = re.compile(r"(`[^`]+`|\"[^\"]+\"|[A-Za-z_]\w*)\s+(.+?)(?:\s+(?:DEFAULT|CODEC|COMMENT)\b.*)?", re.S | re.I)


def plain(name: str) -> str:
    return name.replace("`", "").replace('"', "")


class Catalog:
    """Tables of a session. Columns keep their dialect types in a table property, and so does a table its insert hooks, so
    every engine on the session runs them."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def hooks(self, name: str) -> list[list[str]]:
        """[view, query, target] of each view that hangs on a table."""
        return self.property(name, "wirequery.hooks") or []

    def _hook(self, name: str, held: list[list[str]]) -> None:
        self.spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('wirequery.hooks' = {_text(json.dumps(held))})")

    def create(self, sql: str) -> bool:
        """Run a CREATE TABLE or MATERIALIZED VIEW of the dialect; False if it is neither."""
        if m := _VIEW.fullmatch(sql):
            name, target, query = plain(m[2]), plain(m[3]), m[4]
            source = re.search(r"\bFROM\s+([\w.`\"]+)", query, re.I)
            if not source:
                raise EngineError("the materialized view reads no table")
            held = self.hooks(plain(source[1]))
            if any(v == name for v, *_ in held):
                if not m[1]:
                    raise EngineError(f"there is a view {name} already")
                return True
            self._hook(plain(source[1]), [*held, [name, query, target]])
            return True
        m = _CREATE.fullmatch(sql)
        if not m:
            return False
        fields = []
        for column in split_args(m[3]):
            c = _COLUMN.fullmatch(column)
            if not c:
                raise EngineError(f"not a column: {column}")
            fields.append(field_of(plain(c[1]), c[2]))
        if m[1] and self.exists(plain(m[2])):
            return True
        kinds = json.dumps([[f.name, f.metadata["ch_type"]] for f in fields])
        order = re.search(r"ORDER\s+BY\s+(.*)", m[5], re.S | re.I)
        keys = json.dumps([plain(k) for k in split_args(order[1].strip().strip("();"))] if order else [])
        fields = [S.StructField(f.name, S.StringType() if isinstance(f.dataType, S.NullType) else f.dataType, True, f.metadata) for f in fields]
        self.spark.catalog.createTable(plain(m[2]), source="parquet", schema=S.StructType(fields))
        self.spark.sql(f"ALTER TABLE {m[2]} SET TBLPROPERTIES ('{_PROPERTY}' = {_text(kinds)}, 'wirequery.engine' = {_text(m[4])}, 'wirequery.keys' = {_text(keys)})")
        return True

    def drop(self, name: str) -> bool:
        """Take away hooks of a view or a target; whether name was a view, which has no table of its own."""
        found = False
        for row in self.spark.sql("SHOW TABLES").filter("not isTemporary").collect():
            held = self.hooks(row.tableName)
            left = [x for x in held if name not in (x[0], x[2])]
            if len(left) < len(held):
                found = found or any(x[0] == name for x in held)
                self._hook(row.tableName, left)
        return found

    def property(self, name: str, key: str):
        try:
            found = {r.key: r.value for r in self.spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
        except AnalysisException:  # a temporary view
            return None
        return json.loads(found[key]) if key in found and key != "wirequery.engine" else found.get(key)

    def schema(self, name: str) -> S.StructType:
        kinds = dict(self.property(name, _PROPERTY) or [])
        return S.StructType([S.StructField(f.name, f.dataType, True, {"ch_type": kinds[f.name]} if f.name in kinds else {}) for f in self.spark.table(name).schema])

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(name)

    def describe(self, name: str) -> DataFrame:
        """(name, type) of a table's columns, in dialect types where it was created in the dialect."""
        kinds = dict(self.property(name, _PROPERTY) or [])
        rows = [(f.name, kinds.get(f.name, f.dataType.simpleString())) for f in self.spark.table(name).schema]
        return self.spark.createDataFrame(rows, "name string, type string")

    def append(self, name: str, batch: DataFrame, columns: list[str] | None = None) -> None:
        """Append a batch by column name, absent columns as type defaults; run the views that hang on the table.

        The batch is written once to a staging table, so the table and its views see the same rows. Views are worked out
        before anything is appended, so one that fails leaves all tables as they were. A view's columns go to the target's
        columns of the same names; others are left out, and target columns without one get their defaults. A null in a
        column that isn't nullable becomes its default.
        """
        schema = self.schema(name)
        if columns:
            if len(columns) != len(batch.columns):
                raise EngineError(f"{len(columns)} columns for {len(batch.columns)} values")
            batch = batch.toDF(*columns)
        elif columns is None and not {*batch.columns} <= {*schema.names} and len(batch.columns) == len(schema):
            batch = batch.toDF(*schema.names)
        unknown = {*batch.columns} - {*schema.names}
        if unknown:
            raise EngineError(f"no such columns in {name}: {sorted(unknown)}")
        full = batch.select(*[_filled(F.col(f"`{f.name}`"), f).alias(f.name) if f.name in batch.columns else _default(f).alias(f.name) for f in schema])
        hooks = self.hooks(name)
        if not hooks:
            full.write.insertInto(name)
            return
        stages: list[tuple[str, str]] = []  # (staging table, target)
        try:
            stages.append((self._stage(full), name))
            for _, query, target in hooks:
                put = "".join(stages[0][0] if plain(t.text) == name and t.kind in ("word", "quoted") else t.text for t in sqltext.tokens(query))
                out = self.spark.sql(sqltext.rewrite(put))
                stages.append((self._stage(out.select(*[f"`{c}`" for c in out.columns if c in self.spark.table(target).schema.names], F.lit(0).alias("__wq_row"))), target))
            self.spark.table(stages[0][0]).write.insertInto(name)
            for stage, target in stages[1:]:
                self.append(target, self.spark.table(stage).drop("__wq_row"), [])
        finally:
            for stage, _ in stages:
                self.spark.sql(f"DROP TABLE IF EXISTS {stage}")

    def _stage(self, df: DataFrame) -> str:
        stage = f"wq_stage_{uuid.uuid4().hex}"
        df.write.saveAsTable(stage)
        return stage

    def merged(self, name: str) -> DataFrame:
        """A table of aggregate states, merged on read to one row a key."""
        keys, kinds = self.property(name, "wirequery.keys") or [], [(n, parse(t)) for n, t in self.property(name, _PROPERTY) or []]
        table = self.spark.table(name)
        return table.groupBy(*keys).agg(*[_merge(n, t).alias(n) for n, t in kinds if n not in keys]).select(*table.columns) if keys else table


def _text(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _merge(name: str, t: Type):
    if t.name == "AggregateFunction" and t.args[0] == "avg":
        return F.struct(F.sum(f"{name}.sum").alias("sum"), F.sum(f"{name}.count").alias("count"))
    how = t.args[0] if t.name in ("SimpleAggregateFunction", "AggregateFunction") else "any"
    return {"sum": F.sum, "min": F.min, "max": F.max, "count": F.sum}.get(how, F.any_value)(name)


def _filled(c, f: S.StructField):
    """The checked value; the default for a null that the type doesn't have."""
    kind = (f.metadata or {}).get("ch_type")
    return _checked(c, f) if not kind or parse(kind).nullable else F.coalesce(_checked(c, f), _default(f))


def _checked(c, f: S.StructField):
    """The value cast to the column's type; ranges, labels and widths of dialect types are enforced."""
    kind = (f.metadata or {}).get("ch_type")
    t = parse(kind).unwrap() if kind else None
    out = c.cast(f.dataType)
    if t and t.name in WIDE:
        return codec.wide(out, t.name)
    if t and t.name in codec.LIMITS:
        bad = (out < 0) | (out > F.lit(Decimal(codec.LIMITS[t.name])).cast("decimal(20,0)"))
        return F.when(bad, F.raise_error(F.concat(F.lit(f"out of range of {t.name}: "), out.cast("string"))).cast(f.dataType)).otherwise(out)
    if t and t.name in ("Enum8", "Enum16"):
        labels = [re.match(r"\s*'((?:\\.|[^'\\])*)'", a)[1] for a in t.args]
        return F.when(~out.isin(labels), F.raise_error(F.concat(F.lit(f"not a label of {t.name}: "), out)).cast("string")).otherwise(out)
    if t and t.name == "FixedString":
        width = int(t.args[0])
        long = F.when(F.octet_length(out) > width, F.raise_error(F.concat(F.lit(f"longer than {width} bytes: "), out)).cast("string")).otherwise(out)
        return F.concat(long, F.repeat(F.lit("\0"), F.lit(width) - F.octet_length(out)))
    if t and t.name == "UUID":
        return F.lower(out)
    return out


def _default(f: S.StructField):
    """The default of a column that an insert leaves out: null if it may be, else the type's zero."""
    kind = (f.metadata or {}).get("ch_type")
    if not kind or parse(kind).nullable:
        return F.lit(None).cast(f.dataType)
    t = parse(kind).unwrap()
    if t.name == "FixedString":
        return F.lit("\0" * int(t.args[0]))
    if t.name in ("Enum8", "Enum16"):
        return F.lit(re.match(r"\s*'((?:\\.|[^'\\])*)'", t.args[0])[1])
    if isinstance(f.dataType, S.StringType):
        return F.lit({"UUID": "00000000-0000-0000-0000-000000000000", "IPv4": "0.0.0.0", "IPv6": "::", **dict.fromkeys(WIDE, "0")}.get(t.name, ""))
    if isinstance(f.dataType, (S.NumericType, S.BooleanType)):
        return F.lit(0).cast(f.dataType)
    if isinstance(f.dataType, S.ArrayType):
        return F.array().cast(f.dataType)
    if isinstance(f.dataType, S.MapType):
        return F.create_map().cast(f.dataType)
    if isinstance(f.dataType, (S.DateType, S.TimestampNTZType)):
        return F.lit("1970-01-01").cast(f.dataType)
    if t.name == "AggregateFunction" and isinstance(f.dataType, S.StructType):
        return F.struct(F.lit(0.0).alias("sum"), F.lit(0).cast("long").alias("count"))
    if isinstance(f.dataType, S.StructType):
        inner = [S.StructField(x.name, x.dataType, True, {"ch_type": text}) for x, text in zip(f.dataType, inner_texts(kind), strict=True)]
        return F.struct(*[_default(x).alias(x.name) for x in inner])
    return F.lit(None).cast(f.dataType)
