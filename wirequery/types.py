"""Type strings of the columnar dialect and the Spark types they stand for."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import types as S

from .errors import EngineError


@dataclass(frozen=True)
class Type:
    """A parsed type: its name, inner types, names of inner types, and plain arguments such as widths or labels."""

    name: str
    inner: tuple[Type, ...] = ()
    names: tuple[str | None, ...] = ()
    args: tuple[str, ...] = field(default=())

    def unwrap(self) -> Type:
        """The type that values have, without wrappers."""
        if self.name in ("Nullable", "LowCardinality", "SimpleAggregateFunction"):
            return self.inner[-1].unwrap()
        return self

    @property
    def nullable(self) -> bool:
        return self.name in ("Nullable", "Nothing") or self.name == "LowCardinality" and self.inner[0].nullable


# The type names of the dialect.
SIGNED = {"Int8": S.ByteType(), "Int16": S.ShortType(), "Int32": S.IntegerType(), "Int64": S.LongType()}
UNSIGNED = {"UInt8": S.ShortType(), "UInt16": S.IntegerType(), "UInt32": S.LongType(), "UInt64": S.DecimalType(20, 0)}
WIDE = {"Int128": (-(2**127), 2**127 - 1), "UInt128": (0, 2**128 - 1), "Int256": (-(2**255), 2**255 - 1), "UInt256": (0, 2**256 - 1)}
TEXT = ("String", "FixedString", "Enum8", "Enum16", "UUID", "IPv4", "IPv6", *WIDE)
PLAIN = {"Bool": S.BooleanType(), "Float32": S.FloatType(), "Float64": S.DoubleType(), "Date": S.DateType(), "DateTime": S.TimestampNTZType(), "DateTime64": S.TimestampNTZType(), "Nothing": S.NullType()}
DECIMALS = {"Decimal32": 9, "Decimal64": 18, "Decimal128": 38}
COMPOSITE = ("Tuple", "Map", "Array", "Nested")
ALIASES = {"Integer": "Int32", "INTEGER": "Int32", "INT": "Int32", "Boolean": "Bool", "BOOLEAN": "Bool"}


def split_args(text: str) -> list[str]:
    """Cut at commas outside quotes and brackets of any depth."""
    out, depth, start, i = [], 0, 0, 0
    while i < len(text):
        c = text[i]
        if c in "'\"`":
            i += 1
            while i < len(text) and text[i] != c:
                i += 2 if text[i] == "\\" else 1
        elif c in "([{":
            depth += 1
        elif c in ")]}":
            depth -= 1
        elif c == "," and depth == 0:
            out.append(text[start:i].strip())
            start = i + 1
        i += 1
    last = text[start:].strip()
    return [*out, last] if out or last else []


_NAMED = re.compile(r"(`[^`]+`|[A-Za-z_]\w*)\s+(.+)", re.S)


def parse(text: str) -> Type:
    """The Type of a type string; raises EngineError for names that are unknown."""
    text = text.strip()
    m = re.fullmatch(r"([A-Za-z]\w*)\s*(?:\((.*)\))?", text, re.S)
    if not m:
        raise EngineError(f"no type of this dialect: {text!r}")
    name, args = ALIASES.get(m[1], m[1]), split_args(m[2] or "")
    if name in SIGNED or name in UNSIGNED or name in PLAIN or name in TEXT or name in DECIMALS or name == "Decimal":
        return Type(name, args=tuple(args))
    if name in ("Nullable", "LowCardinality", "Array") and len(args) == 1:
        return Type(name, (parse(args[0]),))
    if name == "Map" and len(args) == 2:
        return Type(name, tuple(map(parse, args)))
    if name in ("Tuple", "Nested") and args:
        named = [(m[1].strip("`"), m[2]) if (m := _NAMED.fullmatch(a)) else (None, a) for a in args]
        return Type(name, tuple(parse(t) for _, t in named), tuple(n for n, _ in named))
    if name in ("SimpleAggregateFunction", "AggregateFunction") and args:
        return Type(name, tuple(map(parse, args[1:])), args=(args[0],))
    raise EngineError(f"no type of this dialect: {text!r}")


def spark_type(t: Type) -> S.DataType:
    """The Spark type that holds values of t."""
    name = t.name
    if name in TEXT:
        return S.StringType()
    for known in (SIGNED, UNSIGNED, PLAIN):
        if name in known:
            return known[name]
    if name in DECIMALS:
        return S.DecimalType(DECIMALS[name], int(t.args[0]) if t.args else 0)
    if name == "Decimal":
        return S.DecimalType(int(t.args[0]) if t.args else 10, int(t.args[1]) if len(t.args) > 1 else 0)
    if name == "Array":
        return S.ArrayType(spark_type(t.inner[0]))
    if name == "Map":
        return S.MapType(*map(spark_type, t.inner))
    if name in ("Tuple", "Nested"):
        row = S.StructType([S.StructField(n or f"_{i}", spark_type(x)) for i, (n, x) in enumerate(zip(t.names, t.inner, strict=True), 1)])
        return S.ArrayType(row) if name == "Nested" else row
    if name == "AggregateFunction":
        if t.args[0] == "avg":
            return S.StructType([S.StructField("sum", S.DoubleType()), S.StructField("count", S.LongType())])
        return spark_type(t.inner[0]) if t.inner else S.LongType()
    return spark_type(t.unwrap())


def field_of(name: str, text: str) -> S.StructField:
    """A column with its type string kept as metadata."""
    t = parse(text)
    return S.StructField(name, spark_type(t), True, {"ch_type": text.strip()})


def name_of(t: S.DataType) -> str:
    """A type string for a Spark type, for headers of encoded results."""
    if isinstance(t, S.ArrayType):
        return f"Array({name_of(t.elementType)})"
    if isinstance(t, S.MapType):
        return f"Map({name_of(t.keyType)}, {name_of(t.valueType)})"
    if isinstance(t, S.StructType):
        return "Tuple(" + ", ".join(f"{f.name} {name_of(f.dataType)}" for f in t) + ")"
    if isinstance(t, S.DecimalType):
        return f"Decimal({t.precision}, {t.scale})"
    names = {"boolean": "Bool", "tinyint": "Int8", "smallint": "Int16", "int": "Int32", "bigint": "Int64", "float": "Float32", "double": "Float64", "date": "Date", "timestamp_ntz": "DateTime64(6)", "timestamp": "DateTime64(6)", "void": "Nothing"}
    return names.get(t.simpleString(), "String")


def inner_texts(text: str) -> list[str]:
    """The type strings of the elements of a tuple."""
    inside = text[text.index("(") + 1 : text.rindex(")")]
    if text.strip().split("(")[0] in ("Nullable", "LowCardinality"):
        return inner_texts(inside)
    return [m[2] if (m := _NAMED.fullmatch(a)) else a for a in split_args(inside)]
