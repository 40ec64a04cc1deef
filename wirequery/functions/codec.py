"""Text codec as column expressions: decode wire text to typed columns, encode columns to wire text and literals.

Scalars are built-in expressions and stay in generated code; nested values are parsed by one Arrow function.
"""

from __future__ import annotations

import datetime as dt
import ipaddress
import uuid
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as S
from pyspark.sql.pandas.types import to_arrow_type

from ..errors import EngineError
from ..types import COMPOSITE, UNSIGNED, WIDE, Type, parse, spark_type

# Escapes of the wire text.
ESCAPES = {"b": "\b", "f": "\f", "r": "\r", "n": "\n", "t": "\t", "0": "\0", "'": "'"}
LIMITS = {"UInt8": 2**8 - 1, "UInt16": 2**16 - 1, "UInt32": 2**32 - 1, "UInt64": 2**64 - 1}


def unescape(c: Column) -> Column:
    """Known escapes to their characters, an unknown escaped character to itself; double backslashes are cut out first."""

    def segment(s: Column) -> Column:
        for k, v in ESCAPES.items():
            s = F.replace(s, F.lit("\\" + k), F.lit(v))
        return F.regexp_replace(s, r"(?s)\\(.)", "$1")

    return F.array_join(F.transform(F.split(c, r"\\\\", -1), segment), "\\")


def escape(c: Column) -> Column:
    """Wire text of a string."""
    c = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    for k, v in ESCAPES.items():
        c = F.replace(c, F.lit(v), F.lit("\\" + k))
    return c


def quote(c: Column) -> Column:
    """SQL literal of a string."""
    return F.concat(F.lit("'"), F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'")), F.lit("'"))


def wide(c: Column, name: str) -> Column:
    """Canonical digits of an integer of 128 or 256 bits; text that isn't one, or is out of range, is an error."""
    low, high = WIDE[name]
    digits = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.trim(c), r"^\+", ""), r"^(-?)0+(?=\d)", "$1"), "^-0$", "0")
    size = F.regexp_replace(digits, "^-", "")
    most = F.when(digits.startswith("-"), str(-low)).otherwise(str(high))
    over = (F.length(size) > F.length(most)) | ((F.length(size) == F.length(most)) & (size > most))
    bad = ~digits.rlike(r"^-?\d+$") | over
    return F.when(bad, F.raise_error(F.concat(F.lit(f"not in the range of {name}: "), c)).cast("string")).otherwise(digits)


def _scalar(c: Column, t: Type) -> Column:
    name = t.name
    if name == "Bool":
        return F.when(c == "true", True).when(c == "false", False).when(c.isNotNull(), F.raise_error(F.concat(F.lit("not a Bool: "), c)).cast("boolean"))
    if name in ("String", "FixedString", "Enum8", "Enum16"):
        return unescape(c)
    if name == "UUID":
        return F.lower(c)
    if name in ("IPv4", "IPv6"):
        return c
    if name in WIDE:
        return wide(c, name)
    if name == "Date":
        return F.nullif(c, F.lit("0000-00-00")).cast("date")
    if name in ("DateTime", "DateTime64"):
        return F.when(~c.startswith("0000-00-00"), c).cast("timestamp_ntz")
    if name == "Nothing":
        return F.lit(None)
    out = c.cast(spark_type(t))
    if name in UNSIGNED:
        low = out < 0
        bad = low | (out > F.lit(Decimal(LIMITS[name])).cast("decimal(20,0)")) if name in LIMITS else low
        return F.when(bad, F.raise_error(F.concat(F.lit(f"out of range of {name}: "), c)).cast(spark_type(t))).otherwise(out)
    return out


def decode(c: Column, type_: str | Type) -> Column:
    """A typed column from wire text. A top-level null is the two characters backslash and N."""
    t = parse(type_) if isinstance(type_, str) else type_
    if t.name == "LowCardinality" or t.name == "SimpleAggregateFunction":
        return decode(c, t.inner[-1])
    if t.name == "Nullable":
        return decode(F.when(c != "\\N", c), t.inner[0])
    if t.name in COMPOSITE or t.name == "AggregateFunction":
        kind = spark_type(t)

        @F.arrow_udf(kind)
        def nested(col: pa.Array) -> pa.Array:
            return pa.array([None if x is None else value(x, t) for x in col.to_pylist()], to_arrow_type(kind))

        return nested(c)
    return _scalar(c, t)


def value(text: str, t: Type):
    """The Python value of a whole nested text."""
    out, end = _value(text, 0, t)
    if text[end:].strip():
        raise EngineError(f"text after the value of {t.name}: {text[end:][:40]!r}")
    return out


def _blank(s: str, i: int) -> int:
    while i < len(s) and s[i] == " ":
        i += 1
    return i


def _list(s: str, i: int, close: str, item):
    out, i = [], _blank(s, i + 1)
    while i < len(s) and s[i] != close:
        v, i = item(s, i, len(out))
        out.append(v)
        i = _blank(s, i)
        if i < len(s) and s[i] == ",":
            i = _blank(s, i + 1)
        elif i >= len(s) or s[i] != close:
            raise EngineError(f"expected ',' or '{close}' at {i} of {s[:80]!r}")
    if i >= len(s):
        raise EngineError(f"no closing '{close}' in {s[:80]!r}")
    return out, i + 1


def _quoted(s: str, i: int) -> tuple[str, int]:
    out, i = [], i + 1
    while i < len(s) and s[i] != "'":
        if s[i] == "\\" and i + 1 < len(s):
            out.append(ESCAPES.get(s[i + 1], s[i + 1]))
            i += 2
        else:
            out.append(s[i])
            i += 1
    if i >= len(s):
        raise EngineError(f"no closing quote in {s[:80]!r}")
    return "".join(out), i + 1


def _value(s: str, i: int, t: Type):
    i = _blank(s, i)
    name = t.name
    if name in ("LowCardinality", "SimpleAggregateFunction"):
        return _value(s, i, t.inner[-1])
    if name == "Nullable":
        if s.startswith("NULL", i) or s.startswith("\\N", i):
            return None, i + (4 if s[i] == "N" else 2)
        return _value(s, i, t.inner[0])
    opens = {"Array": "[", "Nested": "[", "Map": "{", "Tuple": "(", "AggregateFunction": "("}.get(name)
    if opens and (i >= len(s) or s[i] != opens):
        raise EngineError(f"expected '{opens}' at {i} of {s[:80]!r}")
    if name == "Array":
        return _list(s, i, "]", lambda s, i, _: _value(s, i, t.inner[0]))
    if name == "Nested":
        row = Type("Tuple", t.inner, t.names)
        return _list(s, i, "]", lambda s, i, _: _value(s, i, row))
    if name == "Map":

        def entry(s, i, _):
            k, i = _value(s, i, t.inner[0])
            i = _blank(s, i)
            if i >= len(s) or s[i] != ":":
                raise EngineError(f"expected ':' at {i} of {s[:80]!r}")
            v, i = _value(s, i + 1, t.inner[1])
            return (k, v), i

        out, i = _list(s, i, "}", entry)
        return list(dict(out).items()), i
    if name == "AggregateFunction":
        kind = Type("Tuple", (Type("Float64"), Type("Int64")), ("sum", "count"))
        return _value(s, i, kind)
    if name == "Tuple":
        out, i = _list(s, i, ")", lambda s, i, k: _value(s, i, t.inner[min(k, len(t.inner) - 1)]))
        if len(out) != len(t.inner):
            raise EngineError(f"{len(out)} values for {len(t.inner)} elements: {s[:80]!r}")
        return {n or f"_{k}": v for k, (n, v) in enumerate(zip(t.names, out, strict=True), 1)}, i
    if i < len(s) and s[i] == "'":
        text, i = _quoted(s, i)
    else:
        j = i
        while j < len(s) and s[j] not in ",)]}:":
            j += 1
        text, i = s[i:j].strip(), j
    return _plain(text, t), i


def _plain(text: str, t: Type):
    name = t.name
    if name == "Bool":
        if text not in ("true", "false", "1", "0"):
            raise EngineError(f"not a Bool: {text!r}")
        return text in ("true", "1")
    if name == "Nothing":
        return None
    if name in ("String", "FixedString", "Enum8", "Enum16", "IPv4", "IPv6"):
        return text
    if name == "UUID":
        return text.lower()
    if name in WIDE:
        n = int(text)
        if not WIDE[name][0] <= n <= WIDE[name][1]:
            raise EngineError(f"not in the range of {name}: {n}")
        return str(n)
    if name == "Date":
        return None if text == "0000-00-00" else dt.date.fromisoformat(text)
    if name in ("DateTime", "DateTime64"):
        return None if text.startswith("0000-00-00") else dt.datetime.fromisoformat(text)
    if name in ("Float32", "Float64"):
        return float(text)
    if name.startswith("Decimal"):
        return Decimal(text).quantize(Decimal(1).scaleb(-spark_type(t).scale))
    n = int(text)
    if name in UNSIGNED and not 0 <= n <= LIMITS.get(name, n):
        raise EngineError(f"out of range of {name}: {n}")
    return Decimal(n) if isinstance(spark_type(t), S.DecimalType) else n


def _float(c: Column) -> Column:
    return F.when(F.isnan(c), "nan").when(c == float("inf"), "inf").when(c == float("-inf"), "-inf").otherwise(F.replace(c.cast("string"), F.lit("E"), F.lit("e")))


def encode(c: Column, t: S.DataType, inner: bool = True, wire: bool = False) -> Column:
    """Text of a column: a SQL literal, or with wire the text of a field (inner: inside a container)."""
    if isinstance(t, S.NullType):
        out = F.lit(None).cast("string")
    elif isinstance(t, S.BooleanType):
        out = c.cast("string") if wire else c.cast("int").cast("string")
    elif isinstance(t, (S.FloatType, S.DoubleType)):
        out = _float(c)
    elif isinstance(t, (S.StringType, S.VarcharType, S.CharType)):
        out = (F.concat(F.lit("'"), escape(c), F.lit("'")) if inner else escape(c)) if wire else quote(c)
    elif isinstance(t, (S.DateType, S.TimestampType, S.TimestampNTZType)):
        day = F.date_format(c, "yyyy-MM-dd")
        if not isinstance(t, S.DateType):
            second = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
            day = F.when(F.date_format(c, "SSSSSS") == "000000", second).otherwise(F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        out = F.concat(F.lit("'"), day, F.lit("'")) if inner else day
    elif isinstance(t, S.ArrayType):
        out = F.concat(F.lit("["), F.array_join(F.transform(c, lambda x: encode(x, t.elementType, True, wire)), ","), F.lit("]"))
    elif isinstance(t, S.MapType):
        pair = lambda e: F.concat(encode(e["key"], t.keyType, True, wire), F.lit(":"), encode(e["value"], t.valueType, True, wire))
        out = F.concat(F.lit("{"), F.array_join(F.transform(F.map_entries(c), pair), ","), F.lit("}"))
    elif isinstance(t, S.StructType):
        parts = [encode(c.getField(f.name), f.dataType, True, wire) for f in t]
        out = F.when(c.isNotNull(), F.concat(F.lit("("), F.concat_ws(",", *parts), F.lit(")")))
    else:
        out = c.cast("string")
    return F.coalesce(out, F.lit("\\N" if wire and not inner else "NULL"))


#: Exact types of values without inner ones.
SCALARS = {type(None), bool, int, float, str, Decimal, dt.date, dt.datetime, uuid.UUID, ipaddress.IPv4Address, ipaddress.IPv6Address}


def literal(v) -> str:
    """The SQL literal of a Python value; dispatch is on the exact type."""
    kind = type(v)
    if v is None:
        return "NULL"
    if kind is bool:
        return str(int(v))
    if kind in (int, Decimal):
        return str(v)
    if kind is float:
        return repr(v)
    if kind is str:
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if kind is dt.date:
        return f"'{v}'"
    if kind is dt.datetime:
        return "'" + v.replace(tzinfo=None).isoformat(" ", "microseconds" if v.microsecond else "seconds") + "'"
    if kind in (uuid.UUID, ipaddress.IPv4Address, ipaddress.IPv6Address):
        return f"'{v}'"
    if kind is tuple:
        return "(" + ",".join(map(literal, v)) + ")"
    if kind is list:
        return "[" + ",".join(map(literal, v)) + "]"
    if kind is dict:
        return "{" + ",".join(f"{literal(k)}:{literal(x)}" for k, x in v.items()) + "}"
    raise EngineError(f"no literal for a value of {kind}; subclasses of known types count as unknown")


def rows_literal(*rows) -> str:
    return ",".join(map(literal, rows))


def bind(v):
    """A Column or plain value for a query parameter; dispatch is on the exact type."""
    literal(v)  # refuses what isn't known
    kind = type(v)
    if kind is list:
        return F.array(*[_column(x) for x in v])
    if kind is tuple:
        return F.struct(*[_column(x).alias(f"_{i}") for i, x in enumerate(v, 1)])
    if kind is dict:
        return F.create_map(*[_column(x) for pair in v.items() for x in pair])
    return str(v) if kind in (uuid.UUID, ipaddress.IPv4Address, ipaddress.IPv6Address) else v


def _column(v) -> Column:
    out = bind(v)
    return out if isinstance(out, Column) else F.lit(out)


# Python types of values that Spark holds as text.
_AS_PYTHON = {"UUID": uuid.UUID, "IPv4": ipaddress.IPv4Address, "IPv6": ipaddress.IPv6Address, **dict.fromkeys(WIDE, int), "UInt64": int}


def converter(t: Type):
    """A function from a collected value to the Python value of t, or None if they are the same."""
    if t.name in _AS_PYTHON:
        kind = _AS_PYTHON[t.name]
        return lambda v: None if v is None else kind(v)
    if t.name in ("Nullable", "LowCardinality", "SimpleAggregateFunction"):
        return converter(t.inner[-1])
    inner = [converter(x) for x in t.inner]
    if not any(inner) or t.name == "AggregateFunction":
        return None
    same = lambda v: v
    inner = [f or same for f in inner]
    if t.name == "Array":
        return lambda v: None if v is None else [inner[0](x) for x in v]
    if t.name == "Map":
        return lambda v: None if v is None else {inner[0](k): inner[1](x) for k, x in v.items()}
    row = lambda v: None if v is None else tuple(f(x) for f, x in zip(inner, v, strict=True))
    return (lambda v: None if v is None else [row(x) for x in v]) if t.name == "Nested" else row
