"""File formats by name: readers for ingest, and TSVWithNamesAndTypes and JSONEachRow in both directions."""

from __future__ import annotations

import io
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as S

from ..errors import EngineError
from ..functions import codec
from ..types import name_of

# Names of formats.
CSV = ("CSV", "CSVWithNames")
TSV = ("TabSeparated", "TSV", "TabSeparatedWithNames", "TSVWithNames")
TYPED = ("TSVWithNamesAndTypes", "TabSeparatedWithNamesAndTypes")
JSON = ("JSONEachRow",)
PARQUET = ("Parquet",)


#: Bytes of a file that pass from Python at once.
PIECE = 4 << 20


def folder(spark: SparkSession) -> str:
    """A fresh path where the driver and the executors see it, removed when the driver's JVM ends."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise EngineError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = "/tmp/wirequery-shared"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{base}/ingest-{uuid.uuid4().hex}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return path.toString()


def staged(spark: SparkSession, data) -> str:
    """A file with data: bytes, or a binary file, copied in pieces."""
    name = folder(spark)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path)
    source = data if hasattr(data, "read") else io.BytesIO(data)
    while piece := source.read(PIECE):
        out.write(bytearray(piece))
    out.close()
    return name


def _fields(lines: DataFrame, schema: S.StructType) -> DataFrame:
    """Columns of raw TSV lines, decoded by the schema's types; a line of another width is an error."""
    parts = F.split("value", "\t", -1)
    width = F.size(parts)
    checked = F.when(width == len(schema), parts).otherwise(F.raise_error(F.concat(F.lit(f"expected {len(schema)} fields, found "), width.cast("string"))).cast("array<string>"))
    return lines.select(checked.alias("p")).select(*[codec.decode(F.when(F.get("p", F.lit(i)) != "\\N", F.get("p", F.lit(i))), (f.metadata or {}).get("ch_type") or name_of(f.dataType)).alias(f.name) for i, f in enumerate(schema)])


def _text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(F.regexp_replace("value", "\r$", "").alias("value"))


def _below(spark: SparkSession, path: str, n: int) -> DataFrame:
    """Lines of a path without the first n of each file, by position; a file's first lines are those of its block at 0."""

    def run(batches):
        left = {}
        for batch in batches:
            files, keep = batch.column(1).dictionary_encode(), np.ones(batch.num_rows, bool)
            at, first = files.indices.to_numpy(zero_copy_only=False), batch.column(2).to_numpy(zero_copy_only=False) == 0
            for i, file in enumerate(files.dictionary.to_pylist()):
                if left.setdefault(file, n):
                    mine = np.flatnonzero((at == i) & first)[: left[file]]
                    keep[mine] = False
                    left[file] -= len(mine)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(keep))], ["value"])

    rows = spark.read.option("lineSep", "\n").text(path).select(F.regexp_replace("value", "\r$", "").alias("value"), "_metadata.file_path", "_metadata.file_block_start")
    return rows.mapInArrow(run, "value string")


def _headed(first: str | None, sep: str, schema: S.StructType) -> bool:
    """Whether a file's first line has the names of the columns."""
    return first is not None and [x.strip().strip('"') for x in first.rstrip("\r\n").split(sep)] == schema.names


def read(spark: SparkSession, name: str, path: str, schema: S.StructType) -> DataFrame:
    """A file in a named format, with the columns and types of schema; bad rows fail when the result is used."""
    known = {x.lower(): x for x in (*CSV, *TSV, *TYPED, *JSON, *PARQUET)}
    name = known.get(name.lower(), name)
    if name in PARQUET:
        found = spark.read.parquet(path)
        return found.select(*[F.col(f.name).cast(f.dataType) if f.name in found.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema])
    if name in JSON:
        first = _text(spark, path).filter(F.trim("value") != "").limit(1).collect()
        whole = bool(first) and first[0].value.lstrip().startswith("[")  # an array, maybe over many lines
        reader = spark.read.schema(schema).option("mode", "FAILFAST").option("multiLine", whole)
        return reader.option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]").json(path)
    if name in TYPED:
        names, types = (r.value.split("\t") for r in _text(spark, path).limit(2).collect())
        own = S.StructType([S.StructField(n, S.StringType(), True, {"ch_type": t}) for n, t in zip(names, types, strict=True)])
        return _fields(_below(spark, path, 2), own)
    if name not in (*CSV, *TSV):
        raise EngineError(f"Unknown format: {name}")
    first = _text(spark, path).limit(1).collect()
    sep = "," if name in CSV else "\t"
    headed = _headed(first[0].value if first else None, sep, schema)
    if name in TSV:
        return _fields(_below(spark, path, 1) if headed else _text(spark, path), schema)
    # A CSV row with too few or too many fields, or a field of a wrong type, fails. A doubled quote stands for one; an empty
    # field is null here and becomes the default of a column that isn't nullable.
    raw = S.StructType([S.StructField(f.name, f.dataType if not isinstance(f.dataType, (S.ArrayType, S.MapType, S.StructType)) else S.StringType()) for f in schema])
    found = spark.read.schema(raw).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]").csv(path, header=headed, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True, mode="FAILFAST", enforceSchema=True, quote='"', escape='"', nullValue="\\N", emptyValue="")
    return found.select(*[codec.decode(F.col(f.name), (f.metadata or {}).get("ch_type") or name_of(f.dataType)).alias(f.name) if raw[f.name].dataType != f.dataType else F.col(f.name) for f in schema])


def lines(df: DataFrame) -> DataFrame:
    """TSV data lines of a result, in one column `line`; fields are encoded by built-in expressions."""
    fields = [codec.encode(F.col(f"`{f.name}`"), f.dataType, False, True) for f in df.schema]
    return df.select(F.concat_ws("\t", *fields).alias("line"))


def json_lines(df: DataFrame) -> DataFrame:
    """JSONEachRow lines, nulls kept, in one column `line`."""
    return df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}).alias("line"))
