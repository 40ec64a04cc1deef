"""Shared plumbing of the training-data operators: tables, folds, cut points, checked broadcasts."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a table, as counted rows times a stated width, up to which it may be broadcast.
BROADCAST_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: Column | str, modulus: int) -> Column:
    """crc32 of the key as text, modulo; a null key counts as the empty text."""
    key = F.col(key) if isinstance(key, str) else key
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % modulus


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a default is set only where none is configured and all is one machine."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "/tmp/wirequery-shared"
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def _path(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, removed when the driver's JVM ends."""
    path = f"{shared_dir(spark)}/wq-{name}-{uuid.uuid4().hex}"
    hadoop, files = _path(spark, path)
    files.deleteOnExit(hadoop)
    return path


class Scope:
    """Written tables of one computation; all but those that its result needs are removed when it closes."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def cut(self, df: DataFrame, name: str) -> DataFrame:
        """Write df to the shared folder and read it back: lineage ends there, lost executors lose nothing."""
        path = scratch(self.spark, name)
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (path, out)
        return out

    def free(self, *tables: DataFrame) -> None:
        for t in tables:
            path, _ = self.paths.pop(id(t))
            hadoop, files = _path(self.spark, path)
            files.delete(hadoop, True)

    def close(self, *keep: DataFrame) -> None:
        self.free(*[t for k, (_, t) in list(self.paths.items()) if k not in {id(x) for x in keep}])


def cut(df: DataFrame, name: str) -> DataFrame:
    """Scope.cut for a table that stays until the driver ends."""
    return Scope(df.sparkSession).cut(df, name)


def small(df: DataFrame, width: int = 32, limit: int = BROADCAST_BYTES) -> DataFrame:
    """df with a broadcast hint if its rows, counted, take at most `limit` bytes at `width` each, else as it is: the join
    then shuffles. Only for tables whose rows have that width at most and that are cheap to count (cut before).
    """
    rows = limit // width
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def partitions(spark: SparkSession, bytes_: float, per: int = 48 << 20) -> int:
    """Partitions for a stage over that many bytes, at least the configured shuffle width."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(bytes_ // per) + 1)
