"""Joins that Spark has no operator for, as linear plans: as-of and range."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof(left: DataFrame, right: DataFrame, by: str, at: str, value: str, name: str) -> DataFrame:
    """left with a column `name`: value of right's latest row of the same `by` whose `at` isn't after, null if there is none.

    One sort of both sides together; of right's rows at one instant the one with the greatest value counts. Rows of left
    with a null in `by` or `at` get null.
    """
    rows = left.select(F.col(by).alias("__wq_by"), F.col(at).alias("__wq_at"), F.lit(1).alias("__wq_side"), F.lit(None).cast(right.schema[value].dataType).alias("__wq_value"), F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("__wq_row"))
    marks = right.filter(F.col(by).isNotNull() & F.col(at).isNotNull()).select(F.col(by).alias("__wq_by"), F.col(at).alias("__wq_at"), F.lit(0).alias("__wq_side"), F.col(value).alias("__wq_value"), F.lit(None).cast(rows.schema["__wq_row"].dataType).alias("__wq_row"))
    order = Window.partitionBy("__wq_by").orderBy("__wq_at", "__wq_side", "__wq_value").rowsBetween(Window.unboundedPreceding, 0)
    found = F.when(F.col("__wq_by").isNotNull() & F.col("__wq_at").isNotNull(), F.last("__wq_value", ignorenulls=True).over(order))
    both = rows.unionByName(marks).withColumn(name, found).filter("__wq_side = 1")
    return both.select("__wq_row.*", name)


def within(left: DataFrame, right: DataFrame, by: str, at: str, before: str, seconds: int, match: Column | None = None) -> DataFrame:
    """Pairs of rows of the same `by` where right's `before` is up to `seconds` before left's `at`, or at it.

    Time is cut into buckets of `seconds`; a left row meets right rows of its own bucket and of the one before, so a key's
    rows are dealt over its buckets. Column names of the two sides must differ but for `by`, which comes once.
    """
    bucket = lambda c: F.floor(F.unix_micros(F.col(c).cast("timestamp")) / (seconds * 1_000_000))
    x = left.withColumn("__wq_bucket", F.explode(F.array(bucket(at), bucket(at) - 1)))
    y = right.withColumn("__wq_bucket", bucket(before))
    span = F.make_dt_interval(secs=F.lit(seconds))
    near = (F.col(before) <= F.col(at)) & (F.col(before) >= F.col(at) - span)
    return x.join(y, [by, "__wq_bucket"]).filter(near if match is None else near & match).drop("__wq_bucket")
