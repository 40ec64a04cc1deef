"""A training-corpus pipeline over `documents`, from the operators of wirequery.llm.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; its result is written and read again
before the next. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wirequery.llm import decontam, jaccard, langid, linededup, mixing
from wirequery.llm.common import cut, table


#: Rows of a batch that goes to Python, where the session has Spark's default: it bounds what workers and their buffers hold.
BATCH_ROWS, DEFAULT_ROWS = "2000", "10000"


def modest(spark: SparkSession) -> None:
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == DEFAULT_ROWS:
        spark.conf.set(key, BATCH_ROWS)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without letters and those whose language is ambiguous; learns from all that have a language."""
    modest(spark)
    model = langid.fit(docs)
    rows = docs.withColumn("__wq_lang", langid.identify(model, spark, F.col("text")))
    return rows.filter((F.col("__wq_lang.lang_pred") != "und") & ~F.col("__wq_lang.ambiguous")).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops recurring lines but for their first text; documents of which nothing is left go."""
    modest(spark)
    out = linededup.dedup(docs).filter((F.col("n_dropped") == 0) | F.col("text").rlike("[^ \\t\\n\\r\\f\\x0B]"))
    return out.withColumn("n_chars", F.when(F.col("n_dropped") == 0, F.col("n_chars")).otherwise(F.length("text").cast("long"))).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group at a similarity of 0.75 of five-word shingles."""
    modest(spark)
    return jaccard.one_each(docs, percent=75)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a test item, or an edited copy of one."""
    modest(spark)
    hits = decontam.found(docs, table(spark, sf_dir, "benchmark"))
    return docs.withColumn("__wq_hits", hits).filter(F.size("__wq_hits") == 0).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixes sources to shares in proportion to the square root of their size."""
    return mixing.mix(docs, alpha=0.5, seed=17)


STAGES = [("language", language), ("lines", lines), ("near_duplicates", near_duplicates), ("benchmark", benchmark), ("mix", mix)]

#: Language ID and alignment have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
