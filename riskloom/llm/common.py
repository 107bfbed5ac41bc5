"""Shared helpers of the training-data operators.

Documents are tables with ``doc_id`` and ``text``; further columns travel in one struct, so their names
never clash with an operator's own. Each input row is one document, also when ids or texts repeat.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import ensure_checkpoint_dir

#: Whitespace of the word and line rules, as characters and as the inside of a character class.
WS = " \t\n\x0b\x0c\r"
WS_CLASS = "[\\x20\\x09-\\x0D]"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(column: str = "text") -> Column:
    """A null text is an empty one."""
    return F.coalesce(F.col(column), F.lit(""))


def records(docs: DataFrame) -> DataFrame:
    """(rec, doc_id, text, text_key): all columns packed in ``rec``; (doc_id, text_key) names a row's content."""
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("rec"),
        F.col("doc_id").cast("long").alias("doc_id"),
        text_of().alias("text"),
        F.xxhash64(text_of()).alias("text_key"),
    )


def saved(df: DataFrame) -> DataFrame:
    """Write a table to the shared checkpoint folder and read it back, which cuts lineage and survives
    lost executors. The files go when the application ends; the shuffle files behind the table go now."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    jvm.System.gc()  # Spark removes shuffles that nothing refers to any more when its driver collects garbage
    return spark.read.schema(df.schema).parquet(path)


def release(table: DataFrame) -> None:
    """Delete the files of a saved table that nothing reads any more."""
    spark = table.sparkSession
    for file in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(file)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Python tasks that start meanwhile get at most so many rows at once; the session's own bound holds again after."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, min(rows, int(before)) if int(before) > 0 else rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def same(left: DataFrame, right: DataFrame, *names: str) -> Column:
    """Null-safe equality of the named columns."""
    cond = F.lit(True)
    for n in names:
        cond = cond & left[n].eqNullSafe(right[n])
    return cond


def let(value: Column, use) -> Column:
    """``use(value)`` with the value evaluated once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def words_of(text: Column) -> Column:
    """The words of a text: maximal runs without whitespace. No words: an empty array."""
    inner = F.btrim(text, F.lit(WS))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, WS_CLASS + "+"))


def paired(a: Column, gap: int) -> Column:
    """Hash of each element with the one ``gap`` places on; the last ``gap`` elements have no partner."""
    return F.zip_with(a, F.slice(a, gap + 1, F.size(a)), lambda x, y: F.xxhash64(x, y))
