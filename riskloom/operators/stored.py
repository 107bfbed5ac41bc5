"""Working tables on shared storage between the steps of one operator."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from riskloom.session import ensure_checkpoint_dir


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back.

    What follows reads columns of files instead of computing ``df`` again, also after losing executors. The
    files go when the application ends.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return spark.read.schema(df.schema).parquet(path)


def release(table: DataFrame) -> None:
    """Delete the files of a stored table that nothing reads any more."""
    spark = table.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
