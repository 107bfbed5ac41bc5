"""Table readers: files, catalog tables and JDBC, all returning plain DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, source: str, fmt: str = "parquet", schema=None, **options: str) -> DataFrame:
    """Read files (``parquet``, ``orc``, ``json``, ``csv``), a catalog table or a JDBC table.

    For JDBC pass ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions`` so
    that the read is spread over executors.
    """
    if fmt == "table":
        return spark.read.table(source)
    reader = spark.read.options(**options)
    if fmt == "jdbc":
        missing = {"partitionColumn", "lowerBound", "upperBound", "numPartitions"} - options.keys()
        if missing:
            raise ValueError(f"a JDBC read needs {sorted(missing)}, or one task reads the whole table")
        return reader.format("jdbc").option("dbtable", source).load()
    if schema is not None:
        reader = reader.schema(schema)
    return reader.format(fmt).load(source)
