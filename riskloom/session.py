"""Session construction and the settings every job relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def build_session(app: str = "riskloom", master: str | None = None, **extra: str) -> SparkSession:
    """Session with adaptive execution and UTC time; deployments override through ``extra``."""
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    if master:
        b = b.master(master)
    for k, v in extra.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    require_utc(spark)
    return spark


def require_utc(spark: SparkSession) -> None:
    """Dates, hours and string timestamps are all defined in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the shared folder the cluster names; fall back to a local one in local mode only."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if sc.getCheckpointDir() is None:
        if named is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a shared folder before iterative jobs")
            named = tempfile.mkdtemp(prefix="riskloom-ckpt-")
        sc.setCheckpointDir(named)
    return sc.getCheckpointDir()
