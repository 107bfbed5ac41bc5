"""Event payloads: Kafka and file sources, and the JSON decoder they share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.config import EVENT_FIELDS

_BROKEN = "_broken"
# All fields as text: a typed schema would silently turn "500.00" into null.
TEXT_SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in [*EVENT_FIELDS, _BROKEN]])


_PLAIN_INTEGER = r"^\s*[+-]?\d+\s*$"


def _typed_integer(payload: Column, field: str, whole_only: bool) -> Column:
    """A JSON number or boolean as a whole number; null for a text, which is read as text elsewhere.

    The text form of a field cannot tell 1.0 from "1.0" or true from "true", the variant form can. Only fields that
    do not read as a plain integer come here, so few payloads are parsed twice.
    """
    value = F.try_variant_get(F.try_parse_json(payload), f"$.{field}", "variant")
    kind = F.schema_of_variant(value)
    number = F.try_variant_get(value, "$", "double")
    towards_zero = F.when(number < 0, F.ceil(number)).otherwise(F.floor(number))
    whole = F.when(number == towards_zero, number) if whole_only else towards_zero
    return (
        F.when(kind == "BOOLEAN", F.try_variant_get(value, "$", "boolean").cast("bigint"))
        .when(kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)") & (F.abs(number) < 9e18), whole.cast("bigint"))
    )


def decode_payloads(df: DataFrame, value: str = "value") -> DataFrame:
    """Add the event fields as text, the payload itself, ``parse_ok``, and ``tenant_number`` and
    ``transaction_number`` for ids that are JSON numbers or booleans of another form than a plain integer.

    Anything that is not one JSON object (broken text, list, scalar, null) has ``parse_ok`` false. A tenant is cut
    to a whole number (1.9 is 1), a transaction id must be one.
    """
    text = F.col(value).cast("string")
    keep = [c for c in df.columns if c != value]
    parsed = df.select(
        *keep,
        text.alias("raw_payload"),
        F.from_json(text, TEXT_SCHEMA, {"columnNameOfCorruptRecord": _BROKEN}).alias("e"),
    )
    ok = F.coalesce(
        F.col("e").isNotNull() & F.col(f"e.{_BROKEN}").isNull() & F.ltrim(F.col("raw_payload")).startswith("{"),
        F.lit(False),
    )
    typed = [
        F.when(~F.col(f"e.{f}").rlike(_PLAIN_INTEGER), _typed_integer(F.col("raw_payload"), f, whole)).alias(name)
        for name, f, whole in (("tenant_number", "tenant_id", False), ("transaction_number", "transaction_id", True))
    ]
    return parsed.select(*keep, "raw_payload", ok.alias("parse_ok"), *[F.col(f"e.{f}").alias(f) for f in EVENT_FIELDS], *typed)


def with_payload(raw: DataFrame) -> DataFrame:
    """Already split events: rebuild the JSON payload so that rejects can be replayed."""
    body = F.to_json(F.struct(*[c for c in EVENT_FIELDS if c in raw.columns]))
    return raw.select("*", body.alias("raw_payload"), F.lit(True).alias("parse_ok"))


def kafka_options(servers: str, topic: str, starting: str = "earliest", max_per_trigger: int | None = None) -> dict[str, str]:
    opts = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": "true",
    }
    if max_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return opts


def kafka_stream(spark: SparkSession, servers: str, topic: str = "transactions_raw", **kw) -> DataFrame:
    """Payload stream of a topic with the place of each record (``source_version``); needs the Spark Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**kafka_options(servers, topic, **kw)).load().select(
        "value", F.struct(F.col("partition").cast("long").alias("part"), "offset").alias("source_version")
    )


def file_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Payload stream of text files with one JSON object per line, and the place of each (``source_version``)."""
    reader = spark.readStream.schema("value STRING")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    place = ("file_modification_time", "file_path", "file_block_start")
    return reader.text(path).select("value", F.struct(*[F.col(f"_metadata.{c}") for c in place]).alias("source_version"))


def payload_batch(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)
