"""Ordered event checks, first failure wins, as one CASE expression."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.config import (
    CURRENCIES,
    MAX_AMOUNT,
    MAX_FUTURE_SECONDS,
    MAX_PAST_DAYS,
    MIN_AMOUNT,
    RAW_DIRECTIONS,
    RAW_STATUSES,
    REQUIRED_FIELDS,
)
from riskloom.functions.columns import (
    add_once,
    empty_to_null,
    float_text,
    is_blank,
    iso_text,
    quoted,
    strip,
    to_double,
    to_long,
)


def _listing(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in sorted(values)) + "]"


def _instant_text(ts: Column) -> Column:
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))


def parse_fields(events: DataFrame) -> DataFrame:
    """Add the typed form of each field; every text is parsed once per row. The number of an id that was not sent
    as text (``tenant_number``, ``transaction_number``) counts before its text."""
    spelled = events.withColumn("_iso", iso_text(F.col("timestamp")))
    texts = ("transaction_id", "transaction_reference", "account_id", "amount", "timestamp")
    return add_once(
        spelled,
        _tenant=_id(events, "tenant"),
        _tx=_id(events, "transaction"),
        _amount=to_double(F.col("amount")),
        _time=F.col("_iso").try_cast("timestamp"),
        _wall=F.col("_iso").try_cast("timestamp_ntz"),
        **{f"_{f}": F.upper(strip(F.col(f))) for f in ("currency", "direction", "status")},
        **{f"_no_{f}": is_blank(F.col(f)) for f in texts},
    ).drop("_iso")


def _id(events: DataFrame, name: str) -> Column:
    read = to_long(F.col(f"{name}_id"))
    return F.coalesce(F.col(f"{name}_number"), read) if f"{name}_number" in events.columns else read


def _code(as_of: Column) -> Column:
    """Rejection code of the first failing check."""
    newest = as_of + F.expr(f"INTERVAL '{MAX_FUTURE_SECONDS}' SECOND")
    oldest = as_of - F.expr(f"INTERVAL '{MAX_PAST_DAYS}' DAY")

    def fails(good: Column) -> Column:
        return ~F.coalesce(good, F.lit(False))

    def missing(field: str) -> Column:
        if field in ("currency", "direction", "status"):
            return F.col(f"_{field}").isNull() | (F.col(f"_{field}") == "")
        return F.col(f"_no_{field}")

    return (
        F.when(~F.col("parse_ok"), "SCHEMA_ERROR")
        .when(fails(F.col("_tenant") > 0), "INVALID_TENANT")
        .when(reduce(lambda a, b: a | b, [missing(f) for f in REQUIRED_FIELDS]), "MISSING_FIELD")
        .when(fails(F.col("_amount").between(MIN_AMOUNT, MAX_AMOUNT)), "INVALID_AMOUNT")
        .when(~F.col("_currency").isin(CURRENCIES), "INVALID_CURRENCY")
        .when(~F.col("_direction").isin(RAW_DIRECTIONS), "INVALID_DIRECTION")
        .when(~F.col("_status").isin(RAW_STATUSES), "INVALID_STATUS")
        .when(fails(F.col("_time") <= newest), "INVALID_TIMESTAMP")
        .when(F.col("_time") < oldest, "STALE_EVENT")
        .when(F.col("_tx").isNull(), "SCHEMA_ERROR")
    )


def _reason(as_of: Column) -> tuple[Column, Column]:
    """Human readable reason, as the part for word checks and the part for parsed values."""
    code, amount, stamp = F.col("rejection_code"), F.col("_amount"), F.col("_time")
    first_missing = F.coalesce(*[F.when(is_blank(F.col(f)), F.lit(f)) for f in REQUIRED_FIELDS])
    tenant = F.concat(
        F.when(F.col("_tenant").isNull(), "tenant_id is not a valid integer: ").otherwise(
            "tenant_id must be positive integer, got "
        ),
        quoted(F.col("tenant_id")),
    )
    amount_text = (
        F.when(amount.isNull() | F.isnan(amount), F.concat(F.lit("amount is not a valid number: "), quoted(F.col("amount"))))
        .when(
            amount < MIN_AMOUNT,
            F.concat(
                F.lit("amount "), float_text(amount),
                F.lit(f" is below minimum {MIN_AMOUNT} (zero or negative amounts rejected)"),
            ),
        )
        .otherwise(
            F.concat(F.lit("amount "), F.format_number(amount, 2), F.lit(f" exceeds ceiling {MAX_AMOUNT:,.2f}"))
        )
    )
    currency = F.concat(
        F.lit("currency '"), F.col("_currency"),
        F.lit(f"' is not in the allowed list. Allowed: {_listing(CURRENCIES)}"),
    )

    def not_valid(field: str, allowed: list[str]) -> Column:
        return F.concat(F.lit(f"{field} '"), F.col(field), F.lit(f"' is not valid. Allowed: {_listing(allowed)}"))

    unparsed = F.concat(
        F.lit("timestamp '"), F.col("timestamp"),
        F.lit("' could not be parsed: Invalid isoformat string: '"),
        F.replace(F.col("timestamp"), F.lit("Z"), F.lit("+00:00")), F.lit("'"),
    )
    ahead = F.pmod(F.unix_seconds(stamp) - F.unix_seconds(as_of), F.lit(86400)).cast("string")
    future = F.concat(
        F.lit("timestamp "), _instant_text(stamp), F.lit(" is "), ahead,
        F.lit(f"s in the future (max allowed: {MAX_FUTURE_SECONDS}s)"),
    )
    stale = F.concat(
        F.lit("timestamp "), _instant_text(stamp), F.lit(f" is more than {MAX_PAST_DAYS} days in the past")
    )
    schema = F.when(
        F.col("parse_ok"), F.concat(F.lit("transaction_id is not a valid integer: "), quoted(F.col("transaction_id")))
    ).otherwise("payload is not a JSON object")
    simple = (
        F.when(code == "SCHEMA_ERROR", schema)
        .when(code == "MISSING_FIELD", F.concat(F.lit("Required field '"), first_missing, F.lit("' is missing or empty")))
        .when(code == "INVALID_CURRENCY", currency)
        .when(code == "INVALID_DIRECTION", not_valid("direction", RAW_DIRECTIONS))
        .when(code == "INVALID_STATUS", not_valid("status", RAW_STATUSES))
    )
    formatted = (
        F.when(code == "INVALID_TENANT", F.coalesce(tenant, F.lit("tenant_id is missing")))
        .when(code == "INVALID_AMOUNT", amount_text)
        .when(code == "INVALID_TIMESTAMP", F.when(stamp.isNull(), unparsed).otherwise(future))
        .when(code == "STALE_EVENT", stale)
    )
    return simple, formatted


def with_reason(judged: DataFrame, as_of: Column) -> DataFrame:
    """Add ``rejection_reason``; in two operators, which keeps their code small."""
    simple, formatted = _reason(as_of)
    return add_once(judged, _simple=simple).withColumn("rejection_reason", F.coalesce("_simple", formatted)).drop("_simple")


def as_of_column(as_of: str | Column | None) -> Column:
    if as_of is None:
        return F.current_timestamp()
    return F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else as_of


def validate(events: DataFrame, as_of: str | Column | None = None) -> DataFrame:
    """Add ``rejection_code``, null for valid events, and the parsed fields.

    Input: event fields as text plus ``parse_ok``. ``as_of`` stands for the present moment.
    """
    return parse_fields(events).withColumn("rejection_code", _code(as_of_column(as_of)))


def verdicts(judged: DataFrame, *keep: str, as_of: str | Column | None = None) -> DataFrame:
    return with_reason(judged, as_of_column(as_of)).select(
        *keep, F.col("rejection_code").isNull().alias("valid"), "rejection_code", "rejection_reason"
    )


def rejected(judged: DataFrame, *keep: str, stage: str = "raw", as_of: str | Column | None = None) -> DataFrame:
    """Dead-letter records of the events that failed, payload included."""
    failed = judged.where(F.col("rejection_code").isNotNull())
    return with_reason(failed, as_of_column(as_of)).select(
        *keep,
        F.lit(stage).alias("pipeline_stage"),
        "rejection_code",
        "rejection_reason",
        "raw_payload",
        F.col("_tenant").alias("tenant_id"),
        F.coalesce(empty_to_null(F.col("transaction_reference")), empty_to_null(F.col("transaction_id"))).alias("event_id_text"),
        empty_to_null(F.col("account_id")).alias("account_id"),
        F.col("_amount").try_cast("decimal(18,2)").alias("amount"),
        as_of_column(as_of).alias("rejected_at"),
    )


def valid(judged: DataFrame, *keep: str) -> DataFrame:
    """Events that passed, typed; ``event_wall`` keeps the clock reading as sent."""
    return judged.where(F.col("rejection_code").isNull()).select(
        *keep,
        F.coalesce("event_version", F.lit("v1")).alias("event_version"),
        F.col("_tenant").alias("tenant_id"),
        F.col("_tx").alias("transaction_id"),
        "transaction_reference",
        "account_id",
        F.col("_amount").alias("amount"),
        F.col("_currency").alias("currency"),
        "direction",
        "status",
        F.col("_time").alias("event_time"),
        F.col("_wall").alias("event_wall"),
        "vendor_code",
        "employee_id",
    )


def reject_profile(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy("pipeline_stage", "rejection_code").agg(F.count("*").alias("n_events"))


def latest_rejects(rejects: DataFrame, by: str = "rejected_at", limit: int = 10) -> DataFrame:
    return rejects.orderBy(F.desc(by)).limit(limit)
