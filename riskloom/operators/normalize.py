"""From valid events to transaction records, and the text and score normalisers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.config import (
    DIRECTION_ALIASES,
    DIRECTIONS,
    RULE_LABELS,
    STATUS_ALIASES,
    STATUSES,
    TX_DEFAULTS,
)
from riskloom.functions.columns import empty_to_null, map_values, strip

# Columns of the stored transaction record.
TX_COLUMNS = [
    "tenant_id", "tx_id", "account_id", "customer_id", "invoice_id", "tx_time", "booking_time",
    "amount", "currency", "direction", "status", "country_code", "merchant_category", "channel",
    "description",
]
# What scoring needs beyond the record itself.
CONTEXT_COLUMNS = [
    "transaction_id", "transaction_reference", "vendor_code", "employee_id", "amount_raw",
    "direction_raw", "status_raw", "event_version", "event_wall",
]
# The enriched event as it is sent on: exactly these fields. The last three are null without a vendor lookup.
ENRICHED_FIELDS = [
    "event_version", "transaction_id", "tenant_id", "transaction_reference", "account_id", "amount", "currency",
    "direction", "status", "timestamp", "vendor_code", "employee_id",
    "vendor_risk_level", "vendor_country_code", "is_high_risk_country",
]

RULE_RESULT = "struct<rule_name:string,triggered:boolean,score:double,reasons:array<string>>"


def _to_domain(c: Column, aliases: dict[str, str], domain: list[str], default: str) -> Column:
    mapped = map_values(F.upper(strip(c)), aliases)
    return F.when(mapped.isin(domain), mapped).otherwise(default)


def normalize_status(c: Column) -> Column:
    return _to_domain(c, STATUS_ALIASES, STATUSES, "PENDING")


def normalize_direction(c: Column) -> Column:
    return _to_domain(c, DIRECTION_ALIASES, DIRECTIONS, "DEBIT")


def transactions(valid_events: DataFrame, *keep: str) -> DataFrame:
    """Transaction record plus scoring context, one row per valid event."""
    return valid_events.select(
        *keep,
        F.col("transaction_id").alias("id"),
        "tenant_id",
        F.col("transaction_id").cast("string").alias("tx_id"),
        "account_id",
        F.lit(None).cast("string").alias("customer_id"),
        F.lit(None).cast("bigint").alias("invoice_id"),
        F.col("event_time").alias("tx_time"),
        F.col("event_time").alias("booking_time"),
        F.col("amount").cast("decimal(18,2)").alias("amount"),
        "currency",
        normalize_direction(F.col("direction")).alias("direction"),
        normalize_status(F.col("status")).alias("status"),
        *[F.lit(v).alias(k) for k, v in TX_DEFAULTS.items()],
        F.concat(F.lit("ref="), "transaction_reference").alias("description"),
        "transaction_id",
        "transaction_reference",
        "vendor_code",
        "employee_id",
        F.col("amount").alias("amount_raw"),
        F.col("direction").alias("direction_raw"),
        F.col("status").alias("status_raw"),
        "event_version",
        "event_wall",
    )


def enriched_events(tx: DataFrame) -> DataFrame:
    """The declared enriched event of each transaction, direction and status as they were sent."""
    given = {
        "direction": F.col("direction_raw"), "status": F.col("status_raw"), "timestamp": F.col("tx_time"),
        **{c: F.col(c) if c in tx.columns else F.lit(None).cast(t) for c, t in (
            ("vendor_risk_level", "string"), ("vendor_country_code", "string"), ("is_high_risk_country", "boolean"),
        )},
    }
    return tx.select(*[given.get(f, F.col(f)).alias(f) for f in ENRICHED_FIELDS])


def enriched_messages(tx: DataFrame) -> DataFrame:
    """Enriched events as (key, value) messages; every declared field is there, null ones too."""
    body = F.to_json(F.struct(*ENRICHED_FIELDS), {"ignoreNullFields": "false"})
    return enriched_events(tx).select(F.col("transaction_reference").alias("key"), body.alias("value"))


def transaction_reference(description: str = "description", tx_id: str = "tx_id", id_: str = "id") -> Column:
    """Text after the first ``ref=``, else the transaction id, else the row id."""
    text = strip(F.coalesce(F.col(description), F.lit("")))
    at = F.locate("ref=", text)
    after = F.when(at > 0, empty_to_null(strip(F.substr(text, at + 4))))
    return F.coalesce(after, empty_to_null(F.col(tx_id)), F.col(id_).cast("string"))


def rules_to_list(c: Column) -> Column:
    """Stored rule codes (comma separated or a JSON list) as an array without blanks."""
    text = strip(F.coalesce(c, F.lit("")))
    as_json = F.when(text.startswith("[") & text.endswith("]"), F.from_json(text, "array<string>"))
    parts = F.coalesce(as_json, F.split(text, ","))
    return F.filter(F.transform(parts, strip), lambda x: x != "")


def rules_to_text(c: Column) -> Column:
    return F.array_join(c, ",")


def rule_results(c: Column) -> Column:
    """Stored rule results JSON as an array of structs. Each item is read on its own: one that is unusable drops
    out and the others stay. Text that is broken or no list gives an empty array."""
    listed = F.when(strip(c).startswith("["), F.from_json(c, "array<string>"))
    items = F.coalesce(listed, F.array().cast("array<string>"))
    parsed = F.transform(items, lambda x: F.when(strip(x).startswith("{"), F.from_json(x, RULE_RESULT)))
    return F.filter(
        parsed, lambda r: r["rule_name"].isNotNull() & r["triggered"].isNotNull() & r["score"].isNotNull()
    )


def transaction_view(tx: DataFrame) -> DataFrame:
    """Public shape: amount as double (null is 0), reference and timestamp filled in."""
    return tx.select(
        "id", "tenant_id", F.coalesce("tx_id", F.col("id").cast("string")).alias("tx_id"),
        transaction_reference().alias("transaction_reference"),
        "account_id", "customer_id", "invoice_id", "tx_time", F.col("tx_time").alias("timestamp"), "booking_time",
        F.coalesce(F.col("amount").cast("double"), F.lit(0.0)).alias("amount"),
        "currency", "direction", "status", "country_code", "merchant_category", "channel", "description",
    )


def label_rules(hits: DataFrame, code: str = "rule_id") -> DataFrame:
    """Label, category and tone of each rule code; the table is fixed, so no join is needed."""
    c = F.col(code)
    cols = []
    for i, (name, default) in enumerate((("label", c), ("category", F.lit("Other")), ("tone", F.lit("neutral")))):
        known = map_values(c, {k: v[i] for k, v in RULE_LABELS.items()})
        cols.append(F.when(c.isin(list(RULE_LABELS)), known).otherwise(default).alias(name))
    return hits.select("*", *cols)


def fill_timestamps(df: DataFrame, as_of: Column, columns: tuple[str, ...] = ("created_at", "updated_at")) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), as_of) for c in columns})


def repair_score(c: Column) -> Column:
    """Double score to whole number: null is 0, halves go to the even neighbour."""
    return F.bround(F.coalesce(c, F.lit(0.0)), 0).cast("int")
