"""Analyst queries: filtered and paged lists, searches, KPIs and histograms.

Filters sit on raw columns so that they reach the scan. A page is ordered with a unique tie-break
and planned as a top-k. Pages that follow one another seek by the place of the last row (``page_token``).
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from riskloom.config import KPI_CRITICAL, KPI_HIGH, PAGE_DEFAULT, PAGE_MAX
from riskloom.functions.columns import all_of, share_percent
from riskloom.operators.features import ACCOUNT, FEATURE_COLUMNS
from riskloom.operators.joins import lookup_join


#: Column and whether it sorts descending.
Order = list[tuple[str, bool]]


def page(df: DataFrame, order: Order, limit: int = PAGE_DEFAULT, offset: int = 0, after: str | None = None) -> DataFrame:
    """One page in ``order``, whose last column must be unique. Nulls are the smallest values.

    ``after`` is the token of the last row of the page before (``page_token``): the page starts behind that row, the
    scan gets a range filter on the first column, and tasks keep ``limit`` rows however far in the list the page is.
    With ``offset`` instead they keep ``offset + limit`` rows.
    """
    if not 1 <= limit <= PAGE_MAX:
        raise ValueError(f"limit must be between 1 and {PAGE_MAX}")
    if offset < 0:
        raise ValueError("offset must not be negative")
    if after is not None:
        if offset:
            raise ValueError("give after or offset, not both")
        df = df.where(_behind(df, order, after))
    ordered = df.orderBy(*[F.desc(c) if down else F.asc(c) for c, down in order])
    return (ordered.offset(offset) if offset else ordered).limit(limit)


def page_token(row: Row, order: Order) -> str:
    """The place of a row in a list, as text; it stays right when rows come and go."""
    return json.dumps([None if row[c] is None else str(row[c]) for c, _ in order])


def _behind(df: DataFrame, order: Order, token: str) -> Column:
    """Rows that come after the token's row."""
    values = json.loads(token)
    if not isinstance(values, list) or len(values) != len(order):
        raise ValueError("the token belongs to another list")
    out, tie = F.lit(False), F.lit(True)
    for (c, down), v in zip(order, values):
        if v is None:  # nulls are last when descending, first when ascending
            later = F.lit(False) if down else F.col(c).isNotNull()
            same = F.col(c).isNull()
        else:
            value = F.lit(v).cast(df.schema[c].dataType)
            later = (F.col(c) < value) | F.col(c).isNull() if down else F.col(c) > value
            same = F.col(c) == value
        out, tie = out | (tie & later), tie & same
    (c, down), v = order[0], values[0]
    if v is None:
        return out
    value = F.lit(v).cast(df.schema[c].dataType)
    # Implied by the rest, and alone simple enough for the scan to skip files by.
    bound = (F.col(c) <= value) | F.col(c).isNull() if down else F.col(c) >= value
    return bound & out


def _where(df: DataFrame, *conds: Column | None) -> DataFrame:
    cond = all_of(*conds)
    return df if cond is None else df.where(cond)


def _eq(column: str, value) -> Column | None:
    return None if value in (None, "") else F.col(column) == value


def _at_least(column: str, value, kind: str | None = None) -> Column | None:
    return None if value is None else F.col(column) >= (F.lit(value).cast(kind) if kind else F.lit(value))


def _at_most(column: str, value, kind: str | None = None) -> Column | None:
    return None if value is None else F.col(column) <= (F.lit(value).cast(kind) if kind else F.lit(value))


# ------------------------------------------------------------------ alerts
ALERT_ORDER: Order = [("risk_score", True), ("scored_at", True), ("alert_id", True)]
TX_ORDER: Order = [("tx_time", True), ("id", True)]


def list_alerts(alerts: DataFrame, min_risk: int | None = None, severity: str | None = None, **paging) -> DataFrame:
    found = _where(alerts, _at_least("risk_score", min_risk), _eq("severity", severity))
    return page(found, ALERT_ORDER, **paging)


def latest_alerts(alerts: DataFrame, n: int = 5) -> DataFrame:
    return alerts.orderBy(F.desc("alert_id")).limit(n)


def sorted_alerts(alerts: DataFrame, key: str = "scored_at", descending: bool = True, **paging) -> DataFrame:
    if key not in ("scored_at", "risk_score"):
        raise ValueError("alerts sort by scored_at or risk_score")
    return page(alerts, [(key, descending), ("alert_id", False)], **paging)


def search_alerts(alerts: DataFrame, text: str) -> DataFrame:
    """Case-insensitive substring of reference or account."""
    t = text.lower()
    return alerts.where(F.lower("transaction_reference").contains(t) | F.lower("account_id").contains(t))


def alert_details(alerts: DataFrame, tx: DataFrame) -> DataFrame:
    """Alerts with their transaction; ``alerts_without_transaction`` lists the rest."""
    t = tx.select(
        "tenant_id", F.col("id").alias("transaction_id"), "tx_id", "tx_time", "amount", "currency", "direction", "status",
        "description",
    )
    return alerts.join(t, ["tenant_id", "transaction_id"])


def alerts_without_transaction(alerts: DataFrame, tx: DataFrame) -> DataFrame:
    ids = tx.select("tenant_id", F.col("id").alias("transaction_id"))
    return alerts.join(ids, ["tenant_id", "transaction_id"], "left_anti")


def alert_kpis(alerts: DataFrame) -> DataFrame:
    s = F.col("risk_score")
    return alerts.agg(
        F.count("*").alias("total_alerts"),
        F.count_if(s >= KPI_HIGH).alias("high_risk_alerts"),
        F.count_if(s >= KPI_CRITICAL).alias("critical_alerts"),
        F.avg(s).alias("avg_risk_score"),
    )


def severity_shares(alerts: DataFrame) -> DataFrame:
    """Low (everything below high), high and critical alerts as whole percents of all."""
    k = alert_kpis(alerts)
    low = F.col("total_alerts") - F.col("high_risk_alerts")
    rows = F.array(*[
        F.struct(F.lit(name).alias("band"), count.alias("n_alerts"), share_percent(count, F.col("total_alerts")).alias("percent"))
        for name, count in (("LOW", low), ("HIGH", F.col("high_risk_alerts")), ("CRITICAL", F.col("critical_alerts")))
    ])
    rounded = F.coalesce(F.round("avg_risk_score"), F.lit(0.0)).cast("bigint")
    return k.select(rounded.alias("avg_risk_score"), F.explode(rows).alias("r")).select("r.*", "avg_risk_score")


# ------------------------------------------------------------------ records
def list_transactions(
    tx: DataFrame, account_id: str | None = None, customer_id: str | None = None,
    min_time: str | None = None, max_time: str | None = None, **paging,
) -> DataFrame:
    found = _where(
        tx, _eq("account_id", account_id), _eq("customer_id", customer_id),
        _at_least("tx_time", min_time, "timestamp"), _at_most("tx_time", max_time, "timestamp"),
    )
    return page(found, TX_ORDER, **paging)


def list_invoices(
    invoices: DataFrame, vendor_id: str | None = None, employee_id: str | None = None,
    from_date: str | None = None, to_date: str | None = None, **paging,
) -> DataFrame:
    found = _where(
        invoices, _eq("vendor_id", vendor_id), _eq("employee_id", employee_id),
        _at_least("invoice_date", from_date, "date"), _at_most("invoice_date", to_date, "date"),
    )
    ties = [(c, True) for c in ("id", "vendor_id", "subtotal_amount") if c in invoices.columns]
    return page(found, [("invoice_date", True), *ties], **paging)


def list_expenses(
    expenses: DataFrame, employee_id: str | None = None, category: str | None = None, status: str | None = None,
    from_date: str | None = None, to_date: str | None = None,
    min_amount: float | None = None, max_amount: float | None = None, **paging,
) -> DataFrame:
    found = _where(
        expenses, _eq("employee_id", employee_id), _eq("category", category), _eq("status", status),
        _at_least("expense_date", from_date, "date"), _at_most("expense_date", to_date, "date"),
        _at_least("amount", min_amount), _at_most("amount", max_amount),
    )
    return page(found, [("expense_date", True), ("id", True)], **paging)


def list_vendors(
    vendors: DataFrame, vendor_code: str | None = None, country_code: str | None = None, risk_level: str | None = None,
    onboarding_from: str | None = None, onboarding_to: str | None = None, **paging,
) -> DataFrame:
    found = _where(
        vendors, _eq("vendor_code", vendor_code), _eq("country_code", country_code), _eq("risk_level", risk_level),
        _at_least("onboarding_date", onboarding_from, "date"), _at_most("onboarding_date", onboarding_to, "date"),
    )
    return page(found, [("name", False), ("vendor_code", False)], **paging)


# ------------------------------------------------------------------ entities
def list_entities(entities: DataFrame, q: str | None = None, **paging) -> DataFrame:
    """Case-sensitive substring of name or entity id."""
    hit = None if not q else F.col("name").contains(q) | F.col("entity_id").contains(q)
    return page(_where(entities, hit), [("id", False)], **{"limit": 50, **paging})


def filter_entities(
    entities: DataFrame, type_: str | None = None, min_risk: int | None = None, q: str | None = None
) -> DataFrame:
    risk = None if min_risk is None else F.coalesce("risk_score", F.lit(0)) >= min_risk
    hit = None
    if q:
        t = q.lower()
        hit = F.lower("name").contains(t) | F.lower("entity_id").contains(t)
    return _where(entities, _eq("type", type_), risk, hit)


def entity_types(entities: DataFrame) -> DataFrame:
    return entities.where(F.col("type").isNotNull()).select("type").distinct()


def entity_risk_histogram(entities: DataFrame) -> DataFrame:
    r = F.coalesce("risk_score", F.lit(0))
    return entities.agg(
        F.count_if(r < 30).alias("low"), F.count_if((r >= 30) & (r < 60)).alias("medium"),
        F.count_if((r >= 60) & (r < 80)).alias("high"), F.count_if(r >= 80).alias("critical"),
        F.count("*").alias("total"),
    )


def entity_feature_view(entities: DataFrame, features: DataFrame, tenant_id: int = 1) -> DataFrame:
    """Each entity with its features, or a zeroed snapshot that falls back to the entity's own risk."""
    own = features.where(F.col("tenant_id") == tenant_id).select(
        F.col("account_id").alias("entity_id"), F.lit(True).alias("_found"), *FEATURE_COLUMNS
    )
    joined = lookup_join(entities.select("id", "entity_id", "risk_score"), own, ["entity_id"], "id", max_bytes=None)
    found = F.coalesce("_found", F.lit(False))

    def column(c: str) -> Column:
        if c == "latest_risk_score":
            return F.when(found, F.col(c)).otherwise(F.col("risk_score")).alias(c)
        if c in ("first_seen_at", "last_seen_at"):
            return F.col(c)
        if c == "is_velocity_flagged":
            return F.coalesce(c, F.lit(False)).alias(c)
        return F.coalesce(c, F.lit(0)).alias(c)

    return joined.select(
        "id", "entity_id", F.col("entity_id").alias("account_id"), *[column(c) for c in FEATURE_COLUMNS],
        F.when(found, "entity_features").otherwise("entity_only").alias("source"),
    )


def top_entities(features: DataFrame, n: int = 10) -> DataFrame:
    return features.orderBy(F.desc("tx_count_total"), *ACCOUNT).limit(n).select(
        *ACCOUNT, "tx_count_total", "tx_count_24h", "tx_count_7d", "amount_avg", "latest_risk_score",
        "is_velocity_flagged",
    )
