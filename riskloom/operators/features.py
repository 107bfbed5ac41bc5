"""Entity features, daily summaries, velocity, enrichment and pattern checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.config import HIGH_RISK_THRESHOLD, VELOCITY_24H_THRESHOLD
from riskloom.functions.columns import exact_avg
from riskloom.operators.joins import lookup_join
from riskloom.operators.sequences import current_run, previous_instant, rolling_sums, run_lengths, running_totals
from riskloom.operators.stored import stored
from riskloom.operators.validate import as_of_column

ACCOUNT = ["tenant_id", "account_id"]

FEATURE_COLUMNS = [
    "tx_count_total", "tx_count_24h", "tx_count_7d", "amount_total", "amount_avg", "amount_max",
    "amount_last", "latest_risk_score", "risk_score_avg", "high_risk_tx_count",
    "is_velocity_flagged", "consecutive_high_risk", "first_seen_at", "last_seen_at",
]
# Columns the daily job leaves alone when the account already has features.
STREAM_OWNED = ["amount_last", "consecutive_high_risk"]


def _is_high(score: Column) -> Column:
    return score >= HIGH_RISK_THRESHOLD


def with_tenant(rows: DataFrame) -> DataFrame:
    """Rows that belong to a tenant. All features of accounts leave out the others: they have no account."""
    return rows.where(F.col("tenant_id").isNotNull())


def alert_stats(alerts: DataFrame) -> DataFrame:
    """One row per transaction of a tenant, so that joining alerts never multiplies transactions."""
    s = F.col("risk_score")
    return alerts.where(F.col("transaction_id").isNotNull()).groupBy("tenant_id", "transaction_id").agg(
        F.count("*").alias("n_alerts"),
        F.sum(s).alias("score_sum"),
        F.max(s).alias("score_max"),
        F.count_if(_is_high(s)).alias("n_high"),
        F.max_by("risk_score", F.struct("scored_at", "alert_id")).alias("latest_score"),
    )


def _with_alert_stats(tx: DataFrame, alerts: DataFrame, how: str, *columns: str) -> DataFrame:
    stats = alert_stats(alerts).withColumnRenamed("transaction_id", "id")
    return with_tenant(tx).select("id", *ACCOUNT, *columns).join(stats, ["tenant_id", "id"], how)


def alert_agg(tx: DataFrame, alerts: DataFrame) -> DataFrame:
    """Risk measures per account over the alerts that have a transaction."""
    return _with_alert_stats(tx, alerts, "inner").groupBy(*ACCOUNT).agg(
        exact_avg(F.sum("score_sum"), F.sum("n_alerts")).alias("risk_score_avg"),
        F.max("score_max").alias("latest_risk_score"),
        F.sum("n_high").alias("high_risk_tx_count"),
    )


def velocity_counts(as_of: Column) -> dict[str, Column]:
    """Trailing counts against ``as_of``; there is no upper bound, so later rows count too."""
    return {
        "tx_count_24h": F.count_if(F.col("tx_time") >= as_of - F.expr("INTERVAL '24' HOUR")),
        "tx_count_7d": F.count_if(F.col("tx_time") >= as_of - F.expr("INTERVAL '7' DAY")),
    }


def entity_features(tx: DataFrame, alerts: DataFrame, as_of: str | Column | None = None) -> DataFrame:
    """Feature snapshot per account as the daily job writes it.

    Transactions are read once: joined to the per-transaction alert measures, then aggregated.
    ``latest_risk_score`` is the highest score and ``amount_last`` the highest amount here, and
    ``consecutive_high_risk`` starts at 0; ``latest_state`` and ``consecutive_high_risk`` give the
    order-aware values.
    """
    counts = velocity_counts(as_of_column(as_of))
    joined = _with_alert_stats(tx, alerts, "left", "amount", "tx_time")
    agg = joined.groupBy(*ACCOUNT).agg(
        F.count("*").alias("tx_count_total"),
        *[c.alias(n) for n, c in counts.items()],
        F.sum("amount").alias("amount_total"),
        F.max("amount").alias("amount_max"),
        F.max("score_max").alias("score_max"),
        F.sum("score_sum").alias("score_sum"),
        F.sum("n_alerts").alias("n_alerts"),
        F.sum("n_high").alias("n_high"),
        F.min("tx_time").alias("first_seen_at"),
        F.max("tx_time").alias("last_seen_at"),
    )
    zero = F.lit(0)
    return agg.select(
        *ACCOUNT, "tx_count_total", "tx_count_24h", "tx_count_7d",
        F.col("amount_total").cast("decimal(18,2)").alias("amount_total"),
        exact_avg(F.col("amount_total"), F.col("tx_count_total")).cast("decimal(18,2)").alias("amount_avg"),
        "amount_max",
        F.col("amount_max").alias("amount_last"),
        F.coalesce("score_max", zero).alias("latest_risk_score"),
        F.coalesce(exact_avg(F.col("score_sum"), F.col("n_alerts")), zero).cast("decimal(6,2)").alias("risk_score_avg"),
        F.coalesce("n_high", zero).cast("bigint").alias("high_risk_tx_count"),
        (F.col("tx_count_24h") > VELOCITY_24H_THRESHOLD).alias("is_velocity_flagged"),
        zero.cast("bigint").alias("consecutive_high_risk"),
        "first_seen_at", "last_seen_at",
    )


def in_utc_dates(df: DataFrame, from_date: str, to_date: str, time: str = "tx_time") -> DataFrame:
    """Rows of the inclusive date range, as a range on the raw column so that the scan can skip files."""
    return df.where(
        (F.col(time) >= F.lit(f"{from_date} 00:00:00").cast("timestamp"))
        & (F.col(time) < F.lit(f"{to_date} 00:00:00").cast("timestamp") + F.expr("INTERVAL '1' DAY"))
    )


def daily_summary(
    tx: DataFrame, alerts: DataFrame, from_date: str, to_date: str, dedupe_alerts: bool = True
) -> DataFrame:
    """One row per account and UTC date.

    With ``dedupe_alerts`` a transaction counts once, with the score of its latest alert. Without,
    it counts once per alert, as a plain join of transactions and alerts would have it.
    """
    # The range is read and computed once; it picks the alerts and then meets them.
    in_range = stored(with_tenant(in_utc_dates(tx, from_date, to_date)).select("id", *ACCOUNT, "amount", "tx_time", "direction"))
    # Alerts of other days leave before they are aggregated.
    wanted = in_range.select("tenant_id", F.col("id").alias("transaction_id"))
    near = alerts.join(wanted, ["tenant_id", "transaction_id"], "left_semi")
    rows = _with_alert_stats(in_range, near, "left", "amount", "tx_time", "direction")
    if dedupe_alerts:
        times, score_sum, n_scores = F.lit(1), F.col("latest_score"), F.when(F.col("latest_score").isNotNull(), 1)
        score_max, n_high = F.col("latest_score"), F.when(_is_high(F.col("latest_score")), 1).otherwise(0)
    else:
        times = F.coalesce("n_alerts", F.lit(1))
        score_sum, n_scores, score_max = F.col("score_sum"), F.col("n_alerts"), F.col("score_max")
        n_high = F.coalesce("n_high", F.lit(0))
    weighted = rows.select(
        *ACCOUNT, F.to_date("tx_time").alias("summary_date"), "direction", "amount",
        times.cast("bigint").alias("times"), score_sum.cast("bigint").alias("s"), n_scores.cast("bigint").alias("k"),
        score_max.alias("m"), n_high.cast("bigint").alias("h"),
    )

    def of(direction: str) -> Column:
        return F.sum(F.when(F.col("direction") == direction, F.col("times")).otherwise(0))

    agg = weighted.groupBy(*ACCOUNT, "summary_date").agg(
        F.sum("times").alias("tx_count"),
        of("DEBIT").alias("tx_count_debit"),
        of("CREDIT").alias("tx_count_credit"),
        F.sum(F.col("amount") * F.col("times").cast("decimal(10,0)")).alias("amount_total"),
        F.max("amount").alias("amount_max"),
        F.min("amount").alias("amount_min"),
        F.sum("s").alias("s"), F.sum("k").alias("k"), F.max("m").alias("m"), F.sum("h").alias("h"),
    )
    zero = F.lit(0)
    return agg.select(
        *ACCOUNT, "summary_date", "tx_count", "tx_count_debit", "tx_count_credit",
        F.col("amount_total").cast("decimal(18,2)").alias("amount_total"),
        exact_avg(F.col("amount_total"), F.col("tx_count")).cast("decimal(18,2)").alias("amount_avg"),
        "amount_max", "amount_min",
        F.coalesce(exact_avg(F.col("s"), F.col("k")), zero).cast("decimal(6,2)").alias("risk_score_avg"),
        F.coalesce("m", zero).alias("risk_score_max"),
        F.col("h").alias("high_risk_tx_count"),
    )


def entity_risk_changes(
    entities: DataFrame, features: DataFrame, tenant_id: int | None = 1, entity_key: str = "entity_id"
) -> DataFrame:
    """Entities whose stored 0-100 risk differs from a tenth of the latest score; null counts as -1."""
    latest = features if tenant_id is None else features.where(F.col("tenant_id") == tenant_id)
    latest = latest.select(F.col("account_id").alias(entity_key), "latest_risk_score")
    new = F.least(F.round(F.col("latest_risk_score").cast("decimal(10,0)") / 10), F.lit(100)).cast("int")
    return (
        entities.join(latest, entity_key)
        .select("id", entity_key, F.col("risk_score").alias("old_risk_score"), new.alias("risk_score"))
        .where(F.col("risk_score") != F.coalesce("old_risk_score", F.lit(-1)))
    )


def dry_run_counts(tx: DataFrame, from_date: str, to_date: str) -> DataFrame:
    """How many accounts and account days a recompute would write, in one pass."""
    date = F.to_date("tx_time")
    in_range = date.between(F.lit(from_date).cast("date"), F.lit(to_date).cast("date"))
    return tx.agg(
        F.count_distinct(F.when(F.col("tenant_id").isNotNull(), F.col("account_id"))).alias("n_entities"),
        F.count_distinct(F.when(in_range, F.struct("account_id", date.alias("d")))).alias("n_daily_rows"),
    )


def summary_extent(summary: DataFrame) -> DataFrame:
    return summary.agg(
        F.count("*").alias("n_rows"), F.min("summary_date").alias("first_date"), F.max("summary_date").alias("last_date")
    )


def velocity_flags(tx: DataFrame, as_of: str | Column | None = None, threshold: int = VELOCITY_24H_THRESHOLD) -> DataFrame:
    recent = tx.groupBy(*ACCOUNT).agg(velocity_counts(as_of_column(as_of))["tx_count_24h"].alias("tx_count_24h"))
    return recent.withColumn("is_velocity_flagged", F.col("tx_count_24h") > threshold)


def sliding_velocity(tx: DataFrame, hours: int = 24, threshold: int = VELOCITY_24H_THRESHOLD) -> DataFrame:
    """Windows of ``hours`` sliding by one hour that hold more than ``threshold`` transactions.

    Hourly counts come first; only they are copied into the windows that cover them.
    """
    hour = F.date_trunc("hour", "tx_time")
    hourly = tx.groupBy(*ACCOUNT, hour.alias("hour")).agg(F.count("*").alias("n"))
    starts = F.sequence(F.col("hour") - F.expr(f"INTERVAL '{hours - 1}' HOUR"), F.col("hour"), F.expr("INTERVAL '1' HOUR"))
    return (
        hourly.select(*ACCOUNT, F.explode(starts).alias("window_start"), "n")
        .groupBy(*ACCOUNT, "window_start").agg(F.sum("n").alias("tx_count"))
        .where(F.col("tx_count") > threshold)
    )


# ------------------------------------------------------------------ ordered features
def rolling_velocity(tx: DataFrame) -> DataFrame:
    """Per transaction: count and amount of the account in the 24 hours and 7 days up to it."""
    rows = with_tenant(tx).select("id", *ACCOUNT, "tx_time", "amount")
    return rolling_sums(rows, ACCOUNT, "tx_time", "amount", {"24h": "24 HOURS", "7d": "7 DAYS"})


def high_risk_runs(scored: DataFrame) -> DataFrame:
    """Per transaction: consecutive high-risk transactions of the account up to it."""
    rows = with_tenant(scored).select("id", *ACCOUNT, "tx_time", "tx_id", "risk_score")
    return run_lengths(
        rows, ACCOUNT, ["tx_time", "tx_id"], _is_high(F.col("risk_score")), "consecutive_high_risk"
    )


def consecutive_high_risk(scored: DataFrame) -> DataFrame:
    """Per account: the current run of high-risk transactions."""
    return current_run(
        with_tenant(scored), ACCOUNT, "tx_time", ["tx_time", "tx_id"], _is_high(F.col("risk_score")), "consecutive_high_risk"
    )


def latest_state(scored: DataFrame) -> DataFrame:
    """Amount, score and time of the latest transaction of each account."""
    rank = F.struct("tx_time", "tx_id")
    return with_tenant(scored).groupBy(*ACCOUNT).agg(
        F.max_by("amount", rank).alias("amount_last"),
        F.max_by("risk_score", rank).alias("latest_risk_score"),
        F.max_by("tx_id", rank).alias("last_tx_id"),
        F.max("tx_time").alias("last_seen_at"),
    )


def running_risk_avg(scored: DataFrame) -> DataFrame:
    rows = with_tenant(scored).select("id", *ACCOUNT, "tx_time", "tx_id", "risk_score")
    totals = running_totals(
        rows, ACCOUNT, ["tx_time", "tx_id"],
        {"tx_count": F.lit(1).cast("bigint"), "score_total": F.col("risk_score").cast("bigint")},
    )
    return totals.select(
        "id", *ACCOUNT, "tx_count",
        exact_avg(F.col("score_total"), F.col("tx_count")).cast("decimal(6,2)").alias("risk_score_avg"),
    )


# ------------------------------------------------------------------ patterns
def tx_spikes(tx: DataFrame, trailing: int = 7, sigmas: int = 3) -> DataFrame:
    """Days whose transaction count exceeds mean plus ``sigmas`` deviations of the trailing days.

    Compared in whole numbers: k·n − s > 0 and (k·n − s)² > sigmas²·(k·q − s²).
    """
    daily = tx.groupBy(*ACCOUNT, F.to_date("tx_time").alias("tx_date")).agg(F.count("*").alias("tx_count"))
    w = Window.partitionBy(*ACCOUNT).orderBy("tx_date").rowsBetween(-trailing, -1)  # at most one row per day
    n = F.col("tx_count")
    rows = daily.select(
        "*", F.count("*").over(w).alias("trailing_days"), F.coalesce(F.sum(n).over(w), F.lit(0)).alias("trailing_count"),
        F.coalesce(F.sum(n * n).over(w), F.lit(0)).alias("_q"),
    )
    k, s = F.col("trailing_days"), F.col("trailing_count")
    excess = k * n - s
    spike = (k > 1) & (excess > 0) & (excess * excess > sigmas * sigmas * (k * F.col("_q") - s * s))
    return rows.withColumn("is_spike", spike).drop("_q")


def tx_duplicates(tx: DataFrame, minutes: int = 10) -> DataFrame:
    """Transactions that repeat the amount of an earlier one of the account within ``minutes``."""
    keys = [*ACCOUNT, "amount"]
    instants = tx.groupBy(*keys, "tx_time").agg(F.min("tx_id").alias("_first"), F.count("*").alias("_n"))
    linked = previous_instant(instants, keys, "tx_time")
    gap = F.unix_seconds("tx_time") - F.unix_seconds("previous_time")
    near = F.coalesce(gap <= minutes * 60, F.lit(False))
    suspects = linked.withColumn("_near", near).where(F.col("_near") | (F.col("_n") > 1))
    rows = tx.select("id", "tx_id", *keys, "tx_time").join(suspects, [*keys, "tx_time"])
    repeats = rows.where(F.col("_near") | (F.col("tx_id") > F.col("_first")))
    same_time = F.col("tx_id") > F.col("_first")
    return repeats.select(
        "id", *keys, "tx_time", F.when(same_time, F.col("tx_time")).otherwise(F.col("previous_time")).alias("previous_time")
    )


def invoice_duplicates(invoices: DataFrame, days: int = 30) -> DataFrame:
    """Invoices that repeat vendor and subtotal of an earlier one within ``days``.

    The window runs over the distinct dates of a vendor and amount, never over their invoices.
    """
    keys = ["tenant_id", "vendor_id", "subtotal_amount"]
    dates = invoices.groupBy(*keys, "invoice_date").agg(F.min("id").alias("_first"), F.max("id").alias("_last"))
    w = Window.partitionBy(*keys).orderBy("invoice_date")
    linked = dates.withColumn("previous_date", F.lag("invoice_date").over(w))
    near = F.coalesce(F.date_diff("invoice_date", "previous_date") <= days, F.lit(False))
    suspects = linked.withColumn("_near", near).where(F.col("_near") | (F.col("_first") < F.col("_last")))
    rows = invoices.select("id", "invoice_number", *keys, "invoice_date").join(suspects, [*keys, "invoice_date"])
    same_day = F.col("id") > F.col("_first")
    return rows.where(F.col("_near") | same_day).select(
        "id", "invoice_number", *keys, "invoice_date",
        F.when(same_day, F.col("invoice_date")).otherwise(F.col("previous_date")).alias("previous_date"),
    )


def expense_patterns(expenses: DataFrame) -> DataFrame:
    """Spend by category and cost centre with subtotals; ``level`` is 0 for a row of both, 1 for a category
    over all cost centres, 3 for the total, so a missing cost centre is not taken for a subtotal."""
    agg = expenses.rollup("category", "cost_center_code").agg(
        F.grouping_id().cast("bigint").alias("level"),
        F.count("*").alias("n_expenses"), F.sum("amount").alias("amount_total"), F.max("amount").alias("amount_max"),
        F.count_distinct("employee_id").alias("n_employees"),
    )
    return agg.withColumn("amount_avg", exact_avg(F.col("amount_total"), F.col("n_expenses")).cast("decimal(18,2)"))


def expense_linkage(expenses: DataFrame, invoices: DataFrame, tx: DataFrame) -> DataFrame:
    """Each expense with the invoice and payment it points to, and what is missing."""
    one_invoice = invoices.groupBy("tenant_id", F.col("id").alias("invoice_id")).agg(
        F.min(F.struct("total_amount", "vendor_id")).alias("_inv")
    )
    payment = tx.select("tenant_id", F.col("id").alias("transaction_id"), F.col("amount").alias("payment_amount"), F.lit(True).alias("_paid"))
    linked = lookup_join(expenses, one_invoice, ["tenant_id", "invoice_id"], "id", max_bytes=None)
    linked = lookup_join(linked, payment, ["tenant_id", "transaction_id"], "id", max_bytes=None)
    missing_invoice = F.col("invoice_id").isNotNull() & F.col("_inv").isNull()
    missing_payment = F.col("transaction_id").isNotNull() & F.col("_paid").isNull()
    return linked.select(
        "id", "employee_id", "amount", "invoice_id", "transaction_id",
        F.col("_inv.vendor_id").alias("vendor_id"), F.col("_inv.total_amount").alias("invoice_amount"), "payment_amount",
        F.when(missing_invoice & missing_payment, "BOTH_MISSING").when(missing_invoice, "INVOICE_MISSING")
        .when(missing_payment, "PAYMENT_MISSING").otherwise("OK").alias("link_status"),
    )


def enrich_vendor(
    tx: DataFrame, vendors: DataFrame, high_risk_countries: Sequence[str] = (), per_tenant: bool = True
) -> DataFrame:
    """Add vendor risk level and score, country and a high-risk-country flag; null when unknown."""
    on = ["tenant_id", "vendor_code"] if per_tenant else ["vendor_code"]
    country = F.col("country_code")
    dim = vendors.select(
        *on, F.col("risk_level").alias("vendor_risk_level"), country.alias("vendor_country_code"), "vendor_risk_score",
        F.when(country.isNotNull(), country.isin(list(high_risk_countries))).alias("is_high_risk_country"),
    )
    return lookup_join(tx, dim, on, "id")


def seed_entities(tx: DataFrame, entities: DataFrame, max_per_type: int | None = None) -> DataFrame:
    """New account and customer entities that the entity table lacks: all, or the first ``max_per_type`` of each."""
    out = None
    for column, kind, prefix, label in (
        ("account_id", "ACCOUNT", "ACC:", "Account "), ("customer_id", "PERSON", "CUST:", "Customer "),
    ):
        known = entities.where(F.col("type") == kind).select("entity_id")
        ids = tx.where(F.coalesce(F.col(column), F.lit("")) != "").select(F.col(column).alias("key")).distinct()
        new = (
            ids.select(F.concat(F.lit(prefix), "key").alias("entity_id"), F.concat(F.lit(label), "key").alias("name"))
            .join(known, "entity_id", "left_anti")
        )
        if max_per_type is not None:
            new = new.orderBy("entity_id").limit(max_per_type)
        new = new.select("entity_id", "name", F.lit(kind).alias("type"), F.lit(0).alias("risk_score"))
        out = new if out is None else out.unionByName(new)
    return out
