"""Mergeable summaries of what the stream keeps per account and day, without any per-row state.

An account's history is cut into days. The summary of a day is a small record; summaries of neighbouring days, or
of rows wholly before and wholly after each other, combine into the summary of both, as the nodes of a segment tree
do. So a late or corrected transaction changes its own day only, and an account is a fold over its days.
Summaries come from map-side combined aggregations: a hot account costs one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.config import HIGH_RISK_THRESHOLD, VELOCITY_24H_THRESHOLD
from riskloom.functions.columns import exact_avg
from riskloom.operators.features import ACCOUNT, FEATURE_COLUMNS, velocity_counts
from riskloom.operators.joins import lookup_join

#: The node of the tree that a transaction belongs to.
DAY = [*ACCOUNT, "day"]
SUMMARY = [
    "n", "amount_total", "amount_max", "score_total", "n_high", "run", "first_seen_at", "first_tx_id",
    "last_seen_at", "last_tx_id", "amount_last", "latest_risk_score",
]


def with_day(rows: DataFrame) -> DataFrame:
    return rows.withColumn("day", F.to_date("tx_time"))


def summarize(rows: DataFrame, keys: list[str] = DAY) -> DataFrame:
    """One summary per key; ``run`` is the unbroken run of high-risk transactions at its end.

    The run is everything after the last miss, so rows are counted against one small record per key, never sorted.
    """
    rank = F.struct("tx_time", "tx_id")
    high = F.col("risk_score") >= HIGH_RISK_THRESHOLD
    totals = rows.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.sum("amount").cast("decimal(28,2)").alias("amount_total"),
        F.max("amount").alias("amount_max"),
        F.sum("risk_score").cast("bigint").alias("score_total"),
        F.count_if(high).alias("n_high"),
        F.min(rank).alias("_first"),
        F.max_by(F.struct("tx_time", "tx_id", "amount", "risk_score"), rank).alias("_last"),
        F.max(F.when(~high, rank)).alias("_miss"),
    )
    missed = totals.where(F.col("_miss").isNotNull()).select(*keys, "_miss")
    after = lookup_join(rows.select(*keys, "tx_time", "tx_id"), missed, keys, "tx_id", "inner", max_bytes=None)
    tail = after.where(rank > F.col("_miss")).groupBy(*keys).agg(F.count("*").alias("_tail"))
    run = F.when(F.col("_miss").isNull(), F.col("n")).otherwise(F.coalesce("_tail", F.lit(0)))
    return totals.join(tail, keys, "left").select(
        *keys, "n", "amount_total", "amount_max", "score_total", "n_high", run.cast("bigint").alias("run"),
        F.col("_first.tx_time").alias("first_seen_at"), F.col("_first.tx_id").alias("first_tx_id"),
        F.col("_last.tx_time").alias("last_seen_at"), F.col("_last.tx_id").alias("last_tx_id"),
        F.col("_last.amount").alias("amount_last"), F.col("_last.risk_score").cast("bigint").alias("latest_risk_score"),
    )


def merge(earlier: DataFrame, later: DataFrame, keys: list[str] = DAY) -> DataFrame:
    """The summary of each key of ``earlier``, extended by its summary in ``later``.

    ``earlier`` has the key and the summary so far as a struct ``e``, null when there is none; it must lie wholly before
    the later one. A key with neither gets a count of 0 and no values.
    """
    both = earlier.select(*keys, "e").join(later.select(*keys, F.struct(*SUMMARY).alias("l")), keys, "left")

    def plus(c: str) -> Column:
        kind = "decimal(28,2)" if c == "amount_total" else "bigint"
        return (F.coalesce(F.col(f"l.{c}"), F.lit(0)) + F.coalesce(F.col(f"e.{c}"), F.lit(0))).cast(kind).alias(c)

    def newest(c: str) -> Column:
        return F.when(F.col("l").isNotNull(), F.col(f"l.{c}")).otherwise(F.col(f"e.{c}")).alias(c)

    unbroken = F.col("l").isNull() | (F.col("l.n_high") == F.col("l.n"))
    run = F.coalesce("l.run", F.lit(0)) + F.when(unbroken, F.coalesce(F.col("e.run"), F.lit(0))).otherwise(0)
    oldest = F.col("e").isNotNull()
    return both.select(
        *keys, plus("n"), plus("amount_total"), F.greatest("l.amount_max", "e.amount_max").alias("amount_max"),
        plus("score_total"), plus("n_high"), run.cast("bigint").alias("run"),
        *[F.when(oldest, F.col(f"e.{c}")).otherwise(F.col(f"l.{c}")).alias(c) for c in ("first_seen_at", "first_tx_id")],
        *[newest(c) for c in ("last_seen_at", "last_tx_id", "amount_last", "latest_risk_score")],
    )


def fold(days: DataFrame) -> DataFrame:
    """One summary per account from those of its days; days emptied by a correction count for nothing.

    The run at the end is that of the last day with a miss plus all days after it. Rows are days of an account, so
    what meets in a task is bounded by the calendar, not by transactions.
    """
    missed = F.max(F.when(F.col("run") < F.col("n"), F.col("day"))).over(Window.partitionBy(*ACCOUNT))
    marked = days.where("n > 0").withColumn("_missed", missed)
    counts = F.col("_missed").isNull() | (F.col("day") >= F.col("_missed"))
    first, last = F.struct("first_seen_at", "first_tx_id"), F.struct("last_seen_at", "last_tx_id")
    ends = F.struct("last_seen_at", "last_tx_id", "amount_last", "latest_risk_score")
    folded = marked.groupBy(*ACCOUNT).agg(
        F.sum("n").alias("n"), F.sum("amount_total").cast("decimal(28,2)").alias("amount_total"),
        F.max("amount_max").alias("amount_max"), F.sum("score_total").alias("score_total"), F.sum("n_high").alias("n_high"),
        F.coalesce(F.sum(F.when(counts, F.col("run"))), F.lit(0)).alias("run"),
        F.min(first).alias("_first"), F.max_by(ends, last).alias("_last"),
    )
    return folded.select(
        *ACCOUNT, *[c for c in SUMMARY if c in folded.columns], *[F.col(f"_first.{c}").alias(c) for c in ("first_seen_at", "first_tx_id")],
        *[F.col(f"_last.{c}").alias(c) for c in ("last_seen_at", "last_tx_id", "amount_last", "latest_risk_score")],
    ).select(*ACCOUNT, *SUMMARY)


def features_of(summaries: DataFrame, recent: DataFrame, as_of: Column) -> DataFrame:
    """Feature rows: the account summaries plus trailing counts over the transactions of the last seven days."""
    counts = recent.where(F.col("tx_time") >= as_of - F.expr("INTERVAL '7' DAY")).groupBy(*ACCOUNT).agg(
        *[c.alias(n) for n, c in velocity_counts(as_of).items()]
    )
    joined = summaries.join(counts, ACCOUNT, "left").withColumns({
        "tx_count_total": F.col("n"),
        "tx_count_24h": F.coalesce("tx_count_24h", F.lit(0)),
        "tx_count_7d": F.coalesce("tx_count_7d", F.lit(0)),
        "amount_avg": exact_avg(F.col("amount_total"), F.col("n")).cast("decimal(18,2)"),
        "risk_score_avg": exact_avg(F.col("score_total"), F.col("n")).cast("decimal(6,2)"),
        "high_risk_tx_count": F.col("n_high"),
        "consecutive_high_risk": F.col("run"),
    })
    flagged = joined.withColumn("is_velocity_flagged", F.col("tx_count_24h") > VELOCITY_24H_THRESHOLD)
    return flagged.select(*ACCOUNT, *FEATURE_COLUMNS)
