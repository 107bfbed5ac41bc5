"""Per-transaction scores: ML features, ML score, graph score, fusion and alert records.

Everything is row-wise, so scoring adds no shuffle whatever the data size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.config import (
    ML_AMOUNT_SCALE,
    ML_FALLBACK_VERSION,
    NO_SIGNAL_EXPLANATION,
    SCORE_MAX,
    FusionWeights,
    GraphWeights,
)
from riskloom.functions.columns import add_once, band, clamp
from riskloom.operators.rules import POINT_RULES, PointRule, rule_points, triggered_rules


# ------------------------------------------------------------------ machine learning
def ml_features(tx: DataFrame) -> DataFrame:
    """The feature columns. Hour and weekday follow the clock reading the event was sent with."""
    weekday = F.weekday("event_wall")
    return tx.select(
        "*",
        F.log1p(F.greatest(F.col("amount_raw"), F.lit(0.0))).alias("amount_log"),
        F.hour("event_wall").cast("double").alias("hour_of_day"),
        weekday.cast("double").alias("day_of_week"),
        F.when(weekday >= 5, 1.0).otherwise(0.0).alias("is_weekend"),
        F.when(F.upper("direction_raw") == "CREDIT", 1.0).otherwise(0.0).alias("direction_is_credit"),
        F.lit(0.0).alias("vendor_risk_level_num"),
        F.lit(0.0).alias("has_employee_expense_link"),
    )


def fallback_probability(amount: Column) -> Column:
    return clamp(amount / ML_AMOUNT_SCALE, 0.0, 1.0)


def probability_to_score(p: Column) -> Column:
    return (clamp(p, 0.0, 1.0) * SCORE_MAX).cast("int")


def ml_score_columns(amount: Column) -> dict[str, Column]:
    p = fallback_probability(amount)
    return {
        "xgb_score": p,
        "ae_score": p * 0.5,
        "ml_score": probability_to_score(p),
        "model_version": F.lit(ML_FALLBACK_VERSION),
    }


# ------------------------------------------------------------------ graph
def _present(c: str) -> Column:
    return F.coalesce(F.col(c) != "", F.lit(False))


def proxy_metrics() -> dict[str, Column]:
    """Graph metrics guessed from the presence of a vendor and an employee."""
    vendor, employee = _present("vendor_code"), _present("employee_id")

    def total(base, per_vendor, per_employee) -> Column:
        zero = per_vendor * 0
        return (
            F.lit(base)
            + F.when(vendor, per_vendor).otherwise(zero)
            + F.when(employee, per_employee).otherwise(zero)
        )

    return {
        "degree": total(1, 3, 2),
        "community_size": total(1, 10, 5),
        "pagerank": total(0.01, 0.05, 0.03),
        "avg_neighbor_risk": total(0.0, 0.2, 0.1),
    }


def graph_score(metrics: dict[str, Column], w: GraphWeights = GraphWeights()) -> Column:
    raw = (
        F.coalesce(metrics["degree"], F.lit(0)) * w.degree
        + F.coalesce(metrics["community_size"], F.lit(0)) * w.community
        + F.coalesce(metrics["pagerank"], F.lit(0.0)) * w.pagerank
        + F.coalesce(metrics["avg_neighbor_risk"], F.lit(0.0)) * w.neighbor_risk
    )
    return clamp(raw, 0.0, float(SCORE_MAX)).cast("int")


def graph_motifs(metrics: dict[str, Column]) -> Column:
    degree, size = metrics["degree"], metrics["community_size"]
    text = F.concat_ws(
        " | ",
        F.when(degree >= 5, F.concat(F.lit("High-degree node (degree="), degree.cast("string"), F.lit(")"))),
        F.when(size >= 10, F.concat(F.lit("In dense community (size="), size.cast("string"), F.lit(")"))),
        F.when(metrics["avg_neighbor_risk"] > 0.1, F.lit("Neighbors show elevated risk")),
    )
    return F.nullif(text, F.lit(""))


# ------------------------------------------------------------------ fusion
def fuse(rule: Column, ml: Column, graph: Column, w: FusionWeights = FusionWeights()) -> Column:
    """Weighted mean of the scores at hand on the 0-999 scale; 0 when there is none."""
    parts = [(rule, w.rule), (ml, w.ml), (graph, w.graph)]
    total = F.lit(0.0)
    for score, weight in parts:
        total = total + F.when(score.isNotNull(), weight).otherwise(0.0)
    total = F.when(total <= 0, 1.0).otherwise(total)
    value = F.lit(0.0)
    for score, weight in parts:
        share = clamp(score.cast("double"), 0.0, float(SCORE_MAX)) / SCORE_MAX * (F.lit(weight) / total)
        value = value + F.when(score.isNotNull(), share).otherwise(0.0)
    return F.bround(clamp(value, 0.0, 1.0) * SCORE_MAX, 0).cast("int")


def explanation(rule: Column, ml: Column, graph: Column) -> Column:
    text = F.concat_ws(
        " | ",
        F.concat(F.lit("Rules="), rule.cast("string")),
        F.concat(F.lit("ML="), ml.cast("string")),
        F.concat(F.lit("Graph="), graph.cast("string")),
    )
    return F.when(text == "", NO_SIGNAL_EXPLANATION).otherwise(text)


def score_transactions(
    tx: DataFrame, rules: Sequence[PointRule] = POINT_RULES, weights: FusionWeights = FusionWeights()
) -> DataFrame:
    """Add rule, ML, graph and fused scores with their texts."""
    metrics = proxy_metrics()
    scored = add_once(
        tx,
        rule_score=rule_points(rules),
        triggered_rules=triggered_rules(rules),
        **ml_score_columns(F.col("amount_raw")),
        graph_score=graph_score(metrics),
        graph_motifs=graph_motifs(metrics),
    )
    r, m, g = F.col("rule_score"), F.col("ml_score"), F.col("graph_score")
    fused = scored.select("*", fuse(r, m, g, weights).alias("risk_score"), explanation(r, m, g).alias("explanation"))
    return fused.withColumn("severity", band(F.col("risk_score"), "severity"))


def alert_key() -> Column:
    """A key of an alert from its tenant and transaction, the same on every replay."""
    return F.xxhash64("tenant_id", "tx_id").alias("alert_id")


def alert_records(scored: DataFrame, scored_at: Column | None = None, *keep: str) -> DataFrame:
    """One alert per scored transaction; missing engine scores are stored as 0."""
    return scored.select(
        *keep,
        "tenant_id",
        F.col("id").alias("transaction_id"),
        "transaction_reference", "account_id", "vendor_code", "employee_id",
        "risk_score", "severity",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("rule_score", "ml_score", "graph_score")],
        "triggered_rules", "graph_motifs",
        F.lit(None).cast("string").alias("rule_results_json"),
        (F.current_timestamp() if scored_at is None else scored_at).alias("scored_at"),
    )


def alert_messages(alerts: DataFrame, key: str = "tenant_id") -> DataFrame:
    """Alert events as key/value JSON messages for a topic or a text sink."""
    fields = [
        "tenant_id", "transaction_id", "transaction_reference", "account_id", "vendor_code", "employee_id",
        "risk_score", "rule_score", "ml_score", "graph_score", "triggered_rules", "graph_motifs", "scored_at",
    ]
    body = F.struct(F.lit("v1").alias("event_version"), *fields)
    return alerts.select(F.col(key).cast("string").alias("key"), F.to_json(body).alias("value"))


def preview(scored: DataFrame) -> DataFrame:
    return scored.select(
        "transaction_reference", "risk_score",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("rule_score", "ml_score", "graph_score")],
        "triggered_rules", "graph_motifs",
    )
