"""Rule packs: each rule is a named set of SQL expressions, so a pack compiles into one projection."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom.config import SCORE_MAX
from riskloom.functions.columns import clamp, float_text
from riskloom.operators.normalize import RULE_RESULT


@dataclass(frozen=True)
class PointRule:
    """Adds ``points`` to the 0-999 rule score when ``when`` holds."""

    rule_id: str
    when: str
    points: int


@dataclass(frozen=True)
class GradedRule:
    """Gives a 0-1 score; ``detail`` names the column quoted in the reason text."""

    name: str
    when: str
    score: str
    reason: str
    detail: str


POINT_RULES = (
    PointRule("R_HIGH_AMOUNT_10K", "amount_raw >= 10000", 500),
    PointRule("R_WEEKEND_DEBIT", "direction = 'DEBIT' AND weekday(event_wall) >= 5", 200),
    PointRule("R_LARGE_NIGHT_TXN", "amount_raw >= 5000 AND (hour(event_wall) >= 22 OR hour(event_wall) < 6)", 250),
)

GRADED_RULES = (
    GradedRule(
        "high_amount",
        when="coalesce(try_cast(amount AS DOUBLE), 0D) >= 100000",
        score="CASE WHEN coalesce(try_cast(amount AS DOUBLE), 0D) >= 100000 THEN 0.9D ELSE 0.1D END",
        reason="High amount detected: ",
        detail="amount",
    ),
    GradedRule(
        "vendor_risk",
        when="coalesce(vendor_risk_score >= 0.8D, false)",
        score="coalesce(vendor_risk_score, 0.05D)",
        reason="Vendor risk score=",
        detail="vendor_risk_score",
    ),
)


def triggered_rules(rules: Sequence[PointRule] = POINT_RULES) -> Column:
    return F.array_remove(F.array(*[F.when(F.expr(r.when), r.rule_id).otherwise("") for r in rules]), "")


def rule_points(rules: Sequence[PointRule] = POINT_RULES) -> Column:
    total = F.lit(0)
    for r in rules:
        total = total + F.when(F.expr(r.when), r.points).otherwise(0)
    return F.least(total, F.lit(SCORE_MAX))


def _result(name: Column | str, triggered: Column, score: Column, reasons: Column) -> Column:
    name = F.lit(name) if isinstance(name, str) else name
    return F.struct(
        name.alias("rule_name"), triggered.alias("triggered"), score.alias("score"), reasons.alias("reasons")
    )


def evaluate(rules: Sequence[GradedRule] = GRADED_RULES, *extra: Column) -> Column:
    """Array of rule results. A rule that yields no score counts as 0 with a ``rule_error`` reason."""
    out = []
    for r in rules:
        hit, score = F.coalesce(F.expr(r.when), F.lit(False)), F.expr(r.score)
        reason = F.concat(F.lit(r.reason), float_text(F.col(r.detail).cast("double")))
        reasons = F.when(hit, F.array(reason)).otherwise(F.array().cast("array<string>"))
        broken = _result(r.name, F.lit(False), F.lit(0.0), F.array(F.lit("rule_error: no score")))
        out.append(F.when(score.isNull(), broken).otherwise(_result(r.name, hit, score, reasons)))
    return F.array(*out, *extra)


def python_rule(name: str, fn: Callable[..., tuple[bool, float, list[str]]], *inputs: str) -> Column:
    """Escape hatch for a rule that only exists as Python: Arrow batches, errors become ``rule_error``."""

    def one(args) -> dict:
        try:
            hit, score, reasons = fn(*args)
            return {"rule_name": name, "triggered": bool(hit), "score": float(score), "reasons": list(reasons)}
        except Exception as exc:  # a broken rule must not stop the job
            failed = getattr(fn, "__name__", "unknown_rule")
            return {"rule_name": failed, "triggered": False, "score": 0.0, "reasons": [f"rule_error: {exc}"]}

    @F.pandas_udf(RULE_RESULT)
    def batch(*cols: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([one(args) for args in zip(*cols)], columns=["rule_name", "triggered", "score", "reasons"])

    return batch(*inputs)


def graded_score(results: Column) -> Column:
    """Mean of the rule scores where a triggered rule weighs twice; 0 without rules."""
    zero = F.struct(F.lit(0.0).alias("t"), F.lit(0.0).alias("w"))

    def add(acc: Column, r: Column) -> Column:
        weight = F.when(r["triggered"], 2.0).otherwise(1.0)
        return F.struct((acc["t"] + r["score"] * weight).alias("t"), (acc["w"] + weight).alias("w"))

    mean = F.aggregate(results, zero, add, lambda acc: F.when(acc["w"] > 0, acc["t"] / acc["w"]).otherwise(0.0))
    return clamp(mean, 0.0, 1.0)


def stub_anomaly(id_: Column) -> Column:
    """Deterministic stand-in anomaly score in [0, 1) taken from the row id."""
    return F.pmod(F.coalesce(id_, F.lit(0)), F.lit(100)) / F.lit(100.0)


def graded_fusion(rule_score: Column, anomaly: Column) -> Column:
    return F.bround(clamp(rule_score * 0.5 + anomaly * 0.5, 0.0, 1.0) * SCORE_MAX, 0).cast("int")
