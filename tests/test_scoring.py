"""Scorers against values worked out by hand."""

import pytest
from pyspark.sql import functions as F

from riskloom.config import FusionWeights
from riskloom.functions.columns import band, share_percent
from riskloom.operators import normalize, rules, scoring


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()


@pytest.mark.parametrize("vendor,employee,score,motifs", [
    (None, None, 9, None),
    (None, "E", 75, None),
    ("V", None, 134, "In dense community (size=11) | Neighbors show elevated risk"),
    ("V", "E", 200, "High-degree node (degree=6) | In dense community (size=16) | Neighbors show elevated risk"),
    ("", "", 9, None),
])
def test_graph_proxy(spark, vendor, employee, score, motifs):
    df = spark.createDataFrame([(vendor, employee)], "vendor_code string, employee_id string")
    m = scoring.proxy_metrics()
    r = df.select(scoring.graph_score(m).alias("s"), scoring.graph_motifs(m).alias("m")).first()
    assert (r.s, r.m) == (score, motifs)


@pytest.mark.parametrize("r,m,g,want", [
    (500, 999, 200, 640), (None, 999, 9, 669), (None, None, None, 0), (5000, -3, None, 500), (None, None, 77, 77),
])
def test_fusion(spark, r, m, g, want):
    df = spark.createDataFrame([(r, m, g)], "r int, m int, g int")
    cols = [F.col(c) for c in "rmg"]
    got = df.select(scoring.fuse(*cols).alias("s"), scoring.explanation(*cols).alias("e")).first()
    assert got.s == want
    if (r, m, g) == (None, 999, 9):
        assert got.e == "ML=999 | Graph=9"
    if (r, m, g) == (None, None, None):
        assert got.e.startswith("No risk signals")


def test_fusion_weights_are_settings(spark):
    got = one(spark, s=scoring.fuse(F.lit(999), F.lit(0), F.lit(0), FusionWeights(1.0, 0.0, 0.0)))
    assert got.s == 999


def test_graded_rules(spark):
    df = spark.createDataFrame(
        [(1, 200000.0, 0.9), (2, 50.0, None), (3, None, 0.2)], "id int, amount double, vendor_risk_score double"
    )
    scored = df.select("id", rules.evaluate().alias("r")).select("id", "r", rules.graded_score(F.col("r")).alias("s"))
    got = {r.id: r for r in scored.collect()}
    assert got[1].r[0].reasons == ["High amount detected: 200000.0"] and got[1].r[1].reasons == ["Vendor risk score=0.9"]
    assert got[1].s == pytest.approx(0.9)
    assert got[2].s == pytest.approx(0.075)
    assert got[3].s == pytest.approx((0.1 + 0.2) / 2)
    assert one(spark, s=rules.graded_fusion(F.lit(0.075), F.lit(0.42))).s == 247


def test_no_rules_score_zero(spark):
    empty = F.array().cast("array<struct<rule_name:string,triggered:boolean,score:double,reasons:array<string>>>")
    assert one(spark, s=rules.graded_score(empty)).s == 0.0


def test_python_rule_and_its_failure(spark):
    def careful(amount):
        return amount > 10, 0.7, ["big"]

    def broken(amount):
        raise ValueError("boom")

    df = spark.createDataFrame([(50.0, None)], "amount double, vendor_risk_score double")
    r = df.select(rules.evaluate(rules.GRADED_RULES, rules.python_rule("careful", careful, "amount"), rules.python_rule("b", broken, "amount")).alias("r")).first().r
    assert (r[2].rule_name, r[2].triggered, r[2].score, r[2].reasons) == ("careful", True, 0.7, ["big"])
    assert (r[3].rule_name, r[3].triggered, r[3].score, r[3].reasons) == ("broken", False, 0.0, ["rule_error: boom"])


def test_rule_without_score_is_an_error_result(spark):
    rule = rules.GradedRule("odd", "amount > 1", "try_cast('x' AS DOUBLE)", "never: ", "amount")
    r = spark.createDataFrame([(5.0,)], "amount double").select(rules.evaluate([rule]).alias("r")).first().r[0]
    assert (r.triggered, r.score, r.reasons) == (False, 0.0, ["rule_error: no score"])


def test_bands(spark):
    for name, pairs in {
        "severity": [(199, "LOW"), (200, "MEDIUM"), (499, "MEDIUM"), (500, "HIGH"), (800, "CRITICAL")],
        "high_risk_count": [(3, "ok"), (4, "warn"), (10, "warn"), (11, "danger")],
        "consecutive": [(1, "ok"), (2, "warn"), (5, "danger")],
        "entity": [(29, "LOW"), (30, "MEDIUM"), (60, "HIGH"), (80, "CRITICAL")],
    }.items():
        for score, label in pairs:
            assert one(spark, b=band(F.lit(score), name)).b == label
    assert one(spark, p=share_percent(F.lit(1), F.lit(0))).p == 0


def test_rule_text_round_trip(spark):
    for text, want in {"A, B,,": ["A", "B"], '["x"," y ",""]': ["x", "y"], "[a,b]": ["[a", "b]"], None: [], "": [], "[1,2]": ["1", "2"]}.items():
        df = spark.createDataFrame([(text,)], "t string")
        assert df.select(normalize.rules_to_list(F.col("t")).alias("l")).first().l == want


def test_normalisers(spark):
    raw = [("booked", "PENDING"), (" settled ", "POSTED"), ("VOID", "CANCELLED"), ("REVERSED", "REVERSED"), ("x", "PENDING"), ("", "PENDING"), (None, "PENDING")]
    for text, want in raw:
        df = spark.createDataFrame([(text,)], "t string")
        assert df.select(normalize.normalize_status(F.col("t")).alias("s")).first().s == want
    for text, want in [("dr", "DEBIT"), ("IN", "CREDIT"), ("cr", "CREDIT"), ("Out", "DEBIT"), ("?", "DEBIT"), (None, "DEBIT")]:
        df = spark.createDataFrame([(text,)], "t string")
        assert df.select(normalize.normalize_direction(F.col("t")).alias("s")).first().s == want


def test_repair_score_is_half_even(spark):
    for x, want in [(2.5, 2), (3.5, 4), (-2.5, -2), (None, 0)]:
        df = spark.createDataFrame([(x,)], "x double")
        assert df.select(normalize.repair_score(F.col("x")).alias("s")).first().s == want


def test_ml_score_truncates(spark):
    p = scoring.ml_score_columns(F.lit(5000.99))
    r = one(spark, **p)
    assert r.ml_score == int(0.500099 * 999) and r.ae_score == pytest.approx(r.xgb_score / 2)
    assert one(spark, **scoring.ml_score_columns(F.lit(-4.0))).ml_score == 0
