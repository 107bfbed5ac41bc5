"""The domain tables derived from the test tables, as the named queries use them."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators import normalize, scoring, validate
from riskloom.operators.stored import stored
from riskloom.sources import events, testdata
from riskloom.sources.testdata import AS_OF

SECOND_ALERT = 1_000_000_000


def views(spark: SparkSession, sf_dir: str) -> Views:
    """Fresh plans at each call, so that files that changed meanwhile are seen."""
    return Views(spark, sf_dir)


def scored_once(v: Views) -> Views:
    """The same views over scored transactions that were computed and written once, for a query that reads
    transactions or alerts several times."""
    once = Views(v.spark, v.dir)
    once.tx = once.scored = stored(v.scored)
    return once


class Views:
    """Lazy views over one test-data folder. Plans are kept and shared, data never is."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def _load(self, view: str) -> DataFrame:
        return testdata.load(self.spark, self.dir, view)

    @cached_property
    def raw(self) -> DataFrame:
        return events.with_payload(self._load("raw_events"))

    @cached_property
    def decoded(self) -> DataFrame:
        return events.decode_payloads(testdata.payloads(self.spark, self.dir))

    @cached_property
    def judged(self) -> DataFrame:
        return validate.validate(self.raw, AS_OF)

    @cached_property
    def valid(self) -> DataFrame:
        return validate.valid(self.judged)

    @cached_property
    def tx(self) -> DataFrame:
        return normalize.transactions(self.valid)

    @cached_property
    def scored(self) -> DataFrame:
        return scoring.score_transactions(self.tx)

    @cached_property
    def alerts(self) -> DataFrame:
        return scoring.alert_records(self.scored, F.col("tx_time"), F.col("id").alias("alert_id"))

    @cached_property
    def alerts_messy(self) -> DataFrame:
        """Alerts with a later second alert for some transactions and a lost reference for others."""
        a = self.alerts
        second: Column = F.expr(f"CASE WHEN alert_id % 50 = 0 THEN array(0L, {SECOND_ALERT}L) ELSE array(0L) END")
        rows = a.withColumn("_add", F.explode(second))
        again = F.col("_add") > 0
        return rows.withColumns({
            "risk_score": F.when(again, F.least(F.col("risk_score") + 150, F.lit(999))).otherwise(F.col("risk_score")),
            "transaction_id": F.expr("CASE WHEN alert_id % 211 = 0 THEN -1L ELSE transaction_id END"),
        }).withColumn("alert_id", F.col("alert_id") + F.col("_add")).drop("_add")

    @cached_property
    def vendors(self) -> DataFrame:
        return self._load("vendors")

    @cached_property
    def invoices(self) -> DataFrame:
        return self._load("invoices")

    @cached_property
    def expenses(self) -> DataFrame:
        return self._load("expenses")

    @cached_property
    def entities(self) -> DataFrame:
        return self._load("entities")
