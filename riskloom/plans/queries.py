"""Named queries: every operator applied to the whole test tables.

``flat`` gives results plain types (double, bigint, text, boolean) so that they compare with SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom import config as C
from riskloom.functions.columns import band, score_percent
from riskloom.operators import (
    features,
    graph,
    joins,
    normalize,
    quality,
    rules,
    scoring,
    serving,
    training,
    upsert,
    validate,
)
from riskloom.plans.views import Views, scored_once, views
from riskloom.sources.testdata import AS_OF

FROM_DATE, TO_DATE = "2024-01-01", "2024-01-31"
PREVIOUS_RUN = "2024-01-16 00:00:00"
PAGERANK_ROUNDS = 8

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def flat(df: DataFrame) -> DataFrame:
    def plain(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            c = c.cast("string")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c, ",")
        return c.alias(f.name)

    return df.select(*[plain(f) for f in df.schema.fields])


def query(fn: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
    REGISTRY[fn.__name__] = lambda spark, sf_dir: flat(fn(views(spark, sf_dir)))
    return fn


# ------------------------------------------------------------------ validation
@query
def decode_payload(v: Views) -> DataFrame:
    return v.decoded.select(
        "event_id", "parse_ok", "tenant_id", "tenant_number", "transaction_id", "transaction_reference", "account_id", "amount",
        "currency", "direction", "status", F.col("timestamp").alias("event_ts"), "vendor_code", "employee_id",
    )


@query
def validate_events(v: Views) -> DataFrame:
    return validate.verdicts(v.judged, "event_id", as_of=AS_OF)


@query
def typed_ids(v: Views) -> DataFrame:
    return validate.validate(v.decoded, AS_OF).select("event_id", F.col("_tenant").alias("tenant_id"), "rejection_code")


@query
def rejected_events(v: Views) -> DataFrame:
    r = validate.rejected(v.judged, F.col("event_id").alias("source_id"), as_of=AS_OF)
    payload = F.get_json_object("raw_payload", "$.transaction_reference").alias("payload_reference")
    amount = F.get_json_object("raw_payload", "$.amount").alias("payload_amount")
    return r.select("*", payload, amount).drop("raw_payload", "rejected_at")


@query
def valid_events(v: Views) -> DataFrame:
    return v.valid.drop("event_wall", "event_version")


@query
def schema_errors(v: Views) -> DataFrame:
    judged = validate.validate(v.decoded, AS_OF)
    r = validate.rejected(judged, F.col("event_id").alias("source_id"), as_of=AS_OF)
    return r.where(F.col("rejection_code") == "SCHEMA_ERROR").select("source_id", "rejection_code", "rejection_reason")


@query
def reject_profile(v: Views) -> DataFrame:
    return validate.reject_profile(validate.rejected(v.judged, as_of=AS_OF))


@query
def rejects_latest(v: Views) -> DataFrame:
    r = validate.rejected(v.judged, F.col("event_id").alias("source_id"), as_of=AS_OF)
    return validate.latest_rejects(r, "source_id").select("source_id", "rejection_code", "rejection_reason", "account_id")


# ------------------------------------------------------------------ normalisation
@query
def normalize_tx(v: Views) -> DataFrame:
    return v.tx.select("id", *normalize.TX_COLUMNS)


@query
def severity_bands(v: Views) -> DataFrame:
    return v.scored.select("id", "risk_score", "severity")


@query
def risk_bands_all(v: Views) -> DataFrame:
    s = F.col("risk_score")
    return v.alerts.select(
        "alert_id", "risk_score", *[band(s, n).alias(n) for n in ("severity", "kpi", "badge", "bar")],
        F.round(score_percent(s), 4).alias("percent"),
    )


@query
def entity_bands(v: Views) -> DataFrame:
    v = scored_once(v)
    f = upsert.replace_columns(
        _stream_features(v), features.entity_features(v.tx, v.alerts, AS_OF), features.ACCOUNT, features.STREAM_OWNED
    )
    named = f.join(v.entities.select(F.col("entity_id").alias("account_id"), F.col("risk_score").alias("entity_risk")), "account_id")
    return named.select(
        *features.ACCOUNT, "entity_risk", band(F.col("entity_risk"), "entity").alias("entity_band"),
        "consecutive_high_risk", band(F.col("consecutive_high_risk"), "consecutive").alias("consecutive_tone"),
        "high_risk_tx_count", band(F.col("high_risk_tx_count"), "high_risk_count").alias("high_risk_tone"),
    )


DESCRIPTIONS = (
    "CASE id % 6 WHEN 0 THEN NULL WHEN 1 THEN concat('card ref= A-', tx_id, ' ') WHEN 2 THEN 'x ref=   ' "
    "WHEN 3 THEN concat('ref=', tx_id, ' ref=B') WHEN 4 THEN '' ELSE description END"
)


@query
def tx_reference(v: Views) -> DataFrame:
    tx = v.tx.withColumn("description", F.expr(DESCRIPTIONS))
    return tx.select("id", normalize.transaction_reference().alias("transaction_reference"))


RULE_TEXTS = (
    "CASE id % 5 WHEN 0 THEN NULL WHEN 1 THEN concat(' ', stored, ' , ,X_', tx_id, ' ') "
    "WHEN 2 THEN concat('[\"Y_', tx_id, '\", \" Z \", \"\"]') WHEN 3 THEN '[broken' ELSE stored END"
)


@query
def parse_rules(v: Views) -> DataFrame:
    stored = v.scored.withColumn("stored", normalize.rules_to_text(F.col("triggered_rules")))
    parsed = stored.select("id", normalize.rules_to_list(F.expr(RULE_TEXTS)).alias("rules"))
    return parsed.select("id", F.size("rules").alias("n_rules"), normalize.rules_to_text(F.col("rules")).alias("rules_text"))


@query
def parse_rule_results(v: Views) -> DataFrame:
    stored = F.to_json(F.col("results"))
    text = F.when(F.expr("id % 7 = 0"), F.lit("{oops")).when(F.expr("id % 7 = 1"), F.lit(None)).when(
        F.expr("id % 7 = 2"), F.lit('[{"rule_name":"a","triggered":true,"score":0.5},5,{"rule_name":"b"},null,"x",{"score":1}]')
    ).when(F.expr("id % 7 = 3"), F.lit('{"rule_name":"a","triggered":true,"score":0.5}')).otherwise(stored)
    parsed = _graded(v).select("id", normalize.rule_results(text).alias("r"))
    return parsed.select(
        "id", F.size("r").alias("n_results"), F.array_join(F.col("r.rule_name"), ",").alias("names"),
        F.size(F.filter("r", lambda x: x["triggered"])).alias("n_triggered"),
    )


@query
def tx_view(v: Views) -> DataFrame:
    return normalize.transaction_view(v.tx.withColumn("amount", F.expr("CASE WHEN id % 9 = 0 THEN NULL ELSE amount END")))


@query
def rule_hits_labelled(v: Views) -> DataFrame:
    codes = F.when(F.expr("id % 11 = 0"), F.array_append("triggered_rules", F.lit("R_UNKNOWN"))).otherwise(F.col("triggered_rules"))
    hits = v.scored.select("id", F.explode(codes).alias("rule_id"))
    return normalize.label_rules(hits)


@query
def backfill_ts(v: Views) -> DataFrame:
    tx = v.tx.select(
        "id", F.expr("CASE WHEN id % 3 <> 0 THEN tx_time END").alias("created_at"),
        F.expr("CASE WHEN id % 4 <> 0 THEN booking_time END").alias("updated_at"),
    )
    return normalize.fill_timestamps(tx, F.lit(AS_OF).cast("timestamp"))


@query
def score_type_repair(v: Views) -> DataFrame:
    # Halves of both signs, and nulls.
    return v.entities.select(
        "id", normalize.repair_score(F.expr("CASE WHEN id % 10 = 9 THEN NULL ELSE (risk_score - 50) / 2D END")).alias("score")
    )


@query
def entity_features_view(v: Views) -> DataFrame:
    v = scored_once(v)
    f = features.entity_features(v.tx, v.alerts, AS_OF)
    return serving.entity_feature_view(v.entities, f, tenant_id=1)


# ------------------------------------------------------------------ scoring
def _graded(v: Views) -> DataFrame:
    """Invoice payments with their vendor's risk, scored by the graded rules."""
    one = upsert.first_by_key(
        v.invoices.select("id", "tenant_id", F.col("vendor_id").alias("vendor_code"), F.col("total_amount").alias("amount")),
        ["id"], ["amount", "vendor_code"],
    )
    enriched = features.enrich_vendor(one, v.vendors)
    return enriched.select("id", "amount", "vendor_risk_score", rules.evaluate().alias("results"))


@query
def rules_v1(v: Views) -> DataFrame:
    rows = _graded(v).select("id", F.explode("results").alias("r"))
    return rows.select("id", "r.rule_name", "r.triggered", "r.score", F.array_join("r.reasons", ";").alias("reasons"))


@query
def rule_score_v1(v: Views) -> DataFrame:
    return _graded(v).select("id", F.round(rules.graded_score(F.col("results")), 6).alias("rule_score"))


@query
def fused_v1(v: Views) -> DataFrame:
    s = _graded(v).select("id", rules.graded_score(F.col("results")).alias("rule_score"), rules.stub_anomaly(F.col("id")).alias("anomaly_score"))
    return s.select("id", "anomaly_score", rules.graded_fusion(F.col("rule_score"), F.col("anomaly_score")).alias("risk_score"))


@query
def rule_hits(v: Views) -> DataFrame:
    return v.scored.select("id", "rule_score", F.explode("triggered_rules").alias("rule_id"))


@query
def rule_hit_counts(v: Views) -> DataFrame:
    hits = v.scored.select("severity", F.explode("triggered_rules").alias("rule_id"))
    return hits.groupBy("rule_id", "severity").agg(F.count("*").alias("n_hits"))


@query
def ml_features(v: Views) -> DataFrame:
    f = scoring.ml_features(v.tx).select("id", *C.ML_FEATURES)
    return f.withColumn("amount_log", F.round("amount_log", 6))


@query
def ml_scores(v: Views) -> DataFrame:
    return v.scored.select("id", "xgb_score", "ae_score", "ml_score", "model_version")


@query
def graph_scores(v: Views) -> DataFrame:
    return v.scored.select("id", "graph_score", "graph_motifs")


@query
def fusion(v: Views) -> DataFrame:
    return v.scored.select("id", "rule_score", "ml_score", "graph_score", "risk_score", "explanation")


@query
def fusion_missing(v: Views) -> DataFrame:
    s = v.scored.select(
        "id", F.expr("CASE WHEN id % 2 = 0 THEN rule_score END").alias("r"),
        F.expr("CASE WHEN id % 3 = 0 THEN ml_score END").alias("m"),
        F.expr("CASE WHEN id % 5 = 0 THEN graph_score END").alias("g"),
    )
    cols = [F.col(c) for c in "rmg"]
    return s.select("id", scoring.fuse(*cols).alias("risk_score"), scoring.explanation(*cols).alias("explanation"))


@query
def risk_preview(v: Views) -> DataFrame:
    return scoring.preview(v.scored)


@query
def alerts(v: Views) -> DataFrame:
    return v.alerts


@query
def alerts_json(v: Views) -> DataFrame:
    m = scoring.alert_messages(v.alerts, "transaction_reference")
    fields = ["event_version", "tenant_id", "transaction_id", "account_id", "vendor_code", "risk_score", "triggered_rules", "scored_at"]
    return m.select("key", *[F.get_json_object("value", f"$.{f}").alias(f) for f in fields])


# ------------------------------------------------------------------ features
def _stream_features(v: Views) -> DataFrame:
    """Features with the order-aware columns, as a stream would have left them at an earlier moment."""
    before = v.scored.where(F.col("tx_time") < F.lit(PREVIOUS_RUN).cast("timestamp"))
    f = features.entity_features(before, v.alerts, PREVIOUS_RUN).drop("amount_last", "latest_risk_score", "consecutive_high_risk")
    state = features.latest_state(before).select(*features.ACCOUNT, "amount_last", "latest_risk_score")
    run = features.consecutive_high_risk(before)
    return f.join(state, features.ACCOUNT).join(run, features.ACCOUNT).select(*features.ACCOUNT, *features.FEATURE_COLUMNS)


@query
def entity_features_batch(v: Views) -> DataFrame:
    v = scored_once(v)
    return features.entity_features(v.tx, v.alerts_messy, AS_OF)


@query
def alert_agg(v: Views) -> DataFrame:
    v = scored_once(v)
    return features.alert_agg(v.tx, v.alerts_messy)


@query
def daily_summary(v: Views) -> DataFrame:
    v = scored_once(v)
    return features.daily_summary(v.tx, v.alerts_messy, FROM_DATE, TO_DATE)


@query
def daily_summary_fanout(v: Views) -> DataFrame:
    v = scored_once(v)
    return features.daily_summary(v.tx, v.alerts_messy, FROM_DATE, TO_DATE, dedupe_alerts=False)


@query
def entity_risk_sync(v: Views) -> DataFrame:
    v = scored_once(v)
    return features.entity_risk_changes(v.entities, features.entity_features(v.tx, v.alerts, AS_OF), tenant_id=1)


@query
def risk_sync_dryrun(v: Views) -> DataFrame:
    changes = features.entity_risk_changes(v.entities, features.entity_features(v.tx, v.alerts, AS_OF), tenant_id=None)
    return changes.agg(F.count("*").alias("n_changes"))


@query
def dryrun_counts(v: Views) -> DataFrame:
    return features.dry_run_counts(v.tx, FROM_DATE, TO_DATE)


@query
def summary_extent(v: Views) -> DataFrame:
    return features.summary_extent(features.daily_summary(v.tx, v.alerts, FROM_DATE, TO_DATE))


@query
def velocity_flags(v: Views) -> DataFrame:
    return features.velocity_flags(v.tx, AS_OF)


@query
def velocity_sliding(v: Views) -> DataFrame:
    return features.sliding_velocity(v.tx)


@query
def rolling_velocity(v: Views) -> DataFrame:
    return features.rolling_velocity(v.tx)


@query
def consecutive_high_risk(v: Views) -> DataFrame:
    return features.consecutive_high_risk(v.scored)


@query
def high_risk_runs(v: Views) -> DataFrame:
    return features.high_risk_runs(v.scored).drop("tx_id")


@query
def latest_state(v: Views) -> DataFrame:
    return features.latest_state(v.scored)


@query
def running_risk_avg(v: Views) -> DataFrame:
    return features.running_risk_avg(v.scored)


@query
def tx_spikes(v: Views) -> DataFrame:
    return features.tx_spikes(v.tx, sigmas=2)


@query
def tx_duplicates(v: Views) -> DataFrame:
    return features.tx_duplicates(v.tx, minutes=1440)


@query
def invoice_duplicates(v: Views) -> DataFrame:
    # A fifth of the invoices once more: half of them within the bound, half after it.
    cols = ["id", "invoice_number", "tenant_id", "vendor_id", "subtotal_amount", "invoice_date"]
    again = v.invoices.where("id % 5 = 0").withColumns({
        "id": F.col("id") + 1_000_000_000_000,
        "invoice_date": F.expr("date_add(invoice_date, CASE WHEN (id DIV 10) % 2 = 0 THEN 100 ELSE 500 END)"),
    })
    return features.invoice_duplicates(v.invoices.select(*cols).unionByName(again.select(*cols)), days=365)


@query
def expense_patterns(v: Views) -> DataFrame:
    missing = F.expr("CASE WHEN id % 9 <> 0 THEN cost_center_code END")
    return features.expense_patterns(v.expenses.withColumn("cost_center_code", missing))


@query
def expense_linkage(v: Views) -> DataFrame:
    return features.expense_linkage(v.expenses, v.invoices, v.tx)


@query
def enrich_vendor(v: Views) -> DataFrame:
    e = features.enrich_vendor(v.tx, v.vendors, high_risk_countries=["US"])
    return e.select("id", "vendor_code", "vendor_risk_level", "vendor_country_code", "vendor_risk_score", "is_high_risk_country")


@query
def seed_entities(v: Views) -> DataFrame:
    # Customer ids come from the expense owners; half of the accounts exist already.
    tx = v.tx.withColumn("customer_id", F.col("employee_id"))
    known = v.entities.select(F.expr("concat('ACC:ACC-', CAST(id * 20 AS STRING))").alias("entity_id"), F.lit("ACCOUNT").alias("type"))
    return features.seed_entities(tx, known)


# ------------------------------------------------------------------ serving
@query
def alerts_summary(v: Views) -> DataFrame:
    return serving.alert_kpis(v.alerts).withColumn("avg_risk_score", F.round("avg_risk_score", 4))


@query
def alerts_list(v: Views) -> DataFrame:
    return serving.list_alerts(v.alerts, min_risk=300, severity="HIGH", limit=100, offset=20).select("alert_id", "risk_score", "severity", "scored_at")


@query
def alerts_latest(v: Views) -> DataFrame:
    return serving.latest_alerts(v.alerts).select("alert_id", "risk_score", "severity", "account_id")


@query
def alerts_sorted(v: Views) -> DataFrame:
    return serving.sorted_alerts(v.alerts, "scored_at", descending=False).select("alert_id", "scored_at", "risk_score")


@query
def alerts_search(v: Views) -> DataFrame:
    return serving.search_alerts(v.alerts, "acc-1").select("alert_id", "transaction_reference", "account_id")


@query
def alert_detail(v: Views) -> DataFrame:
    v = scored_once(v)
    return serving.alert_details(v.alerts_messy, v.tx).select(
        "alert_id", "transaction_id", "risk_score", "tx_id", "tx_time", "amount", "direction", "status", "description"
    )


@query
def alerts_detached(v: Views) -> DataFrame:
    v = scored_once(v)
    return serving.alerts_without_transaction(v.alerts_messy, v.tx).select("alert_id", "transaction_id")


@query
def transactions_list(v: Views) -> DataFrame:
    return serving.list_transactions(
        v.tx, account_id="ACC-0", min_time="2024-01-05 00:00:00", max_time="2024-01-20 12:00:00"
    ).select("id", "account_id", "tx_time", "amount")


@query
def invoices_list(v: Views) -> DataFrame:
    return serving.list_invoices(
        v.invoices, vendor_id="VEND-7", from_date="1996-01-01", to_date="2000-12-31"
    ).select("id", "invoice_number", "vendor_id", "invoice_date", "total_amount", "status")


@query
def expenses_list(v: Views) -> DataFrame:
    return serving.list_expenses(
        v.expenses, employee_id="EMP-3", category="MEALS", status="PAID", from_date="1995-01-01", to_date="2001-12-31",
        min_amount=1000.0, max_amount=400000.0,
    ).select("id", "employee_id", "category", "status", "expense_date", "amount")


@query
def vendors_list(v: Views) -> DataFrame:
    return serving.list_vendors(
        v.vendors, country_code="US", risk_level="HIGH", onboarding_from="2020-01-01", onboarding_to="2020-12-31"
    ).select("vendor_code", "name", "country_code", "risk_level", "onboarding_date")


@query
def entities_search(v: Views) -> DataFrame:
    return serving.list_entities(v.entities, q="ACC-1")


@query
def entities_filter(v: Views) -> DataFrame:
    return serving.filter_entities(v.entities, type_="COMPANY", min_risk=60, q="customer#")


@query
def entity_risk_histogram(v: Views) -> DataFrame:
    return serving.entity_risk_histogram(v.entities)


@query
def severity_share(v: Views) -> DataFrame:
    return serving.severity_shares(v.alerts)


@query
def entity_types(v: Views) -> DataFrame:
    return serving.entity_types(v.entities)


@query
def top_entities(v: Views) -> DataFrame:
    return serving.top_entities(features.entity_features(v.tx, v.alerts, AS_OF))


@query
def lookup_by_keys(v: Views) -> DataFrame:
    wanted = v.expenses.select(F.col("transaction_id").alias("id")).where(F.col("id").isNotNull())
    return joins.semi_lookup(v.tx, wanted, ["id"]).select("id", "account_id", "amount", "tx_time")


# ------------------------------------------------------------------ upserts
@query
def tx_upsert(v: Views) -> DataFrame:
    existing = v.tx.select("id", *normalize.TX_COLUMNS)
    # Replays of every row: some under a new id, all with another amount.
    incoming = existing.withColumns({
        "tx_id": F.expr("CASE WHEN id % 7 = 0 THEN concat('N', tx_id) ELSE tx_id END"),
        "amount": (F.col("amount") + 1).cast("decimal(18,2)"),
    })
    merged = upsert.upsert(existing, incoming.unionByName(existing.where("amount > 100")), ["tenant_id", "tx_id"], ["tx_time", "amount"])
    return merged.select("tenant_id", "tx_id", "account_id", "tx_time", "amount", "status", "change")


@query
def features_upsert(v: Views) -> DataFrame:
    v = scored_once(v)
    new = features.entity_features(v.tx, v.alerts, AS_OF)
    return upsert.replace_columns(_stream_features(v), new, features.ACCOUNT, features.STREAM_OWNED)


@query
def ingest_new_invoices(v: Views) -> DataFrame:
    cols = ["tenant_id", "invoice_number", "vendor_id", "invoice_date", "subtotal_amount", "tax_amount", "status", "cost_center_code"]
    incoming = v.invoices.select(*cols)
    existing = incoming.where(F.col("invoice_date") < F.lit("1998-01-01").cast("date"))
    return upsert.ingest_new(existing, incoming, ["tenant_id", "invoice_number"], cols[2:])


@query
def ingest_invoice_report(v: Views) -> DataFrame:
    existing = v.invoices.where(F.col("invoice_date") < F.lit("1998-01-01").cast("date"))
    return upsert.ingest_report(existing, v.invoices, ["tenant_id", "invoice_number"])


# ------------------------------------------------------------------ data quality
@query
def dedupe_keep_first(v: Views) -> DataFrame:
    cols = ["id", "tenant_id", "vendor_id", "invoice_date"]
    return quality.keep_first(v.invoices.select(*cols), ["tenant_id", "vendor_id", "invoice_date"])


@query
def orphan_alerts(v: Views) -> DataFrame:
    v = scored_once(v)
    return quality.null_orphan_alerts(v.alerts_messy, v.tx).select("alert_id", "transaction_id", "risk_score")


@query
def dq_duplicates(v: Views) -> DataFrame:
    v = scored_once(v)
    f = features.entity_features(v.tx, v.alerts, AS_OF)
    d = features.daily_summary(v.tx, v.alerts, FROM_DATE, TO_DATE)
    parts = [
        (v.tx, ["tenant_id", "tx_id"], "transactions"), (v.entities, ["entity_id"], "entities"),
        (f, features.ACCOUNT, "entity_features"), (d, [*features.ACCOUNT, "summary_date"], "entity_daily_summary"),
        (v.invoices, ["tenant_id", "invoice_number"], "invoices"), (v.vendors, ["tenant_id", "vendor_code"], "vendors"),
    ]
    out = None
    for df, keys, name in parts:
        one = quality.duplicate_keys(df, keys, name)
        out = one if out is None else out.unionByName(one)
    return out


@query
def dq_orphans(v: Views) -> DataFrame:
    v = scored_once(v)
    out = quality.orphans(v.alerts_messy, "transaction_id", v.tx, "id", "alerts->transactions")
    out = out.unionByName(quality.orphans(v.expenses, "invoice_id", v.invoices, "id", "expenses->invoices"))
    out = out.unionByName(quality.orphans(v.expenses, "transaction_id", v.tx, "id", "expenses->transactions"))
    paid = v.tx.withColumn("invoice_id", F.col("id") * 10 + 1)
    return out.unionByName(quality.orphans(paid, "invoice_id", v.invoices, "id", "transactions->invoices"))


@query
def dq_lengths(v: Views) -> DataFrame:
    limits = {"currency": 3, "country_code": 2, "merchant_category": 8, "channel": 32}
    out = quality.length_violations(v.tx, "transactions", limits, ["tx_id", "account_id", "tx_time", "amount"])
    out = out.unionByName(quality.length_violations(v.raw, "raw_events", {"currency": 3, "account_id": 6}, ["tenant_id", "account_id"]))
    return out.unionByName(quality.length_violations(v.vendors, "vendors", {"country_code": 2}, ["vendor_code", "name"]))


@query
def dq_domains(v: Views) -> DataFrame:
    out = quality.domain_violations(v.tx, "transactions", {"direction": C.DIRECTIONS, "status": C.STATUSES})
    for df, name, domains in (
        (v.raw, "raw_events", {"direction": C.DIRECTIONS, "status": C.STATUSES}),
        (v.invoices, "invoices", {"status": C.INVOICE_STATUSES}),
        (v.vendors, "vendors", {"risk_level": C.VENDOR_RISK_LEVELS}),
        (v.expenses, "employee_expenses", {"status": C.EXPENSE_STATUSES, "category": C.EXPENSE_CATEGORIES}),
        (v.entities, "entities", {"type": C.ENTITY_TYPES}),
    ):
        out = out.unionByName(quality.domain_violations(df, name, domains))
    return out


@query
def dq_ranges(v: Views) -> DataFrame:
    scores = {c: (0, 999) for c in ("risk_score", "rule_score", "ml_score", "graph_score")}
    out = quality.range_violations(v.alerts, "alerts", scores)
    out = out.unionByName(quality.range_violations(v.scored, "ml_scores", {"xgb_score": (0.0, 1.0), "ae_score": (0.0, 0.4)}))
    return out.unionByName(quality.range_violations(v.entities, "entities", {"risk_score": (0, 99)}))


# Rows of each table that break one constraint each, as SQL that both engines read; the report must count them.
PLANTED = {
    "transactions": {
        "tx_id": "CASE WHEN id % 43 = 5 THEN 'TWICE' WHEN id % 43 = 6 THEN NULL ELSE tx_id END",
        "account_id": "CASE WHEN id % 47 = 5 THEN NULL ELSE account_id END",
        "tx_time": "CASE WHEN id % 53 = 5 THEN NULL ELSE tx_time END",
        "amount": "CASE WHEN id % 59 = 5 THEN NULL ELSE amount END",
        "currency": "CASE WHEN id % 61 = 5 THEN concat(currency, 'X') ELSE currency END",
        "country_code": "CASE WHEN id % 67 = 5 THEN concat(country_code, 'X') ELSE country_code END",
        "merchant_category": "CASE WHEN id % 71 = 5 THEN concat(merchant_category, '89') ELSE merchant_category END",
        "channel": "CASE WHEN id % 73 = 5 THEN repeat('K', 33) ELSE repeat('K', 32) END",
        "direction": "CASE WHEN id % 79 = 5 THEN 'SIDEWAYS' ELSE direction END",
        "status": "CASE WHEN id % 83 = 5 THEN 'BOGUS' ELSE status END",
    },
    "alerts": {
        "risk_score": "CASE WHEN alert_id % 43 = 5 THEN 1000 ELSE risk_score END",
        "rule_score": "CASE WHEN alert_id % 47 = 5 THEN -1 ELSE rule_score END",
        "ml_score": "CASE WHEN alert_id % 53 = 5 THEN 1000 ELSE ml_score END",
        "graph_score": "CASE WHEN alert_id % 59 = 5 THEN -1 ELSE graph_score END",
    },
    "ml_scores": {
        "xgb_score": "CASE WHEN id % 43 = 5 THEN xgb_score + 1.5 ELSE xgb_score END",
        "ae_score": "CASE WHEN id % 47 = 5 THEN -0.25 ELSE 0.25 END",
    },
    "entity_features": {"account_id": "CASE WHEN tx_count_total % 3 = 0 THEN 'TWICE' ELSE account_id END"},
    "invoices": {
        "invoice_number": "CASE WHEN id % 43 = 5 THEN 'TWICE' ELSE invoice_number END",
        "status": "CASE WHEN id % 47 = 5 THEN 'LOST' ELSE status END",
    },
    "vendors": {
        "vendor_code": "CASE WHEN vendor_code LIKE '%3' THEN 'TWICE' WHEN vendor_code LIKE '%4' THEN NULL ELSE vendor_code END",
        "name": "CASE WHEN vendor_code LIKE '%5' THEN NULL ELSE name END",
        "country_code": "CASE WHEN vendor_code LIKE '%6' THEN 'USA' ELSE country_code END",
        "risk_level": "CASE WHEN vendor_code LIKE '%7' THEN 'SEVERE' ELSE risk_level END",
    },
    "employee_expenses": {
        "status": "CASE WHEN id % 43 = 5 THEN 'LOST' ELSE status END",
        "category": "CASE WHEN id % 47 = 5 THEN 'YACHT' ELSE category END",
    },
    "entities": {
        "entity_id": "CASE WHEN id % 43 = 5 THEN 'TWICE' ELSE entity_id END",
        "type": "CASE WHEN id % 47 = 5 THEN 'ROBOT' ELSE type END",
        "risk_score": "CASE WHEN id % 53 = 5 THEN 1000 ELSE risk_score END",
    },
}


@query
def dq_report(v: Views) -> DataFrame:
    """All constraints of each table in one scan of it."""
    v = scored_once(v)
    f = features.entity_features(v.tx, v.alerts, AS_OF)
    score = (0, 999)
    plan = [
        ("transactions", v.tx, [["tenant_id", "tx_id"]], [
            *quality.null_or_longer({"currency": 3, "country_code": 2, "merchant_category": 8, "channel": 32}, ["tx_id", "account_id", "tx_time", "amount"]),
            *quality.outside_domain({"direction": C.DIRECTIONS, "status": C.STATUSES}),
        ]),
        ("alerts", v.alerts, [], quality.outside_range(dict.fromkeys(("risk_score", "rule_score", "ml_score", "graph_score"), score))),
        ("ml_scores", v.scored, [], quality.outside_range({"xgb_score": (0, 1), "ae_score": (0, 1)})),
        ("entity_features", f, [features.ACCOUNT], []),
        ("invoices", v.invoices, [["tenant_id", "invoice_number"]], quality.outside_domain({"status": C.INVOICE_STATUSES})),
        ("vendors", v.vendors, [["tenant_id", "vendor_code"]], [
            *quality.null_or_longer({"country_code": 2}, ["vendor_code", "name"]), *quality.outside_domain({"risk_level": C.VENDOR_RISK_LEVELS}),
        ]),
        ("employee_expenses", v.expenses, [], quality.outside_domain({"status": C.EXPENSE_STATUSES, "category": C.EXPENSE_CATEGORIES})),
        ("entities", v.entities, [["entity_id"]], [*quality.outside_domain({"type": C.ENTITY_TYPES}), *quality.outside_range({"risk_score": score})]),
    ]
    out = None
    for name, df, keys, checks in plan:
        broken = df.select(*[F.expr(PLANTED[name][c]).alias(c) if c in PLANTED[name] else F.col(c) for c in df.columns])
        one = quality.constraint_report(broken, name, keys, checks)
        out = one if out is None else out.unionByName(one)
    return out


def two_tenants(df: DataFrame, ids: str, keep: str = "true") -> DataFrame:
    """A second tenant beside the first, with the same ids where ``keep`` holds and every third id moved."""
    first = df.withColumn("tenant_id", F.lit(1).cast("bigint"))
    other = df.where(keep).withColumns({
        "tenant_id": F.lit(2).cast("bigint"), ids: F.expr(f"CASE WHEN {ids} % 3 = 1 THEN {ids} + 1000000000 ELSE {ids} END"),
    })
    return first.unionByName(other)


@query
def tenants_linkage(v: Views) -> DataFrame:
    """Expenses, invoices and payments of two tenants that use the same ids."""
    expenses, invoices = two_tenants(v.expenses, "id"), two_tenants(v.invoices, "id", "id % 2 = 0")
    tx = two_tenants(v.tx.select("id", "tenant_id", "amount"), "id", "id % 4 = 0")
    own = F.concat(F.col("tenant_id"), F.lit(":"), F.col("id"))
    linked = features.expense_linkage(expenses.withColumn("id", own), invoices, tx)
    return linked.select("id", "invoice_amount", "payment_amount", "link_status")


@query
def tenants_alerts(v: Views) -> DataFrame:
    """Alerts and transactions of two tenants that use the same ids: measures per account, and lost references."""
    v = scored_once(v)
    tx = two_tenants(v.tx, "id", "id % 4 = 0")
    alerts = two_tenants(v.alerts_messy, "transaction_id", "transaction_id % 3 = 0")
    lost = quality.null_orphan_alerts(alerts, tx).groupBy("tenant_id").agg(F.count_if(F.col("transaction_id").isNull()).alias("n_lost"))
    return features.alert_agg(tx, alerts).join(lost, "tenant_id")


# ------------------------------------------------------------------ graph
def _edges(v: Views) -> DataFrame:
    return graph.edges(v.tx, v.expenses, v.invoices)


@query
def graph_edges(v: Views) -> DataFrame:
    return _edges(v)


@query
def graph_degree(v: Views) -> DataFrame:
    return graph.degrees(_edges(v))


@query
def graph_components(v: Views) -> DataFrame:
    return graph.components(_edges(v))


@query
def graph_pagerank(v: Views) -> DataFrame:
    return graph.pagerank(_edges(v), PAGERANK_ROUNDS).withColumn("pagerank", F.round("pagerank", 8))


@query
def graph_neighbor_risk(v: Views) -> DataFrame:
    r = graph.neighbor_risk(_edges(v), graph.node_risk(v.alerts))
    return r.withColumn("avg_neighbor_risk", F.round("avg_neighbor_risk", 6))


@query
def graph_scores_real(v: Views) -> DataFrame:
    return graph.score_with_metrics(v.tx, graph.node_metrics(_edges(v), v.alerts, PAGERANK_ROUNDS))


# ------------------------------------------------------------------ anomaly profile
def _errors(v: Views) -> DataFrame:
    f = scoring.ml_features(v.tx).select("id", *C.ML_FEATURES)
    normal = f.where(F.col("amount_raw") <= 8000)
    return training.anomaly_errors(f, training.fit_mean(normal))


@query
def anomaly_threshold(v: Views) -> DataFrame:
    p = training.error_profile(_errors(v).where(F.col("amount_raw") <= 8000))
    return p.select("n_rows", *[F.round(c, 4).alias(c) for c in ("error_mean", "error_std", "threshold")])


@query
def anomaly_scores(v: Views) -> DataFrame:
    e = _errors(v)
    threshold = training.error_profile(e.where(F.col("amount_raw") <= 8000)).first().threshold
    return training.anomaly_flags(e, threshold).select("id", F.round("error", 4).alias("error"), "is_anomaly")
