"""Stream, stored tables, daily job and lists together: tenants, arrival order, crashes, moved rows."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from riskloom.functions.columns import float_text
from riskloom.operators import features, graph, normalize, quality, serving
from riskloom.operators.features import alert_stats
from riskloom.plans import daily_batch
from riskloom.sources.testdata import AS_OF
from riskloom.streaming.risk_stream import TX_KEY, TX_SCHEMA, RiskStream, topic_writer

JAN = dt.date(2024, 1, 1), dt.date(2024, 1, 31)


def payloads(spark, *events):
    base = {"event_version": "v1", "currency": "MYR", "direction": "DEBIT", "status": "BOOKED", "account_id": "A"}
    rows = [(json.dumps({**base, "transaction_reference": f"R{e['transaction_id']}", "timestamp": f"2024-01-{e.pop('day'):02d}T10:00:00", **e}),) for e in events]
    return spark.createDataFrame(rows, "value string").coalesce(1)


def e(i, amount, day=3, tenant=1, **more):
    return {"transaction_id": i, "amount": amount, "day": day, "tenant_id": tenant, **more}


ENTITIES = "id long, entity_id string, name string, type string, risk_score int"


def test_tenants_with_equal_ids_stay_apart(spark, tmp_path):
    s = RiskStream(spark, str(tmp_path / "t"), AS_OF)
    s.process(payloads(spark, e(7, 60000), e(7, 20, tenant=2), e(8, 20)), 0)
    tx, alerts = s.transactions(), s.alerts()
    assert alerts.select("alert_id").distinct().count() == 3
    scores = {(r.tenant_id, r.transaction_id): r.risk_score for r in alerts.collect()}
    store = daily_batch.run(
        spark, tx, alerts, spark.createDataFrame([(1, "A", "a", "COMPANY", 0)], ENTITIES), str(tmp_path / "d"), *JAN, AS_OF
    )
    known = {r.tenant_id: r for r in store.current("entity_features", daily_batch.FEATURE_SCHEMA, features.ACCOUNT).collect()}
    assert float(known[2].risk_score_avg) == scores[2, 7] and known[1].latest_risk_score == scores[1, 7]
    days = {(r.tenant_id, r.tx_count): r.risk_score_max for r in daily_batch.daily_summaries(store).collect()}
    assert days == {(1, 2): scores[1, 7], (2, 1): scores[2, 7]}
    shown = serving.alert_details(alerts, tx).collect()
    assert sorted((r.tenant_id, r.transaction_id, float(r.amount)) for r in shown) == [(1, 7, 60000.0), (1, 8, 20.0), (2, 7, 20.0)]
    assert serving.list_alerts(alerts).count() == 3
    gone = tx.where("tenant_id = 1")
    assert {(r.tenant_id, r.transaction_id) for r in quality.null_orphan_alerts(alerts, gone).collect()} == {(1, 7), (1, 8), (2, None)}
    assert serving.alerts_without_transaction(alerts, gone).count() == 1
    assert quality.orphans(alerts, "transaction_id", gone, "id", "x").first().n_rows == 1


@pytest.mark.parametrize("cuts", [[], [1], [1, 2, 3, 4]])
def test_arrival_order_wins_wherever_batches_are_cut(spark, tmp_path, cuts):
    events = [e(1, 60000), e(2, 5, day=9), e(1, 20), e(3, 70000, day=2), e(2, 6, day=1)]
    s = RiskStream(spark, str(tmp_path), AS_OF, fold_every=2)
    for n, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(events)])):
        s.process(payloads(spark, *[dict(x) for x in events[a:b]]), n)
    assert {r.transaction_id if "transaction_id" in r else r.id: float(r.amount) for r in s.transactions().collect()} == {1: 20.0, 2: 6.0, 3: 70000.0}
    account = s.account_summaries().first()
    assert (account.n, float(account.amount_total), float(account.amount_last), account.run) == (3, 70026.0, 20.0, 0)


@pytest.mark.parametrize("table", ["transactions", "alerts", "account_days"])
def test_a_crash_before_the_commit_leaves_nothing(spark, tmp_path, monkeypatch, table):
    s = RiskStream(spark, str(tmp_path), AS_OF)
    s.process(payloads(spark, e(1, 10)), 0)
    write = s.store.write

    def failing(name, df, batch_id):
        write(name, df, batch_id)
        if name == table:
            raise OSError("lost")

    monkeypatch.setattr(s.store, "write", failing)
    with pytest.raises(OSError):
        s.process(payloads(spark, e(2, 20)), 1)
    again = RiskStream(spark, str(tmp_path), AS_OF)
    again.process(payloads(spark, e(1, 10)), 1)  # another batch under the same number, without changes
    assert again.transactions().count() == 1 and again.alerts().count() == 1
    assert again.account_summaries().first().n == 1


def test_lookup_reads_the_columns_it_asks_for(spark, tmp_path):
    s = RiskStream(spark, str(tmp_path), AS_OF)
    s.process(payloads(spark, e(1, 10), e(2, 20)), 0)
    found = s.store.current("transactions", TX_SCHEMA, TX_KEY, columns=["amount"], among=spark.createDataFrame([(1, "2")], "tenant_id long, tx_id string"))
    assert [float(r.amount) for r in found.collect()] == [20.0]
    plan = found._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.splitlines() if "ReadSchema" in x and "amount" in x)
    assert "currency" not in scan and "risk_score" not in scan


def test_a_moved_transaction_leaves_its_old_day(spark, tmp_path):
    s = RiskStream(spark, str(tmp_path / "t"), AS_OF)
    entities = spark.createDataFrame([(1, "A", "a", "COMPANY", 99)], ENTITIES)
    for n, day in enumerate((3, 4)):
        s.process(payloads(spark, e(1, 10, day=day)), n)
        store = daily_batch.run(spark, s.transactions(), s.alerts(), entities, str(tmp_path / "d"), *JAN, AS_OF)
        rows = daily_batch.daily_summaries(store).collect()
        assert [(str(r.summary_date), r.tx_count) for r in rows] == [(f"2024-01-{day:02d}", 1)]
        assert str(rows[0].batch_run_at) == AS_OF[:19]
    changes = features.entity_risk_changes(entities, store.current("entity_features", daily_batch.FEATURE_SCHEMA, features.ACCOUNT))
    want = {r.id: r.risk_score for r in changes.collect()}
    assert list(want) == [1] and want[1] < 99
    assert {r.id: r.risk_score for r in daily_batch.apply_risk_changes(entities, changes).collect()} == want


def test_the_daily_job_updates_entities(spark, tmp_path):
    s = RiskStream(spark, str(tmp_path / "t"), AS_OF)
    s.process(payloads(spark, e(1, 60000), e(2, 20, account_id="B")), 0)
    source = spark.createDataFrame([(1, "A", "a", "COMPANY", 0), (2, "B", "b", "COMPANY", None), (3, "C", "c", "COMPANY", 7)], ENTITIES)
    args = str(tmp_path / "d"), *JAN, AS_OF
    store = daily_batch.run(spark, s.transactions(), s.alerts(), source, *args)
    scores = {r.transaction_id: r.risk_score for r in s.alerts().collect()}
    want = {1: round(scores[1] / 10 + 1e-9), 2: round(scores[2] / 10 + 1e-9), 3: 7}
    assert {r.id: r.risk_score for r in daily_batch.entities_of(store, source).collect()} == want
    changed = "id long, entity_id string, old_risk_score int, risk_score int"
    for run, n in ((0, 2), (1, 0)):
        if run:
            daily_batch.run(spark, s.transactions(), s.alerts(), source, *args)
        assert store.batch("entity_risk_changes", changed, run).count() == n
    assert {r.id: r.risk_score for r in daily_batch.entities_of(store, source).collect()} == want
    # A run that fails before its commit leaves the scores of the one before.
    store.write("entities", source, 2)
    assert {r.id: r.risk_score for r in daily_batch.entities_of(store, source).collect()} == want
    more = source.unionByName(spark.createDataFrame([(9, "Z", "z", "COMPANY", 3)], ENTITIES))
    assert daily_batch.entities_of(store, more).where("id = 9").first().risk_score == 3


def test_alerts_of_other_days_leave_before_the_aggregation(spark):
    tx = spark.range(10).select("id", F.lit(1).cast("long").alias("tenant_id"), F.lit("A").alias("account_id"), F.lit(1).cast("decimal(18,2)").alias("amount"),
                                F.lit("2024-01-02").cast("timestamp").alias("tx_time"), F.lit("DEBIT").alias("direction"))
    alerts = spark.range(10).select(F.col("id").alias("alert_id"), F.lit(1).cast("long").alias("tenant_id"), F.col("id").alias("transaction_id"),
                                    F.lit(5).alias("risk_score"), F.lit("2024-01-02").cast("timestamp").alias("scored_at"))
    plan = features.daily_summary(tx, alerts, "2024-01-01", "2024-01-02")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("max_by") < plan.index("LeftSemi")
    assert alert_stats(alerts).count() == 10


def test_enriched_and_alert_messages_reach_a_sink(spark, tmp_path):
    out = topic_writer("parquet", path=str(tmp_path / "alerts")), topic_writer("parquet", path=str(tmp_path / "enriched"))
    s = RiskStream(spark, str(tmp_path / "t"), AS_OF, emit_alerts=out[0], emit_enriched=out[1])
    s.process(payloads(spark, e(1, 10), e(2, 20)), 0)
    for name in ("alerts", "enriched"):
        got = spark.read.parquet(str(tmp_path / name)).collect()
        assert len(got) == 2 and all(json.loads(r.value) for r in got)


def test_rule_results_item_by_item(spark):
    good = '{"rule_name":"a","triggered":true,"score":0.5}'
    texts = [f"[{good},5]", good, f"[{good},null,\"x\",{{\"rule_name\":\"b\"}},{good}]", "[]", "{oops", None, "[[1]]"]
    d = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "id int, t string")
    assert [r[0] for r in d.orderBy("id").select(F.size(normalize.rule_results(F.col("t")))).collect()] == [1, 0, 2, 0, 0, 0, 0]


def test_float_text(spark):
    values = {0.0001: "0.0001", -12345678.123: "-12345678.123", 1e7: "10000000.0", 0.00025: "0.00025", 5.0: "5.0", 123456789012.5: "123456789012.5"}
    d = spark.createDataFrame([(v,) for v in values], "v double")
    assert {r.v: r.t for r in d.select("v", float_text(F.col("v")).alias("t")).collect()} == values


def test_more_new_entities_than_a_page(spark):
    tx = spark.range(1000).select(F.concat(F.lit("A"), "id").alias("account_id"), F.lit(None).cast("string").alias("customer_id"))
    none = spark.createDataFrame([], "entity_id string, type string")
    assert features.seed_entities(tx, none).count() == 1000 and features.seed_entities(tx, none, 5).count() == 5


def test_missing_cost_centre_is_not_a_subtotal(spark):
    d = spark.createDataFrame([("MEALS", None, 1, "E"), ("MEALS", "C", 2, "E")], "category string, cost_center_code string, amount int, employee_id string")
    got = {(r.category, r.cost_center_code, r.level): r.n_expenses for r in features.expense_patterns(d).collect()}
    assert got == {("MEALS", None, 0): 1, ("MEALS", "C", 0): 1, ("MEALS", None, 1): 2, (None, None, 3): 2}


def test_rows_without_tenant_have_no_ordered_features(spark):
    d = spark.createDataFrame([(n, t, "A", f"2024-01-0{n + 1}", str(n), 900) for n, t in enumerate((None, 1, 1, None))],
                              "id long, tenant_id long, account_id string, tx_time string, tx_id string, risk_score int").withColumn("tx_time", F.col("tx_time").cast("timestamp"))
    assert sorted(r.consecutive_high_risk for r in features.high_risk_runs(d).collect()) == [1, 2]
    assert [r.consecutive_high_risk for r in features.consecutive_high_risk(d).collect()] == [2]
    assert features.running_risk_avg(d).count() == 2


def test_long_account_ids_keep_all_letters(spark):
    name = "x" * 3000
    m = spark.createDataFrame([(1, f"ACCOUNT:{name}", 1, 2, 0.5, 0.1)], "tenant_id long, node string, degree long, community_size long, pagerank double, avg_neighbor_risk double")
    tx = spark.createDataFrame([(1, 1, name)], "id long, tenant_id long, account_id string")
    assert graph.score_with_metrics(tx, m).first().graph_score is not None
