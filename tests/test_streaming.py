"""The stream must leave the same tables as the batch operators, whatever the order of arrival."""

import pytest
from pyspark.sql import functions as F

from riskloom.operators import features, normalize, scoring, validate
from riskloom.sources import events, testdata
from riskloom.sources.testdata import AS_OF
from riskloom.streaming.risk_stream import TX_SCHEMA, ProgressLog, RiskStream, live_totals, scored_stream


def rows(df, *cols):
    names = list(cols) or sorted(df.columns)
    return sorted(map(repr, df.select(*names).collect()))


@pytest.fixture(scope="module")
def payload_dir(spark, sf_dir, tmp_path_factory):
    """Payload files in shuffled order, every seventh event sent twice."""
    path = str(tmp_path_factory.mktemp("payloads") / "in")
    p = testdata.payloads(spark, sf_dir)
    replays = p.where(F.expr("event_id % 7 = 0"))
    p.unionByName(replays).repartition(5, F.xxhash64("value", F.rand(3))).select("value").write.text(path)
    return path


@pytest.fixture(scope="module")
def expected(spark, sf_dir):
    judged = validate.validate(events.decode_payloads(testdata.payloads(spark, sf_dir)), AS_OF)
    scored = scoring.score_transactions(normalize.transactions(validate.valid(judged))).cache()
    return judged, scored


@pytest.fixture(scope="module")
def stream(spark, payload_dir, tmp_path_factory):
    root = tmp_path_factory.mktemp("store")
    messages = []
    s = RiskStream(spark, str(root / "tables"), AS_OF, emit_alerts=lambda df, i: messages.append((i, df.count())))
    source = events.file_stream(spark, payload_dir, max_files=1)
    listener = ProgressLog()
    spark.streams.addListener(listener)
    s.start(source, str(root / "ckpt"), available_now=True).awaitTermination()
    spark.streams.removeListener(listener)
    s.messages = messages
    return s


def test_several_batches_ran(stream):
    assert stream.store.committed() >= 3
    assert len(stream.messages) == stream.store.committed() + 1


def test_transactions_equal_batch(stream, expected):
    _, scored = expected
    cols = ["id", *normalize.TX_COLUMNS]
    assert rows(stream.transactions(), *cols) == rows(scored, *cols)


def test_alerts_equal_batch(stream, expected):
    _, scored = expected
    cols = ["tenant_id", "transaction_id", "account_id", "risk_score", "severity", "rule_score", "ml_score", "graph_score", "triggered_rules", "graph_motifs"]
    assert rows(stream.alerts(), *cols) == rows(scoring.alert_records(scored), *cols)


def test_features_equal_batch(stream, expected):
    _, scored = expected
    alerts = scoring.alert_records(scored, F.col("tx_time"), F.col("id").alias("alert_id"))
    batch = features.entity_features(scored, alerts, AS_OF).drop("amount_last", "latest_risk_score", "consecutive_high_risk")
    ordered = features.latest_state(scored).select(*features.ACCOUNT, "amount_last", "latest_risk_score")
    batch = batch.join(ordered, features.ACCOUNT).join(features.consecutive_high_risk(scored), features.ACCOUNT)
    cols = [*features.ACCOUNT, *features.FEATURE_COLUMNS]
    same = [F.col(c).cast("string").alias(c) for c in cols]
    assert rows(stream.features().select(*same)) == rows(batch.select(*same))


def test_rejects_keep_every_bad_payload(stream, expected):
    judged, _ = expected
    want = validate.rejected(judged, as_of=AS_OF).where(F.col("rejection_code").isNotNull())
    got = stream.rejects().select("rejection_code", "raw_payload").distinct()
    assert rows(got) == rows(want.select("rejection_code", "raw_payload").distinct())


def test_metrics_add_up(stream, expected):
    judged, scored = expected
    m = stream.metrics
    assert m.tx_inserted == scored.count() and m.tx_updated == 0
    replayed = scored.where(F.expr("id % 7 = 0")).count()
    assert 0 <= m.tx_unchanged <= replayed


def test_a_new_checkpoint_replays_everything_and_changes_nothing(spark, stream, payload_dir, tmp_path):
    before = {t: rows(getattr(stream, t)()) for t in ("transactions", "features")}
    n_alerts, last = stream.alerts().count(), stream.store.committed()
    again = RiskStream(spark, stream.store.root, AS_OF)
    counted = stream.metrics
    again.start(events.file_stream(spark, payload_dir), str(tmp_path / "ckpt"), available_now=True).awaitTermination()
    m = again.metrics  # goes on from what the store has counted
    assert (m.tx_inserted, m.tx_updated) == (counted.tx_inserted, 0) and m.tx_unchanged > counted.tx_unchanged
    assert again.store.committed() == last + 1
    assert {t: rows(getattr(again, t)()) for t in ("transactions", "features")} == before
    assert again.alerts().count() == n_alerts
    assert set(again.store.query_progress().values()) == {last, 0}


def test_committed_batch_is_not_run_again(spark, tmp_path):
    one = _payloads(spark, {"transaction_id": 1, "account_id": "A", "amount": 5, "timestamp": "2024-01-02"})
    two = _payloads(spark, {"transaction_id": 2, "account_id": "A", "amount": 5, "timestamp": "2024-01-03"})
    RiskStream(spark, str(tmp_path), AS_OF).process(one, 0)
    s = RiskStream(spark, str(tmp_path), AS_OF)
    s.process(two, 0)
    assert s.store.committed() == 0 and s.transactions().count() == 1
    s.process(two, 1)
    assert s.store.committed() == 1 and s.transactions().count() == 2


def _payloads(spark, *events_):
    import json

    base = {"event_version": "v1", "tenant_id": 1, "currency": "MYR", "direction": "DEBIT", "status": "BOOKED"}
    return spark.createDataFrame([(json.dumps({**base, "transaction_reference": f"R{e['transaction_id']}", **e}),) for e in events_], "value string")


def test_corrections_and_late_rows_are_exact(spark, tmp_path):
    s = RiskStream(spark, str(tmp_path), AS_OF)

    def e(i, account, amount, day, hour=12):
        return {"transaction_id": i, "account_id": account, "amount": amount, "timestamp": f"2024-01-{day:02d}T{hour:02d}:00:00"}

    s.process(_payloads(spark, e(1, "A", 50000, 2), e(2, "A", 60000, 3), e(3, "B", 10, 3)), 0)
    assert {r.account_id: (r.n, r.run) for r in s.account_summaries().collect()} == {"A": (2, 2), "B": (1, 0)}
    # An older low-risk row arrives late, another account gets a newer one.
    s.process(_payloads(spark, e(4, "A", 10, 1), e(5, "B", 70000, 4)), 1)
    assert {r.account_id: (r.n, r.run) for r in s.account_summaries().collect()} == {"A": (3, 2), "B": (2, 1)}
    assert s.metrics.days_recomputed == 0  # another day of A, so nothing of A is read
    # A correction lowers one amount and moves one transaction to another account.
    s.process(_payloads(spark, e(2, "A", 20, 3), e(3, "C", 10, 3)), 2)
    got = {r.account_id: (r.n, r.run, float(r.amount_total), r.amount_last and float(r.amount_last)) for r in s.account_summaries().collect()}
    assert got == {"A": (3, 0, 50030.0, 20.0), "B": (1, 1, 70000.0, 70000.0), "C": (1, 0, 10.0, 10.0)}
    assert s.metrics.tx_updated == 2
    assert s.metrics.days_recomputed == 3  # A, and B and C, each on the third
    # Another correction empties account C; a later transaction starts it afresh.
    s.process(_payloads(spark, e(3, "B", 10, 3)), 3)
    assert {r.account_id: r.n for r in s.account_summaries().collect()} == {"A": 3, "B": 2}
    assert s.features().count() == 2
    s.process(_payloads(spark, e(8, "C", 40, 8)), 4)
    c = s.account_summaries().where("account_id = 'C'").first()
    assert (c.n, str(c.first_seen_at), float(c.amount_total)) == (1, "2024-01-08 12:00:00", 40.0)
    # Compaction changes nothing.
    before = rows(s.transactions())
    s.store.compact("transactions", TX_SCHEMA, ["tenant_id", "tx_id"])
    assert rows(s.transactions()) == before
    s.process(_payloads(spark, e(9, "C", 5, 9)), 5)
    assert s.transactions().count() == len(before) + 1


def test_uncommitted_batch_is_invisible(spark, tmp_path):
    s = RiskStream(spark, str(tmp_path), AS_OF)
    s.process(_payloads(spark, {"transaction_id": 1, "account_id": "A", "amount": 5, "timestamp": "2024-01-02"}), 0)
    s.store.write("transactions", s.store._load("transactions", TX_SCHEMA).drop("batch_id"), 1)
    assert s.transactions().count() == 1 and s.store.committed() == 0


def pruned_scans(df, part):
    """The scans of a plan that leave out folders by ``part``."""
    old = df.sparkSession.conf.get("spark.sql.adaptive.enabled")
    df.sparkSession.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = df._jdf.queryExecution().executedPlan().toString()
    finally:
        df.sparkSession.conf.set("spark.sql.adaptive.enabled", old)
    return [x for x in text.splitlines() if "FileScan" in x and "PartitionFilters: [" in x and f"{part}#" in x.split("PartitionFilters: [")[1].split("]")[0]]


def test_lookups_read_the_folders_of_their_keys(spark, tmp_path):
    """A batch's keys pick slices of the base, late rows pick days; other folders are not read at all."""
    s = RiskStream(spark, str(tmp_path), AS_OF, fold_every=1, slices=8)
    first = [{"transaction_id": i, "account_id": f"A{i % 3}", "amount": 5 + i, "timestamp": f"2024-01-{1 + i % 20:02d}T12:00:00"} for i in range(1, 61)]
    s.process(_payloads(spark, *first), 0)
    base = tmp_path / "transactions_base" / "batch_id=0"
    assert len(list(base.glob("slice=*"))) == 8 and len(list((tmp_path / "account_rows_base" / "batch_id=0").glob("day=*"))) == 20
    newest = spark.createDataFrame([(1, "7")], "tenant_id long, tx_id string").selectExpr("*", "CAST(pmod(xxhash64(tenant_id, tx_id), 8) AS INT) AS slice")
    wanted = newest.first().slice
    found = s.stored_versions(newest, [wanted])
    scans = pruned_scans(found, "slice")
    assert scans and all(f"({wanted})" in x or f"= {wanted}" in x for x in scans)
    assert [float(r.amount) for r in found.collect()] == [12.0]
    # With every other folder gone the answer is the same.
    for folder in base.glob("slice=*"):
        if folder.name != f"slice={wanted}":
            for f in folder.iterdir():
                f.unlink()
    assert [float(r.amount) for r in s.stored_versions(newest, [wanted]).collect()] == [12.0]
    # A late row of one day needs that day only: the rows of the others are gone.
    for folder in (tmp_path / "account_rows_base" / "batch_id=0").glob("day=*"):
        if folder.name != "day=2024-01-03":
            for f in folder.iterdir():
                f.unlink()
    s2 = RiskStream(spark, str(tmp_path), AS_OF, fold_every=0, slices=8)
    s2.process(_payloads(spark, {"transaction_id": 900, "account_id": "A2", "amount": 70000, "timestamp": "2024-01-03T01:00:00"}), 1)
    assert s2.metrics.days_recomputed == 1
    day = {(r.account_id, str(r.day)): (r.n, r.run, float(r.amount_total)) for r in s2.account_days().collect()}
    # Transactions 2, 22 and 42 fall on the third, 2 of A2.
    assert day["A2", "2024-01-03"] == (2, 0, 70007.0) and len(day) == 60 and day["A1", "2024-01-03"][0] == 1


def test_counters_survive_restart_and_retry(spark, tmp_path, monkeypatch):
    e = lambda i, **m: {"transaction_id": i, "account_id": "A", "amount": 5, "timestamp": "2024-01-02", **m}
    s = RiskStream(spark, str(tmp_path), AS_OF)
    s.process(_payloads(spark, e(1), e(2), e(3, amount=-1)), 0)
    commit = s.store.commit
    monkeypatch.setattr(s.store, "commit", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        s.process(_payloads(spark, e(4)), 1)
    monkeypatch.setattr(s.store, "commit", commit)
    assert (s.metrics.processed, s.metrics.errors) == (2, 1)
    again = RiskStream(spark, str(tmp_path), AS_OF)
    again.process(_payloads(spark, e(4), e(1, amount=6)), 1)
    m = again.metrics
    assert (m.processed, m.rejected, m.errors) == (4, 1, 1)
    assert (m.tx_inserted, m.tx_updated, m.alerts_inserted) == (3, 1, 3)
    assert m.features_upserted >= 2 and m.rate(0)["errors"] == 1


def test_messages_are_sent_after_the_commit(spark, tmp_path, monkeypatch):
    sent = []
    e = lambda i: {"transaction_id": i, "account_id": "A", "amount": 5, "timestamp": "2024-01-02"}

    def stream():
        take = lambda kind: lambda df, n: sent.append((kind, n, sorted(r.key for r in df.collect())))
        return RiskStream(spark, str(tmp_path), AS_OF, emit_alerts=take("alert"), emit_enriched=take("enriched"))

    s = stream()
    commit = s.store.commit
    monkeypatch.setattr(s.store, "commit", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        s.process(_payloads(spark, e(1)), 0)
    assert sent == []  # written, not committed: nothing goes out, not even later
    s = stream()
    s.process(_payloads(spark, e(2)), 0)
    assert sent == [("enriched", 0, ["R2"]), ("alert", 0, ["A"])]
    # Cut off between commit and sending: sent by the next start, once.
    monkeypatch.setattr(s, "publish", lambda: None)
    s.process(_payloads(spark, e(3)), 1)
    assert len(sent) == 2
    again = stream()
    again.publish()
    again.publish()
    assert sent[2:] == [("enriched", 1, ["R3"]), ("alert", 1, ["A"])]
    assert again.store.notes("published") == ["1"]


def test_enriched_events_have_the_declared_fields(spark, tmp_path):
    import json

    got = []
    vendors = spark.createDataFrame([(1, "V1", "HIGH", "US", 0.5)], "tenant_id long, vendor_code string, risk_level string, country_code string, vendor_risk_score double")
    e = {"transaction_id": 1, "account_id": "A", "amount": 5.5, "timestamp": "2024-01-02T03:04:05", "vendor_code": "V1", "direction": "DR", "status": "BOOKED"}
    for n, enrich in enumerate((None, lambda tx: features.enrich_vendor(tx, vendors, ["US"]))):
        s = RiskStream(spark, str(tmp_path / str(n)), AS_OF, enrich=enrich, emit_enriched=lambda df, _: got.extend(json.loads(r.value) for r in df.collect()))
        s.process(_payloads(spark, e), 0)
    plain, full = got
    assert list(plain) == normalize.ENRICHED_FIELDS == list(full)
    assert (plain["direction"], plain["status"], plain["amount"], plain["employee_id"], plain["vendor_risk_level"]) == ("DR", "BOOKED", 5.5, None, None)
    assert (full["vendor_risk_level"], full["vendor_country_code"], full["is_high_risk_country"]) == ("HIGH", "US", True)


def test_native_streams(spark, payload_dir, expected):
    _, scored = expected
    source = events.file_stream(spark, payload_dir)
    q = live_totals(scored_stream(source, AS_OF)).writeStream.format("memory").queryName("totals").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    # This form counts replays twice, so the accounts match and counts are at least those of the batch.
    batch = {(r.tenant_id, r.account_id): r["count"] for r in scored.groupBy(*features.ACCOUNT).count().collect()}
    live = {(r.tenant_id, r.account_id): r.tx_count_total for r in spark.table("totals").collect()}
    assert live.keys() == batch.keys() and all(live[k] >= batch[k] for k in batch)


def test_kafka_options():
    o = events.kafka_options("h:1", "t", max_per_trigger=10)
    assert o["subscribe"] == "t" and o["maxOffsetsPerTrigger"] == "10" and o["startingOffsets"] == "earliest"
