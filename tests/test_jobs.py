"""Daily job, synthetic events, models, readers and joins."""

import datetime as dt

import pytest
import synthetic
from pyspark.sql import functions as F

from riskloom.config import ML_FEATURES
from riskloom.operators import features, joins, normalize, quality, scoring, serving, training, upsert, validate
from riskloom.plans import daily_batch
from riskloom.plans.views import views
from riskloom.sources import events
from riskloom.sources.tables import read_table
from riskloom.sources.testdata import AS_OF


def test_date_range():
    today = dt.date(2026, 3, 17)
    assert daily_batch.date_range(today, days=7) == (dt.date(2026, 3, 11), today)
    assert daily_batch.date_range(today) == (dt.date(2025, 1, 1), today)
    start, end = daily_batch.date_range(today, 7, "2026-01-01", "2026-03-17")
    assert (end - start).days + 1 == 76


def test_high_risk_threshold(spark):
    tx = spark.createDataFrame([(1, 1, "A"), (2, 1, "A")], "id long, tenant_id long, account_id string")
    al = spark.createDataFrame([(1, 1, 1, 500, None), (2, 1, 2, 499, None)], "alert_id long, tenant_id long, transaction_id long, risk_score int, scored_at timestamp")
    assert features.alert_agg(tx, al).first().high_risk_tx_count == 1


def test_daily_job_is_rerunnable(spark, sf_dir, tmp_path):
    v = views(spark, sf_dir)
    args = (v.tx, v.alerts, v.entities, str(tmp_path), dt.date(2024, 1, 1), dt.date(2024, 1, 31), AS_OF)
    store = daily_batch.run(spark, *args)
    top, extent = daily_batch.report(spark, store)
    first = (sorted(map(repr, top.collect())), extent.first())
    daily_batch.run(spark, *args)
    top, extent = daily_batch.report(spark, store)
    assert (sorted(map(repr, top.collect())), extent.first()) == first
    assert extent.first().n_rows == features.daily_summary(v.tx, v.alerts, "2024-01-01", "2024-01-31").count()
    # A shorter rerun leaves the other dates alone.
    daily_batch.run(spark, v.tx, v.alerts, v.entities, str(tmp_path), dt.date(2024, 1, 5), dt.date(2024, 1, 6), AS_OF)
    assert daily_batch.report(spark, store)[1].first() == first[1]
    known = store.current("entity_features", daily_batch.FEATURE_SCHEMA, features.ACCOUNT)
    counts = daily_batch.dry_run(v.tx, v.entities, known, dt.date(2024, 1, 1), dt.date(2024, 1, 31))
    assert counts["entities"] == v.tx.select("account_id").distinct().count() and counts["daily_rows"] > 0


def test_synthetic_events(spark):
    now = F.lit("2024-06-15 12:00:00").cast("timestamp")
    a = synthetic.synthetic_events(spark, 20000, seed=3, as_of=now)
    b = synthetic.synthetic_events(spark, 20000, seed=3, as_of=now).repartition(3)
    assert a.exceptAll(b).count() == 0
    s = a.agg(
        F.count_distinct("account_id").alias("n"), F.avg((F.col("currency") == "MYR").cast("int")).alias("myr"),
        F.avg((F.col("direction") == "DEBIT").cast("int")).alias("debit"),
        F.avg(F.when(F.col("account_id") == "ACC-ENT-002", F.col("vendor_code").isNull().cast("int"))).alias("no_vendor"),
        F.avg(F.when(F.col("account_id") == "ACC-ENT-002", F.col("employee_id").isNull().cast("int"))).alias("no_employee"),
        F.avg(F.when(F.col("account_id") == "ACC-ENT-014", (F.col("amount") > 95000).cast("int"))).alias("burst"),
        F.max(F.when(F.col("account_id") == "ACC-ENT-003", F.col("vendor_code"))).alias("none"),
    ).first()
    assert s.n == 15 and s.none is None
    assert s.myr == pytest.approx(0.70, abs=0.02) and s.debit == pytest.approx(0.65, abs=0.02)
    assert s.no_vendor == pytest.approx(0.3, abs=0.04) and s.no_employee == pytest.approx(0.4, abs=0.04)
    assert s.burst == pytest.approx(0.3, abs=0.07)
    judged = validate.validate(events.decode_payloads(synthetic.as_payloads(a)), "2024-06-15 12:00:00")
    assert judged.where(F.col("rejection_code").isNotNull()).count() == 0


def test_classifier_learns_saves_and_predicts(spark, tmp_path):
    now = F.lit("2024-06-15 12:00:00").cast("timestamp")
    raw = events.with_payload(
        synthetic.synthetic_events(spark, 1500, as_of=now).select(*[F.col(c).cast("string") for c in ("event_version", "tenant_id", "transaction_id", "transaction_reference", "account_id", "amount", "currency", "direction", "status", "timestamp", "vendor_code", "employee_id")])
    )
    tx = normalize.transactions(validate.valid(validate.validate(raw, "2024-06-15 12:00:00")))
    f = scoring.ml_features(tx).withColumn("label", training.amount_label()).cache()
    train, test = training.stratified_split(f, "label", "id", 0.2, 42)
    assert train.count() + test.count() == f.count()
    for label in (0.0, 1.0):
        share = test.where(F.col("label") == label).count() / f.where(F.col("label") == label).count()
        assert share == pytest.approx(0.2, abs=0.07)
    model, auc = training.train_classifier(f, settings=training.BoostingSettings(rounds=5))
    assert auc > 0.95
    training.save_model(model, str(tmp_path / "m"))
    loaded = training.load_model(str(tmp_path / "m"))
    assert loaded.stages[0].getInputCols() == ML_FEATURES
    got = training.predict(f.drop("vendor_risk_level_num"), loaded).select("xgb_score", "ae_score", "ml_score", "amount_raw").collect()
    assert all(r.ml_score == int(r.xgb_score * 999) and r.ae_score == r.xgb_score / 2 for r in got)
    assert min(r.xgb_score for r in got if r.amount_raw > 20000) > max(r.xgb_score for r in got if r.amount_raw < 5000)


def test_lookup_join_beyond_the_bound_equals_broadcast(spark):
    left = spark.range(2000).select("id", F.when(F.col("id") % 3 > 0, F.concat(F.lit("V"), (F.col("id") % 7).cast("string"))).alias("k"))
    right = spark.range(5).select(F.concat(F.lit("V"), F.col("id").cast("string")).alias("k"), F.col("id").alias("x"))
    a = joins.lookup_join(left, right, ["k"], "id")
    b = joins.lookup_join(left, right, ["k"], "id", max_bytes=3)
    assert "BroadcastHashJoin" in a._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(repr, a.select("id", "k", "x").collect())) == sorted(map(repr, b.select("id", "k", "x").collect()))
    assert b.count() == 2000


def test_broadcast_is_chosen_without_a_job(spark, sf_dir, tmp_path):
    v = views(spark, sf_dir)
    v.vendors.write.parquet(str(tmp_path / "vendors"))
    spark.range(3_000_000).select(F.lit(1).alias("tenant_id"), F.concat(F.lit("V"), "id").alias("vendor_code"), F.lit("US").alias("country_code"),
                                  F.lit("LOW").alias("risk_level"), F.rand(1).alias("vendor_risk_score")).write.parquet(str(tmp_path / "many"))
    tracker, tx = spark.sparkContext.statusTracker(), v.tx
    for name, broadcast in (("vendors", True), ("many", False)):
        vendors = read_table(spark, str(tmp_path / name))
        spark.sparkContext.setJobGroup(f"plan-{name}", "")
        joined = features.enrich_vendor(tx, vendors)
        assert not tracker.getJobIdsForGroup(f"plan-{name}")
        assert ("BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()) == broadcast
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
def test_salted_lookup_equals_plain_join(spark, how):
    left = spark.range(3000).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 11).alias("k"))
    right = spark.range(6).select(F.col("id").alias("k"), *([] if how == "left_semi" else [(F.col("id") * 2).alias("x")]))
    want = sorted(map(repr, left.join(right, ["k"], how).select("id", "k").collect()))
    for salts in (1, 8):
        got = joins.lookup_join(left, right, ["k"], "id", how, max_bytes=None, salts=salts)
        assert sorted(map(repr, got.select("id", "k").collect())) == want


def test_hot_key_is_split_by_adaptive_execution(spark):
    """A third of the rows share a key and the right side is an aggregation on that key."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, x in settings.items():
            spark.conf.set(k, x)
        left = spark.range(300000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).cast("long").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
        right = left.groupBy("k").agg(F.count("*").alias("n"))
        df = joins.lookup_join(left.repartition(8), right, ["k"], "id", max_bytes=None)
        df.write.format("noop").mode("overwrite").save()
        assert df.groupBy("n").count().agg(F.sum("count")).first()[0] == 300000
        df.collect()
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, x in old.items():
            spark.conf.unset(k) if x is None else spark.conf.set(k, x)


def test_page_limits(spark):
    df = spark.range(1000).select(F.col("id").alias("alert_id"), F.lit(1).alias("risk_score"), F.lit(None).cast("timestamp").alias("scored_at"), F.lit("LOW").alias("severity"))
    assert [r.alert_id for r in serving.list_alerts(df, limit=3, offset=2).collect()] == [997, 996, 995]
    for bad in ({"limit": 0}, {"limit": 501}, {"offset": -1}):
        with pytest.raises(ValueError):
            serving.list_alerts(df, **bad)
    assert "TakeOrderedAndProject" in serving.list_alerts(df)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("descending", [True, False])
def test_seek_paging_equals_offset_paging(spark, descending):
    """Ties, nulls and equal moments at page ends."""
    rows = [(i, [None, 5, 5, 7][i % 4], dt.datetime(2024, 1, 1 + i % 3) if i % 5 else None) for i in range(120)]
    df = spark.createDataFrame(rows, "alert_id long, risk_score int, scored_at timestamp").withColumn("severity", F.lit("LOW"))
    order = [("scored_at", descending), ("alert_id", False)]
    for listed, by in ((serving.list_alerts, serving.ALERT_ORDER), (lambda d, **k: serving.sorted_alerts(d, "scored_at", descending, **k), order)):
        token, seen = None, []
        for n in range(9):
            rows_ = listed(df, limit=14, after=token).collect()
            assert rows_ == listed(df, limit=14, offset=14 * n).collect()
            seen += rows_
            token = serving.page_token(rows_[-1], by) if rows_ else token
        assert len(seen) == 120
    with pytest.raises(ValueError):
        serving.list_alerts(df, after="[1]")
    with pytest.raises(ValueError):
        serving.list_alerts(df, after=token, offset=3)


def test_seek_reaches_the_scan(spark, sf_dir, tmp_path):
    views(spark, sf_dir).tx.write.parquet(str(tmp_path / "tx"))
    tx = read_table(spark, str(tmp_path / "tx"))
    last = serving.list_transactions(tx, limit=5).collect()[-1]
    plan = serving.list_transactions(tx, after=serving.page_token(last, serving.TX_ORDER))._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject(limit=100" in plan and "LessThanOrEqual(tx_time" in plan


def test_filters_reach_the_scan(spark, tmp_path, sf_dir):
    views(spark, sf_dir).tx.write.parquet(str(tmp_path / "tx"))
    tx = read_table(spark, str(tmp_path / "tx"))
    plan = serving.list_transactions(tx, account_id="ACC-0", min_time="2024-01-05")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(account_id,ACC-0)" in plan and "GreaterThanOrEqual(tx_time" in plan
    daily = features.in_utc_dates(tx, "2024-01-01", "2024-01-02").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(tx_time" in daily and "LessThan(tx_time" in daily


def test_readers(spark, tmp_path):
    df = spark.range(3)
    for fmt in ("parquet", "orc", "json"):
        df.write.format(fmt).save(str(tmp_path / fmt))
        assert read_table(spark, str(tmp_path / fmt), fmt).count() == 3
    df.write.option("header", "true").csv(str(tmp_path / "csv"))
    assert read_table(spark, str(tmp_path / "csv"), "csv", "id long", header="true").count() == 3
    with pytest.raises(ValueError):
        read_table(spark, "t", "jdbc", url="x")


def test_keep_first_and_upsert(spark):
    df = spark.createDataFrame([(3, "a", 1), (1, "a", 2), (2, None, 3), (4, None, 4)], "id long, k string, v int")
    assert {(r.id, r.k) for r in quality.keep_first(df, ["k"]).collect()} == {(1, "a"), (2, None), (4, None)}
    new = spark.createDataFrame([("a", 9, 1), ("a", 8, 2), ("b", 7, 1)], "k string, v int, at int")
    old = spark.createDataFrame([("a", 1, 0), ("c", 2, 9)], "k string, v int, at int")
    got = {r.k: (r.v, r.change) for r in upsert.upsert(old, new, ["k"], ["at"]).collect()}
    assert got == {"a": (8, "updated"), "b": (7, "inserted"), "c": (2, "kept")}
    # Running the same upsert on its own result changes nothing more.
    again = upsert.upsert(upsert.upsert(old, new, ["k"], ["at"]).drop("change"), new, ["k"], ["at"])
    assert {r.k: r.v for r in again.collect()} == {"a": 8, "b": 7, "c": 2}
