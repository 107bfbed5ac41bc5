"""Bucketed sequence operators against brute force, with one hot account and many equal times."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from riskloom.operators import features, sequences

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    out = []
    for i in range(1500):
        account = "HOT" if i % 3 else f"A{rng.randrange(6)}"
        seconds = rng.choice([rng.randrange(0, 20 * 86400), rng.randrange(0, 40) * 3600, rng.randrange(0, 20) * 86400])
        out.append((i, 1, account, T0 + dt.timedelta(seconds=seconds, microseconds=rng.choice([0, 0, 1])), f"{i:05d}", rng.randrange(1, 6) * 100, rng.randrange(300, 700)))
    return out


@pytest.fixture(scope="module")
def tx(spark, rows):
    df = spark.createDataFrame(rows, "id long, tenant_id long, account_id string, tx_time timestamp, tx_id string, amount int, risk_score int")
    return df.withColumn("amount", F.col("amount").cast("decimal(18,2)")).cache()


def by_account(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r[2], r[3], r[4])):
        out.setdefault(r[2], []).append(r)
    return out


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_running_totals(tx, rows, partitions):
    got = sequences.running_totals(
        tx, features.ACCOUNT, ["tx_time", "tx_id"], {"s": F.col("risk_score"), "k": F.lit(1)}, partitions
    )
    got = {r.id: (r.s, r.k) for r in got.collect()}
    for group in by_account(rows).values():
        s = 0
        for k, r in enumerate(group, 1):
            s += r[6]
            assert got[r[0]] == (s, k)
    assert len(got) == len(rows)


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_run_lengths(tx, rows, partitions):
    got = sequences.run_lengths(tx, features.ACCOUNT, ["tx_time", "tx_id"], F.col("risk_score") >= 500, partitions=partitions)
    got = {r.id: r.run_length for r in got.collect()}
    for group in by_account(rows).values():
        run = 0
        for r in group:
            run = run + 1 if r[6] >= 500 else 0
            assert got[r[0]] == run


def test_long_runs_cross_buckets(spark):
    data = [(i, 1, "A", T0 + dt.timedelta(hours=3 * i), f"{i:05d}", 900 if i > 4 else 100) for i in range(40)]
    df = spark.createDataFrame(data, "id long, tenant_id long, account_id string, tx_time timestamp, tx_id string, risk_score int")
    got = sequences.run_lengths(df, features.ACCOUNT, ["tx_time", "tx_id"], F.col("risk_score") >= 500, partitions=5)
    assert [r.run_length for r in got.orderBy("id").collect()] == [0] * 5 + list(range(1, 36))
    cur = features.consecutive_high_risk(df).first()
    assert cur.consecutive_high_risk == 35


def test_current_run(tx, rows):
    got = {r.account_id: r.consecutive_high_risk for r in features.consecutive_high_risk(tx).collect()}
    for account, group in by_account(rows).items():
        run = 0
        for r in group:
            run = run + 1 if r[6] >= 500 else 0
        assert got[account] == run


@pytest.mark.parametrize("partitions", [1, 4, 16])
def test_rolling_sums(tx, rows, partitions):
    got = sequences.rolling_sums(
        tx.select("id", *features.ACCOUNT, "tx_time", "amount"), features.ACCOUNT, "tx_time", "amount",
        {"24h": "24 HOURS", "7d": "7 DAYS"}, partitions,
    )
    got = {r.id: (r.count_24h, float(r.sum_24h), r.count_7d, float(r.sum_7d)) for r in got.collect()}
    for group in by_account(rows).values():
        for r in group:
            want = []
            for width in (dt.timedelta(hours=24), dt.timedelta(days=7)):
                inside = [q[5] for q in group if r[3] - width <= q[3] <= r[3]]
                want += [len(inside), float(sum(inside))]
            assert got[r[0]] == tuple(want)
    assert len(got) == len(rows)


@pytest.mark.parametrize("minutes", [1, 60, 2880])
def test_tx_duplicates(tx, rows, minutes):
    got = {r.id for r in features.tx_duplicates(tx, minutes).collect()}
    want = set()
    for group in by_account(rows).values():
        for amount in {r[5] for r in group}:
            same = [r for r in group if r[5] == amount]
            for a, b in zip(same, same[1:]):
                if (b[3].replace(microsecond=0) - a[3].replace(microsecond=0)).total_seconds() <= minutes * 60:
                    want.add(b[0])
    assert got == want


@pytest.mark.parametrize("partitions", [2, 7, 40])
def test_every_row_after_the_first_partition_continues(spark, partitions):
    """Whole partitions of one key, with and without misses, pass their totals on."""
    data = [(i, 1, "A" if i < 300 else "B", i % 290 != 289) for i in range(400)]
    df = spark.createDataFrame(data, "id long, tenant_id long, account_id string, high boolean")
    got = sequences.prefix_scan(df, features.ACCOUNT, ["id"], {"n": F.lit(1), "v": F.col("id")}, {"run": F.col("high")}, partitions)
    n, v, run = {}, {}, {}
    want = []
    for i, _, a, high in data:
        n[a], v[a], run[a] = n.get(a, 0) + 1, v.get(a, 0) + i, run.get(a, 0) + 1 if high else 0
        want.append((i, n[a], v[a], run[a]))
    assert [(r.id, r.n, r.v, r.run) for r in got.orderBy("id").collect()] == want


def test_an_account_on_one_instant_is_split(spark):
    df = spark.range(20_000).select(
        "id", F.lit(1).cast("long").alias("tenant_id"), F.lit("A").alias("account_id"), F.lit(T0).alias("tx_time"),
        F.format_string("%06d", "id").alias("tx_id"), F.lit(1).cast("decimal(18,2)").alias("amount"),
    )
    sizes = [r["count"] for r in sequences.ranged(df, features.ACCOUNT, ["tx_time", "tx_id"], 8).groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 5000
    totals = sequences.running_totals(df, features.ACCOUNT, ["tx_time", "tx_id"], {"n": F.lit(1)}, 8)
    assert totals.where("n <> id + 1").count() == 0
    rolled = features.rolling_velocity(df)
    assert {(r.count_24h, r.count_7d, float(r.sum_7d)) for r in rolled.select("count_24h", "count_7d", "sum_7d").distinct().collect()} == {(20_000, 20_000, 20_000.0)}


def test_null_keys_empty_tables_and_overflow(spark):
    schema = "id long, tenant_id long, account_id string, v long"
    df = spark.createDataFrame([(1, None, None, 5), (2, None, None, None), (3, 1, None, 7), (4, 1, "", 1)], schema)
    got = sequences.running_totals(df, features.ACCOUNT, ["id"], {"t": F.col("v")}, 3)
    assert {r.id: r.t for r in got.collect()} == {1: 5, 2: 5, 3: 7, 4: 1}
    assert sequences.running_totals(df.limit(0), features.ACCOUNT, ["id"], {"t": F.col("v")}).count() == 0
    big = spark.createDataFrame([(n, 1, "A", 2**61) for n in range(9)], schema)
    with pytest.raises(Exception, match="64 bits"):
        sequences.running_totals(big, features.ACCOUNT, ["id"], {"t": F.col("v")}, 1).count()


def test_rows_are_exchanged_once(tx):
    rows = tx.select("id", *features.ACCOUNT, "tx_time", "tx_id")
    plan = sequences.ranged(rows, features.ACCOUNT, ["tx_time", "tx_id"], 8)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "rangepartitioning(tenant_id" in plan


def test_velocity_threshold_is_strict(spark):
    def at(n, account):
        return [(i, 1, account, T0 + dt.timedelta(minutes=i)) for i in range(n)]

    df = spark.createDataFrame(at(20, "A") + at(21, "B"), "id long, tenant_id long, account_id string, tx_time timestamp")
    got = {r.account_id: r.is_velocity_flagged for r in features.velocity_flags(df, "2024-01-01 12:00:00").collect()}
    assert got == {"A": False, "B": True}
    assert {r.account_id for r in features.sliding_velocity(df).collect()} == {"B"}
