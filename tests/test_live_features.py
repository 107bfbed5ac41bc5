"""The native stateful stream against the batch-store features, over several micro-batches and a restart."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from riskloom.operators import features
from riskloom.streaming import account_state, live_features

AS_OF = "2024-01-31 00:00:00"
SCHEMA = "tenant_id long, tx_id string, account_id string, tx_time timestamp, amount decimal(18,2), risk_score int, arrival long"
T0 = dt.datetime(2024, 1, 10)


def make_rows(n, seed):
    from decimal import Decimal

    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        account = "HOT" if i % 3 else f"A{rnd.randrange(5)}"
        at = T0 + dt.timedelta(hours=rnd.randrange(0, 21 * 24), microseconds=rnd.choice([0, 1]))
        rows.append((1 + i % 2, f"t{i:05d}", account, at, Decimal(rnd.randrange(100, 10**7)) / 100, rnd.randrange(300, 700), i))
    for k in range(n // 10):  # corrections: of the amount, the moment, the account; and plain replays
        t, x, a, at, m, s, _ = rows[rnd.randrange(n)]
        kind = k % 4
        rows.append((t, x, "A9" if kind == 2 else a, at + dt.timedelta(days=1) if kind == 1 else at, m + 1 if kind == 0 else m, 999 if kind == 0 else s, n + k))
    return rows


@pytest.fixture
def rocksdb(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(key)
    live_features.use_rocksdb(spark)
    yield
    spark.conf.set(key, old)


def expected(spark, rows):
    last = {}
    for r in sorted(rows, key=lambda r: r[-1]):
        last[r[:2]] = r
    current = spark.createDataFrame([*last.values()], SCHEMA)
    days = account_state.summarize(account_state.with_day(current))
    return account_state.features_of(account_state.fold(days), current, F.lit(AS_OF).cast("timestamp"))


def text(df):
    return {(r.tenant_id, r.account_id): r for r in df.select(*features.ACCOUNT, *[F.col(c).cast("string").alias(c) for c in features.FEATURE_COLUMNS]).collect()}


def test_live_features_equal_the_batch_form(spark, tmp_path, rocksdb, monkeypatch):
    monkeypatch.setattr(live_features, "CHUNK_ROWS", 7)
    rows = make_rows(240, 4)
    for n in range(4):  # in order of arrival, so corrections come late and cross batches
        part = rows[n * len(rows) // 4 : (n + 1) * len(rows) // 4]
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "in" / f"part{n}"))
    source = lambda: spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    seen = []

    def keep(df, n):
        seen.append(n)
        df.withColumn("n", F.lit(n)).write.mode("append").parquet(str(tmp_path / "out"))

    def run():
        live_features.live_features(source(), AS_OF).writeStream.foreachBatch(keep).option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start().awaitTermination()

    def newest():
        out = spark.read.parquet(str(tmp_path / "out"))
        return out.groupBy(*features.ACCOUNT).agg(F.max_by(F.struct(*features.FEATURE_COLUMNS), "n").alias("f")).select(*features.ACCOUNT, "f.*").where("tx_count_total > 0")

    run()
    assert len(seen) >= 4
    assert text(newest()) == text(expected(spark, rows))
    # A new start from the checkpoint goes on with the same state.
    more = [(1, "t00001", "HOT", T0, rows[1][4], 650, 10_000), (1, "late", "HOT", T0 + dt.timedelta(days=2), rows[0][4], 100, 10_001), (2, "t00001", "A1", T0, rows[1][4], 1, 10_002)]
    spark.createDataFrame(more, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "in" / "part9"))
    run()
    assert text(newest()) == text(expected(spark, rows + more))


def test_days_are_changed_alone():
    """What a change reads and writes: chunks of its own day only."""

    class Map(dict):
        def __init__(self):
            super().__init__()
            self.read = []

        def getValue(self, k):
            self.read.append(k)
            return self[k]

        def containsKey(self, k):
            return k in self

        def updateValue(self, k, v):
            self[k] = v

        def removeKey(self, k):
            del self[k]

    p = live_features.AccountFeatures(AS_OF)
    p.days, p.chunks = Map(), Map()
    for d in range(1, 30):
        p._change_day(f"2024-01-{d:02d}", set(), [(d * 10**9 + i, f"{d}-{i}", 5, 600) for i in range(live_features.CHUNK_ROWS + 3)])
    p.chunks.read.clear()
    p._change_day("2024-01-07", set(), [(8 * 10**9, "x", 5, 1)])  # in order: only the last chunk is read
    assert p.chunks.read == [("2024-01-07", 1)] and p.days["2024-01-07",][5] == 0
    p.chunks.read.clear()
    p._change_day("2024-01-07", {"7-2"}, [])  # taken out: the day's chunks, no others
    assert {k[0] for k in p.chunks.read} == {"2024-01-07"} and p.days["2024-01-07",][0] == live_features.CHUNK_ROWS + 3
    p._change_day("2024-01-07", {f"7-{i}" for i in range(600)} | {"x"}, [])
    assert ("2024-01-07",) not in p.days and not [k for k in p.chunks if k[0] == "2024-01-07"]
