"""Account features as a native stateful stream: ``transformWithState`` on the RocksDB state store.

Two stateful steps. The first is keyed by transaction: it knows the last version of each and turns what arrives into
changes (a replay is none, a correction that moves a transaction also takes it out of its old place). The second is
keyed by account: it keeps a summary per day and the day's rows in chunks. Rows in order extend the summary of their
day; a late or corrected row has its own day summed up again and touches no other. Trailing counts come from whole
days plus the rows of the day that the window cuts, and timers send an account's row again when a transaction
leaves the window. What a micro-batch reads and writes follows its own rows, not the history.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from decimal import ROUND_HALF_UP, Decimal

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from riskloom.config import HIGH_RISK_THRESHOLD, VELOCITY_24H_THRESHOLD
from riskloom.operators.features import ACCOUNT, FEATURE_COLUMNS

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Rows of a day that are read and written together.
CHUNK_ROWS = 512
_MONEY, _LONG, _TEXT, _TIME = T.DecimalType(18, 2), T.LongType(), T.StringType(), T.TimestampType()


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


VERSION = _schema(account_id=_TEXT, tx_time=_TIME, amount=_MONEY, risk_score=_LONG)
CHANGE = _schema(
    tenant_id=_LONG, account_id=_TEXT, tx_id=_TEXT, tx_time=_TIME, amount=_MONEY, risk_score=_LONG, day=_TEXT, live=T.BooleanType()
)
DAY = _schema(
    n=_LONG, cents=_LONG, top=_LONG, score_total=_LONG, n_high=_LONG, run=_LONG, first_at=_LONG, last_at=_LONG, last_tx=_TEXT,
    last_cents=_LONG, last_score=_LONG, chunks=_LONG,
)
CHUNK = _schema(at=T.ArrayType(_LONG), tx=T.ArrayType(_TEXT), cents=T.ArrayType(_LONG), score=T.ArrayType(_LONG))
FEATURES = _schema(**{
    "tenant_id": _LONG, "account_id": _TEXT, "tx_count_total": _LONG, "tx_count_24h": _LONG, "tx_count_7d": _LONG, "amount_total": T.DecimalType(28, 2),
    "amount_avg": _MONEY, "amount_max": _MONEY, "amount_last": _MONEY, "latest_risk_score": _LONG, "risk_score_avg": T.DecimalType(6, 2),
    "high_risk_tx_count": _LONG, "is_velocity_flagged": T.BooleanType(), "consecutive_high_risk": _LONG, "first_seen_at": _TIME,
    "last_seen_at": _TIME,
})
_EPOCH = dt.datetime(1970, 1, 1)
_DAY_US = 86_400_000_000


def micros(t) -> int:
    """Microseconds since 1970 in UTC, the zone of every job."""
    t = pd.Timestamp(t)
    t = t.tz_convert("UTC").tz_localize(None) if t.tzinfo else t
    return (t.to_pydatetime() - _EPOCH) // dt.timedelta(microseconds=1)


def moment(us: int) -> dt.datetime:
    return _EPOCH + dt.timedelta(microseconds=us)


def money(cents: int) -> Decimal:
    return Decimal(cents).scaleb(-2)


def rounded(total: int, n: int, unit: int = 1) -> Decimal:
    """total / n / unit to two places, halves up."""
    return (Decimal(total) / (n * unit)).quantize(Decimal("0.01"), ROUND_HALF_UP)


class LastVersions(StatefulProcessor):
    """Per transaction: what its last version was."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.known = handle.getValueState("known", VERSION)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        arrived = pd.concat(list(rows))
        newest = arrived.loc[arrived["arrival"].idxmax()]
        version = (newest.account_id, newest.tx_time.to_pydatetime(), newest.amount, int(newest.risk_score))
        before = self.known.get() if self.known.exists() else None
        if before is not None and (before[0], micros(before[1]), before[2], before[3]) == (version[0], micros(version[1]), *version[2:]):
            return
        out = []
        if before is not None:
            out.append((key[0], before[0], key[1], before[1], before[2], before[3], str(moment(micros(before[1])).date()), False))
        out.append((key[0], version[0], key[1], version[1], version[2], version[3], str(moment(micros(version[1])).date()), True))
        self.known.update(version)
        yield pd.DataFrame(out, columns=CHANGE.names)

    def close(self) -> None:
        pass


class AccountFeatures(StatefulProcessor):
    """Per account: summaries of its days, and the rows of each day in chunks."""

    def __init__(self, as_of: str | None):
        self.as_of = as_of

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.days = handle.getMapState("days", _schema(day=_TEXT), DAY)
        self.chunks = handle.getMapState("chunks", _schema(day=_TEXT, number=_LONG), CHUNK)

    # -------------------------------------------------------------- state of a day
    def _rows(self, day: str, chunks: int) -> list[tuple]:
        out = []
        for n in range(chunks):
            c = self.chunks.getValue((day, n))
            out += zip(c[0], c[1], c[2], c[3])
        return out

    def _keep(self, day: str, rows: list[tuple], first: int = 0) -> int:
        """Write rows as chunks from number ``first`` on; returns how many chunks there are then."""
        n = first
        for at in range(0, len(rows), CHUNK_ROWS):
            self.chunks.updateValue((day, n), tuple(list(x) for x in zip(*rows[at : at + CHUNK_ROWS])))
            n += 1
        return n

    @staticmethod
    def _extended(d: tuple | None, rows: list[tuple], chunks: int) -> tuple:
        """The summary with rows that all come after it."""
        n, cents, top, score, high, run, first, last, tx, last_cents, last_score = d[:11] if d else (0, 0, 0, 0, 0, 0, rows[0][0], 0, "", 0, 0)
        for at, name, c, s in rows:
            n, cents, top, score = n + 1, cents + c, max(top, c), score + s
            is_high = s >= HIGH_RISK_THRESHOLD
            high, run = high + is_high, run + 1 if is_high else 0
            last, tx, last_cents, last_score = at, name, c, s
        return n, cents, top, score, high, run, first, last, tx, last_cents, last_score, chunks

    def _change_day(self, day: str, gone: set[str], new: list[tuple]) -> None:
        d = self.days.getValue((day,)) if self.days.containsKey((day,)) else None
        chunks = d[11] if d else 0
        if not gone and (d is None or new[0][:2] > (d[7], d[8])):
            if chunks:  # fill the last chunk up first
                tail = self.chunks.getValue((day, chunks - 1))
                chunks = self._keep(day, [*zip(tail[0], tail[1], tail[2], tail[3]), *new], chunks - 1)
            else:
                chunks = self._keep(day, new)
            self.days.updateValue((day,), self._extended(d, new, chunks))
            return
        names = {r[1] for r in new} | gone
        rows = sorted([r for r in self._rows(day, chunks) if r[1] not in names] + new)
        now = self._keep(day, rows)
        for n in range(now, chunks):
            self.chunks.removeKey((day, n))
        if rows:
            self.days.updateValue((day,), self._extended(None, rows, now))
        elif d:
            self.days.removeKey((day,))

    # -------------------------------------------------------------- calls by Spark
    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        changes: dict[str, tuple[set[str], list[tuple]]] = {}
        for frame in rows:
            for r in frame.itertuples(index=False):
                gone, new = changes.setdefault(r.day, (set(), []))
                if r.live:
                    new.append((micros(r.tx_time), r.tx_id, int(r.amount.scaleb(2)), int(r.risk_score)))
                else:
                    gone.add(r.tx_id)
        for day, (gone, new) in changes.items():
            self._change_day(day, gone, sorted(new))
        yield from self._features(key, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._features(key, timerValues)

    def _since(self, days: dict[str, tuple], start: int) -> tuple[int, int | None]:
        """Transactions from ``start`` on, and the time of the first of them: whole days by their count, the day that
        ``start`` cuts by its rows."""
        cut = str(moment(start).date())
        later = [d for name, d in days.items() if name > cut]
        inside = sorted(r[0] for r in self._rows(cut, days[cut][11]) if r[0] >= start) if cut in days else []
        first = inside[0] if inside else min((d[6] for d in later), default=None)
        return len(inside) + sum(d[0] for d in later), first

    def _features(self, key, timerValues) -> Iterator[pd.DataFrame]:
        days = {k[0]: v for k, v in self.days.iterator()}
        now = micros(self.as_of) if self.as_of else timerValues.getCurrentProcessingTimeInMs() * 1000
        if not days:
            yield pd.DataFrame([(*key, 0, 0, 0, *[None] * 6, 0, False, 0, None, None)], columns=FEATURES.names)
            return
        order = [days[k] for k in sorted(days)]
        n, cents, score = (sum(d[i] for d in order) for i in (0, 1, 3))
        run = 0
        for d in order:
            run = run + d[5] if d[5] == d[0] else d[5]
        (n24, first24), (n7, first7) = self._since(days, now - _DAY_US), self._since(days, now - 7 * _DAY_US)
        last = order[-1]
        yield pd.DataFrame([(
            *key, n, n24, n7, money(cents), rounded(cents, n, 100), money(max(d[2] for d in order)), money(last[9]), last[10],
            rounded(score, n), sum(d[4] for d in order), n24 > VELOCITY_24H_THRESHOLD, run, moment(order[0][6]), moment(last[7]),
        )], columns=FEATURES.names)
        if not self.as_of:
            leaves = [t + w for t, w in ((first24, _DAY_US), (first7, 7 * _DAY_US)) if t is not None]
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
            if leaves:  # one timer: the next moment at which a count falls
                self.handle.registerTimer(max(min(leaves), now) // 1000 + 1)

    def close(self) -> None:
        pass


def use_rocksdb(spark: SparkSession) -> None:
    """State on local disk with snapshots and change logs in the query's checkpoint; needed before the query starts."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def live_features(scored: DataFrame, as_of: str | None = None) -> DataFrame:
    """Feature rows of a stream of scored transactions, one for each account that a micro-batch changed.

    ``arrival`` (a number, as a topic's offset) says which version of a transaction is the last of its micro-batch;
    without it, the latest time. The newest row of an account is its current one; an account emptied by a correction has a count
    of 0. ``as_of`` fixes the moment that trailing counts look back from, else it is the time of processing, and timers
    send the account again when a count falls.
    """
    arrival = F.col("arrival") if "arrival" in scored.columns else F.unix_micros("tx_time")
    rows = scored.where(F.col("tenant_id").isNotNull()).select(
        "tenant_id", "tx_id", "account_id", "tx_time", "amount", F.col("risk_score").cast("bigint").alias("risk_score"),
        arrival.cast("bigint").alias("arrival"),
    )
    changes = rows.groupBy("tenant_id", "tx_id").transformWithStateInPandas(LastVersions(), CHANGE, "Append", "None")
    mode = "None" if as_of else "ProcessingTime"
    return changes.groupBy(*ACCOUNT).transformWithStateInPandas(AccountFeatures(as_of), FEATURES, "Append", mode).select(*ACCOUNT, *FEATURE_COLUMNS)
