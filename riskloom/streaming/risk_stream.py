"""The scoring stream: decode, validate, normalise, score, store and emit, one micro-batch at a time."""

from __future__ import annotations

import datetime as dt
import json
import logging
import time
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import asdict, dataclass, fields

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from riskloom.config import FusionWeights
from riskloom.operators import normalize, scoring, validate
from riskloom.operators.features import ACCOUNT
from riskloom.operators.rules import POINT_RULES, PointRule
from riskloom.operators.upsert import latest_by_key
from riskloom.session import require_utc
from riskloom.sources.events import decode_payloads
from riskloom.streaming import account_state
from riskloom.streaming.store import BatchStore

log = logging.getLogger("riskloom.stream")

TX_KEY = ["tenant_id", "tx_id"]
ALERT_KEY = ["tenant_id", "transaction_id"]
_MONEY, _LONG, _TEXT, _TIME = T.DecimalType(18, 2), T.LongType(), T.StringType(), T.TimestampType()


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


TX_SCHEMA = _schema(
    id=_LONG, tenant_id=_LONG, tx_id=_TEXT, account_id=_TEXT, customer_id=_TEXT, invoice_id=_LONG, tx_time=_TIME,
    booking_time=_TIME, amount=_MONEY, currency=_TEXT, direction=_TEXT, status=_TEXT, country_code=_TEXT,
    merchant_category=_TEXT, channel=_TEXT, description=_TEXT, vendor_code=_TEXT, employee_id=_TEXT,
    risk_score=T.IntegerType(), change=_TEXT, slice=T.IntegerType(),
)
ALERT_SCHEMA = _schema(
    alert_id=_LONG, tenant_id=_LONG, transaction_id=_LONG, transaction_reference=_TEXT, account_id=_TEXT, vendor_code=_TEXT,
    employee_id=_TEXT, risk_score=T.IntegerType(), severity=_TEXT, rule_score=T.IntegerType(), ml_score=T.IntegerType(),
    graph_score=T.IntegerType(), triggered_rules=T.ArrayType(_TEXT), graph_motifs=_TEXT, rule_results_json=_TEXT,
    scored_at=_TIME,
)
REJECT_SCHEMA = _schema(
    pipeline_stage=_TEXT, rejection_code=_TEXT, rejection_reason=_TEXT, raw_payload=_TEXT, tenant_id=_LONG,
    event_id_text=_TEXT, account_id=_TEXT, amount=_MONEY, rejected_at=_TIME,
)
#: What account features need of a transaction, under the account and day it counts for; a transaction that left
#: for another account or day stays there as a row that is not ``live``.
ROW_SCHEMA = _schema(
    tenant_id=_LONG, account_id=_TEXT, day=T.DateType(), tx_id=_TEXT, tx_time=_TIME, amount=_MONEY, risk_score=T.IntegerType(),
    live=T.BooleanType(),
)
ROW_KEY = [*account_state.DAY, "tx_id"]
DAY_SCHEMA = _schema(
    tenant_id=_LONG, account_id=_TEXT, day=T.DateType(), n=_LONG, amount_total=T.DecimalType(28, 2), amount_max=_MONEY,
    score_total=_LONG, n_high=_LONG, run=_LONG, first_seen_at=_TIME, first_tx_id=_TEXT, last_seen_at=_TIME, last_tx_id=_TEXT,
    amount_last=_MONEY, latest_risk_score=_LONG,
)
_SUMMARY_TYPE = T.StructType([DAY_SCHEMA[c] for c in account_state.SUMMARY])
MESSAGE_SCHEMA = _schema(key=_TEXT, value=_TEXT)
#: Keyed tables: schema, key and the column that their base is partitioned by.
KEYED = {
    "transactions": (TX_SCHEMA, TX_KEY, "slice"), "alerts": (ALERT_SCHEMA, ALERT_KEY, None),
    "account_rows": (ROW_SCHEMA, ROW_KEY, "day"), "account_days": (DAY_SCHEMA, account_state.DAY, "day"),
}
#: Folders that the transactions of a store are dealt to by key. A lookup reads those of its batch's keys, so choose
#: as many as keep a folder within what a batch may read; a store keeps the number that it began with.
SLICES = 64
# What makes a replayed transaction differ from the stored one.
_CONTENT = ["account_id", "tx_time", "amount", "currency", "direction", "status", "vendor_code", "employee_id", "risk_score"]


@dataclass
class StreamMetrics:
    """Counters of all committed batches of a store, logged every ``log_every`` processed events.

    A batch's counts are part of its commit, so a retried batch counts once and a restarted stream goes on from
    where it was. ``errors`` are attempts at a batch that failed. ``days_recomputed`` are account days whose summary
    had to be taken from their transactions again.
    """

    processed: int = 0
    rejected: int = 0
    errors: int = 0
    tx_inserted: int = 0
    tx_updated: int = 0
    tx_unchanged: int = 0
    alerts_inserted: int = 0
    features_upserted: int = 0
    days_recomputed: int = 0

    def add(self, counts: dict[str, int]) -> None:
        for f in fields(self):
            setattr(self, f.name, getattr(self, f.name) + counts.get(f.name, 0))

    def rate(self, started: float) -> dict:
        elapsed = time.time() - started
        return {**asdict(self), "elapsed_seconds": round(elapsed, 1), "rate_per_sec": round(self.processed / max(elapsed, 1), 1)}


class ProgressLog(StreamingQueryListener):
    """Logs rows and rate of every trigger; add it with ``spark.streams.addListener``."""

    def onQueryStarted(self, event) -> None:
        log.info(json.dumps({"event": "stream_started", "id": str(event.id), "name": event.name}))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        log.info(json.dumps({
            "event": "stream_progress", "batch": p.batchId, "rows": p.numInputRows,
            "rows_per_second": round(p.processedRowsPerSecond or 0.0, 1),
        }))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        log.info(json.dumps({"event": "stream_terminated", "id": str(event.id), "error": event.exception}))


class RiskStream:
    """Writes transactions, alerts, rejects and account state of a payload stream to a batch store.

    ``as_of`` fixes the present moment for tests and backfills. ``emit_alerts`` receives each batch
    of alert messages (key, value) and its id; ``emit_enriched`` the enriched events. Messages are stored with
    their batch and sent after its commit: a batch that fails sends nothing, and one whose sending was cut off is
    sent again by the next batch or start, so a receiver sees each message at least once.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        as_of: str | None = None,
        rules: Sequence[PointRule] = POINT_RULES,
        weights: FusionWeights = FusionWeights(),
        enrich: Callable[[DataFrame], DataFrame] | None = None,
        emit_alerts: Callable[[DataFrame, int], None] | None = None,
        emit_enriched: Callable[[DataFrame, int], None] | None = None,
        log_every: int = 500,
        fold_every: int = 50,
        slices: int = SLICES,
    ):
        require_utc(spark)
        self.spark, self.as_of = spark, as_of
        self.store = BatchStore(spark, root, {t: part for t, (_, _, part) in KEYED.items() if part})
        self.rules, self.weights, self.enrich = rules, weights, enrich
        self.outbox = {"enriched_messages": emit_enriched, "alert_messages": emit_alerts}
        self._progress: dict[str, int] | None = None
        self.fold_every, self.slices = fold_every, slices
        self.metrics, self.log_every, self._started, self._logged = StreamMetrics(), log_every, time.time(), 0

    # ------------------------------------------------------------------ stored tables
    def _current(self, table: str, *more, **how) -> DataFrame:
        schema, keys, _ = KEYED[table]
        return self.store.current(table, schema, keys, *more, **how).drop("batch_id")

    def transactions(self) -> DataFrame:
        return self._current("transactions").drop("change", "slice")

    def alerts(self) -> DataFrame:
        return self._current("alerts")

    def rejects(self) -> DataFrame:
        return self.store.log("rejected_events", REJECT_SCHEMA)

    def account_days(self) -> DataFrame:
        """Summary of each account and day; one emptied by a correction is stored with a count of 0."""
        return self._current("account_days").where("n > 0")

    def account_summaries(self) -> DataFrame:
        return account_state.fold(self.account_days())

    def features(self, as_of: str | None = None) -> DataFrame:
        moment = validate.as_of_column(as_of or self.as_of)
        recent = F.col("day") >= F.to_date(moment - F.expr("INTERVAL '7' DAY"))
        rows = self._current("account_rows", where=recent).where("live")
        return account_state.features_of(self.account_summaries(), rows, moment)

    # ------------------------------------------------------------------ one micro-batch
    def process(self, batch: DataFrame, source_batch: int) -> None:
        """Handle one micro-batch; one that is already committed for this query is skipped.

        Stored batches are numbered by the store, so a query that starts over with a new checkpoint
        is read in full again: its replays are recognised by key, never by batch number.
        """
        query = self.spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct"
        if self._progress is None:
            known = self.store.committed() >= 0
            self._progress = self.store.query_progress() if known else {}
            self.metrics.add({**(self.store.counters() if known else {}), "errors": len(self.store.notes("failed"))})
        self.publish()
        if source_batch <= self._progress.get(query, -1):
            return
        last = self.store.committed()
        batch_id = last + 1
        now = self.as_of or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
        place = [c for c in batch.columns if c == "source_version"]
        arrival = F.struct(*place, F.monotonically_increasing_id().alias("row")).alias("arrival")
        payloads = batch.select(*[c for c in batch.columns if c not in place], arrival)
        judged = validate.validate(decode_payloads(payloads), now).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            counts = self._write_rejects(judged, batch_id, now) | self._write_valid(judged, batch_id, last, now)
            self.store.commit(batch_id, query, source_batch, counts)
        except Exception:
            self.metrics.errors += 1
            self.store.note("failed", f"{batch_id}-{uuid.uuid4().hex}")
            raise
        finally:
            judged.unpersist()
        self._progress[query] = source_batch
        self.metrics.add(counts)
        self.publish()
        if self.fold_every and (batch_id + 1) % self.fold_every == 0:
            for table, (schema, keys, _) in KEYED.items():
                self.store.compact(table, schema, keys)
        if self.metrics.processed - self._logged >= self.log_every:
            self._logged = self.metrics.processed
            log.info(json.dumps({"event": "stream_metrics", **self.metrics.rate(self._started)}))

    def publish(self) -> None:
        """Send the stored messages of committed batches that were not sent yet, batch by batch, and note it."""
        if not any(self.outbox.values()):
            return
        sent = [int(n) for n in self.store.notes("published")]
        for n in range(max(sent, default=-1) + 1, self.store.committed() + 1):
            for table, emit in self.outbox.items():
                messages = self.store.batch(table, MESSAGE_SCHEMA, n) if emit else None
                if messages is not None:
                    emit(messages, n)
            self.store.note("published", str(n))
            for before in sent:
                self.store.drop_note("published", str(before))
            for table in self.outbox:
                self.store.drop_batch(table, n)
            sent = [n]

    def _write_rejects(self, judged: DataFrame, batch_id: int, now: str) -> dict[str, int]:
        seen = Observation()
        rejects = validate.rejected(judged, as_of=now).observe(seen, F.count("*").alias("n"))
        self.store.write("rejected_events", rejects, batch_id)
        return {"rejected": seen.get["n"]}

    def _write_valid(self, judged: DataFrame, batch_id: int, last: int, now: str) -> dict[str, int]:
        tx = normalize.transactions(validate.valid(judged, "arrival"), "arrival")
        if self.enrich is not None:
            tx = self.enrich(tx)
        if self.outbox["enriched_messages"] is not None:
            self.store.write("enriched_messages", normalize.enriched_messages(tx), batch_id)
        scored = scoring.score_transactions(tx, self.rules, self.weights)
        # The last to arrive wins, inside a batch as across batches, so where batches are cut changes nothing.
        of_key = F.pmod(F.xxhash64(*TX_KEY), F.lit(self.slices)).cast("int").alias("slice")
        kept = latest_by_key(scored, TX_KEY, ["arrival"]).select("*", of_key, F.to_date("tx_time").alias("day"))
        seen = Observation()
        newest = self.store.stage("newest", kept.observe(seen, F.collect_set("slice").alias("slices")))
        stored = self.stored_versions(newest, seen.get["slices"], last)
        seen = Observation()
        kinds = ("inserted", "updated", "unchanged")
        marked = self._mark_changes(newest, stored).observe(
            seen, *[F.count_if(F.col("change") == k).alias(k) for k in kinds],
            F.collect_set("day").alias("days"), F.collect_set("_day_before").alias("days_before"),
        )
        changed = self.store.stage("changed", marked.drop("event_wall"))
        counts = seen.get
        days = {*counts.pop("days"), *counts.pop("days_before")}
        fresh = changed.where(F.col("change") != "unchanged")
        self.store.write("transactions", fresh.select(*TX_SCHEMA.names), batch_id)
        alerts = scoring.alert_records(fresh, F.lit(now).cast("timestamp"), scoring.alert_key())
        self.store.write("alerts", alerts.select(*ALERT_SCHEMA.names), batch_id)
        if self.outbox["alert_messages"] is not None:
            self.store.write("alert_messages", scoring.alert_messages(alerts, "account_id"), batch_id)
        touched = self._write_account_days(fresh, days, batch_id, last, any_updates=counts["updated"] > 0)
        return {
            "processed": sum(counts.values()), "alerts_inserted": counts["inserted"], **touched,
            **{f"tx_{k}": n for k, n in counts.items()},
        }

    def stored_versions(self, newest: DataFrame, slices: Iterable[int], last: int | None = None) -> DataFrame:
        """What the store has of the transactions in ``newest``: reads the slices that their keys fall into."""
        if self.store.committed() < 0:
            return self.spark.createDataFrame([], TX_SCHEMA).select(*TX_KEY, *_CONTENT)
        return self._current("transactions", last, columns=_CONTENT, among=newest, where=F.col("slice").isin(sorted(slices)))

    @staticmethod
    def _mark_changes(newest: DataFrame, stored: DataFrame) -> DataFrame:
        before = stored.select(
            *TX_KEY, F.struct(*_CONTENT).alias("_before"), F.col("account_id").alias("_account_before"),
            F.to_date("tx_time").alias("_day_before"),
        )
        content = F.struct(*_CONTENT)
        change = F.when(F.col("_before").isNull(), "inserted").when(content.eqNullSafe(F.col("_before")), "unchanged")
        return newest.join(before, TX_KEY, "left").withColumn("change", change.otherwise("updated")).drop("_before")

    def _write_account_days(self, fresh: DataFrame, days: Iterable[dt.date], batch_id: int, last: int, any_updates: bool) -> dict[str, int]:
        """Bring the summaries of the touched account days up to date.

        New transactions later than all known ones of their day extend its summary. A day with a late or a
        corrected transaction is summed up from its own rows again; no other day of the account is read.
        """
        keys, state = account_state.DAY, ["tx_time", "tx_id", "amount", "risk_score"]
        live = fresh.withColumn("live", F.lit(True))
        rows = live.select(*ROW_SCHEMA.names, "change")
        if any_updates:
            moved = live.where((F.col("change") == "updated") & (
                (F.col("account_id") != F.col("_account_before")) | (F.col("day") != F.col("_day_before"))
            ))
            gone = moved.withColumns({"account_id": F.col("_account_before"), "day": F.col("_day_before"), "live": F.lit(False)})
            rows = rows.unionByName(gone.select(*ROW_SCHEMA.names, "change"))
        self.store.write("account_rows", rows.select(*ROW_SCHEMA.names), batch_id)
        inserted = rows.where("change = 'inserted'").select(*keys, *state)
        only = F.col("day").isin(sorted(days))
        # One record per touched day: the first new transaction, and whether anything known of the day changed.
        new = F.col("change") == "inserted"
        touched = rows.groupBy(*keys).agg(
            F.min(F.when(new, F.struct("tx_time", "tx_id"))).alias("_first"), F.max(~new).alias("_again")
        )
        if last < 0:
            known = touched.select(*keys, F.lit(None).cast(_SUMMARY_TYPE).alias("e"), "_first", "_again")
        else:
            earlier = self._current("account_days", last, among=rows, where=only).where("n > 0")
            known = touched.join(earlier.select(*keys, F.struct(*account_state.SUMMARY).alias("e")), keys, "left")
        late = F.struct("e.last_seen_at", "e.last_tx_id") >= F.col("_first")
        stale = F.coalesce(F.col("_again") | (F.col("e").isNotNull() & late), F.lit(False))
        seen = Observation()
        known = self.store.stage("days", known.select(*keys, "e", stale.alias("stale")).observe(
            seen, F.count("*").alias("features_upserted"), F.count_if(F.col("stale")).alias("days_recomputed")
        ))
        counts = seen.get
        if counts["days_recomputed"]:
            again = known.where("stale").select(*keys)
            # The rows of these days as they stand with this batch, and the new rows of the others.
            history = self._current("account_rows", batch_id, among=again, where=only).where("live").select(*keys, *state)
            inserted = self.store.stage("rows", history.unionByName(inserted.join(again, keys, "left_anti")))
        kept = known.withColumn("e", F.when(~F.col("stale"), F.col("e")))
        self.store.write("account_days", account_state.merge(kept, account_state.summarize(inserted)).select(*DAY_SCHEMA.names), batch_id)
        return counts

    # ------------------------------------------------------------------ running
    def start(self, payloads: DataFrame, checkpoint: str, available_now: bool = False, every: str = "10 seconds") -> StreamingQuery:
        self.publish()
        writer = payloads.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)).start()


def live_totals(tx_stream: DataFrame) -> DataFrame:
    """Running totals per account as a native streaming aggregation (update mode).

    For feeds that deliver each transaction once; state is one row per account.
    """
    rank = F.struct("tx_time", "tx_id")
    return tx_stream.groupBy(*ACCOUNT).agg(
        F.count("*").alias("tx_count_total"), F.sum("amount").alias("amount_total"), F.max("amount").alias("amount_max"),
        F.max_by("amount", rank).alias("amount_last"), F.min("tx_time").alias("first_seen_at"),
        F.max("tx_time").alias("last_seen_at"),
    )


def scored_stream(payloads: DataFrame, as_of: str | None = None) -> DataFrame:
    """Payload stream to scored transactions, stateless, for any streaming sink."""
    judged = validate.validate(decode_payloads(payloads), as_of)
    return scoring.score_transactions(normalize.transactions(validate.valid(judged)))


def topic_writer(format_: str = "kafka", **options: str) -> Callable[[DataFrame, int], None]:
    """For ``emit_alerts`` and ``emit_enriched``: appends each batch of key/value messages to a topic, or to
    any other batch sink. A topic needs the Spark Kafka connector on the class path and the options
    ``kafka.bootstrap.servers`` and ``topic``; a repeated batch repeats its messages."""

    def write(messages: DataFrame, batch_id: int) -> None:
        rows = messages.selectExpr("CAST(key AS STRING)", "CAST(value AS STRING)")
        rows.write.format(format_).options(**options).mode("append").save()

    return write
