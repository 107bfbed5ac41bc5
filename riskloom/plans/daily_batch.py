"""Daily job: recompute entity features and daily summaries, then sync entity risk.

    python -m riskloom.plans.daily_batch --transactions T --alerts A --entities E --out O [--days 7]
"""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators import features, serving, upsert
from riskloom.session import build_session
from riskloom.sources.tables import read_table
from riskloom.streaming.risk_stream import RiskStream
from riskloom.streaming.store import BatchStore

FULL_HISTORY_FROM = dt.date(2025, 1, 1)
_MONEY, _LONG = T.DecimalType(18, 2), T.LongType()
FEATURE_SCHEMA = T.StructType([
    T.StructField(n, t) for n, t in {
        "tenant_id": _LONG, "account_id": T.StringType(), "tx_count_total": _LONG, "tx_count_24h": _LONG,
        "tx_count_7d": _LONG, "amount_total": _MONEY, "amount_avg": _MONEY, "amount_max": _MONEY, "amount_last": _MONEY,
        "latest_risk_score": _LONG, "risk_score_avg": T.DecimalType(6, 2), "high_risk_tx_count": _LONG,
        "is_velocity_flagged": T.BooleanType(), "consecutive_high_risk": _LONG, "first_seen_at": T.TimestampType(),
        "last_seen_at": T.TimestampType(),
    }.items()
])


SUMMARY_SCHEMA = T.StructType([
    T.StructField(n, t) for n, t in {
        "tenant_id": _LONG, "account_id": T.StringType(), "summary_date": T.DateType(), "tx_count": _LONG,
        "tx_count_debit": _LONG, "tx_count_credit": _LONG, "amount_total": _MONEY, "amount_avg": _MONEY,
        "amount_max": _MONEY, "amount_min": _MONEY, "risk_score_avg": T.DecimalType(6, 2), "risk_score_max": _LONG,
        "high_risk_tx_count": _LONG, "batch_run_at": T.TimestampType(),
    }.items()
])
RANGE_SCHEMA = T.StructType([T.StructField("first_date", T.DateType()), T.StructField("last_date", T.DateType())])


def daily_summaries(store: BatchStore) -> DataFrame:
    """Summaries of the last committed run that covered each date; a date it found empty has none."""
    covered = store.log("summary_ranges", RANGE_SCHEMA).select(
        F.explode(F.sequence("first_date", "last_date")).alias("summary_date"), "batch_id"
    )
    last = covered.groupBy("summary_date").agg(F.max("batch_id").alias("batch_id"))
    return store.log("entity_daily_summary", SUMMARY_SCHEMA).join(F.broadcast(last), ["summary_date", "batch_id"]).select(*SUMMARY_SCHEMA.names)


def apply_risk_changes(entities: DataFrame, changes: DataFrame) -> DataFrame:
    """The entity table with the changed risk scores."""
    new = changes.select("id", F.col("risk_score").alias("_new"))
    score = F.coalesce("_new", "risk_score").cast(entities.schema["risk_score"].dataType)
    return entities.join(new, "id", "left").withColumn("risk_score", score).select(*entities.columns)


def entities_of(store: BatchStore, source: DataFrame) -> DataFrame:
    """The entity table with the risk scores of the last committed run; before the first, as it is in the source."""
    known = store.batch("entities", T.StructType([source.schema["id"], source.schema["risk_score"]]), store.committed())
    if known is None:
        return source
    return apply_risk_changes(source, known)


def date_range(
    today: dt.date, days: int | None = None, from_date: str | None = None, to_date: str | None = None
) -> tuple[dt.date, dt.date]:
    """Inclusive range: an explicit start wins over ``days``; without both it is the full history."""
    end = dt.date.fromisoformat(to_date) if to_date else today
    if from_date:
        return dt.date.fromisoformat(from_date), end
    return (today - dt.timedelta(days=days - 1) if days else FULL_HISTORY_FROM), end


def dry_run(tx: DataFrame, entities: DataFrame, known: DataFrame, start: dt.date, end: dt.date) -> dict[str, int]:
    counts = features.dry_run_counts(tx, str(start), str(end)).first()
    changes = features.entity_risk_changes(entities, known, tenant_id=None).count()
    return {"entities": counts.n_entities, "daily_rows": counts.n_daily_rows, "risk_changes": changes}


def run(
    spark: SparkSession, tx: DataFrame, alerts: DataFrame, entities: DataFrame, out: str,
    start: dt.date, end: dt.date, as_of: str | None = None, tenant_id: int = 1, dedupe_alerts: bool = True,
) -> BatchStore:
    """Write the three outputs under ``out``; a rerun of the same range gives the same tables.

    All outputs go through the batch store and appear with its commit. Features keep the columns that the
    stream owns and become the new base; summaries replace every date of the range, empty ones too; the entity
    table is written anew with its changed scores (``entities_of``) next to the list of changes. Its version
    before stays for readers that began earlier.
    """
    store = BatchStore(spark, out)
    entities = entities_of(store, entities)
    run_id = store.committed() + 1
    known = store.current("entity_features", FEATURE_SCHEMA, features.ACCOUNT).drop("batch_id")
    fresh = features.entity_features(tx, alerts, as_of)
    merged = upsert.replace_columns(known, fresh, features.ACCOUNT, features.STREAM_OWNED)
    typed = merged.select(*[merged[f.name].cast(f.dataType).alias(f.name) for f in FEATURE_SCHEMA.fields])
    current = store.stage("entity_features", typed)
    store.write("entity_features", current, run_id)

    ran_at = F.lit(as_of).cast("timestamp") if as_of else F.current_timestamp()
    summary = features.daily_summary(tx, alerts, str(start), str(end), dedupe_alerts).withColumn("batch_run_at", ran_at)
    typed = summary.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SUMMARY_SCHEMA.fields])
    # Sorted files, so that readers of a date skip the others.
    store.write("entity_daily_summary", typed.repartitionByRange("summary_date", "account_id").sortWithinPartitions("summary_date"), run_id)
    store.write("summary_ranges", spark.createDataFrame([(start, end)], RANGE_SCHEMA), run_id)

    changes = store.stage("entity_risk_changes", features.entity_risk_changes(entities, current, tenant_id))
    store.write("entity_risk_changes", changes, run_id)
    store.write("entities", apply_risk_changes(entities, changes), run_id)
    store.commit(run_id)
    store.drop_batch("entities", run_id - 2)
    store.compact("entity_features", FEATURE_SCHEMA, features.ACCOUNT)
    return store


def report(spark: SparkSession, store: BatchStore) -> tuple[DataFrame, DataFrame]:
    """Top entities and the extent of the summaries after a run."""
    known = store.current("entity_features", FEATURE_SCHEMA, features.ACCOUNT)
    return serving.top_entities(known), features.summary_extent(daily_summaries(store))


def main(argv: Sequence[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    for name in ("entities", "out"):
        p.add_argument(f"--{name}", required=True)
    p.add_argument("--store", help="tables of the scoring stream, instead of --transactions and --alerts")
    p.add_argument("--transactions")
    p.add_argument("--alerts")
    p.add_argument("--format", default="parquet")
    p.add_argument("--days", type=int)
    p.add_argument("--from-date")
    p.add_argument("--to-date")
    p.add_argument("--dry-run", action="store_true")
    a = p.parse_args(argv)
    start, end = date_range(dt.datetime.now(dt.timezone.utc).date(), a.days, a.from_date, a.to_date)
    spark = build_session("riskloom-daily")
    entities = read_table(spark, a.entities, a.format)
    if a.store:
        stream = RiskStream(spark, a.store)
        tx, alerts = stream.transactions(), stream.alerts()
    elif a.transactions and a.alerts:
        tx, alerts = (read_table(spark, x, a.format) for x in (a.transactions, a.alerts))
    else:
        p.error("give --store, or --transactions and --alerts")
    if a.dry_run:
        store = BatchStore(spark, a.out)
        known = store.current("entity_features", FEATURE_SCHEMA, features.ACCOUNT)
        print(dry_run(tx, entities_of(store, entities), known, start, end))
        return
    top, extent = report(spark, run(spark, tx, alerts, entities, a.out, start, end))
    top.show(truncate=False)
    extent.show()


if __name__ == "__main__":
    main()
