"""Constraint checks as jobs: keys, references, lengths, domains, ranges, and their repairs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.operators.joins import lookup_join
from riskloom.operators.upsert import first_by_key


def duplicate_keys(df: DataFrame, keys: list[str], table: str) -> DataFrame:
    """Number of key values that occur more than once, and of rows beyond the first."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > 1)
    return counts.agg(
        F.lit(table).alias("table_name"), F.lit(",".join(keys)).alias("key_columns"),
        F.count("*").alias("n_keys"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_extra_rows"),
    )


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_key: str, relation: str) -> DataFrame:
    """Child rows whose reference does not exist in their tenant; counted per value before the join."""
    refs = child.where(F.col(column).isNotNull()).groupBy("tenant_id", F.col(column).alias("_ref")).agg(F.count("*").alias("n"))
    lost = refs.join(parent.select("tenant_id", F.col(parent_key).alias("_ref")), ["tenant_id", "_ref"], "left_anti")
    return lost.agg(
        F.lit(relation).alias("relation"), F.count("*").alias("n_values"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows")
    )


def _violations(df: DataFrame, table: str, checks: Sequence[tuple[str, Column]]) -> DataFrame:
    """All checks of a table in one pass, returned as one row per check."""
    counted = df.agg(*[F.count_if(bad).alias(f"c{i}") for i, (_, bad) in enumerate(checks)])
    rows = F.array(*[
        F.struct(F.lit(table).alias("table_name"), F.lit(name).alias("check_name"), F.col(f"c{i}").alias("n_rows"))
        for i, (name, _) in enumerate(checks)
    ])
    return counted.select(F.inline(rows))


def null_or_longer(limits: Mapping[str, int], required: Sequence[str] = ()) -> list[tuple[str, Column]]:
    checks = [(f"{c}<={n}", F.coalesce(F.length(c) > n, F.lit(False))) for c, n in limits.items()]
    return checks + [(f"{c} not null", F.col(c).isNull()) for c in required]


def outside_domain(domains: Mapping[str, Sequence[str]]) -> list[tuple[str, Column]]:
    return [(f"{c} in domain", F.col(c).isNotNull() & ~F.col(c).isin(list(values))) for c, values in domains.items()]


def outside_range(ranges: Mapping[str, tuple[float, float]]) -> list[tuple[str, Column]]:
    return [(f"{c} in {lo}..{hi}", F.col(c).isNotNull() & ~F.col(c).between(lo, hi)) for c, (lo, hi) in ranges.items()]


def constraint_report(
    df: DataFrame, table: str, keys: Sequence[Sequence[str]] = (), checks: Sequence[tuple[str, Column]] = ()
) -> DataFrame:
    """(table_name, check_name, n_rows): all constraints of a table in one scan.

    A row gives one record with all its row checks and one per key. The records are counted by key value, map-side
    combined, so a value that most rows share costs a row per task; row checks ride along as sums. A key check counts
    the rows beyond the first of each value. An empty table gives zeros.
    """
    flags = [F.when(bad, 1).otherwise(0).cast("bigint") for _, bad in checks]
    zero = F.lit(0).cast("bigint")

    def record(number: int, value: Column, counted: list[Column]) -> Column:
        return F.struct(F.lit(number).alias("_check"), value.alias("_value"), *[c.alias(f"_f{i}") for i, c in enumerate(counted)])

    of_row = record(-1, F.lit(None).cast("array<string>"), flags)
    of_keys = [record(i, F.array(*[F.col(c).cast("string") for c in k]), [zero] * len(flags)) for i, k in enumerate(keys)]
    rows = df.select(F.inline(F.array(of_row, *of_keys)))
    values = rows.groupBy("_check", "_value").agg(F.count("*").alias("_n"), *[F.sum(f"_f{i}").alias(f"_f{i}") for i in range(len(flags))])
    extra = [F.sum(F.when(F.col("_check") == i, F.col("_n") - 1)) for i in range(len(keys))]
    total = values.agg(
        *[F.coalesce(x, zero).alias(f"_k{i}") for i, x in enumerate(extra)],
        *[F.coalesce(F.sum(f"_f{i}"), zero).alias(f"_f{i}") for i in range(len(flags))],
    )
    named = [(f"unique {','.join(k)}", f"_k{i}") for i, k in enumerate(keys)] + [(n, f"_f{i}") for i, (n, _) in enumerate(checks)]
    return total.select(F.inline(F.array(*[
        F.struct(F.lit(table).alias("table_name"), F.lit(n).alias("check_name"), F.col(c).alias("n_rows")) for n, c in named
    ])))


def length_violations(df: DataFrame, table: str, limits: Mapping[str, int], required: Sequence[str] = ()) -> DataFrame:
    return _violations(df, table, null_or_longer(limits, required))


def domain_violations(df: DataFrame, table: str, domains: Mapping[str, Sequence[str]]) -> DataFrame:
    return _violations(df, table, [
        (c, F.col(c).isNotNull() & ~F.col(c).isin(list(values))) for c, values in domains.items()
    ])


def range_violations(df: DataFrame, table: str, ranges: Mapping[str, tuple[float, float]]) -> DataFrame:
    return _violations(df, table, [
        (c, F.col(c).isNotNull() & ~F.col(c).between(lo, hi)) for c, (lo, hi) in ranges.items()
    ])


def keep_first(df: DataFrame, keys: list[str], id_: str = "id") -> DataFrame:
    """Drop copies of a key, keeping the lowest id; rows with a null key are all kept."""
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()
    return first_by_key(df.where(~no_key), keys, [id_]).unionByName(df.where(no_key))


def null_orphan_alerts(alerts: DataFrame, tx: DataFrame) -> DataFrame:
    """Alerts whose transaction is gone keep their row and lose the reference.

    The missing ids are found among the distinct references first, so alerts that all point to one
    missing transaction do not meet in one task of the large join.
    """
    refs = alerts.where(F.col("transaction_id").isNotNull()).select("tenant_id", "transaction_id").distinct()
    ids = tx.select("tenant_id", F.col("id").alias("transaction_id"))
    lost = refs.join(ids, ["tenant_id", "transaction_id"], "left_anti").withColumn("_lost", F.lit(True))
    return lookup_join(alerts, lost, ["tenant_id", "transaction_id"], "alert_id", max_bytes=None).select(
        *[
            F.when(F.col("_lost").isNull(), F.col(c)).alias(c) if c == "transaction_id" else F.col(c)
            for c in alerts.columns
        ]
    )
