"""Keyed merges as DataFrame transforms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_by_key(df: DataFrame, keys: list[str], order: list[str] | Column) -> DataFrame:
    """The last row of each key in ``order``.

    An aggregation, not a window: copies are folded on the map side, so a key that holds a large
    part of the rows sends one row per task through the shuffle.
    """
    rank = F.struct(*order) if isinstance(order, list) else order
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def first_by_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in ``order``; ties must be full copies."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def upsert(existing: DataFrame, incoming: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Merged table: incoming rows win over existing ones, the last one by ``order`` among themselves.

    Adds ``change``: ``inserted``, ``updated`` or ``kept``.
    """
    both = existing.withColumn("_new", F.lit(0)).unionByName(incoming.withColumn("_new", F.lit(1)))
    rest = [c for c in existing.columns if c not in keys]
    merged = both.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.struct("_new", *order)).alias("_row"),
        F.min("_new").alias("_lo"), F.max("_new").alias("_hi"),
    )
    change = F.when(F.col("_hi") == 0, "kept").when(F.col("_lo") == 1, "inserted").otherwise("updated")
    return merged.select(
        *[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in existing.columns], change.alias("change")
    )


def replace_columns(existing: DataFrame, incoming: DataFrame, keys: list[str], keep: list[str]) -> DataFrame:
    """Upsert that overwrites every column except ``keep``, which existing rows hold on to."""
    old = existing.select(*keys, F.lit(True).alias("_old"), *[F.col(c).alias(f"_old_{c}") for c in existing.columns if c not in keys])
    new = incoming.withColumn("_new", F.lit(True))
    joined = old.join(new, keys, "full_outer")

    def pick(c: str) -> Column:
        first = F.col("_old") if c in keep else F.col("_new")
        a, b = (f"_old_{c}", c) if c in keep else (c, f"_old_{c}")
        return F.when(first, F.col(a)).otherwise(F.col(b)).alias(c)

    return joined.select(*[F.col(c) if c in keys else pick(c) for c in existing.columns])


def ingest_new(existing: DataFrame, incoming: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Rows to add: the first of each key that the table does not hold yet, with how often it was offered."""
    rest = [c for c in incoming.columns if c not in keys]
    first = incoming.groupBy(*keys).agg(
        F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"), F.count("*").alias("n_offered")
    )
    new = first.join(existing.select(*keys).distinct(), keys, "left_anti")
    return new.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in incoming.columns], "n_offered")


def ingest_report(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Offered rows by outcome: new, repeated within the offer, or already present."""
    offered = incoming.groupBy(*keys).agg(F.count("*").alias("n"))
    known = existing.select(*keys).distinct().withColumn("_known", F.lit(True))
    rows = offered.join(known, keys, "left")
    return rows.agg(
        F.count_if(F.col("_known").isNull()).alias("n_new"),
        F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col("n") - 1)), F.lit(0)).alias("n_repeated"),
        F.coalesce(F.sum(F.when(F.col("_known"), F.col("n"))), F.lit(0)).alias("n_present"),
    )


def merge_into_table(incoming: DataFrame, table: str, keys: list[str]) -> None:
    """MERGE for catalogs whose table format supports row-level updates."""
    on = " AND ".join(f"target.{k} = source.{k}" for k in keys)
    rest = {c: F.col(f"source.{c}") for c in incoming.columns if c not in keys}
    aliased = incoming.alias("source")
    condition = F.expr(on.replace("target.", f"{table}."))
    aliased.mergeInto(table, condition).whenMatched().update(rest).whenNotMatched().insertAll().merge()
