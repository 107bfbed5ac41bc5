"""Lookup joins that stay balanced whatever the keys look like."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 10 << 20
NULL_SALTS = 256


def estimated_bytes(df: DataFrame) -> int:
    """Size of the result by the optimizer's statistics (file and column sizes); no job runs for it.

    It is the size of the files for a scan, and an upper bound above filters and joins.
    """
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    spread: str | None = None,
    how: str = "left",
    max_bytes: int | None = BROADCAST_BYTES,
    salts: int = 1,
) -> DataFrame:
    """Join a large table to a table with one row per key.

    The right side is broadcast only when the optimizer's statistics put it within ``max_bytes``; ``None``
    never asks for it. Otherwise it is a shuffle join made safe for skew:

    * left rows with a null key match nothing and are spread by a hash of ``spread`` (all columns
      by default) instead of piling up in one task;
    * the salt is a join key, so both sides get an exchange of their own directly below the join.
      Only then does adaptive execution split a hot key over several tasks; it would not if the
      right side were, say, an aggregation on the same key;
    * ``salts`` above 1 splits every key that many ways up front, at the price of that many copies
      of the right side.
    """
    if max_bytes is not None and estimated_bytes(right) <= max_bytes:
        return left.join(F.broadcast(right), on, how)
    mix = F.xxhash64(*([spread] if spread else left.columns))
    no_key = F.lit(False)
    for c in on:
        no_key = no_key | F.col(c).isNull()
    n = F.when(no_key, F.lit(NULL_SALTS * salts)).otherwise(F.lit(salts))
    salted = left.withColumn("_salt", F.pmod(mix, n).cast("int"))
    copies = right.withColumn("_salt", F.explode(F.array(*[F.lit(i) for i in range(salts)])))
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")


def semi_lookup(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``keys``: the batch form of many point lookups."""
    return lookup_join(df, keys.select(*on).distinct(), on, how="left_semi", max_bytes=None)
