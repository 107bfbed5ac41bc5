"""Sharding by a two-pass external shuffle.

Pass one scatters records over memory-sized buckets by a seeded hash of all their columns, so that rows with
equal or null ids spread too. Pass two sorts each bucket
(so that arrival order does not matter), shuffles it by Fisher-Yates under a seed of its own and numbers it.
With the buckets one after the other this is one permutation of all records; record p of it goes to shard
``p mod shards``, place ``p div shards``, so counts differ by one at most.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import documents, records, text_of

SEED = 20240501
BUCKET_BYTES = 64 << 20
MIN_BUCKETS = 256
#: A base per bucket is broadcast up to this many buckets (16 bytes each); beyond, it is joined by shuffle.
BROADCAST_BUCKETS = 500_000


def fisher_yates(n: int, seed: int, bucket: int) -> np.ndarray:
    """A permutation of range(n): place i, from the last down, swaps with one drawn from 0..i."""
    rng = np.random.Generator(np.random.PCG64([seed, bucket]))
    at = list(range(n))
    for i, j in zip(range(n - 1, 0, -1), rng.integers(0, np.arange(n, 1, -1)).tolist()):
        at[i], at[j] = at[j], at[i]
    return np.array(at, dtype=np.int64)


def shuffle_shards(
    docs: DataFrame, shards: int = 16, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES, min_buckets: int = MIN_BUCKETS
) -> DataFrame:
    """(rec, doc_id, size, text_crc32, shard, slot) with every input row once; ``rec`` holds all its columns.

    Null text counts as empty (size 1, checksum 0). Null ids sort after the others. Rows equal in id, size
    and checksum are ordered arbitrarily among themselves, which changes nothing when their texts are equal.
    Empty input gives no rows. Buckets hold about ``bucket_bytes`` of text each; there are at least
    ``min_buckets``, so that small inputs use all cores.
    """
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length(text_of()) + 1)).first()[0] or 0
    buckets = max(min_buckets, -(-total // bucket_bytes))
    # Maps have no hash; a row's other columns and its text tell rows apart well enough.
    plain = [f"`{f.name}`" for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]

    def bucket(prefix: str = "") -> Column:
        return F.pmod(F.xxhash64(F.lit(seed), *[F.col(prefix + c) for c in plain]), F.lit(buckets)).cast("int").alias("bucket")

    base = docs.groupBy(bucket()).count().select(
        "bucket", (F.sum("count").over(Window.orderBy("bucket")) - F.col("count")).alias("base")
    )
    rows = records(docs).select(
        "rec", "doc_id", (F.octet_length("text").cast("long") + 1).alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"), bucket("rec."),
    )
    rows = rows.join(F.broadcast(base) if buckets <= BROADCAST_BUCKETS else base, "bucket")
    schema = spark.createDataFrame([], rows.schema).withColumn("place", F.lit(0).cast("long")).schema

    def shuffled(table: pa.Table) -> pa.Table:
        number = table["bucket"][0].as_py()
        order = pc.sort_indices(table.select(["doc_id", "text_crc32", "size"]), sort_keys=[
            ("doc_id", "ascending"), ("text_crc32", "ascending"), ("size", "ascending")
        ])
        n = table.num_rows
        out = table.combine_chunks().take(order.take(pa.array(fisher_yates(n, seed, number))))
        return out.append_column("place", pa.array(np.arange(n, dtype=np.int64)))

    place = F.col("base") + F.col("place")
    return rows.groupBy("bucket").applyInArrow(shuffled, schema).select(
        "rec", "doc_id", "size", "text_crc32",
        F.pmod(place, F.lit(shards)).cast("int").alias("shard"), F.floor(place / F.lit(shards)).cast("long").alias("slot"),
    )


def write_shards(docs: DataFrame, path: str, shards: int = 16, **how) -> None:
    """Write each shard to ``path/shard=N`` with all columns of the input and the ``slot``.

    Input columns named ``shard`` or ``slot`` keep their values as ``input_shard`` and ``input_slot`` (with one more
    ``input_`` while that name is taken). Nulls, repeated rows and empty tables as in ``shuffle_shards``.
    """
    names = {c: c for c in docs.columns if c not in ("shard", "slot")}
    for c in ("shard", "slot"):
        if c in docs.columns:
            new = f"input_{c}"
            while new in names.values():
                new = f"input_{new}"
            names[c] = new
    out = shuffle_shards(docs, shards, **how)
    out.select(*[F.col("rec")[c].alias(n) for c, n in names.items()], "shard", "slot").write.partitionBy("shard").parquet(path)


def op10_sharding(spark, sf_dir) -> DataFrame:
    """One row per document under the law ``rows``; nulls and repeated rows as in ``shuffle_shards``."""
    return shuffle_shards(documents(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
