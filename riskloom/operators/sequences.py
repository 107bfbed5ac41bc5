"""Per-key ordered computations that survive a key, or one instant of it, holding a large part of all rows.

A plain window over an account puts the whole account into one task. ``prefix_scan`` sorts all rows by key and
order over range partitions, which are cut anywhere, also inside an account or an instant. Each partition is
streamed once; what it leaves open for the key of its last row is one small record, and the next partitions that
begin with this key start from it. ``current_run`` and ``previous_instant`` need less: they cut accounts into time
buckets and carry one small row per bucket onward.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators.stored import stored

BUCKET_SECONDS = 3600
_B = "_bucket"


def _bucketed(df: DataFrame, time: str, seconds: int) -> DataFrame:
    return df.withColumn(_B, F.floor(F.unix_seconds(F.col(time).cast("timestamp")) / seconds))


# ------------------------------------------------------------------ prefix scan
def _new_keys(batch: pa.RecordBatch, keys: list[str], last: tuple | None) -> tuple[np.ndarray, tuple]:
    """Where a row's key differs from the row before (``last`` before the first one), and the last key."""
    new = np.zeros(batch.num_rows, dtype=bool)
    for k in keys:
        a, b = batch[k].slice(1), batch[k].slice(0, batch.num_rows - 1)
        differs = pc.fill_null(pc.not_equal(a, b), False).to_numpy(zero_copy_only=False)
        nulls = pc.not_equal(a.is_null(), b.is_null()).to_numpy(zero_copy_only=False)
        new[1:] |= differs | nulls
    new[0] = tuple(batch[k][0].as_py() for k in keys) != last
    return new, tuple(batch[k][-1].as_py() for k in keys)


def _scan(keys: list[str], sums: list[str], runs: list[str], names: list[str]):
    """Streams one sorted partition; emits its rows with local totals, then an edge record."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid = TaskContext.get().partitionId()
        first = last = None
        segments = 0
        total, run, clean = dict.fromkeys(sums, 0), dict.fromkeys(runs, 0), dict.fromkeys(runs, True)

        def batch_of(columns: dict, n: int) -> pa.RecordBatch:
            fill = {"_pid": pa.array([pid] * n, pa.int32())}
            return pa.RecordBatch.from_arrays([columns.get(c, fill.get(c)) for c in names], names)

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            new, key = _new_keys(batch, keys, last)
            if first is None:
                first = tuple(batch[k][0].as_py() for k in keys)
            last = key
            at = np.arange(n)
            begin = np.maximum.accumulate(np.where(new, at, -1))  # -1: the key of the batch before goes on
            going = begin < 0
            opening = np.cumsum(new) + segments <= 1
            segments += int(new.sum())
            out = {c: batch[c] for c in batch.schema.names if c in names}
            for s in sums:
                v = batch[s].to_numpy(zero_copy_only=False).astype(np.int64)
                run_to = np.concatenate(([0], np.cumsum(v)))
                value = run_to[1:] - run_to[np.maximum(begin, 0)] + np.where(going, total[s], 0)
                if abs(np.concatenate(([float(total[s])], v.astype(np.float64))).cumsum()).max() >= 2.0**62:
                    raise OverflowError(f"running total of {s} leaves 64 bits")
                out[s], total[s] = pa.array(value), int(value[-1])
            for r in runs:
                hit = batch[r].to_numpy(zero_copy_only=False).astype(bool)
                reset = np.maximum.accumulate(np.where(hit, np.where(new, at - 1, -1), at))
                untouched = going & (reset < 0)
                value = np.where(untouched, at + 1 + run[r], at - reset)
                missed = np.cumsum(opening & ~hit) > 0
                out[r], run[r] = pa.array(value.astype(np.int64)), int(value[-1])
                out[f"_open_{r}"] = pa.array(opening & ~missed & clean[r])
                clean[r] = clean[r] and not missed.any()
            out["_opening"] = pa.array(opening)
            yield batch_of({**out, "_edge": pa.nulls(n, _edge_type(keys, sums, runs))}, n)
        if first is not None:
            edge = {
                "first": [str(v) if v is not None else None for v in first], "last": [str(v) if v is not None else None for v in last],
                "single": segments <= 1, "totals": list(total.values()), "runs": list(run.values()), "clean": list(clean.values()),
            }
            nothing = {f.name: pa.nulls(1, f.type) for f in batch.schema if f.name in names}
            more = {f"_open_{r}": pa.nulls(1, pa.bool_()) for r in runs} | {"_opening": pa.nulls(1, pa.bool_())}
            swapped = {c: pa.nulls(1, pa.int64()) for c in [*sums, *runs]}
            yield batch_of({**nothing, **more, **swapped, "_edge": pa.array([edge], _edge_type(keys, sums, runs))}, 1)

    return go


def _edge_type(keys: list[str], sums: list[str], runs: list[str]) -> pa.DataType:
    text, long = pa.list_(pa.string()), pa.list_(pa.int64())
    return pa.struct([
        ("first", text), ("last", text), ("single", pa.bool_()), ("totals", long), ("runs", long), ("clean", pa.list_(pa.bool_())),
    ])


_EDGE = "struct<first:array<string>,last:array<string>,single:boolean,totals:array<bigint>,runs:array<bigint>,clean:array<boolean>>"


def _carries(edges: list) -> list[tuple[int, list[int], list[int]]]:
    """(partition, totals, runs) that the first key of a partition brings along from the partitions before."""
    out, key, totals, runs = [], None, [], []
    for pid, e in edges:
        goes_on = key is not None and key == e["first"]
        if goes_on:
            out.append((pid, totals, runs))
        add = goes_on and e["single"]
        totals = [a + b for a, b in zip(e["totals"], totals)] if add else list(e["totals"])
        runs = [a + (b if c else 0) for a, b, c in zip(e["runs"], runs, e["clean"])] if add else list(e["runs"])
        key = e["last"]
    return out


def ranged(df: DataFrame, keys: list[str], order: list[str], partitions: int | None = None) -> DataFrame:
    """All rows sorted by key and order over partitions that are cut where the row counts say."""
    columns = [*keys, *order]
    spread = df.repartitionByRange(partitions, *columns) if partitions else df.repartitionByRange(*columns)
    return spread.sortWithinPartitions(*columns)


def prefix_scan(
    df: DataFrame, keys: list[str], order: list[str], sums: Mapping[str, Column], runs: Mapping[str, Column] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Add running sums (bigint, null counts as 0) and lengths of the unbroken run of hits, up to each row in
    ``order`` within ``keys``. Rows that tie in it come in no particular order.

    The input is computed once. Rows are exchanged once. The driver sees one record per partition. A total
    beyond 64 bits is an error.
    """
    spark = df.sparkSession
    runs = runs or {}
    s, r = [f"_sum_{n}" for n in sums], [f"_run_{n}" for n in runs]
    rows = stored(df.select(
        "*", *[F.coalesce(e.cast("bigint"), F.lit(0).cast("bigint")).alias(n) for n, e in zip(s, sums.values())],
        *[F.coalesce(h, F.lit(False)).alias(n) for n, h in zip(r, runs.values())],
    ))
    plain = [f for f in rows.schema.fields if f.name not in (*s, *r)]
    schema = T.StructType([
        *[T.StructField(f.name, f.dataType) for f in plain], *[T.StructField(n, T.LongType()) for n in (*s, *r)],
        *[T.StructField(f"_open_{n}", T.BooleanType()) for n in r], T.StructField("_opening", T.BooleanType()),
        T.StructField("_pid", T.IntegerType()), T.StructField("_edge", T._parse_datatype_string(_EDGE)),
    ])
    scanned = stored(ranged(rows, keys, order, partitions).mapInArrow(_scan(keys, s, r, schema.names), schema))
    edges = scanned.where("_edge IS NOT NULL").select("_pid", "_edge").orderBy("_pid").collect()
    carries = spark.createDataFrame(
        _carries([(e._pid, e._edge) for e in edges]), "_pid int, _totals array<bigint>, _runs array<bigint>"
    )
    joined = scanned.where("_edge IS NULL").join(F.broadcast(carries), "_pid", "left")
    zero = F.lit(0).cast("bigint")

    def carried(own: str, from_: str, at: int, applies: str) -> Column:
        return F.col(own) + F.when(F.col(applies), F.coalesce(F.col(from_)[at], zero)).otherwise(zero)

    return joined.select(
        *[f.name for f in plain], *[carried(c, "_totals", i, "_opening").alias(n) for i, (n, c) in enumerate(zip(sums, s))],
        *[carried(c, "_runs", i, f"_open_{c}").alias(n) for i, (n, c) in enumerate(zip(runs, r))],
    )


def running_totals(
    df: DataFrame, keys: list[str], order: list[str], sums: Mapping[str, Column], partitions: int | None = None
) -> DataFrame:
    """Add the running sum of each expression, current row included, in ``order`` within ``keys``."""
    return prefix_scan(df, keys, order, sums, partitions=partitions)


def run_lengths(
    df: DataFrame, keys: list[str], order: list[str], hit: Column, name: str = "run_length", partitions: int | None = None
) -> DataFrame:
    """Add the number of consecutive hits up to each row; a miss resets it to 0."""
    return prefix_scan(df, keys, order, {}, {name: hit}, partitions)


def rolling_sums(
    df: DataFrame, keys: list[str], time: str, amount: str, windows: Mapping[str, str], partitions: int | None = None
) -> DataFrame:
    """Add count and sum of the rows in ``[time - width, time]`` for each named width.

    Sweep over moments: a row enters at its time and leaves after its width; between the two, at its own time,
    it reads the running totals. At one moment all rows enter before any reads, and leave after all have read.
    """
    kind = df.schema[amount].dataType
    scale = kind.scale if isinstance(kind, T.DecimalType) else 0
    result = T.DecimalType(min(38, kind.precision + 10), scale) if isinstance(kind, T.DecimalType) else T.LongType()
    units = F.coalesce((F.col(amount) * F.lit(Decimal(10**scale))).cast("bigint"), F.lit(0).cast("bigint"))
    measures = [f"{m}_{w}" for w in windows for m in ("n", "a")]
    row_type = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields if f.name not in keys])
    row = F.struct(*row_type.names)

    def event(at: Column, step: int, carried: Column, values: Mapping[str, Column]) -> Column:
        cells = [values.get(m, F.lit(0)).cast("bigint").alias(m) for m in measures]
        return F.struct(at.alias("_at"), F.lit(step).alias("_step"), carried.alias("_row"), *cells)

    nothing, own = F.lit(None).cast(row_type), {"n": F.lit(1), "a": F.col("_units")}
    events = [event(F.col(time), 0, nothing, {m: own[m[0]] for m in measures}), event(F.col(time), 1, row, {})]
    for w, width in windows.items():
        gone = F.col(time) + F.expr(f"INTERVAL {width}")
        events.append(event(gone, 2, nothing, {f"{m}_{w}": -own[m] for m in ("n", "a")}))
    spread = df.select("*", units.alias("_units"), F.xxhash64(*df.columns).alias("_mix")).select(*keys, "_mix", F.inline(F.array(*events)))
    totals = prefix_scan(spread, keys, ["_at", "_step", "_mix"], {f"_t_{m}": F.col(m) for m in measures}, partitions=partitions)
    one = F.lit(Decimal(1).scaleb(-scale))
    return totals.where("_step = 1").select(
        *[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns],
        *[F.col(f"_t_n_{w}").alias(f"count_{w}") for w in windows],
        *[(F.col(f"_t_a_{w}").cast("decimal(20,0)") * one).cast(result).alias(f"sum_{w}") for w in windows],
    )


# ------------------------------------------------------------------ time buckets
def current_run(
    df: DataFrame, keys: list[str], time: str, order: list[str], hit: Column, name: str = "run_length",
    bucket_seconds: int = BUCKET_SECONDS,
) -> DataFrame:
    """Length of the latest unbroken run of hits per key, without sorting any rows.

    Whole buckets after the last miss are counted from the bucket totals; only rows of the one
    bucket that holds the last miss are looked at again, by a join on key and bucket.
    """
    rows = _bucketed(df.select(*dict.fromkeys([*keys, time, *order]), hit.alias("_hit")), time, bucket_seconds)
    rows = rows.select(*keys, _B, F.struct(*order).alias("_rank"), "_hit")
    buckets = rows.groupBy(*keys, _B).agg(
        F.count("*").alias("_n"), F.max(F.when(~F.col("_hit"), F.col("_rank"))).alias("_miss")
    )
    latest = F.max(F.when(F.col("_miss").isNotNull(), F.struct(_B, "_miss"))).over(Window.partitionBy(*keys))
    after = F.col("_last").isNull() | (F.col(_B) > F.col(f"_last.{_B}"))
    state = buckets.withColumn("_last", latest).groupBy(*keys).agg(
        F.max("_last").alias("_last"), F.coalesce(F.sum(F.when(after, F.col("_n"))), F.lit(0)).alias("_later")
    ).select(*keys, F.col(f"_last.{_B}").alias(_B), F.col("_last._miss").alias("_miss"), "_later")
    # Without any miss the bucket is null, nothing joins, and all rows are in ``_later``. The rows meet one small
    # record per key, which a plan may broadcast, and leave as one count per key.
    tail = rows.drop("_hit").join(state.where(F.col(_B).isNotNull()).drop("_later"), [*keys, _B]).where(
        F.col("_rank") > F.col("_miss")
    ).groupBy(*keys).agg(F.count("*").alias("_tail"))
    return state.join(tail, keys, "left").select(*keys, (F.col("_later") + F.coalesce("_tail", F.lit(0))).alias(name))


def previous_instant(
    df: DataFrame, keys: list[str], time: str, name: str = "previous_time", bucket_seconds: int = BUCKET_SECONDS
) -> DataFrame:
    """Add the next earlier ``time`` of the same key; one row per key and time is expected."""
    rows = _bucketed(df, time, bucket_seconds)
    local = rows.select("*", F.lag(time).over(Window.partitionBy(*keys, _B).orderBy(time)).alias("_in"))
    latest = rows.groupBy(*keys, _B).agg(F.max(time).alias("_last"))
    carried = latest.select(*keys, _B, F.lag("_last").over(Window.partitionBy(*keys).orderBy(_B)).alias("_carry"))
    return local.join(carried, [*keys, _B]).select(*df.columns, F.coalesce("_in", "_carry").alias(name))
