"""Centroid clustering with a bisector tournament.

Vectors become integers, so all comparisons are exact. For centroids i < j the bisector has the integer normal
``2 (c_j - c_i)`` and the threshold ``|c_j|^2 - |c_i|^2``: a vector is nearer to j exactly when its product with the
normal exceeds the threshold, and zero favours i. A vector is assigned by k - 1 such sign tests, the winner so far
against the next number; a squared distance is computed for the last winner only. Rounds are one pass each: tasks add
up the vectors of each cluster, Spark adds the tasks' sums, and the driver sees k x dimensions whole numbers.
"""

from __future__ import annotations

import hashlib
import math
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIMENSIONS = 64
CLUSTERS = 16
ROUNDS = 3
SCALE = 64
SEED = 1
#: Up to this size of components every product and distance of 64 components fits 64 bits; beyond, exact Python
#: numbers are used.
SMALL = 1 << 27
#: Vectors of one step of the tournament, which holds a normal for each.
_STEP = 2048


def kept_vectors(vectors: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """(rec, vec_id, x) of the vectors with exactly ``dimensions`` components, none null, NaN or infinite.

    ``rec`` holds all columns of the input, so clashing names do no harm. Repeated rows stay.
    """
    x = F.col("embedding").cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return vectors.select(
        F.struct(*[F.col(f"`{c}`") for c in vectors.columns]).alias("rec"), F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")
    ).where((F.size("x") == dimensions) & ~bad)


def whole(column: pa.Array | pa.ChunkedArray, dimensions: int, scale: int) -> np.ndarray:
    """floor(scale * x) for the rows of a list column, as 64-bit numbers or, where too large, Python numbers."""
    flat = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)
    with np.errstate(over="ignore"):
        scaled = np.floor(flat * scale)
    if not scaled.size or np.abs(scaled).max() <= SMALL:
        return scaled.astype(np.int64)
    exact = [math.floor(v * scale) if math.isfinite(v * scale) else int(v) * scale for v in flat.ravel().tolist()]
    return np.array(exact, dtype=object).reshape(-1, dimensions)


class Bisectors:
    """Normals and thresholds of all pairs of centroids: k * k * dimensions numbers."""

    def __init__(self, centroids: list[list[int]]):
        c = np.array(centroids, dtype=object)
        small = all(abs(v) <= SMALL for row in centroids for v in row)
        squares = (c * c).sum(axis=1)
        normals, thresholds = 2 * (c[None, :, :] - c[:, None, :]), squares[None, :] - squares[:, None]
        kind = np.int64 if small else object
        self.centroids, self.normals, self.thresholds = c.astype(kind), normals.astype(kind), thresholds.astype(kind)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the nearest centroid, squared distance) of each row; the smaller number wins a tie."""
        numbers, distances = [], []
        for at in range(0, len(x), _STEP):
            part = x[at : at + _STEP]
            winner = np.zeros(len(part), dtype=np.int64)
            for j in range(1, len(self.centroids)):
                side = (part * self.normals[winner, j]).sum(axis=1) - self.thresholds[winner, j]
                winner[side > 0] = j
            gap = part - self.centroids[winner]
            numbers.append(winner)
            distances.append((gap * gap).sum(axis=1))
        none = np.zeros(0, dtype=np.int64)
        return np.concatenate([none, *numbers]), np.concatenate([none, *distances])


def _sums(centroids: list[list[int]], scale: int):
    def go(batches):
        dimensions = len(centroids[0])
        planes = Bisectors(centroids)
        total = np.zeros((len(centroids), dimensions), dtype=object)
        count = np.zeros(len(centroids), dtype=np.int64)
        for b in batches:
            x = whole(b["x"], dimensions, scale)
            number, _ = planes.nearest(x)
            order = np.argsort(number, kind="stable")
            found, first = np.unique(number[order], return_index=True)
            if len(found):
                total[found] += np.add.reduceat(x[order], first, axis=0).astype(object)
                count += np.bincount(number, minlength=len(count))
        at = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(at, dimensions), pa.int32()), pa.array(np.tile(np.arange(dimensions), len(at)), pa.int32()),
            pa.array([Decimal(int(v)) for v in total[at].ravel()], pa.decimal128(38, 0)),
            pa.array(np.repeat(count[at], dimensions), pa.int64()),
        ], ["cluster", "position", "total", "n"])

    return go


def _assigned(centroids: list[list[int]], scale: int):
    def go(batches):
        planes = Bisectors(centroids)
        for b in batches:
            number, distance = planes.nearest(whole(b["x"], len(centroids[0]), scale))
            yield pa.RecordBatch.from_arrays(
                [b["rec"], pa.array(number, pa.int32()), pa.array(distance.tolist(), pa.int64())], ["rec", "cluster", "distance"]
            )

    return go


def first_centroids(kept: DataFrame, clusters: int = CLUSTERS, seed: int = SEED, scale: int = SCALE) -> list[list[int]]:
    """The vectors with the smallest SHA-256 of ``seed:vec_id``, in that order; equal ids go by their components,
    null ids come last. Fewer vectors than ``clusters`` give fewer centroids."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = kept.select("x", name.alias("name")).orderBy(F.col("name").asc_nulls_last(), "x").limit(clusters).collect()
    x = whole(pa.array([r.x for r in rows], pa.list_(pa.float64())), len(rows[0].x), scale) if rows else []
    return [[int(v) for v in row] for row in x]


def fit(kept: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, scale: int = SCALE) -> list[list[int]]:
    """Centroids after ``rounds`` rounds; an empty cluster keeps its centroid. Holds clusters x dimensions numbers."""
    centroids = first_centroids(kept, clusters, seed, scale)
    for _ in range(rounds if centroids else 0):
        sums = kept.select("x").mapInArrow(_sums(centroids, scale), "cluster int, position int, total decimal(38,0), n long")
        for r in sums.groupBy("cluster", "position").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():
            centroids[r.cluster][r.position] = int(r.total) // r.n
    return centroids


def cluster(
    vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, dimensions: int = DIMENSIONS,
    scale: int = SCALE,
) -> DataFrame:
    """(rec, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every kept vector.

    Dropped are vectors that are null, of another length, or with a null, NaN or infinite component. Repeated rows
    and repeated ids all count and all come out; a null id never starts a cluster while others are left. An empty
    table, or one without kept vectors, gives no rows. Ties go to the smaller number. A distance or sum of distances
    beyond 64 bits is an error, never a wrong number.
    """
    spark = vectors.sparkSession
    kept = kept_vectors(vectors, dimensions)
    centroids = fit(kept, clusters, rounds, seed, scale)
    schema = kept.select("rec", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).schema
    rows = kept.select("rec", "x").mapInArrow(_assigned(centroids, scale), schema) if centroids else spark.createDataFrame([], schema)
    inertia = {r.cluster: r.s for r in rows.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    per = spark.createDataFrame([
        (n, inertia[n], sum(inertia.values()), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
        for n, c in enumerate(centroids) if n in inertia
    ], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(per), "cluster").select("rec", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op11_centroid_clustering(spark, sf_dir) -> DataFrame:
    """One row per kept vector of ``embeddings``; nulls, ties and repeated rows as in ``cluster``."""
    return cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).select(
        F.col("rec.vec_id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
