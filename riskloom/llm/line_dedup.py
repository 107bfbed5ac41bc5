"""Line dedup over range-partitioned hashes.

Lines become rows of (hash, document, positions), one per document and key. These are partitioned by range
of (hash, document) and sorted inside, so a key that a third of all documents hold is spread over as many
partitions as it needs. Each partition is streamed once: inside a run of equal hashes the first rows wait
until the run is known to reach the bound, all later ones pass through. Only the first and the last run of a
partition may continue in a neighbour; at most ``min_docs`` rows of each go to a small second step that adds
up the parts. What comes out are compressed bitmaps of kept lines, per document with losses, never text.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import WS, documents, records, same, saved

_WS = WS.encode()
_KEYS = "hash binary, doc_id long, text_key long, n_lines int, positions binary"
_BATCH = 4000


def line_key(line: bytes) -> bytes:
    return line.strip(_WS).lower()


def _keys(batches):
    for b in batches:
        out = ([], [], [], [], [])
        for i, k, t in zip(b["doc_id"].to_pylist(), b["text_key"].to_pylist(), b["text"]):
            lines = t.as_buffer().to_pybytes().split(b"\n")
            found: dict[bytes, list[int]] = {}
            for n, line in enumerate(lines):
                if key := line_key(line):
                    found.setdefault(xxhash.xxh3_128_digest(key), []).append(n)
            for h, at in found.items():
                for column, v in zip(out, (h, i, k, len(lines), np.array(at, dtype="<u4").tobytes())):
                    column.append(v)
        yield _batch(*out)


def _batch(h, i, k, n, at, *more):
    names = ["hash", "doc_id", "text_key", "n_lines", "positions"]
    arrays = [pa.array(h, pa.binary()), pa.array(i, pa.int64()), pa.array(k, pa.int64()), pa.array(n, pa.int32()), pa.array(at, pa.binary())]
    if more:
        names += ["edge", "run_docs"]
        arrays += [pa.array(more[0], pa.bool_()), pa.array(more[1], pa.int64())]
    return pa.RecordBatch.from_arrays(arrays, names)


def _stream(min_docs: int, keep_first: bool):
    """Rows that lose lines. edge: undecided, from a run that may go on in a neighbour; run_docs: the
    documents of that run in this partition, on the first of its rows."""

    def go(batches):
        out: list[tuple] = []
        run, count, held, edge = None, 0, [], True

        def close(edge: bool):
            if edge:
                out.extend((*r, True, 0 if n else count) for n, r in enumerate(held))
            elif count >= min_docs:
                for n, (*names, at) in enumerate(held):
                    out.append((*names, at[4:] if keep_first and n == 0 else at, False, 0))

        for b in batches:
            for row in zip(*(b[c].to_pylist() for c in ("hash", "doc_id", "text_key", "n_lines", "positions"))):
                if row[0] != run:
                    if run is not None:
                        close(edge)
                        edge = False
                    run, count, held = row[0], 0, []
                count += 1
                if count <= min_docs:
                    held.append(row)
                else:
                    out.append((*row, False, 0))
            if len(out) >= _BATCH:
                yield _batch(*zip(*out))
                out.clear()
        if run is not None:
            close(True)
        if out:
            yield _batch(*zip(*out))

    return go


def _bitmaps(batches):
    for b in batches:
        maps, dropped = [], []
        for n, parts in zip(b["n_lines"].to_pylist(), b["parts"].to_pylist()):
            keep = np.ones(n, dtype=bool)
            keep[np.frombuffer(b"".join(parts), dtype="<u4")] = False
            maps.append(zlib.compress(np.packbits(keep).tobytes()))
            dropped.append(int(n - keep.sum()))
        yield pa.RecordBatch.from_arrays(
            [b["doc_id"], b["text_key"], b["n_lines"], pa.array(dropped, pa.int64()), pa.array(maps, pa.binary())],
            ["doc_id", "text_key", "n_lines", "n_dropped", "keep_bitmap"],
        )


def keep_bitmaps(docs: DataFrame, min_docs: int = 10, keep_first: bool = False) -> DataFrame:
    """(doc_id, text_key, n_lines, n_dropped, keep_bitmap) of the documents that lose lines.

    A key (line without whitespace at its ends, A-Z in lower case, not empty) found in ``min_docs`` rows or
    more loses all its lines, or all but the first by (doc_id, position) with ``keep_first``. Each row counts
    as a document, repeated ones too; a null id sorts first. ``keep_bitmap`` has a bit per line, zlib-packed.
    """
    keys = records(docs).select("doc_id", "text_key", "text").mapInArrow(_keys, _KEYS)
    order = ("hash", "doc_id", "text_key")
    ranged = keys.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = saved(ranged.mapInArrow(_stream(min_docs, keep_first), _KEYS + ", edge boolean, run_docs long"))
    edge = rows.where("edge")
    total = edge.groupBy("hash").agg(
        F.sum("run_docs").alias("docs"), F.min(F.struct("doc_id", "text_key")).alias("first")
    ).where(F.col("docs") >= min_docs)
    at = F.col("positions")
    if keep_first:
        is_first = F.struct("doc_id", "text_key").eqNullSafe(F.col("first"))
        at = F.when(is_first, F.expr("substring(positions, 5)")).otherwise(at)
    columns = ["doc_id", "text_key", "n_lines", "positions"]
    lost = rows.where("NOT edge").select(columns).unionByName(edge.join(total, "hash").withColumn("positions", at).select(columns))
    return (
        lost.where(F.length("positions") > 0).groupBy("doc_id", "text_key")
        .agg(F.max("n_lines").alias("n_lines"), F.collect_list("positions").alias("parts"))
        .mapInArrow(_bitmaps, "doc_id long, text_key long, n_lines int, n_dropped long, keep_bitmap binary")
    )


def _apply(batches):
    for b in batches:
        kept, lines, dropped = [], [], []
        for t, packed in zip(b["text"], b["keep_bitmap"].to_pylist()):
            raw = t.as_buffer().to_pybytes()
            if packed is not None:
                parts = raw.split(b"\n")
                keep = np.unpackbits(np.frombuffer(zlib.decompress(packed), dtype=np.uint8), count=len(parts))
                stay = [x for x, k in zip(parts, keep) if k]
                raw, n, lost = b"\n".join(stay), len(parts), len(parts) - len(stay)
            else:
                n, lost = raw.count(b"\n") + 1, 0
            kept.append(raw.decode())
            lines.append(n)
            dropped.append(lost)
        yield pa.RecordBatch.from_arrays(
            [b["rec"], pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.string())],
            ["rec", "n_lines", "n_dropped", "kept_text"],
        )


def drop_common_lines(docs: DataFrame, min_docs: int = 10, keep_first: bool = False) -> DataFrame:
    """(rec, n_lines, n_dropped, kept_text) for every input row; ``rec`` holds all its columns.

    Null and empty texts are one empty line and stay empty. Lines that stay are joined by a line feed, so a
    document may become empty. Repeated rows each count and each come out. Empty input gives no rows.
    """
    rows = records(docs)
    maps = keep_bitmaps(docs, min_docs, keep_first).select("doc_id", "text_key", "keep_bitmap")
    joined = rows.join(maps, same(rows, maps, "doc_id", "text_key"), "left").select(rows["rec"], rows["text"], "keep_bitmap")
    schema = joined.select("rec", F.lit(0).cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_dropped"),
                           F.col("text").alias("kept_text")).schema
    return joined.mapInArrow(_apply, schema)


def op5_line_dedup(spark, sf_dir) -> DataFrame:
    """One row per document; null and empty texts and repeated rows as in ``drop_common_lines``."""
    return drop_common_lines(documents(spark, sf_dir)).select(
        F.col("rec.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )
