"""Suffix-array dedup of repeated byte strings.

A string of ``size`` bytes that occurs twice holds the same anchor at the same place both times: the smallest
hash among its runs of ``KEY`` bytes. So only suffixes that start at anchors are sorted, about one in 140, and of
these only those whose run of KEY bytes occurs elsewhere. Each carries the bytes a string around it can hold;
equal surroundings become one row with a count, so copies do not grow a group.

The suffixes of a bucket are sorted key by key on their bytes, of which each has at most ``size``, and how far
neighbours agree is read off rows of padded bytes, some thousand at a time, so that a task holds little more than
the surroundings themselves. The same is done leftwards. A string that reaches l bytes left of its anchor
occurs twice when two anchors agree on l bytes to the left and on size - l to the right: when they share a run
in both orders. A key with far more surroundings than a bucket holds on average is split: its reaches l are dealt
into blocks, all strings of a block share a core, and only what lies around equal cores is sorted, again in buckets.
A core with too many different windows around it is split the same way, down to single strings.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.bytehash import mix, prefixes, substring
from riskloom.llm.common import documents, records, release, same, saved, text_of

SIZE = 400
KEY = 128
#: Long texts are scanned in pieces of this many bytes that overlap by a string.
PIECE = 1 << 22
#: Anchors of one bucket on average at most.
BUCKET_ANCHORS = 20_000
#: A key is split when it has more surroundings than so many average buckets and than LARGE_KEY, or more than HOT_KEY.
UNEVEN = 3
LARGE_KEY = 250
HOT_KEY = 50_000
#: Blocks of reaches into which a key is split.
FAN = 13
#: Neighbours whose bytes are compared together.
STEP_ROWS = 4096
_PLACE = np.uint64((1 << 24) - 1)


def anchors(data: np.ndarray, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes of the KEY bytes there): of each string the leftmost run with the smallest hash."""
    if len(data) < size:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    step, places, keys = PIECE - size + 1, [], []
    for a in range(0, len(data) - size + 1, step):
        part = data[a : a + PIECE]
        start = np.arange(len(part) - KEY + 1)
        h = mix(substring(prefixes(part), start, start + KEY))
        rank = (h & ~_PLACE) | start.astype(np.uint64)
        w = size - KEY + 1
        pad = np.concatenate((rank, np.full(-len(rank) % w, ~np.uint64(0), dtype=np.uint64))).reshape(-1, w)
        right = np.minimum.accumulate(pad, axis=1).ravel()
        left = np.minimum.accumulate(pad[:, ::-1], axis=1)[:, ::-1].ravel()
        n = len(part) - size + 1
        at = np.unique((np.minimum(left[:n], right[w - 1 : w - 1 + n]) & _PLACE).astype(np.int64))
        places.append(at + a)
        keys.append(h[at])
    places, keys = np.concatenate(places), np.concatenate(keys)
    places, first = np.unique(places, return_index=True)
    return places, keys[first]


def _raw(column) -> list[bytes]:
    return [t.as_buffer().to_pybytes() for t in column]


def _anchor_rows(size: int):
    def go(batches):
        for b in batches:
            found = [anchors(np.frombuffer(t, dtype=np.uint8), size) for t in _raw(b["text"])]
            n = [len(p) for p, _ in found]
            take = pa.array(np.repeat(np.arange(len(n)), n))
            if sum(n):
                yield pa.RecordBatch.from_arrays([
                    b["doc_id"].take(take), b["text_key"].take(take),
                    pa.array(np.concatenate([k for _, k in found]).view(np.int64)), pa.array(np.concatenate([p for p, _ in found])),
                ], ["doc_id", "text_key", "key", "place"])

    return go


def _surroundings(size: int):
    def go(batches):
        seen: dict[bytes, int] = {}  # names of this task: copies cost a name, not their bytes
        for b in batches:
            out: list[list] = [[] for _ in range(10)]
            for i, k, text, spots in zip(b["doc_id"].to_pylist(), b["text_key"].to_pylist(), _raw(b["text"]), b["spots"].to_pylist()):
                for s in spots:
                    p = s["place"]
                    left, right = text[max(0, p - size + KEY) : p], text[p : p + size]
                    name = hashlib.blake2b(left + right, digest_size=16, salt=len(left).to_bytes(8, "little")).digest()
                    seen[name] = before = seen.get(name, 0) + 1
                    first = before == 1
                    row = (i, k, s["key"], p, name, left if first else None, right if first else None, len(left), len(right), before <= 2)
                    for column, v in zip(out, row):
                        column.append(v)
                if len(out[0]) >= 20_000:
                    yield _surrounding(out)
                    out = [[] for _ in range(10)]
            yield _surrounding(out)

    return go


def _surrounding(out):
    kinds = [pa.int64()] * 4 + [pa.binary()] * 3 + [pa.int32()] * 2 + [pa.bool_()]
    names = ["doc_id", "text_key", "key", "place", "name", "left", "right", "la", "ra", "shown"]
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, kinds)], names)


class Suffixes:
    """Suffixes of one byte array, each with a length, compared by their bytes."""

    def __init__(self, data: np.ndarray, at: np.ndarray, length: np.ndarray):
        raw = data.tobytes()
        self.parts, self.length = [raw[a : a + n] for a, n in zip(at.tolist(), length.tolist())], length

    def sorted_runs(self, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(order, agreement with the suffix before, 0 for the first of a group); groups are given sorted."""
        n, order = len(group), []
        first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        for a, b in zip(first.tolist(), [*first[1:].tolist(), n]):
            order += sorted(range(a, b), key=self.parts.__getitem__)
        agree = np.zeros(n, dtype=np.int64)
        for a in range(0, n - 1, STEP_ROWS):
            agree[a + 1 : a + STEP_ROWS + 1] = self._agreements(order[a : a + STEP_ROWS + 1])
        agree[first] = 0
        return np.array(order, dtype=np.int64), agree

    def _agreements(self, order: list[int]) -> np.ndarray:
        """Longest common prefix of each of a few suffixes with the one before."""
        length = self.length[order]
        width = max(1, int(length.max()))
        rows = np.array([self.parts[k] for k in order], dtype=f"S{width}").view(np.uint8).reshape(-1, width)
        differ = rows[1:] != rows[:-1]
        shared = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        return np.minimum(shared, np.minimum(length[1:], length[:-1]))


def _reaches(size: int, furthest: int | None = None):
    """Per surrounding the least and the greatest reach left of its anchor of a string that occurs twice."""
    furthest = size - KEY if furthest is None else furthest

    def go(table: pa.Table) -> pa.Table:
        table = table.sort_by("key")
        key, many = (table[c].to_numpy() for c in ("key", "many"))
        left, right, name = (table[c].to_pylist() for c in ("left", "right", "name"))
        n, la, ra = len(key), np.array([len(x) for x in left]), np.array([len(x) for x in right])
        group = np.cumsum(np.concatenate(([0], (key[1:] != key[:-1]).astype(np.int64))))
        data = np.frombuffer(b"".join(x + y for x, y in zip(left, right)), dtype=np.uint8)
        at = np.concatenate(([0], np.cumsum(la + ra)[:-1])) + la
        orders = [Suffixes(data, at, ra).sorted_runs(group), Suffixes(data[::-1], len(data) - at, la).sorted_runs(group)]
        least, most = np.full(n, -1), np.full(n, -1)
        new = np.concatenate(([True], group[1:] != group[:-1]))  # each order keeps the groups in place
        for reach in range(furthest + 1):
            runs = []
            for (order, agree), need in zip(orders, (size - reach, reach)):
                run = np.empty(n, dtype=np.int64)
                run[order] = np.cumsum(new | (agree < need))
                runs.append(run)
            fits = np.flatnonzero((la >= reach) & (ra >= size - reach))
            if not len(fits):
                continue
            _, inverse, count = np.unique(runs[0][fits] * (n + 1) + runs[1][fits], return_inverse=True, return_counts=True)
            twice = fits[(count[inverse] > 1) | many[fits]]
            least[twice] = np.where(least[twice] < 0, reach, least[twice])
            most[twice] = reach
        keep = np.flatnonzero(most >= 0)
        return pa.table({
            "key": pa.array(key[keep], table.schema.field("key").type), "name": pa.array([name[k] for k in keep], pa.binary()),
            "least": pa.array(least[keep].astype(np.int32)), "most": pa.array(most[keep].astype(np.int32)),
        })

    return go


def _blocks(furthest: int) -> tuple[list[int], int]:
    """(first reach of each block, reaches after it): blocks of one width, of which the last may overlap."""
    span = -(-(furthest + 1) // FAN) - 1
    return sorted({min(low, furthest - span) for low in range(0, furthest + 1, span + 1)}), span


def _windows(size: int, furthest: int):
    """Per surrounding and block of reaches the core that all strings of the block hold and the bytes around it."""
    lows, span = _blocks(furthest)

    def go(batches):
        for b in batches:
            out: list[list] = [[] for _ in range(8)]
            for k, name, left, right, n in zip(*(b[c].to_pylist() for c in ("key", "name", "left", "right", "n"))):
                head, la = k if isinstance(k, bytes) else k.to_bytes(8, "little", signed=True), len(left)
                for low in lows:
                    inner = size - low - span  # bytes of the core right of the anchor
                    if la < low or len(right) < inner:
                        continue
                    x, y = left[max(0, la - low - span) : la - low], right[inner : inner + span]
                    if len(x) + len(y) < span:
                        continue
                    core = hashlib.blake2b(head + low.to_bytes(4, "little") + left[la - low :] + right[:inner], digest_size=16).digest()
                    window = hashlib.blake2b(core + len(x).to_bytes(4, "little") + x + y, digest_size=16).digest()
                    for column, v in zip(out, (k, name, low, core, window, x, y, n)):
                        column.append(v)
            kinds = [b.schema.field("key").type, pa.binary(), pa.int32(), *[pa.binary()] * 4, pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, kinds)], ["key", "name", "low", "core", "window", "left", "right", "n"])

    return go


def _found(rows: DataFrame, size: int, furthest: int) -> DataFrame:
    """(key, name, least, most) of the surroundings with a string that occurs twice.

    ``rows`` has (key, name, left, right, n): n occurrences of a named surrounding, at least one row with its bytes.
    """
    per_key = rows.select("key", "name").distinct().groupBy("key").agg(F.count("*").alias("kinds"))
    total, top = (x or 0 for x in per_key.agg(F.sum("kinds"), F.max("kinds")).first())
    buckets = max(256, -(-total // BUCKET_ANCHORS))
    limit, split = min(HOT_KEY, max(LARGE_KEY, UNEVEN * total // buckets)), None
    if furthest and top > limit:
        large = saved(per_key.where(F.col("kinds") > limit).select("key"))  # at most one key for ``limit`` surroundings
        split = _split(rows.join(F.broadcast(large), "key"), size, furthest)
        rows = rows.join(F.broadcast(large), "key", "left_anti")
    # Equal surroundings become one row before a task takes its bucket; both need the same exchange.
    one = rows.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets))).repartition("bucket").groupBy("bucket", "key", "name").agg(
        F.first("left", True).alias("left"), F.first("right", True).alias("right"), (F.sum("n") > 1).alias("many")
    )
    found = one.groupBy("bucket").applyInArrow(_reaches(size, furthest), f"key {rows.schema['key'].dataType.simpleString()}, name binary, least int, most int")
    return found if split is None else found.unionByName(split)


def _split(rows: DataFrame, size: int, furthest: int) -> DataFrame:
    """``_found`` for keys too large for a bucket: block by block of reaches, over different windows around equal cores."""
    _, span = _blocks(furthest)
    whole = (F.first("left", True).alias("left"), F.first("right", True).alias("right"), F.sum("n").alias("n"))
    kind = rows.schema["key"].dataType.simpleString()
    parts = saved(rows.groupBy("key", "name").agg(*whole).mapInArrow(
        _windows(size, furthest), f"key {kind}, name binary, low int, core binary, window binary, left binary, right binary, n long"
    ))
    windows = saved(parts.groupBy(F.col("core").alias("key"), F.col("window").alias("name")).agg(*whole))
    # A table of its own, so that adaptive execution can split a hot window in the join.
    found = saved(_found(windows, span, span).select(F.col("key").alias("core"), F.col("name").alias("window"), "least", "most"))
    out = saved(parts.join(found, ["core", "window"]).groupBy("key", "name").agg(
        F.min(F.col("low") + F.col("least")).alias("least"), F.max(F.col("low") + F.col("most")).alias("most")
    ))
    for table in (parts, windows, found):
        release(table)
    return out


def repeated_spans(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """(doc_id, text_key, start, stop): byte ranges whose union is what repeated strings cover."""
    rows = records(docs).select("doc_id", "text_key", "text")
    all_anchors = saved(rows.mapInArrow(_anchor_rows(size), "doc_id long, text_key long, key long, place long"))
    # A table of its own, so that the join has exchanges of its own and adaptive execution can split a hot key.
    twice = saved(all_anchors.groupBy("key").count().where("count > 1").select("key"))
    spots = all_anchors.join(twice, "key").groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("key", "place")).alias("spots"))
    around = rows.join(spots, same(rows, spots, "doc_id", "text_key")).select(rows["doc_id"], rows["text_key"], "text", "spots").mapInArrow(
        _surroundings(size),
        "doc_id long, text_key long, key long, place long, name binary, left binary, right binary, la int, ra int, shown boolean",
    )
    around = saved(around)
    release(all_anchors)
    # At most two rows of a name from each task, one of them with the bytes.
    found = _found(around.where("shown").select("key", "name", "left", "right", F.lit(1).alias("n")), size, size - KEY)
    names = around.select("doc_id", "text_key", "key", "place", "name")
    spans = saved(names.join(found, ["key", "name"]).select(
        "doc_id", "text_key", (F.col("place") - F.col("most")).alias("start"), (F.col("place") - F.col("least") + size).alias("stop")
    ))
    release(around)
    release(twice)
    return spans


def _remove(batches):
    for b in batches:
        sizes, removed, spans, kept = [], [], [], []
        for text, found in zip(_raw(b["text"]), b["spans"].to_pylist()):
            runs: list[list[int]] = []
            for s in sorted((x["start"], x["stop"]) for x in found or []):
                if runs and s[0] <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], s[1])
                else:
                    runs.append(list(s))
            edges = [0, *(x for r in runs for x in r), len(text)]
            kept.append(b"".join(text[x:y] for x, y in zip(edges[::2], edges[1::2])))
            sizes.append(len(text))
            removed.append(len(text) - len(kept[-1]))
            spans.append(len(runs))
        yield pa.RecordBatch.from_arrays(
            [b["rec"], *[pa.array(x, pa.int64()) for x in (sizes, removed, spans)], pa.array(kept, pa.binary())],
            ["rec", "n_bytes", "n_removed", "n_spans", "kept"],
        )


def remove_repeats(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """(rec, n_bytes, n_removed, n_spans, kept) for every input row; ``rec`` holds all its columns.

    Each byte that lies in a string of ``size`` bytes which also starts anywhere else, in the same text or in
    another row's, is removed; ``kept`` has the others, as bytes. Texts shorter than ``size``, empty and null
    ones stay whole. Equal rows are occurrences of their own. Strings never cross rows.
    """
    spans = repeated_spans(docs, size).groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    rows = records(docs).drop("text")  # the text travels once, in ``rec``
    joined = rows.join(spans, same(rows, spans, "doc_id", "text_key"), "left").select("rec", text_of("rec.text").alias("text"), "spans")
    schema = joined.select(
        "rec", *[F.lit(0).cast("long").alias(c) for c in ("n_bytes", "n_removed", "n_spans")], F.col("text").cast("binary").alias("kept")
    ).schema
    return joined.mapInArrow(_remove, schema)


def op1_suffix_dedup(spark, sf_dir) -> DataFrame:
    """One row per document; nulls, short and repeated texts as in ``remove_repeats``."""
    return remove_repeats(documents(spark, sf_dir)).select(
        F.col("rec.doc_id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )
