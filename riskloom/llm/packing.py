"""Best-fit packing planned over a histogram of lengths.

Documents become token ids once; ids longer than a sequence are cut so that only the first piece is short.
The plan works on counts per length (at most one per length, however many documents): best fit decreasing,
where all open sequences with the same free space are one entry with a count. It yields runs of slots
(length, first rank, last rank) -> (sequence, place). Pieces then take slots by joining on their rank
within the length. Ranks are counted in salted parts, so one length may hold any share of all pieces.
"""

from __future__ import annotations

import base64
import bisect
import json
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import documents, records, saved

SEQUENCE = 1024
END_ID = 2
#: Pieces that one salted part of a length holds on average at most.
PART_ROWS = 1_000


class ByteBpe:
    """The byte-level vocabulary of 50k tokens, with the ids of its json file; its rank file gives them faster.

    The added tokens of the json file are found in the text first, as its own coder does, and keep their ids.
    """

    def __init__(self):
        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
            added = json.load(f)["added_tokens"]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
            raise ValueError("an added token takes more than its own characters")
        self._coder = tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._added = {t["content"]: t["id"] for t in added}
        # Parts are coded one by one: what comes before a token ends there, so spaces at its end stay together.
        self._parts = re.compile("(" + "|".join(map(re.escape, sorted(self._added, key=len, reverse=True))) + ")")

    def encode(self, text: str) -> list[int]:
        parts = self._parts.split(text)
        if len(parts) == 1:
            return self._coder.encode_ordinary(text)
        return [i for p in parts for i in ((self._added[p],) if p in self._added else self._coder.encode_ordinary(p))]


def piece_bounds(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of each piece of n ids; all but the first are full."""
    head = n % size or min(n, size)
    return [(0, head), *((s, size) for s in range(head, n, size))]


def tokenize_pieces(docs: DataFrame, size: int = SEQUENCE, end_id: int = END_ID, with_ids: bool = False, coder=ByteBpe) -> DataFrame:
    """(doc_id, text_key, piece, start, length, ids_crc32[, ids]) per piece.

    A null text is empty and becomes the end id alone. ``ids``: little-endian unsigned 32-bit numbers.
    """

    def go(batches):
        encode = coder().encode
        for b in batches:
            out: list[list] = [[] for _ in range(7)]
            for i, k, text in zip(b["doc_id"].to_pylist(), b["text_key"].to_pylist(), b["text"].to_pylist()):
                ids = np.array([*encode(text), end_id], dtype="<u4")
                for n, (start, length) in enumerate(piece_bounds(len(ids), size)):
                    raw = ids[start : start + length].tobytes()
                    row = (i, k, n, start, length, zlib.crc32(raw), raw if with_ids else None)
                    for column, v in zip(out, row):
                        column.append(v)
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            names = ["doc_id", "text_key", "piece", "start", "length", "ids_crc32", "ids"]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, kinds)][: 6 + with_ids], names[: 6 + with_ids])

    schema = "doc_id long, text_key long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return records(docs).select("doc_id", "text_key", "text").mapInArrow(go, schema)


def plan(counts: dict[int, int], size: int = SEQUENCE) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit decreasing over counts. Runs (length, rank_from, rank_to, sequence, per, place): rank r in
    [rank_from, rank_to) goes to sequence + (r - rank_from) div per, at place + length * ((r - rank_from) mod per)."""
    runs: list[tuple[int, int, int, int, int, int]] = []
    free: dict[int, list[tuple[int, int]]] = {}  # free space -> (first sequence, number of them)
    spaces: list[int] = []
    fresh = 0

    def add(space: int, first: int, n: int) -> None:
        if space and n:
            if space not in free:
                bisect.insort(spaces, space)
            free.setdefault(space, []).append((first, n))

    def fill(length: int, rank: int, left: int, space: int, first: int, n: int) -> int:
        """Put up to `left` pieces into the n sequences; returns how many went in."""
        per = space // length
        took = min(left, n * per)
        runs.append((length, rank, rank + took, first, per, size - space))
        whole, rest = divmod(took, per)
        add(space - per * length, first, whole)
        if rest:
            add(space - rest * length, first + whole, 1)
            whole += 1
        add(space, first + whole, n - whole)
        return took

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect.bisect_left(spaces, length)
            if at < len(spaces):
                space = spaces[at]
                first, n = free[space].pop()
                if not free[space]:
                    del free[space], spaces[at]
            else:
                space, first, n = size, fresh, -(-left // (size // length))
                fresh += n
            took = fill(length, rank, left, space, first, n)
            rank, left = rank + took, left - took
    return runs


def pack_pieces(pieces: DataFrame, size: int = SEQUENCE) -> DataFrame:
    """Adds sequence_id and offset (long) to pieces with (doc_id, text_key, piece, length); other columns stay.

    Lengths lie in 1..size. Equal rows get different places. No pieces, no rows.
    """
    spark = pieces.sparkSession
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most `size` rows
    # At most a few runs a length, bounded by the number of lengths and not by the documents.
    runs = spark.createDataFrame(
        plan(counts, size) or [(0, 0, 0, 0, 1, 0)],
        "length long, rank_from long, rank_to long, first_sequence long, per long, place long",
    )
    parts = spark.createDataFrame([(k, -(-n // PART_ROWS)) for k, n in counts.items()] or [(0, 1)], "length long, _parts long")
    part = F.pmod(F.xxhash64("doc_id", "text_key", "piece"), F.col("_parts"))
    salted = pieces.join(F.broadcast(parts), "length").withColumn("_part", part)
    base = salted.groupBy("length", "_part").count().select(
        "length", "_part", (F.sum("count").over(Window.partitionBy("length").orderBy("_part")) - F.col("count")).alias("_base")
    )
    within = Window.partitionBy("length", "_part").orderBy("doc_id", "text_key", "piece")
    ranked = salted.withColumn("_rank", F.row_number().over(within) - 1).join(base, ["length", "_part"])
    ranked = ranked.withColumn("_rank", F.col("_rank") + F.col("_base"))
    slot = ranked.join(F.broadcast(runs), "length").where("_rank >= rank_from AND _rank < rank_to")
    step = F.col("_rank") - F.col("rank_from")
    return slot.select(
        *pieces.columns,
        (F.col("first_sequence") + F.floor(step / F.col("per")).cast("long")).alias("sequence_id"),
        (F.col("place") + F.col("length") * F.pmod(step, F.col("per"))).cast("long").alias("offset"),
    )


def pack_documents(docs: DataFrame, size: int = SEQUENCE, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Tokenize, cut and pack. Every piece of every row comes out once; sequences fill from place 0 without gaps."""
    return pack_pieces(saved(tokenize_pieces(docs, size, end_id, with_ids)), size)


def op4_packing(spark, sf_dir) -> DataFrame:
    """One row per piece of each document; null and empty texts, which have one id, as in ``pack_documents``."""
    return pack_documents(documents(spark, sf_dir)).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
