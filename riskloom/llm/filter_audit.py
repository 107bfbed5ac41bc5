"""Filter interaction audit by a Gray-code walk over all sets of filters.

One pass turns every document into a mask of the filters that it fails; documents count up to cells (part, mask).
For each part a walk visits the sets of filters in Gray-code order, so that a step switches one filter. Every cell
has a counter of the switched-on filters it fails; a cell whose counter leaves or reaches zero leaves or joins the
running survivors. The survivors of each set are stored, and each step of each order of filters is a difference of
two of them: no order is ever replayed over documents.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.bytehash import mix, prefixes, substring
from riskloom.llm.common import documents, saved, text_of
from riskloom.llm.shingles import chunks

#: A, B, C, D and E, with the bit of each in a mask.
FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_UPPER_PERCENT, SYMBOLS = 200, 50, 2, "#$%&*|"
#: What is counted of the documents of a cell: all, good ones, toxic ones.
MEASURES = ["n", "good", "toxic"]

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in SYMBOLS]] = True


def _per_text(flags: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many of ``flags`` lie in each text; ``ends`` begins with 0."""
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[ends[1:]] - total[ends[:-1]]


def text_masks(texts: list[bytes]) -> np.ndarray:
    """Bits of the filters A to D that each UTF-8 text fails. Distinct words are told apart by 64-bit hashes."""
    out = []
    for _, part in chunks(texts):
        data = np.frombuffer(b" ".join(part) + b" ", dtype=np.uint8)
        ends = np.concatenate(([0], np.cumsum([len(t) + 1 for t in part])))
        space = _SPACE[data]
        before = np.concatenate(([True], space[:-1]))
        start, stop = np.flatnonzero(~space & before), np.flatnonzero(space & ~before)
        at = np.searchsorted(ends, start, side="right") - 1
        words = np.bincount(at, minlength=len(part))
        names = mix(substring(prefixes(data), start, stop))
        order = np.lexsort((names, at))
        new = np.ones(len(order), dtype=bool)
        new[1:] = (names[order][1:] != names[order][:-1]) | (at[order][1:] != at[order][:-1])
        distinct = np.bincount(at[order][new], minlength=len(part))
        points = _per_text((data & 0xC0) != 0x80, ends) - 1  # without the separator
        upper = _per_text((data >= 65) & (data <= 90), ends)
        symbols = _per_text(_SYMBOL[data], ends)
        failed = [words < MIN_WORDS, 100 * distinct < MIN_DISTINCT_PERCENT * words, 100 * upper > MAX_UPPER_PERCENT * points, symbols > 0]
        out.append(sum(f.astype(np.int32) << n for n, f in enumerate(failed)))
    return np.concatenate(out) if out else np.zeros(0, dtype=np.int32)


def _masks(batches):
    for b in batches:
        texts = [t.as_buffer().to_pybytes() for t in b["text"]]
        yield pa.RecordBatch.from_arrays(
            [b["doc_id"], b["part"], b["text_key"], pa.array(text_masks(texts), pa.int32())], ["doc_id", "part", "text_key", "mask"]
        )


def failure_cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part by the set of filters that they fail.

    The part is ``source``, null as an empty string. A null text is empty. Texts are compared by SHA-256. A document
    fails E when a smaller id has its text; rows that repeat an id do not fail each other, and rows without an id fail
    nobody, do not fail E and have no labels. A document is good or toxic when any label row of its id says so.
    """
    text = text_of()
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.sha2(text, 256).alias("text_key"), text.alias("text"),
    ).mapInArrow(_masks, "doc_id long, part string, text_key string, mask int")
    # Repeated rows become one with a count before anything is shuffled by id.
    slim = saved(rows.groupBy("doc_id", "part", "text_key", "mask").agg(F.count("*").alias("n")))
    named = slim.where("doc_id IS NOT NULL")
    # A group of copies is only ever reduced to its least id; the id is in the join's key, so no group meets in a task.
    first = named.groupBy("text_key").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "text_key", F.lit(0).alias("again"))
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")
    ).where("good + toxic > 0")
    known = named.join(first, ["doc_id", "text_key"], "left").join(marks, "doc_id", "left")
    copy_bit = 1 << FILTERS.index("E")
    known = known.select("part", (F.col("mask") + F.coalesce("again", F.lit(copy_bit))).alias("mask"), "n", "good", "toxic")
    nameless = slim.where("doc_id IS NULL").select("part", "mask", "n", F.lit(0).alias("good"), F.lit(0).alias("toxic"))
    return known.unionByName(nameless).groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        *[F.sum(F.col("n") * F.coalesce(m, F.lit(0))).alias(m) for m in ("good", "toxic")],
    )


def survivors(masks: np.ndarray, counts: np.ndarray, filters: int) -> np.ndarray:
    """``counts`` (cells x measures) summed over the cells that pass each set of filters: one row per set."""
    states = np.zeros((1 << filters, counts.shape[1]), dtype=np.int64)
    running, failing, on = counts.sum(axis=0), np.zeros(len(masks), dtype=np.int64), 0
    states[0] = running
    for step in range(1, 1 << filters):
        switched = (step & -step).bit_length() - 1  # the bit in which Gray codes step and step - 1 differ
        hit = (masks >> switched & 1).astype(bool)
        on ^= 1 << switched
        if on >> switched & 1:
            running = running - counts[hit & (failing == 0)].sum(axis=0)
            failing[hit] += 1
        else:
            failing[hit] -= 1
            running = running + counts[hit & (failing == 0)].sum(axis=0)
        states[on] = running
    return states


def _audit(filters: str):
    size, everything = len(filters), (1 << len(filters)) - 1
    names = ["filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]

    def go(table: pa.Table) -> pa.Table:
        counts = np.stack([table[m].to_numpy() for m in MEASURES], axis=1).astype(np.int64)
        left = survivors(table["mask"].to_numpy().astype(np.int64), counts, size)
        n = left[:, 0]
        failing = [int(n[0] - n[1 << f]) for f in range(size)]
        alone = [int(n[everything ^ (1 << f)] - n[everything]) for f in range(size)]
        value = [
            sum(
                math.factorial(s.bit_count()) * math.factorial(size - 1 - s.bit_count()) * int(n[s] - n[s | 1 << f])
                for s in range(everything + 1) if not s >> f & 1
            )
            for f in range(size)
        ]
        out = []
        for order in itertools.permutations(range(size)):
            name, on = "".join(filters[f] for f in order), 0
            for step, f in enumerate(order, 1):
                lost = left[on] - left[on | 1 << f]
                on |= 1 << f
                out.append((name, step, n[on], lost[0], failing[f] - lost[0], alone[f], lost[1], lost[2], value[f]))
        columns = list(zip(*out))
        return pa.table(
            [pa.array([table["part"][0].as_py()] * len(out)), pa.array(columns[0]), pa.array(columns[1], pa.int32())]
            + [pa.array([int(v) for v in c], pa.int64()) for c in columns[2:]], names=["part", *names],
        )

    return go


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row per part, order of the five filters and step, with what that step keeps, removes and loses.

    Nulls, empty texts and repeated rows count as in ``failure_cells``; other columns are not looked at. A part has at
    most 32 cells, so a task holds little whatever the part's size. An empty table has no parts and gives no rows.
    """
    fields = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    schema = "part string, filter_order string, step int, " + ", ".join(f"{f} long" for f in fields)
    return failure_cells(docs, labels).groupBy("part").applyInArrow(_audit(FILTERS), schema)


def op12_filter_audit(spark, sf_dir) -> DataFrame:
    """Counts per source, order of filters and step; nulls, ties and repeated rows as in ``audit``."""
    return audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
