"""Toxicity by nearest labelled examples under exact TF-IDF cosine.

Terms are words and the first four letters of words, named by 64-bit hashes. The vocabulary is every term of a bounded number of labelled
examples; every document becomes a sparse vector of counts over it in one pass, and inverse document frequencies
count all documents. A document's terms outside the vocabulary meet no example: they would divide all its cosines
by one number, which changes neither their order nor the votes, so only they are left out.
The index holds the examples in blocks of similar ones. Rare terms have postings and add up exactly for all
examples; for common terms the largest weight of each block bounds what they add. Blocks are read from the highest
bound down until no bound exceeds the k-th best cosine, which leaves the exact k nearest. Their votes, weighted by
closeness, pass a monotone calibration fitted on examples kept aside.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.bytehash import mix, prefixes, substring
from riskloom.llm.common import documents, records, saved

#: Labelled examples used at most, half of them toxic where there are enough; a fifth of them calibrates.
EXAMPLES = 8_000
NEAREST = 15
BLOCK = 32
#: Blocks that are read together between two looks at the bound.
STEP_BLOCKS = 12
#: Terms that a sixteenth of the examples hold, this many at most, lie in full rows; how a term lies changes no cosine.
COMMON = 512
_WORD = re.compile(r"[^\W\d_]+")


def terms(text: str) -> Counter:
    words = Counter(_WORD.findall(text.lower()))
    out = Counter(words)
    for w, n in words.items():
        if len(w) > 4:
            out["^" + w[:4]] += n
    return out


#: Texts are cut into words together up to about this many characters; a longer one is worked on alone.
CHUNK_CHARS = 1 << 19
_STEM = np.uint64(0x9E3779B97F4A7C15)
_tables: list[np.ndarray] = []


def _word_characters() -> np.ndarray:
    """For each code point whether ``_WORD`` takes it."""
    if not _tables:
        _tables.append(np.array([c.isalnum() and not c.isdecimal() for c in map(chr, range(0x110000))]))
    return _tables[0]


def hashed_terms(texts: list[str]):
    """For many texts at once: (text of each term occurrence, hash of the term), as ``terms`` counts them."""
    held, size, first = [], 0, 0
    for n, t in enumerate([*texts, None]):
        if t is None or (held and size + len(t) > CHUNK_CHARS):
            if held:
                owner, term = _hashed(held)
                yield owner + first, term
            held, size, first = [], 0, n
        if t is not None:
            held.append(t.lower())
            size += len(held[-1])


def _hashed(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    inside = _word_characters()[data]
    before = np.concatenate(([False], inside[:-1]))
    start, stop = np.flatnonzero(inside & ~before), np.flatnonzero(~inside & before)
    owner = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), start, side="right")
    p, size = prefixes(data), stop - start
    long = size > 4
    words = mix(substring(p, start, stop) + size.astype(np.uint64))
    stems = mix(substring(p, start[long], start[long] + 4) ^ _STEM)
    return np.concatenate((owner, owner[long])), np.concatenate((words, stems))


def learnable(doc_id):
    """Rows whose id's checksum leaves no remainder by five are held out from learning."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0


def choose_examples(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES) -> DataFrame:
    """(doc_id, text_key, text, toxic, aside): at most about ``examples`` labelled rows, chosen by hash per class."""
    known = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").where(learnable(F.col("doc_id"))).groupBy(
        F.col("doc_id").cast("long").alias("doc_id")
    ).agg(F.max("toxic").cast("int").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    place = F.pmod(F.xxhash64("doc_id", F.lit("example")), F.lit(1_000_000))
    chosen = known.where("false")
    for label, n in counts.items():
        chosen = chosen.unionByName(known.where((F.col("toxic") == label) & (place < int(1_000_000 * min(1.0, examples / 2 / n)))))
    # About `examples` pairs of numbers: a bounded broadcast.
    aside = (F.pmod(F.xxhash64("doc_id", F.lit("aside")), F.lit(5)) == 0).alias("aside")
    return records(docs).drop("rec").join(F.broadcast(chosen), "doc_id").select("doc_id", "text_key", "text", "toxic", aside)


def _terms_only(batches):
    for b in batches:
        found = [np.unique(term) for _, term in hashed_terms(b["text"].to_pylist())]
        found = np.unique(np.concatenate(found)) if found else np.zeros(0, dtype=np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], ["term"])


def choose_terms(examples: DataFrame) -> np.ndarray:
    """The hash of every term of the examples, in order; none unless both classes are there."""
    if examples.select("toxic").distinct().count() < 2:
        return np.zeros(0, dtype=np.uint64)
    found = examples.select("text").mapInArrow(_terms_only, "term long").distinct().toArrow()["term"].to_numpy()
    return np.sort(found.view(np.uint64))


def pack(at: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted terms and their counts as bytes: gaps and counts, byte by byte of all, deflated. Nothing for no terms."""
    if not len(at):
        return b""
    v = np.stack((np.diff(at, prepend=0), counts), axis=1).astype("<u4")
    return zlib.compress(np.ascontiguousarray(v.view(np.uint8).T).tobytes(), 1)


def unpack(vector: bytes) -> tuple[np.ndarray, np.ndarray]:
    if not vector:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    v = np.ascontiguousarray(np.frombuffer(zlib.decompress(vector), dtype=np.uint8).reshape(8, -1).T).view("<u4").astype(np.int64)
    return np.cumsum(v[:, 0]), v[:, 1]


def _vectors(vocabulary):
    """``vocabulary``: a broadcast of the terms' hashes, in order."""

    def go(batches):
        known = vocabulary.value
        for b in batches:
            texts = b["text"].to_pylist()
            out = [b""] * len(texts)
            for owner, term in hashed_terms(texts):
                at = np.minimum(np.searchsorted(known, term), len(known) - 1) if len(known) else np.zeros(len(term), np.int64)
                hit = known[at] == term if len(known) else np.zeros(len(term), bool)
                pairs, counts = np.unique(owner[hit] << 32 | at[hit], return_counts=True)
                who = pairs >> 32
                cut = np.flatnonzero(np.diff(who, prepend=-1))
                for x, y in zip(cut.tolist(), [*cut[1:].tolist(), len(who)]):
                    out[int(who[x])] = pack(pairs[x:y] & 0xFFFFFFFF, counts[x:y])
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["text_key"], pa.array(out, pa.binary())], ["doc_id", "text_key", "vector"])

    return go


def _document_counts(size: int):
    def go(batches):
        n, counts = 0, np.zeros(size, dtype=np.int64)
        for b in batches:
            for v in b["vector"].to_pylist():
                counts[unpack(v)[0]] += 1
                n += 1
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(counts[at], n))], ["term", "docs"])

    return go


def weigh(vector: bytes, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(terms, weights) of unit length."""
    at, n = unpack(vector)
    w = n * idf[at]
    return at, w / (np.sqrt((w * w).sum()) or 1)


class BlockMaxIndex:
    """Exact k nearest by cosine among examples with at least one term."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], ids: list[int], labels: list[int], size: int, k: int = NEAREST):
        held = [i for i, v in enumerate(vectors) if len(v[0])]
        self.k, n = k, len(held)
        counts = np.bincount(np.concatenate([vectors[i][0] for i in held]), minlength=size) if n else np.zeros(size, dtype=np.int64)
        common = np.argsort(-counts, kind="stable")[:COMMON]
        common = common[counts[common] * 16 > n]
        self.column = np.full(size, -1, dtype=np.int64)
        self.column[common] = np.arange(len(common))

        def kind(i):  # the common term that weighs most
            at, w = vectors[i]
            c = self.column[at]
            return int(c[np.argmax(np.where(c >= 0, w, -1.0))])

        order = sorted(held, key=lambda i: (kind(i), labels[i], i))
        blocks = -(-n // BLOCK)
        full = np.zeros((blocks * BLOCK, len(common)), dtype=np.float32)
        rest = []
        for r, i in enumerate(order):
            at, w = vectors[i]
            c = self.column[at]
            full[r, c[c >= 0]] = w[c >= 0]
            rest.append((at[c < 0], np.full(int((c < 0).sum()), r, dtype=np.int32), w[c < 0].astype(np.float32)))
        self.labels = np.zeros(len(full), dtype=np.int64)
        self.ids = np.full(len(full), -1, dtype=np.int64)
        self.labels[:n], self.ids[:n] = [labels[i] for i in order], [ids[i] for i in order]
        # A row for each block and common term: a query reads the terms it has.
        self.peak = full.reshape(blocks, BLOCK, len(common)).max(axis=1)
        self.rows = np.ascontiguousarray(full.reshape(blocks, BLOCK, len(common)).transpose(0, 2, 1)).reshape(-1, BLOCK)
        # Postings of the other terms, one after the other: rows and weights from start[t] to start[t + 1].
        at, row, w = (np.concatenate(x) for x in zip(*rest)) if rest else (np.zeros(0, dtype=np.int64),) * 3
        by = np.argsort(at, kind="stable")
        self.start = np.append(0, np.cumsum(np.bincount(at, minlength=size)))
        self.posting, self.weight = row[by], w[by]

    def nearest(self, at: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions, cosines) of the k nearest with a cosine above zero, nearest first; ties by position."""
        c = self.column[at]
        here, own = c[c >= 0], weight[c >= 0].astype(np.float32)
        query = np.zeros(self.peak.shape[1], dtype=np.float32)
        query[here] = own
        rare, w = at[c < 0], weight[c < 0]
        first, n = self.start[rare], self.start[rare + 1] - self.start[rare]
        taken = np.repeat(first - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        known = np.bincount(self.posting.take(taken), self.weight.take(taken) * np.repeat(w, n), minlength=len(self.ids)).reshape(-1, BLOCK)
        bound = known.max(axis=1) + self.peak @ query
        order = np.argsort(-bound, kind="stable")
        order = order[: int(np.count_nonzero(bound > 0))]
        pos, cos, done, least = np.zeros(0, dtype=np.int64), np.zeros(0), 0, -np.inf
        while done < len(order) and bound[order[done]] + 1e-5 >= least:
            part = order[done : done + STEP_BLOCKS]
            read = self.rows.take((part[:, None] * len(query) + here).ravel(), axis=0).reshape(len(part), len(here), BLOCK)
            got = (known[part] + own @ read).ravel()
            near = np.flatnonzero(got >= least)
            pos = np.concatenate((pos, part[near // BLOCK] * BLOCK + near % BLOCK))
            cos = np.concatenate((cos, got[near]))
            if len(cos) >= self.k:
                least = np.partition(cos, len(cos) - self.k)[len(cos) - self.k]
                keep = cos >= least  # ties with the last one stay until the end
                pos, cos = pos[keep], cos[keep]
            done += STEP_BLOCKS
        best = np.lexsort((pos, -cos))[: self.k]
        best = best[cos[best] > 0]
        return pos[best], cos[best]

    def vote(self, at: np.ndarray, weight: np.ndarray) -> tuple[float | None, list[int]]:
        pos, cos = self.nearest(at, weight)
        if not len(pos):
            return None, []
        near = cos * cos
        return float((near * self.labels[pos]).sum() / near.sum()), self.ids[pos].tolist()


def monotone(votes: list[float], labels: list[int], weights: list[float]) -> tuple[list[float], list[float]]:
    """Pool-adjacent-violators: (lowest vote of each step, probability there), smoothed by one row of the mean."""
    mean = float(np.average(labels, weights=weights))
    steps: list[list[float]] = []
    for v, y, w in sorted(zip(votes, labels, weights)):
        steps.append([v, y * w, w])
        while len(steps) > 1 and steps[-2][1] * steps[-1][2] >= steps[-1][1] * steps[-2][2]:
            _, s, n = steps.pop()
            steps[-1][1] += s
            steps[-1][2] += n
    return [s[0] for s in steps], [(s[1] + mean) / (s[2] + 1) for s in steps]


class Model:
    def __init__(self, idf, index, steps, without):
        self.idf, self.index, self.steps, self.without = idf, index, steps, without

    def score(self, vector: bytes) -> tuple[float, list[int]]:
        if self.index is None or not vector:
            return self.without, []
        v, evidence = self.index.vote(*weigh(vector, self.idf))
        if v is None:
            return self.without, []
        return float(self.steps[1][max(0, int(np.searchsorted(self.steps[0], v, side="right")) - 1)]), evidence


def fit(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES) -> tuple[Model, DataFrame]:
    """(model, vectors of all rows). Without labels of both classes every score is the mean label, or 0.

    A null text is empty. Label rows without an id or a label, and those held out, teach nothing; of several rows of an
    id the toxic one counts. Repeated documents of an id are examples each. Empty tables give no vectors.
    """
    spark = docs.sparkSession
    chosen = saved(choose_examples(docs, labels, examples))
    vocabulary = choose_terms(chosen)
    size = len(vocabulary)
    number = spark.sparkContext.broadcast(vocabulary)
    rows = records(docs).select("doc_id", "text_key", "text")
    vectors = saved(rows.mapInArrow(_vectors(number), "doc_id long, text_key long, vector binary"))
    share = labels.where("toxic IN (0, 1)").where(learnable(F.col("doc_id"))).agg(F.avg("toxic"), F.count("*")).first()
    prior = float(share[0] or 0.0)
    if not size:
        return Model(None, None, None, prior), vectors
    table = vectors.mapInArrow(_document_counts(size), "term long, docs long").groupBy("term").agg(F.sum("docs").alias("docs")).toArrow()
    counts = np.zeros(size + 1)  # the number of documents comes last
    counts[table["term"].to_numpy()] = table["docs"].to_numpy()
    # Without a constant added, a term of nearly all documents weighs nearly nothing.
    idf = np.log((1 + counts[-1]) / (1 + counts[:-1]))
    made = chosen.select("doc_id", "toxic", "aside", "text_key", "text").mapInArrow(
        _with_labels(number), "doc_id long, toxic int, aside boolean, vector binary"
    ).orderBy("doc_id", "toxic", "vector").collect()  # at most about EXAMPLES sparse vectors
    have = Counter(r["toxic"] for r in made)
    weight = {1: prior / have[1], 0: (1 - prior) / have[0]}
    scale = len(made)
    inside, aside = [r for r in made if not r["aside"]], [r for r in made if r["aside"]]
    index = BlockMaxIndex([weigh(r["vector"], idf) for r in inside], [r["doc_id"] for r in inside], [r["toxic"] for r in inside], size)
    votes, empty = [], [0.0, 0.0]
    for r in aside:
        w = weight[r["toxic"]] * scale
        v = index.vote(*weigh(r["vector"], idf))[0] if r["vector"] else None
        if v is None:
            empty = [empty[0] + w * r["toxic"], empty[1] + w]
        else:
            votes.append((v, r["toxic"], w))
    steps = monotone(*zip(*votes)) if votes else ([0.0], [prior])
    return Model(idf, index, steps, (empty[0] + prior) / (empty[1] + 1)), vectors


def _with_labels(number):
    def go(batches):
        for b in batches:
            made = next(_vectors(number)([b]))
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["toxic"], b["aside"], made["vector"]], ["doc_id", "toxic", "aside", "vector"])

    return go


def _scores(model):
    def go(batches):
        known: dict[bytes, tuple[float, list[int]]] = {}
        for b in batches:
            score, evidence = [], []
            for v in b["vector"].to_pylist():
                if v not in known:
                    if len(known) > 50_000:
                        known.clear()
                    known[v] = model.value.score(v)
                score.append(known[v][0])
                evidence.append(known[v][1])
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], b["text_key"], pa.array(score, pa.float64()), pa.array(evidence, pa.list_(pa.int64()))],
                ["doc_id", "text_key", "score", "evidence"],
            )

    return go


def score_documents(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES) -> DataFrame:
    """(doc_id, text_key, score, evidence) for every input row, in no order; evidence: ids of the nearest examples.

    Texts without any term of the examples, empty and null ones too, get the calibrated share of such examples. Equal
    texts get equal scores. Empty input gives no rows.
    """
    model, vectors = fit(docs, labels, examples)
    return vectors.mapInArrow(
        _scores(docs.sparkSession.sparkContext.broadcast(model)), "doc_id long, text_key long, score double, evidence array<bigint>"
    )


def op8_toxicity(spark, sf_dir) -> DataFrame:
    """One row per document; null and empty texts, repeated rows and empty tables as in ``score_documents``."""
    out = score_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return out.select(
        "doc_id", F.coalesce(~learnable(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), F.array_join("evidence", ",").alias("evidence"),
    )
