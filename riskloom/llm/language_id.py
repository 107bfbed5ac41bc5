"""Language identification by sparse multinomial logistic regression on character n-grams.

A text becomes its n-grams of one to three lower-case letters, word edges included, hashed to ``1 << BITS`` features.
A feature's value is its share of the text's n-grams times its inverse document frequency, which counts all learning
documents. Weights are learned by follow-the-regularised-leader with an elastic-net penalty, one example at a time, on a
bounded sample; most end as exact zeros. A temperature fitted on examples kept out of that learning calibrates the
probabilities. Scoring is a sum of table rows over the n-grams of a text: one pass, no shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.bytehash import mix
from riskloom.llm.common import documents, records, text_of

BITS = 17
GRAMS = 3
#: About this many labelled documents are learned from, shared evenly by the languages; each language has one at least.
SAMPLE_ROWS = 8_000
EPOCHS = 4
#: Every fifth example is for the temperature.
CALIBRATION_PART = 5
#: Learning rate, its offset, and the elastic-net penalty.
ALPHA, BETA, L1, L2 = 0.5, 0.1, 0.02, 0.01
#: Values are shares of a text; this factor brings them to the order of one.
VALUE_SCALE = 20.0
UNKNOWN = "und"
#: Texts are worked on together up to about this many characters; a longer one is worked on alone.
CHUNK_CHARS = 1 << 19
_tables: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For each code point its lower-case letter; 0 for what is no letter."""
    if not _tables:
        table = np.zeros(0x110000, dtype=np.uint32)
        for c in range(0x110000):
            if chr(c).isalpha():
                low = chr(c).lower()
                table[c] = ord(low) if len(low) == 1 else c
        _tables.append(table)
    return _tables[0]


def text_chunks(texts: list[str]) -> Iterator[list[str]]:
    held, size = [], 0
    for t in texts:
        if held and size + len(t) > CHUNK_CHARS:
            yield held
            held, size = [], 0
        held.append(t)
        size += len(t)
    if held:
        yield held


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(feature of each n-gram, where each text's n-grams begin and the last's end); a text without letters has none.

    Runs of other characters, and both ends of a text, are one word edge; an n-gram holds one letter at least.
    """
    data = np.frombuffer("\0".join(["", *texts, ""]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    owner = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts])
    code = letters()[data]
    # The separator before a text belongs to nobody; one edge of each run stays, but each text keeps its first one.
    owner = np.concatenate(([-1], owner))
    edge = code == 0
    keep = ~edge | np.concatenate(([True], ~edge[:-1])) | np.concatenate(([True], owner[1:] != owner[:-1]))
    code, owner, edge = code[keep].astype(np.uint64), owner[keep], edge[keep]
    ids, owners = [], []
    key = np.zeros(len(code), dtype=np.uint64)
    for n in range(1, GRAMS + 1):
        size = len(code) - n + 1
        if size <= 0:
            break
        key = (key[:size] << np.uint64(21)) | (code[n - 1 :][:size] + np.uint64(1))
        inner = np.zeros(size, dtype=bool)
        for k in range(n):
            inner |= ~edge[k : k + size]
        for k in range(1, n - 1):  # an edge inside would join two words
            inner &= ~edge[k : k + size]
        # The first character may be the edge at the end of the text before: the n-gram belongs to its second one.
        last = owner[n - 1 :][:size]
        inner &= (owner[:size] == last) | (edge[:size] & (owner[min(1, n - 1) :][:size] == last))
        inner &= last >= 0
        ids.append((mix(key[inner]) >> np.uint64(64 - BITS)).astype(np.int64))
        owners.append(last[inner])
    ids, owners = np.concatenate(ids), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    bounds = np.concatenate(([0], np.cumsum(np.bincount(owners, minlength=len(texts)))))
    return ids[order], bounds


@dataclass
class Model:
    """Weights times inverse document frequency for each feature (languages side by side), biases, temperature."""

    languages: list[str]
    features: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float

    def table(self) -> np.ndarray:
        full = np.zeros((1 << BITS, len(self.languages)))
        full[self.features] = self.weights
        return full


def softmax(a: np.ndarray) -> np.ndarray:
    e = np.exp(a - a.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def predict_texts(texts: list[str], model: Model, table: np.ndarray) -> tuple[list[str], list[float]]:
    """The likeliest language (the first in name order on a tie) and its calibrated probability."""
    names, scores = [], []
    for part in text_chunks(texts):
        ids, bounds = grams(part)
        size = np.diff(bounds)
        some = np.flatnonzero(size)
        logits = np.zeros((len(part), len(model.languages)))
        if len(some):
            logits[some] = np.add.reduceat(table[ids], bounds[some], axis=0) * (VALUE_SCALE / size[some])[:, None]
        chance = softmax((logits + model.bias) / model.temperature)
        best = chance.argmax(axis=1)
        for n, b in enumerate(best.tolist()):
            names.append(model.languages[b] if size[n] else UNKNOWN)
            scores.append(float(chance[n, b]) if size[n] else 0.0)
    return names, scores


# ------------------------------------------------------------------ learning
def learning_rows(docs: DataFrame, learn: Column) -> DataFrame:
    """(text, lang) of the rows that may be learned from: a language, and a text of one character at least."""
    return docs.where(learn).select(text_of().alias("text"), F.col("lang").cast("string").alias("lang")).where("lang IS NOT NULL AND text <> ''")


def _document_counts(batches):
    total, n = np.zeros(1 << BITS, dtype=np.int64), 0
    for b in batches:
        for part in text_chunks(b["text"].to_pylist()):
            ids, bounds = grams(part)
            owner = np.repeat(np.arange(len(part)), np.diff(bounds))
            total += np.bincount(np.unique((owner << BITS) | ids) & ((1 << BITS) - 1), minlength=1 << BITS)
            n += len(part)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(([-1], at)), pa.int32()), pa.array(np.concatenate(([n], total[at])), pa.int64())], ["feature", "docs"]
    )


def inverse_frequencies(rows: DataFrame) -> np.ndarray:
    """ln((1 + documents) / (1 + documents with the feature)) + 1 over all rows; one number per feature."""
    counts = rows.select("text").mapInArrow(_document_counts, "feature int, docs long").groupBy("feature").agg(F.sum("docs").alias("docs"))
    found = counts.toArrow()
    feature, n = found["feature"].to_numpy(), found["docs"].to_numpy()
    total = int(n[feature < 0].sum())
    docs = np.zeros(1 << BITS)
    docs[feature[feature >= 0]] = n[feature >= 0]
    return np.log((1 + total) / (1 + docs)) + 1


def _vectors(batches):
    """Features and their shares, which are bounded by the number of features however long a text is."""
    for b in batches:
        features, shares = [], []
        for part in text_chunks(b["text"].to_pylist()):
            ids, bounds = grams(part)
            for a, z in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                at, n = np.unique(ids[a:z], return_counts=True)
                features.append(at.astype("<i4").tobytes())
                shares.append((n / max(1, z - a)).astype("<f4").tobytes())
        yield pa.RecordBatch.from_arrays(
            [b["lang"], b["name"], pa.array(features, pa.binary()), pa.array(shares, pa.binary())], ["lang", "name", "features", "shares"]
        )


def learn_weights(examples: list[tuple[np.ndarray, np.ndarray, int]], languages: int) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal over (features, values, language) for ``EPOCHS`` rounds; the last row is the bias, not penalised
    by L1. Returns (weights, biases)."""
    z, n = np.zeros(((1 << BITS) + 1, languages)), np.zeros(((1 << BITS) + 1, languages))
    l1 = np.full(((1 << BITS) + 1, 1), L1)
    l1[-1] = 0.0

    def weights(at):
        big = np.abs(z[at]) > l1[at]
        return np.where(big, (np.sign(z[at]) * l1[at] - z[at]) / ((BETA + np.sqrt(n[at])) / ALPHA + L2), 0.0)

    for epoch in range(EPOCHS):
        for k in np.random.Generator(np.random.PCG64([7, epoch])).permutation(len(examples)).tolist():
            features, values, language = examples[k]
            at, x = np.append(features, 1 << BITS), np.append(values, 1.0)
            w = weights(at)
            error = softmax(x @ w)
            error[language] -= 1
            g = x[:, None] * error
            more = n[at] + g * g
            z[at] += g - (np.sqrt(more) - np.sqrt(n[at])) / ALPHA * w
            n[at] = more
    w = weights(np.arange((1 << BITS) + 1))
    return w[:-1], w[-1]


def fit_temperature(logits: np.ndarray, language: np.ndarray) -> float:
    """The temperature of least log loss, by ternary search over its logarithm; 1 without examples."""
    if not len(language):
        return 1.0

    def loss(u: float) -> float:
        p = softmax(logits / math.exp(u))[np.arange(len(language)), language]
        return float(-np.log(np.maximum(p, 1e-300)).mean())

    low, high = -3.0, 3.0
    for _ in range(60):
        a, b = low + (high - low) / 3, high - (high - low) / 3
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return math.exp((low + high) / 2)


def _learner(languages: list[str], idf: np.ndarray):
    """One task over the bounded sample; gives the rows of the model."""
    number = {name: n for n, name in enumerate(languages)}

    def go(table: pa.Table) -> pa.Table:
        table = table.sort_by([("name", "ascending"), ("lang", "ascending")])
        rows = []
        for lang, f, s in zip(*(table[c].to_pylist() for c in ("lang", "features", "shares"))):
            at = np.frombuffer(f, "<i4").astype(np.int64)
            rows.append((at, np.frombuffer(s, "<f4") * idf[at] * VALUE_SCALE, number[lang]))
        held = [r for k, r in enumerate(rows) if k % CALIBRATION_PART == CALIBRATION_PART - 1]
        weights, bias = learn_weights([r for k, r in enumerate(rows) if k % CALIBRATION_PART < CALIBRATION_PART - 1], len(languages))
        logits = np.array([x @ weights[at] + bias for at, x, _ in held]).reshape(-1, len(languages))
        temperature = fit_temperature(logits, np.array([y for _, _, y in held], dtype=np.int64))
        at = np.flatnonzero(weights.any(axis=1))
        used = weights[at] * idf[at][:, None]
        feature = np.concatenate((np.repeat(at, len(languages)), np.full(len(languages), -1), [-2]))
        language = np.concatenate((np.tile(np.arange(len(languages)), len(at) + 1), [0]))
        value = np.concatenate((used.ravel(), bias, [temperature]))
        some = (value != 0) | (feature < 0)
        return pa.table([
            pa.array(feature[some], pa.int32()), pa.array(language[some], pa.int32()), pa.array(value[some], pa.float64())
        ], names=["feature", "language", "weight"])

    return go


def fit(docs: DataFrame, learn: Column | bool = True) -> Model | None:
    """Learn from the rows of ``docs`` for which ``learn`` holds; None when none has a language and a text.

    Document frequencies cover all of these rows. The examples are a sample by text hash of about ``SAMPLE_ROWS``, the
    same number from each language as far as it has them, so equal texts are in or out together. Languages are what the
    rows name; there are at most as many as rows of the sample.
    """
    rows = learning_rows(docs, F.lit(learn) if isinstance(learn, bool) else learn)
    per = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not per:
        return None
    languages = sorted(per)
    share = -(-SAMPLE_ROWS // len(languages))
    idf = inverse_frequencies(rows)
    limits = docs.sparkSession.createDataFrame([(x, min(1.0, share / per[x])) for x in languages], "lang string, part double")
    name = F.xxhash64("text")
    drawn = rows.join(F.broadcast(limits), "lang").where(F.pmod(name, F.lit(1 << 30)) <= F.col("part") * (1 << 30))
    sample = drawn.select("lang", name.alias("name"), "text").mapInArrow(_vectors, "lang string, name long, features binary, shares binary")
    found = sample.withColumn("all", F.lit(0)).groupBy("all").applyInArrow(_learner(languages, idf), "feature int, language int, weight double").toArrow()
    feature, language, weight = (found[c].to_numpy() for c in ("feature", "language", "weight"))
    used = np.unique(feature[feature >= 0])
    weights = np.zeros((len(used), len(languages)))
    inside = feature >= 0
    weights[np.searchsorted(used, feature[inside]), language[inside]] = weight[inside]
    bias = np.zeros(len(languages))
    bias[language[feature == -1]] = weight[feature == -1]
    return Model(languages, used.astype(np.int64), weights, bias, float(weight[feature == -2][0]))


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """(rec, lang_pred, score) for every row; ``rec`` holds all its columns.

    Null and empty texts, and texts without a letter, get ``und`` and 0; so does every text when nothing could be
    learned. Ties go to the first language by name. Repeated rows each come out; an empty table gives no rows. The model
    is broadcast: at most ``1 << BITS`` features times the languages, and only features with a weight.
    """
    rows = records(docs).select("rec", "text")
    schema = rows.select("rec", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
    if model is None:
        return rows.select("rec", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def go(batches):
        table = shared.value.table()
        for b in batches:
            names, scores = predict_texts(b["text"].to_pylist(), shared.value, table)
            yield pa.RecordBatch.from_arrays(
                [b["rec"], pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["rec", "lang_pred", "score"]
            )

    return rows.mapInArrow(go, schema)


def held_out() -> Column:
    """Rows kept from learning: crc32 of the id as text leaves 1 modulo 3. A null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1


def op13_language_id(spark, sf_dir) -> DataFrame:
    """One row per document; nulls, empty texts, ties and repeated rows as in ``identify``."""
    docs = documents(spark, sf_dir)
    model = fit(docs, ~held_out())
    slim = docs.select("doc_id", "text", held_out().alias("held_out"))
    return identify(slim, model).select(
        F.col("rec.doc_id").alias("doc_id"), F.col("rec.held_out").alias("held_out"), "lang_pred", "score"
    )
