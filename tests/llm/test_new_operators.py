"""Centroid clustering, the filter audit and language identification, against brute force, SQL and held-out labels."""

import hashlib
import itertools
import math
import random
from collections import Counter

import duckdb
import pytest
from llm_help import bag
from pyspark.sql import functions as F

from compare import compare
from riskloom.llm import centroid_clustering as cc
from riskloom.llm import filter_audit as fa
from riskloom.llm import language_id as li
from riskloom.llm.registry import oracle_sql, queries

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", ["op5_line_dedup", "op11_centroid_clustering", "op12_filter_audit"])
def test_query_equals_its_sql(spark, con, name):
    assert compare(queries()[name](spark, SF), con, oracle_sql()[name]) is None


# ------------------------------------------------------------------ centroid clustering
VECTORS = "vec_id long, embedding array<float>, rec string, x int, cluster string, distance double"


def brute_clusters(rows, k, rounds, size):
    kept = [(i, [math.floor(64 * v) for v in e]) for i, e in rows if e is not None and len(e) == size and all(v is not None and math.isfinite(v) for v in e)]
    name = lambda i: hashlib.sha256(f"1:{i}".encode()).hexdigest()
    centroids = [x for _, x in sorted(kept, key=lambda r: (r[0] is None, name(r[0]) if r[0] is not None else "", r[1]))[:k]]
    dist = lambda a, b: sum((p - q) ** 2 for p, q in zip(a, b))
    near = lambda x: min((dist(x, c), n) for n, c in enumerate(centroids))
    for _ in range(rounds):
        at = [near(x)[1] for _, x in kept]
        for n in set(at):
            own = [x for (_, x), a in zip(kept, at) if a == n]
            centroids[n] = [sum(c) // len(own) for c in zip(*own)]
    out = [(i, *reversed(near(x))) for i, x in kept]
    total = Counter()
    for _, n, d in out:
        total[n] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, n, d, total[n], sum(total.values()), sha[n]) for i, n, d in out]


def vector_rows():
    rnd = random.Random(3)
    rows = [(i, [rnd.uniform(-2, 2) for _ in range(4)]) for i in range(120)]
    rows += [(200 + i, [0.5, 0.5, 0.25, -1.0]) for i in range(60)] + [(7, rows[7][1])] * 3 + [(None, [1.0, 1.0, 1.0, 1.0])] * 5
    rows += [(300, None), (301, []), (302, [1.0] * 3), (303, [1.0] * 5), (304, [1.0, None, 1.0, 1.0]), (305, [float("nan")] * 4)]
    rows += [(306, [float("inf"), 0.0, 0.0, 0.0]), (307, [0.0, 0.0, 0.0, 0.0]), (308, [-0.001, 0.0, 0.0, 0.0]), (309, [64.0, -64.0, 0.0, 0.0])]
    return rows


def as_floats(rows):
    import numpy as np

    return [(i, None if e is None else [None if v is None else float(np.float32(v)) for v in e]) for i, e in rows]


def found_clusters(spark, rows, **how):
    df = spark.createDataFrame([(i, e, "r", 1, "c", 0.5) for i, e in rows], VECTORS).repartition(7)
    out = cc.cluster(df, dimensions=4, **how)
    assert out.select("rec.rec", "rec.cluster", "rec.distance").distinct().count() <= 1
    return bag(map(tuple, out.select("rec.vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()))


@pytest.mark.parametrize(("k", "rounds"), [(5, 3), (1, 2), (16, 0), (400, 1)])
def test_clusters_equal_brute_force(spark, k, rounds):
    rows = as_floats(vector_rows())
    assert found_clusters(spark, rows, clusters=k, rounds=rounds) == bag(brute_clusters(rows, k, rounds, 4))


def test_ties_and_empty_vectors(spark):
    rows = [(n, [float(n % 2), 0.0, 0.0, 0.0]) for n in range(8)] + [(50, [0.5, 0.0, 0.0, 0.0])]
    assert found_clusters(spark, rows, clusters=9, rounds=3) == bag(brute_clusters(rows, 9, 3, 4))
    assert found_clusters(spark, [], clusters=3) == [] == found_clusters(spark, [(1, None), (2, [1.0])], clusters=3)


def test_large_components_stay_exact(spark):
    rows = as_floats([(n, [2.0**23 + n, -(2.0**22), float(n), 0.0]) for n in range(20)])
    assert found_clusters(spark, rows, clusters=3, rounds=2) == bag(brute_clusters(rows, 3, 2, 4))


# ------------------------------------------------------------------ filter audit
def brute_audit(rows, labels):
    import re

    texts = [t or "" for _, t, _ in rows]
    least = {}
    for (i, _, _), t in zip(rows, texts):
        if i is not None:
            least[t] = min(i, least.get(t, i))
    fails, good, toxic = [], [], []
    for (i, _, _), t in zip(rows, texts):
        w = re.findall("[^\x20\x09-\x0d]+", t)
        fails.append({
            "A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            "D": any(c in t for c in "#$%&*|"), "E": i is not None and i > least[t],
        })
        good.append(any(i is not None and a == i and q == 1 for a, q, _ in labels))
        toxic.append(any(i is not None and a == i and x == 1 for a, _, x in labels))
    out, shapley = [], Counter()
    for part in {s or "" for _, _, s in rows}:
        own = [n for n, r in enumerate(rows) if (r[2] or "") == part]
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [n for n in left if fails[n][f]]
                left = [n for n in left if not fails[n][f]]
                earlier = sum(fails[n][f] and any(fails[n][e] for e in order[: step - 1]) for n in own)
                alone = sum(fails[n][f] and sum(fails[n].values()) == 1 for n in own)
                shapley[part, f] += len(gone)
                out.append((part, "".join(order), step, len(left), len(gone), earlier, alone, sum(good[n] for n in gone), sum(toxic[n] for n in gone)))
    return [(*r, shapley[r[0], r[1][r[2] - 1]]) for r in out]


def test_audit_equals_brute_force(spark, rows, labels):
    rnd = random.Random(9)
    words = ["".join(rnd.choice("abcXYZ") for _ in range(3)) for _ in range(500)]
    some = [(i, t, ["s", "t", None][n % 3]) for n, (i, t) in enumerate(rows)]
    some += [(1000 + n, " ".join(rnd.choice(words[: rnd.choice([50, 500])]) for _ in range(rnd.randint(150, 260))).lower(), "long") for n in range(40)]
    some += [(2000 + n, some[-1][1] + " #" * (n % 2), "long") for n in range(6)] + [(None, some[-1][1], "long")] * 2
    schema = "doc_id long, text string, source string, part string, mask int, n int, text_key string"
    docs = spark.createDataFrame([(*r, "p", 3, 1, "k") for r in some], schema).repartition(6)
    marks = [tuple(r) for r in labels.collect()] + [(1003, 1, 1), (1003, 0, 0), (2001, 0, 1)]
    got = fa.audit(docs, spark.createDataFrame(marks, labels.schema)).collect()
    assert bag(map(tuple, got)) == bag(brute_audit(some, marks))
    assert fa.audit(docs.limit(0), labels).count() == 0
    without = fa.audit(docs, labels.limit(0)).agg(F.sum("good_lost"), F.sum("toxic_lost")).first()
    assert tuple(without) == (0, 0)


def test_survivors_of_every_set():
    import numpy as np

    masks = np.array([0, 3, 5, 16, 31, 8])
    counts = np.array([[5, 1], [4, 0], [3, 3], [2, 1], [1, 0], [7, 7]])
    left = fa.survivors(masks, counts, 5)
    for s in range(32):
        assert left[s].tolist() == counts[(masks & s) == 0].sum(axis=0).tolist()


# ------------------------------------------------------------------ language identification
def plain_grams(text):
    import unicodedata

    is_letter = lambda c: unicodedata.category(c) in ("Lu", "Ll", "Lt", "Lm", "Lo")
    low = lambda c: c.lower() if len(c.lower()) == 1 else c
    word, words = "", []
    for c in text:
        if is_letter(c):
            word += low(c)
        elif word:
            words.append(word)
            word = ""
    words += [word] if word else []
    found = Counter()
    for w in words:
        edged = f" {w} "
        for n in (1, 2, 3):
            for k in range(len(edged) - n + 1):
                g = edged[k : k + n]
                if g.strip():
                    found[g] += 1
    return found


def feature_of(gram):
    import numpy as np

    key = 0
    for c in gram:
        key = key << 21 | (0 if c == " " else ord(c)) + 1
    return int(li.mix(np.array([key], dtype=np.uint64))[0] >> np.uint64(64 - li.BITS))


def test_grams_equal_brute_force(rows):
    texts = [t or "" for _, t in rows] + ["  a", "a  ", "1a2", "ÀÉ ñ", "İx", "٣", "..", "漢字x", "a\0b", "\0", "", "x"]
    ids, bounds = li.grams(texts)
    for n, t in enumerate(texts):
        want = Counter()
        for g, k in plain_grams(t).items():
            want[feature_of(g)] += k
        assert Counter(ids[bounds[n] : bounds[n + 1]].tolist()) == want, t[:40]


def test_held_out_languages(spark):
    out = queries()["op13_language_id"](spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in out if r.held_out]
    assert len(out) == 1000 and 250 < len(held) < 420
    assert sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in out)
    sure = sum(r.score for r in held) / len(held)
    assert abs(sure - sum(r.lang_pred == r.lang for r in held) / len(held)) < 0.05


def test_labels_of_held_out_rows_change_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(300)
    model = li.fit(docs, ~li.held_out())
    other = docs.withColumn("lang", F.when(li.held_out(), F.lit("xx")).otherwise(F.col("lang"))).withColumn(
        "text", F.when(li.held_out(), F.lit("other words")).otherwise(F.col("text")))
    again = li.fit(other, ~li.held_out())
    assert model.languages == again.languages and (model.weights == again.weights).all() and model.temperature == again.temperature


def test_language_edges(spark, docs, no_docs, rows):
    model = li.fit(docs.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, F.lit("aa")).when(F.col("doc_id") % 5 > 0, F.lit("bb"))))
    assert model.languages == ["aa", "bb"]
    out = li.identify(docs, model).select("rec.*", "lang_pred", "score").collect()
    assert bag((r.doc_id, r.text) for r in out) == bag(rows)
    for r in out:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters) and (letters or r.score == 0)
        assert r.kept == "kept" and r.rec == "rec"
    assert li.fit(no_docs) is None and li.identify(no_docs, model).count() == 0
    assert li.fit(docs.withColumn("lang", F.lit(None).cast("string"))) is None
    assert {tuple(r) for r in li.identify(docs, None).select("lang_pred", "score").collect()} == {("und", 0.0)}
    one = li.fit(docs)
    assert one.languages == ["en"] and {r.lang_pred for r in li.identify(docs, one).collect()} == {"en", "und"}
