"""What tasks hold and what is shuffled stays bounded."""

import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskloom.llm import jaccard_join, pii, suffix_dedup, toxicity
from riskloom.llm import sentencepiece_sampling as sp


@pytest.mark.parametrize("nearest", [True, False])
def test_pairs_of_a_large_cell_are_reduced_as_they_come(nearest, monkeypatch):
    """A cell of near copies in as many components: all pairs are allowed; few are held at a time."""
    monkeypatch.setattr(jaccard_join, "STEP_PAIRS", 50_000, raising=False)
    rnd, n = np.random.default_rng(3), 900
    sigs = np.zeros((n, 16), dtype=np.uint8)
    sigs[np.arange(n), rnd.integers(0, 16, n)] = 1 << rnd.integers(0, 8, n)
    table = pa.record_batch({
        "cell": pa.array(np.zeros(n, dtype=np.int64)), "class": pa.array([b"%016d" % i for i in range(n)], pa.binary()),
        "n": pa.array(np.full(n, 300, dtype=np.int32)), "coarse": pa.array([x.tobytes() for x in sigs], pa.binary()),
        "root": pa.array([b"%016d" % i for i in range(n)], pa.binary()), "side": pa.array(np.full(n, 2, dtype=np.int8)),
    })
    go = jaccard_join._cross(80, nearest)
    tracemalloc.start()
    found = [(a, b, d) for part in go([table]) for a, b, d in zip(*(part[c].to_pylist() for c in "abd"))] if nearest else []
    if not nearest:
        for part in go([table]):
            found.append(pa.concat_arrays([part["a"], part["b"]]).to_numpy(zero_copy_only=False).reshape(2, -1))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    apart = np.bitwise_count(sigs[:, None] ^ sigs[None]).sum(axis=2)
    if nearest:
        np.fill_diagonal(apart, 99)
        assert [a for a, _, _ in found] == [b"%016d" % i for i in range(n)]
        assert [round(d * 600) for _, _, d in found] == apart.min(axis=1).tolist()
        assert [int(b) for _, b, _ in found] == apart.argmin(axis=1).tolist()
        assert peak < 15e6
    else:
        got = [(int(a), int(b)) for x, y in found for a, b in zip(x, y)]
        assert set(got) == {(i, j) for i in range(n) for j in range(i + 1, n)} and len(found) > 5


def test_only_wanted_texts_move(spark):
    rows = spark.range(20_000).select(
        F.when(F.col("id") != 7, F.col("id")).alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"), F.xxhash64("id").alias("text_key")
    )
    few = rows.where("text_key % 20 = 0 OR doc_id IS NULL OR doc_id = 0").select("doc_id", "text_key")
    near = jaccard_join._may_be_among(rows, few)
    assert near.columns == rows.columns
    got = {tuple(r) for r in near.select("doc_id", "text_key").collect()}
    want = {tuple(r) for r in few.collect()}
    assert want <= got and len(got) <= len(want) + 20 and len(want) > 500
    assert jaccard_join._may_be_among(rows, few.where("false")).count() == 0


def test_links_with_joins_of_all_sizes_by_shuffle(spark, monkeypatch):
    """With no small-table joins, as on large inputs: the same groups."""
    rnd = np.random.default_rng(4)
    words = [f"w{x}" for x in range(400)]
    base = [[words[x] for x in rnd.integers(0, 400, 120)] for _ in range(30)]
    texts = [" ".join(b) for b in base] + [" ".join(b[:-1] + ["other"]) for b in base[:12]] + [" ".join(b[1:]) for b in base[6:20]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = {r.doc_id: r.component_id for r in jaccard_join.near_duplicates(docs, 4, 85).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == {i: i for i in range(30)} | {30 + i: i for i in range(12)} | {42 + i: 6 + i for i in range(14)}


def test_trees_learn_from_all_judged_candidates(spark, monkeypatch):
    rows = spark.range(50_000).select(
        F.col("id").alias("doc_id"), F.col("id").alias("text_key"), F.lit("email").alias("kind"), F.lit(0).alias("start"), F.lit(9).alias("stop"),
        (F.col("id") % 10 > 0).alias("judged"), (F.col("id") % 3 > 0).alias("valid"), (F.col("id") % 3).cast("double").alias("f_a"),
    )
    seen = {}

    class Trees:
        def __init__(self, **_):
            pass

        def fit(self, grow):
            seen["grow"] = grow.count()
            raise StopIteration

    def kept(table):
        seen["all"] = table.count()
        return table

    monkeypatch.setattr(pii, "GBTClassifier", Trees)
    monkeypatch.setattr(pii, "saved", kept)
    with pytest.raises(StopIteration):
        pii.train(rows)
    assert seen["all"] == 45_000 and 33_000 < seen["grow"] < 34_500


def test_votes_read_only_the_common_terms_of_a_text():
    """A step reads its blocks' weights of the terms that a query has, not those of all common terms."""
    rnd, size = np.random.default_rng(6), 600
    vectors = [(at, np.full(len(at), 1 / np.sqrt(len(at)))) for at in (np.sort(rnd.choice(size, 200, replace=False)) for _ in range(4000))]
    index = toxicity.BlockMaxIndex(vectors, list(range(4000)), [n % 2 for n in range(4000)], size)
    at = np.array([5, 77, 300])
    index.nearest(at, np.full(3, 0.5))
    tracemalloc.start()
    pos, cos = index.nearest(at, np.full(3, 0.5))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    dense = np.array([np.isin(at, a).sum() * 0.5 / np.sqrt(200) for a, _ in vectors])
    assert np.allclose(cos, np.sort(dense)[::-1][:15], atol=1e-6) and np.allclose(dense[index.ids[pos]], cos, atol=1e-6)
    assert peak < 500_000


def test_tables_of_pieces_find_what_they_hold():
    """Also hashes that share their first bits, and those beyond either end."""
    rnd = np.random.default_rng(7)
    back = np.uint64(pow(int(sp._STEP), -1, 1 << 64))
    spread = np.unique(np.concatenate((rnd.integers(0, 1 << 64, 3000, dtype=np.uint64), np.arange(40, dtype=np.uint64), np.uint64(2**64 - 1) - np.arange(30, dtype=np.uint64))))
    hashes = spread * back
    ids = rnd.permutation(len(hashes))
    h = np.concatenate((hashes, (spread + np.uint64(1)) * back, rnd.integers(0, 1 << 64, 5000, dtype=np.uint64)))
    on, got = sp._look_up(sp._table(hashes, ids), h)
    known = dict(zip(hashes.tolist(), ids.tolist()))
    assert {int(i): int(v) for i, v in zip(on, got)} == {i: known[x] for i, x in enumerate(h.tolist()) if x in known}


def test_a_large_bucket_of_suffixes_takes_little_more_than_its_bytes():
    rng, size, names, sides = np.random.default_rng(3), 400, [], []
    base = rng.integers(97, 123, 2 * size - suffix_dedup.KEY, dtype=np.uint8)
    a = size - suffix_dedup.KEY  # bytes left of the anchor
    for k in range(6000):
        row = base.copy()
        for at in rng.integers(0, a, 1 + k % 2).tolist() + rng.integers(size, len(base), k % 3).tolist():
            row[at] = rng.integers(97, 123)
        names.append(k.to_bytes(16, "little"))
        sides.append((row[k % 40 : a].tobytes(), row[a:].tobytes()))
    table = pa.table({
        "key": pa.array([7] * len(names), pa.int64()), "name": pa.array(names, pa.binary()),
        "left": pa.array([x for x, _ in sides], pa.binary()), "right": pa.array([y for _, y in sides], pa.binary()), "many": [False] * len(names),
    })
    tracemalloc.start()
    got = suffix_dedup._reaches(size)(table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16 * sum(len(x) + len(y) for x, y in sides)
    want: dict = {}
    for reach in range(a + 1):
        found: dict = {}
        for name, (x, y) in zip(names, sides):
            if len(x) >= reach:
                found.setdefault((x[len(x) - reach :], y[: size - reach]), []).append(name)
        for those in found.values():
            for name in those if len(those) > 1 else ():
                want[name] = (want.get(name, (reach,))[0], reach)
    assert want == {r["name"]: (r["least"], r["most"]) for r in got.to_pylist()}


def test_surroundings_of_a_common_passage_are_dealt_out(spark, monkeypatch):
    """A common passage just under a string, one over it and many near copies: no task sorts a large key whole."""
    monkeypatch.setattr(suffix_dedup, "LARGE_KEY", 20, raising=False)
    monkeypatch.setattr(suffix_dedup, "UNEVEN", 0, raising=False)
    rng, size, make = np.random.default_rng(11), 400, suffix_dedup._reaches

    def watched(*args):
        inner = make(*args)

        def go(table):
            keys = table["key"].to_pylist()
            assert max(map(keys.count, set(keys))) <= 20, "one key's surroundings meet in one task"
            return inner(table)

        return go

    monkeypatch.setattr(suffix_dedup, "_reaches", watched)
    prose = lambda n: rng.integers(97, 123, n, dtype=np.uint8).tobytes()
    ends, passages = [prose(k) for k in (1, 4, 9, 30, 60)], [prose(390), prose(430)]
    texts = [prose(300) + ends[k % 5] + passages[k % 2] + ends[k // 10 % 5] + prose(300) for k in range(160)]
    base = np.frombuffer(prose(700), dtype=np.uint8)
    for k in range(160):
        near = base.copy()
        near[rng.integers(0, 700, 1 + k % 3)] = 65 + k % 20
        texts.append(near.tobytes())
    texts = [t.decode() for t in texts] + [texts[3].decode()] * 2
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    seen = Counter(t[p : p + size] for t in texts for p in range(len(t) - size + 1))
    want = {}
    for i, t in enumerate(texts):
        gone = {q for p in range(len(t) - size + 1) if seen[t[p : p + size]] > 1 for q in range(p, p + size)}
        want[i] = (len(gone), "".join(c for q, c in enumerate(t) if q not in gone))
    got = suffix_dedup.remove_repeats(docs).select("rec.doc_id", "n_removed", F.col("kept").cast("string")).collect()
    assert {i: (n, kept) for i, n, kept in got} == want
    assert 0 < sum(n > 0 for n, _ in want.values()) < len(want)


def test_tasks_of_the_join_get_few_rows_at_once(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BATCH_ROWS", 50, raising=False)

    def watched(make):
        def made(*args):
            inner = make(*args)

            def go(batches):
                def few():
                    for b in batches:
                        assert b.num_rows <= 50, "too many rows at once"
                        yield b

                return inner(few())

            return go

        return made

    for name in ("_sketch", "_describe", "_sets", "_linked", "_signs_allow", "_cross"):
        monkeypatch.setattr(jaccard_join, name, watched(getattr(jaccard_join, name)))
    bound = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    texts = [(2 * i + j, " ".join(f"w{i}x{k}" for k in range(30)) + j * " more") for i in range(150) for j in range(2)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.near_duplicates(docs, 4, 85).collect()}
    assert got == {i: i - i % 2 for i, _ in texts}
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == bound


def test_noise_is_drawn_only_for_nodes_that_may_win(monkeypatch):
    rng, drawn, uniform = np.random.default_rng(5), [], sp.uniform
    monkeypatch.setattr(sp, "uniform", lambda keys: drawn.append(np.size(keys)) or uniform(keys))
    text = " ".join("".join(chr(97 + c) for c in rng.integers(0, 26, 6)) for _ in range(3000))
    ((sample,),) = sp.sample_texts([text], np.array([1], dtype=np.uint64), 1, sp.ALPHA)
    assert sp.decode_ids(sample[0]).decode() == text
    assert sum(drawn) < 1.4 * len(sample[0])  # one each for the walk


def test_empty_texts_alone_have_their_empty_sample():
    got = sp.sample_texts(["", ""], np.arange(2, dtype=np.uint64), 3, sp.ALPHA)
    assert [[(len(ids), logp, inclusion) for ids, logp, _, inclusion in found] for found in got] == [[(0, 0.0, 1.0)]] * 2
