"""Sampling, toxicity and the pipeline: exact round trips, brute force and held-out accuracy."""

import random
import zlib

import numpy as np
import pytest
from llm_help import bag
from pyspark.sql import functions as F

import corpus_pipeline
from riskloom.llm import sentencepiece_sampling as sp
from riskloom.llm import toxicity

SF = "/root/testdata/sf0.01"


def test_round_trip(docs, rows, no_docs):
    out = sp.decode(sp.sample_segmentations(docs)).collect()
    by: dict = {}
    for r in out:
        by.setdefault((r.doc_id, r.text_key), []).append(r)
    model = sp.pieces(sp.ALPHA).model
    texts = {(t or "").replace("▁", " ") for _, t in rows}
    assert {r.decoded for r in out} == texts
    assert len(by) == len({(i, t or "") for i, t in rows})
    for group in by.values():
        assert len({r.ids for r in group}) == len({r.sample for r in group}) <= 3
        first = {r.sample: r for r in group}
        assert [first[n].noise for n in sorted(first)] == sorted((first[n].noise for n in first), reverse=True)
    for r in out[:50]:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert model.decode(ids).replace("▁", " ") == r.decoded and zlib.crc32(r.ids) == r.ids_crc32 and len(ids) == r.n_pieces
        assert 0 < r.inclusion <= 1 and r.log_probability <= 1e-9
    again = sp.sample_segmentations(docs.repartition(2)).select("doc_id", "text_key", "sample", "ids_crc32", "noise")
    assert bag(map(tuple, again.collect())) == bag((r.doc_id, r.text_key, r.sample, r.ids_crc32, r.noise) for r in out)
    assert sp.sample_segmentations(no_docs).count() == 0


def test_samples_follow_the_lattice():
    """Against all segmentations of a short word: probabilities, first draws, and unbiased weighted sums."""
    alpha, n, text = 0.3, 4000, "there"
    known = sp.pieces(alpha)
    ids = {known.model.id_to_piece(i): i for i in range(259, 32000)}

    def every(s):
        if not s:
            yield ()
        for size in range(1, len(s) + 1):
            if s[:size] in ids:
                for rest in every(s[size:]):
                    yield (ids[s[:size]], *rest)

    mass = {x: np.exp(known.logp[list(x)].sum()) for x in every(known.model.normalize(text))}
    total = sum(mass.values())
    out = sp.sample_texts([text] * n, sp.mix(np.arange(1, n + 1, dtype=np.uint64)), 4, alpha)
    weighted = []
    for found in out:
        assert len({tuple(f[0].tolist()) for f in found}) == 4
        for f in found:
            assert abs(np.exp(f[1]) - mass[tuple(f[0].tolist())] / total) < 1e-9
        weighted.append(sum(np.exp(f[1]) / f[3] for f in found))
    assert abs(np.mean(weighted) - 1) < 0.03
    best = max(mass, key=mass.get)
    share = np.mean([tuple(f[0][0].tolist()) == best for f in out])
    assert abs(share - mass[best] / total) < 0.03


def test_all_segmentations_when_few():
    out = sp.sample_texts(["a", ""], np.array([1, 2], dtype=np.uint64), 50, 1.0)
    assert len(out[0]) == 2 and all(f[3] == 1.0 for f in out[0])  # "▁a" and "▁", "a"
    assert [f[0].tolist() for f in out[1]] == [[]]


def test_nearest_are_exact():
    rnd = random.Random(3)
    size, vectors = 40, []
    for _ in range(500):
        at = sorted(rnd.sample(range(size), rnd.randint(0, 6)))
        w = np.array([rnd.random() + 0.1 for _ in at])
        vectors.append((np.array(at, dtype=np.int64), w / (np.sqrt((w * w).sum()) or 1)))
    index = toxicity.BlockMaxIndex(vectors, list(range(500)), [n % 2 for n in range(500)], size)
    dense = np.zeros((500, size))
    for r, (at, w) in zip(dense, vectors):
        r[at] = w
    for at, w in vectors[:200]:
        pos, cos = index.nearest(at, w)
        want = np.sort(dense[:, at] @ w)[::-1][:15]
        assert np.allclose(cos, want[want > 0][: len(cos)], atol=1e-6) and len(cos) == min(15, int((want > 1e-12).sum()))


def test_toxicity_on_rows_held_out(spark):
    d = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    out = toxicity.score_documents(d, labels).join(labels, "doc_id").where(~toxicity.learnable(F.col("doc_id"))).collect()
    told = [(r.score >= 0.5, r.toxic == 1) for r in out]
    hit = sum(p and t for p, t in told)
    assert hit / sum(p for p, _ in told) >= 0.9 and hit / sum(t for _, t in told) >= 0.6


def test_all_terms_of_the_examples_count(spark):
    """Few examples and rare words: evidence and cosines are those of the full TF-IDF vectors, by brute force."""
    rnd = random.Random(8)
    texts = {n: " ".join(rnd.choices([f"w{chr(97 + k % 26)}{chr(97 + k // 26)}word" for k in range(300)], k=rnd.randint(3, 40))) + (" vile" if n % 2 else "") for n in range(160)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    labels = spark.createDataFrame([(n, n % 2) for n in texts], "doc_id long, toxic int")
    found = {n: toxicity.terms(t) for n, t in texts.items()}
    df = {t: sum(t in f for f in found.values()) for f in found.values() for t in f}
    unit = {}
    for n, f in found.items():
        w = {t: c * np.log((1 + len(texts)) / (1 + df[t])) for t, c in f.items()}
        unit[n] = {t: x / np.sqrt(sum(y * y for y in w.values())) for t, x in w.items()}
    inside = [r.doc_id for r in toxicity.choose_examples(docs, labels).where("NOT aside").collect()]
    assert len(inside) > 50
    out = toxicity.score_documents(docs, labels).collect()
    assert len(out) == len(texts)
    for r in out:
        cos = {n: sum(x * unit[n].get(t, 0.0) for t, x in unit[r.doc_id].items()) for n in inside}
        want = sorted((c for c in cos.values() if c > 1e-9), reverse=True)[:15]
        assert np.allclose([cos[n] for n in r.evidence], want, atol=1e-5)
    at, n = toxicity.unpack(toxicity.pack(np.array([3, 70_000]), np.array([1, 300])))
    assert (at.tolist(), n.tolist()) == ([3, 70_000], [1, 300]) and toxicity.pack(np.zeros(0, int), np.zeros(0, int)) == b""


def test_hashed_terms_count_as_terms(rows):
    from collections import Counter

    texts = [t or "" for _, t in rows] + ["Straße İstanbul x_y 12ab ½cup", "ÉCOLE école ecole", "aaaa aaaaa AAAAA", "a\0b"]
    found = [Counter() for _ in texts]
    for owner, term in toxicity.hashed_terms(texts):
        for o, t in zip(owner.tolist(), term.tolist()):
            found[o][t] += 1
    names = {}
    for t, f in zip(texts, found):
        want = toxicity.terms(t)
        assert sorted(f.values()) == sorted(want.values())
        for term in want:
            one = next(toxicity.hashed_terms([term.lstrip("^") + ("" if term[0] != "^" else "xyz")]))[1].tolist()
            names[term] = one[-1] if term[0] == "^" else one[0]
            assert f[names[term]] == want[term], (t[:30], term)
    assert len(set(names.values())) == len(names)


def test_toxicity_of_awkward_rows(docs, labels, no_docs):
    out = toxicity.score_documents(docs, labels).collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 for r in out)
    assert len({r.score for r in out if r.doc_id in (8,)}) == 1
    assert toxicity.score_documents(no_docs, labels).count() == 0
    assert {r.score for r in toxicity.score_documents(docs, labels.where("false")).collect()} == {0.0}


def test_pipeline_stages(spark, docs, no_docs, tmp_path, labels):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    at, empty = docs, no_docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, at, str(tmp_path))
        nothing = stage(spark, empty, str(tmp_path))
        assert nothing.count() == 0
        if name != "packing":
            assert out.columns == docs.columns
            at, empty = corpus_pipeline.saved(out), corpus_pipeline.saved(nothing)
        assert out.count() > 0


@pytest.mark.parametrize("n", [1])
def test_pipeline_over_a_table(spark, n):
    out = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in out} and all(zlib.crc32(r.ids) == r.ids_crc32 for r in out)


def test_pipeline_stages_equal_brute_force(spark, docs, labels, tmp_path):
    """Each stage on its own input: dropped lines, one row per group, redacted spans, packed ids."""
    import re
    from collections import Counter

    import public_tokenizers
    from tokenizers import Tokenizer

    word = re.compile(r"[^\x20\x09-\x0D]+")
    lower = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    stages = dict(corpus_pipeline.STAGES)
    at = corpus_pipeline.saved(stages["quality_rules"](spark, docs, str(tmp_path)))
    given = bag((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    kept = [(r.doc_id, r.text) for r in at.collect()]
    assert not Counter(bag(kept)) - Counter(given) and len(kept) > 40
    assert all(len(word.findall(t or "")) >= 20 for _, t in kept)

    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(lower)
    held = Counter(k for _, t in kept for k in {key(x) for x in (t or "").split("\n")} if k)
    want = [(i, "\n".join(x for x in (t or "").split("\n") if held[key(x)] < 10)) for i, t in kept]
    at = corpus_pipeline.saved(stages["line_dedup"](spark, at, str(tmp_path)))
    assert bag((r.doc_id, r.text) for r in at.collect()) == bag(want)
    assert all(r.text == t for r, t in [(r, r.text) for r in at.collect()])

    def shingles(t):
        w = word.findall(t.translate(lower))
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())

    sets, group = [shingles(t) for _, t in want], list(range(len(want)))

    def root(n):
        while group[n] != n:
            n = group[n]
        return n

    for a in range(len(want)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                group[max(root(a), root(b))] = min(root(a), root(b))
    members: dict = {}
    for n, s in enumerate(sets):
        if s:
            members.setdefault(root(n), []).append(want[n])
    alone = sum(not s for s in sets)
    at = corpus_pipeline.saved(stages["jaccard_join"](spark, at, str(tmp_path)))
    out = [(r.doc_id, r.text) for r in at.collect()]
    assert len(out) == len(members) + alone
    first = [min(m, key=lambda r: (r[0] is None, r[0] or 0))[0] for m in members.values()]
    assert bag(i for i, t in out if word.search(t)) == bag(first)

    at = corpus_pipeline.saved(stages["pii"](spark, at, str(tmp_path)))
    clean = [(r.doc_id, r.text) for r in at.collect()]
    mail = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    assert len(clean) == len(out) and not any(mail.search(t) for _, t in clean)
    assert bag(x for x in clean if "<" not in x[1]) == bag(x for x in out if x in clean and "<" not in x[1])

    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = stages["packing"](spark, at, str(tmp_path)).collect()
    got: dict = {}
    for p in sorted(pieces, key=lambda p: p.piece):
        ids = np.frombuffer(p.ids, "<u4").tolist()
        assert len(ids) == p.length <= 1024 and zlib.crc32(p.ids) == p.ids_crc32
        got.setdefault((p.doc_id, p.piece == 0 and p.start), []).append(ids)
    assert sum(p.length for p in pieces) == sum(len(coder.encode(t, add_special_tokens=False).ids) + 1 for _, t in clean)
    full: dict = {}
    for p in pieces:
        full.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for parts in full.values():
        ends = 0
        for offset, length in sorted(parts):
            assert offset == ends
            ends += length
        assert ends <= 1024
