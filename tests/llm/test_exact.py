"""Operators against brute force on a small table with every awkward row."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_help import bag
from pyspark.sql import functions as F

from riskloom.llm import fingerprints, jaccard_join, line_dedup, packing, pii, quality_rules, sharding, suffix_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
sha = lambda b: hashlib.sha256(b).hexdigest()


@pytest.mark.parametrize("hot_key", [50_000, 1])
def test_repeats(docs, rows, no_docs, monkeypatch, hot_key):
    monkeypatch.setattr(suffix_dedup, "HOT_KEY", hot_key)
    raw = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(t[p : p + 400] for _, t in raw for p in range(len(t) - 399))
    want = []
    for i, t in raw:
        gone = bytearray(len(t))
        for p in range(len(t) - 399):
            if seen[t[p : p + 400]] > 1:
                gone[p : p + 400] = b"\1" * 400
        want.append((i, len(t), sum(gone), len(re.findall(b"\1+", bytes(gone))), sha(bytes(c for c, g in zip(t, gone) if not g))))
    out = suffix_dedup.remove_repeats(docs).select("rec.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
    assert bag(map(tuple, out.collect())) == bag(want)
    assert suffix_dedup.remove_repeats(no_docs).count() == 0


def test_colliding_hashes_are_noticed(monkeypatch):
    texts = [b"abcd" * 20, b"abca" * 20, b"b" * 80, b"abcd" * 20]
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    monkeypatch.setattr(suffix_dedup, "substring", lambda p, a, b: np.zeros(len(a), dtype=np.uint64))
    order, agree = suffix_dedup.Suffixes(data, np.arange(4) * 80, np.full(4, 80)).sorted_runs(np.zeros(4, dtype=np.int64))
    assert [texts[k] for k in order] == sorted(texts) and agree.tolist() == [0, 3, 80, 0]


def test_statistics(docs, rows):
    want = []
    for i, t in rows:
        t = t or ""
        w = WORD.findall(t)
        lines = [x for x in t.split("\n") if WORD.search(x)]
        at: dict = {}
        for k in range(len(w) - 7):
            at.setdefault(tuple(w[k : k + 8]), []).append(k)
        twice = {k + j for v in at.values() if len(v) > 1 for k in v for j in range(8)}
        base = len(w) < 20 or 100 * len(twice) > 30 * len(w)
        want.append((i, len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(twice), base))
    got = quality_rules.judge(docs, []).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert bag(map(tuple, got.collect())) == bag(want)


def test_rules_are_learned_and_applied_in_order(spark, docs, labels, no_docs):
    text = lambda n, mark: " ".join(f"{'w' * (1 + n % 9)}{n}x{k}{mark if k % 2 else ''}" for k in range(40 + n % 30))
    clean = [(n, text(n, ""), 1) for n in range(200)]
    junk = [(1000 + n, text(n, "###"), 0) for n in range(100)]
    d = spark.createDataFrame([r[:2] for r in clean + junk], "doc_id long, text string")
    lab = spark.createDataFrame([(i, q) for i, _, q in clean + junk], "doc_id long, quality int")
    rules = quality_rules.learn_from_labels(d, lab)
    assert rules and rules[0][0][0] == "symbol_rate" and rules[0][0][1] == ">" and rules[0][0][2] > 0
    got = {r.doc_id: r.kept for r in quality_rules.judge(d, rules).collect()}
    assert all(got[i] == bool(q) for i, _, q in clean + junk)
    assert quality_rules.learn_from_labels(d, lab.where("false")) == []
    assert quality_rules.learn_from_labels(d, lab.where("quality = 1")) == []
    assert quality_rules.learn_from_labels(no_docs, labels) == []
    assert quality_rules.judge(docs, quality_rules.learn_from_labels(docs, labels)).count() == docs.count()


def components_by_brute_force(rows, width, percent):
    sets = []
    for _, t in rows:
        w = WORD.findall((t or "").translate(LOWER))
        sets.append({tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    groups: dict = {}
    for k in range(len(rows)):
        groups.setdefault(find(k), []).append(k)
    return sets, groups


@pytest.mark.parametrize(("width", "percent", "block"), [(4, 85, 1024), (5, 80, 2)])
def test_near_duplicates(docs, rows, no_docs, monkeypatch, width, percent, block):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    sets, groups = components_by_brute_force(rows, width, percent)
    want = []
    for members in groups.values():
        least = min((rows[k][0] for k in members if rows[k][0] is not None), default=None)
        want += [(rows[k][0], len(sets[k]), least) for k in members]
    got = jaccard_join.near_duplicates(docs, width, percent).select("doc_id", "n_shingles", "component_id")
    assert bag(map(tuple, got.collect())) == bag(want)
    assert jaccard_join.near_duplicates(no_docs, width, percent).count() == 0


def test_one_of_each_group_stays(docs, rows):
    sets, groups = components_by_brute_force(rows, 5, 80)
    want = []
    for members in groups.values():
        if sets[members[0]]:
            ids = [rows[k][0] for k in members if rows[k][0] is not None]
            want.append(min(ids) if ids else None)
        else:
            want += [rows[k][0] for k in members]
    out = jaccard_join.one_per_group(docs)
    assert out.columns == docs.columns
    assert bag(r.doc_id for r in out.collect()) == bag(want)


def test_packing(docs, rows, no_docs):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    want = []
    for i, text in rows:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        head = len(ids) % 1024 or min(1024, len(ids))
        for n, a in enumerate([0, *range(head, len(ids), 1024)]):
            part = np.array(ids[a : head if n == 0 else a + 1024], dtype="<u4")
            want.append((i, n, a, len(part), zlib.crc32(part.tobytes())))
    out = packing.pack_documents(docs, with_ids=True).collect()
    assert bag((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == bag(want)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in out)
    packed: dict = {}
    for r in out:
        packed.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in packed.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(packed) <= -(-sum(r.length for r in out) // 1024) + 1
    assert packing.pack_documents(no_docs).count() == 0


def test_added_tokens_have_the_ids_of_the_json(spark):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    texts = [f"end {end} start", end, f"a{end}{end} b", f"  {end}\n x", f"x  {end}  y", f"é{end}'s 12{end}", "<|endoftext|", "<<|endoftext|>>", end.upper(), "", f"word {end} " * 900]
    coder = packing.ByteBpe()
    assert [coder.encode(x) for x in texts] == [t.encode(x, add_special_tokens=False).ids for x in texts]
    assert coder.encode(texts[0]) == [437, 220, 50256, 923]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r.doc_id, r.piece): r.ids_crc32 for r in packing.pack_documents(docs).collect()}
    for n, x in enumerate(texts):
        ids = np.array([*t.encode(x, add_special_tokens=False).ids, 2], dtype="<u4")
        for k, (a, m) in enumerate(packing.piece_bounds(len(ids), 1024)):
            assert got.pop((n, k)) == zlib.crc32(ids[a : a + m].tobytes())
    assert not got


def test_plan_is_best_fit():
    counts = {700: 3, 600: 2, 400: 2, 300: 4, 24: 5, 1024: 1}
    used: dict = {}
    for length, a, b, first, per, place in packing.plan(counts):
        for r in range(b - a):
            used.setdefault(first + r // per, []).append((place + length * (r % per), length))
    assert sum(len(v) for v in used.values()) == sum(counts.values())
    assert sum(n for v in used.values() for _, n in v) == sum(k * v for k, v in counts.items())
    assert len(used) == 7
    for parts in used.values():
        at = 0
        for place, n in sorted(parts):
            assert place == at
            at += n
        assert at <= 1024
    assert packing.plan({}) == []
    assert packing.plan({1024: 10**12}) == [(1024, 0, 10**12, 0, 1, 0)]


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize("partitions", ["3", "64"])
def test_lines(spark, docs, rows, no_docs, keep_first, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(LOWER)
        found = Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")} if k)
        out = line_dedup.drop_common_lines(docs, 10, keep_first).select("rec.doc_id", "n_lines", "n_dropped", "kept_text").collect()
        if not keep_first:
            want = []
            for i, t in rows:
                ls = (t or "").split("\n")
                stay = [x for x in ls if found[key(x)] < 10]
                want.append((i, len(ls), len(ls) - len(stay), "\n".join(stay)))
            assert bag(map(tuple, out)) == bag(want)
        else:
            lines = [x for r in out for x in r.kept_text.split("\n")]
            assert sum(key(x) == "shared line of text" for x in lines) == 1
            assert sum(r.n_dropped for r in out) == 11
        assert line_dedup.drop_common_lines(no_docs).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_fingerprints(docs, rows, no_docs):
    out = fingerprints.with_next(docs).select("doc_id", "text", "next_text").collect()
    order = sorted(((i is not None, i or 0), t or "") for i, t in rows)
    got = sorted(((r.doc_id is not None, r.doc_id or 0), r.text, r.next_text) for r in out)
    # Rows with equal ids follow one another in some order; ids alone fix the rest.
    ids = [o[0] for o in order]
    by_text = {(i, t) for i, t in order}
    for i, t, nxt in got:
        last = max(k for k, x in enumerate(ids) if x == i)
        assert any((j, nxt) in by_text for j in {i, ids[(last + 1) % len(ids)]})
    alone = [(i, t, n) for i, t, n in got if ids.count(i) == 1 and ids.count(ids[(ids.index(i) + 1) % len(ids)]) == 1]
    for i, _, nxt in alone:
        assert nxt == order[(ids.index(i) + 1) % len(ids)][1]
    a = F.col("a")
    one = docs.select("doc_id", fingerprints.anchors(F.coalesce("text", F.lit(""))).alias("a")).select("doc_id", "a", fingerprints.likeness(a, a).alias("self"))
    assert {r.self for r in one.collect()} == {1.0}
    assert fingerprints.with_next(no_docs).count() == 0


def test_syncmers_are_context_free(spark):
    w = [f"word{k}" for k in range(200)]
    d = spark.createDataFrame([(0, " ".join(w)), (1, " ".join(["new"] * 7 + w)), (2, " ".join(f"x{k}" for k in range(200)))], "doc_id long, text string")
    r = d.select(fingerprints.anchors(F.col("text")).alias("a")).collect()
    places = {x.hash: x.place for x in r[0].a}
    moved = {x.hash: x.place for x in r[1].a}
    assert len(places) > 60 and all(moved[h] == p + 7 for h, p in places.items())
    like = d.alias("x").crossJoin(d.alias("y")).select(
        F.col("x.doc_id"), F.col("y.doc_id"), fingerprints.likeness(fingerprints.anchors(F.col("x.text")), fingerprints.anchors(F.col("y.text")))
    ).collect()
    value = {(a, b): v for a, b, v in like}
    assert value[0, 1] > 0.9 and value[0, 2] == 0.0 and value[1, 1] == 1.0


def test_likeness_of_texts_with_passages_put_in(spark):
    w = [f"word{k}" for k in range(1000)]
    new = lambda n: [f"new{n}x{k}" for k in range(40)]
    copies = [w, w[:500] + new(1) + w[500:], w[:333] + new(1) + w[333:666] + new(2) + w[666:], w[:300] + w[350:700] + w[760:], w[500:] + w[:500]]
    d = spark.createDataFrame([(n, " ".join(w), " ".join(c)) for n, c in enumerate(copies)], "n int, x string, y string")
    got = {r.n: r.like for r in d.select("n", fingerprints.likeness(fingerprints.anchors(F.col("x")), fingerprints.anchors(F.col("y"))).alias("like")).collect()}
    assert got[0] == 1 and got[1] > 0.85 and got[2] > 0.8 and got[3] > 0.75 and 0.3 < got[4] < 0.7


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def h64(data, seed=42):
    import xxhash

    return signed(xxhash.xxh64(data, seed=seed % (1 << 64)).intdigest())


def chained(*longs):
    seed = 42
    for v in longs:
        seed = h64(v.to_bytes(8, "little", signed=True), seed)
    return seed


def brute_anchors(t):
    w = WORD.findall(t)
    if len(w) < 5:
        return [(h64(" ".join(w).encode()), 0)] if w else []
    one = [h64(x.encode()) for x in w]
    two = [chained(a, b) for a, b in zip(one, one[1:])]
    four = [chained(a, b) for a, b in zip(two, two[2:])]
    first = {}
    for i in range(len(w) - 4):
        low = min(two[i : i + 4])
        if low in (two[i], two[i + 3]):
            first.setdefault(chained(four[i], one[i + 4]), i)
    return sorted(first.items())


def brute_likeness(a, b):
    from bisect import bisect_left

    if not a or not b:
        return float(not a and not b)
    there = dict(b)
    ends: list = []
    shared = sorted((p, there[h]) for h, p in a if h in there)
    for _, x in shared:
        ends[(at := bisect_left(ends, x)) : at + 1] = [x]
    return len(ends) / (len(a) + len(b) - len(shared))


def test_fingerprint_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    text = lambda a: " ".join(f"{h % (1 << 64):X}@{p}" for h, p in a)
    want = []
    for n, (i, t) in enumerate(docs):
        nxt = docs[(n + 1) % len(docs)][1]
        half = len(t) // 2
        e = t[: len(t) - half] + nxt[:half]
        a, b, c = brute_anchors(t), brute_anchors(e), brute_anchors(nxt)
        want.append((i, len(t), sha(e.encode()), text(a), text(b), brute_likeness(a, b), brute_likeness(a, c)))
    got = sorted(map(tuple, fingerprints.op7_fingerprints(spark, sf).collect()))
    assert got == want


def test_long_texts_that_differ_in_one_passage(spark):
    w = [f"word{k * 7919 % 20011}" for k in range(20_000)]
    other = w[:9000] + [f"new{k}" for k in range(60)] + w[9060:]
    d = spark.createDataFrame([(" ".join(w), " ".join(other))], "x string, y string").select(
        fingerprints.anchors(F.col("x")).alias("a"), fingerprints.anchors(F.col("y")).alias("b"))
    r = d.select("a", "b", fingerprints.likeness(F.col("a"), F.col("b")).alias("like")).first()
    assert len(r.a) > 6000 and r.a != r.b and 0.98 < r.like < 1


def test_no_id_is_one_group(spark, monkeypatch):
    """A third of the ids null, a third equal: ranges of both are cut by text."""
    monkeypatch.setattr(fingerprints, "RANGE_ROWS", 50)
    rows = [(None if n % 3 == 0 else 7 if n % 3 == 1 else n, f"text {n} of many") for n in range(3000)]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = fingerprints.with_next(d)
    got = out.collect()
    assert bag((r.doc_id, r.text) for r in got) == bag(rows)
    assert len({r.next_text for r in got}) == 3000  # one ring through all rows
    follows = {r.text: r.next_text for r in got}
    at, seen = got[0].text, set()
    while at not in seen:
        seen.add(at)
        at = follows[at]
    assert len(seen) == 3000
    ids = {t: i for i, t in rows}
    steps = [(ids[a], ids[b]) for a, b in follows.items()]
    back = [(a, b) for a, b in steps if (a is not None, a or 0) > (b is not None, b or 0)]
    assert len(back) == 1  # ids rise along the ring but for its end


def test_longest_rise(spark):
    from bisect import bisect_left
    from random import Random

    rnd, lists = Random(4), [[], [3], [2, 1], [1, 2, 3]]
    lists += [rnd.sample(range(200), rnd.randint(1, 60)) for _ in range(30)]
    for r in spark.createDataFrame([(x,) for x in lists], "a array<int>").select("a", fingerprints.longest_rise(F.col("a")).alias("n")).collect():
        ends: list = []
        for x in r.a:
            ends[(at := bisect_left(ends, x)) : at + 1] = [x]
        assert r.n == len(ends)


def brute_spans(t):
    out = []
    patterns = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
                ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))
    for kind, p in patterns:
        for m in re.finditer(p, t):
            d = re.sub("[^0-9]", "", m.group())
            luhn = sum(int(c) * (1 + n % 2) - 9 * (int(c) * (1 + n % 2) > 9) for n, c in enumerate(reversed(d))) % 10 == 0
            if {"ip": lambda: all(int(x) <= 255 for x in m.group().split(".")), "card": lambda: 13 <= len(d) <= 19 and luhn,
                "phone": lambda: 9 <= len(d) <= 15, "email": lambda: True}[kind]():
                out.append((kind, m.start(), m.end()))
    return out


def test_personal_data(spark, docs, rows, no_docs):
    more = ["a@b.c%d@e.f x@y", "a@b@c.d", "1.2.3.4.5.6.7.8 999.2.3.4 01.002.0003.4", "12  34-5 4111-1111-1111-1111-", "😀 +49 (30) 1234567. 😀x@y.de", "@a.b @@ .@.", "+1 2"]
    d = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(5000 + n, t) for n, t in enumerate(more)], "doc_id long, text string"))
    known = [*rows, *((5000 + n, t) for n, t in enumerate(more))]
    out = pii.detect(d).collect()
    assert bag((r.doc_id, [tuple(b) for b in r.base]) for r in out) == bag((i, brute_spans(t or "")) for i, t in known)
    for r in out:
        assert {tuple(b) for b in r.base} <= {tuple(s) for s in r.spans}
    assert pii.detect(no_docs).count() == 0


def test_disguised_addresses_are_added(spark):
    texts = [f"please write to user{n}@host{n % 7}.org for more of it" if n % 2 else f"the mail user{n}@host{n % 7}.example.com. Then nothing" for n in range(200)]
    planted = {1000: ("write to john @ example.com for more", "john @ example.com"), 1001: ("write to anna (at) example (dot) com for more", "anna (at) example (dot) com"),
               1002: ("write to eve [at] example.org for more", "eve [at] example.org"), 1003: ("write to bob@example.com for more", "bob@example.com")}
    others = {1004: "meet me @ home. Later we go", 1005: "nothing here"}
    rows = [*enumerate(texts), *((i, t) for i, (t, _) in planted.items()), *others.items()]
    got = {r.doc_id: [(s.kind, s.start, s.stop) for s in r.spans] for r in pii.detect(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, (t, m) in planted.items():
        assert got[i] == [("email", t.index(m), t.index(m) + len(m))], (t, got[i])
    assert got[1004] == [] and got[1005] == []
    assert all(got[n] == [("email", *re.search(r"\S+@[a-z0-9]+(\.[a-z]+)+", t).span())] for n, t in enumerate(texts))


def test_redaction(spark):
    d = spark.createDataFrame([("mail a@b.co or 10.0.0.1!", [("email", 5, 11), ("ip", 15, 23)]), ("abcdef", [("x", 1, 4), ("y", 2, 5)]), ("", [])],
                              "text string, spans array<struct<kind:string,start:int,stop:int>>")
    assert [r[0] for r in d.select(pii.redact(F.col("text"), F.col("spans"))).collect()] == ["mail <EMAIL> or <IP>!", "a<X>f", ""]


def test_shards(docs, rows, no_docs):
    out = sharding.shuffle_shards(docs, 7).select("doc_id", "size", "text_crc32", "shard", "slot").collect()
    assert bag((r.doc_id, r.size, r.text_crc32) for r in out) == bag((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    by: dict = {}
    for r in out:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    again = sharding.shuffle_shards(docs.repartition(3), 7).select("doc_id", "size", "text_crc32", "shard", "slot").collect()
    assert bag(map(tuple, again)) == bag(map(tuple, out))
    assert sharding.shuffle_shards(no_docs).count() == 0
    assert sorted(sharding.fisher_yates(50, 1, 2).tolist()) == list(range(50))


def test_null_ids_spread_over_buckets(spark):
    d = spark.createDataFrame([(None if n % 3 == 0 else 5 if n % 3 == 1 else n, f"t{n}") for n in range(3000)], "doc_id long, text string")
    out = sharding.shuffle_shards(d, 16, min_buckets=32)
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 3000 and out.select("shard", "slot").distinct().count() == 3000
    bucket = d.groupBy(F.pmod(F.xxhash64(F.lit(sharding.SEED), "doc_id", "text"), F.lit(32))).count().collect()
    assert len(bucket) == 32 and max(r["count"] for r in bucket) < 200


def test_clashing_columns_are_written(spark, tmp_path):
    d = spark.createDataFrame([(n, f"t{n}", 7, n * 2, "x") for n in range(40)], "doc_id long, text string, shard int, slot long, input_shard string")
    sharding.write_shards(d, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert set(back.columns) == {"doc_id", "text", "input_input_shard", "input_slot", "input_shard", "shard", "slot"}
    assert {(r.input_input_shard, r.input_slot == 2 * r.doc_id, r.input_shard) for r in back.collect()} == {(7, True, "x")}


def test_shards_are_written(spark, docs, tmp_path):
    sharding.write_shards(docs, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == docs.count() and {r.shard for r in back.select("shard").distinct().collect()} == {0, 1, 2, 3}
