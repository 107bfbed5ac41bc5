"""N-gram Jaccard join by multiple global orders.

Texts become sets of shingle hashes; equal sets are one class. Two sets as alike as asked for must share a token
among the first few of each, under any order of all tokens. Several orders are used: each puts tokens that a
count sketch over all documents finds common last, and shuffles the rest by a hash of its own. The first order
gives lists of classes that share a prefix token. A pair from a list goes on when sizes and parity signatures
allow it, then when the prefixes under every further order also meet, and is then verified on whole sets.

Pairs of a list are not written out. First each class is tried with the one smaller class it shares most lists
with; links make components. Then only pairs across components are left to try, inside the lists that still
span several: twice the nearest candidate of each class, and at last all that are left. Long lists are cut into
blocks, and pairs of blocks are separate cells; the component that holds most of a list is never paired with
itself, so its classes go out once for each block of the others. A task streams its cells in order and works on
the small ones many at a time.

Prefixes under the further orders and whole sets are made again from the texts of the few classes in candidate
pairs; what is kept of every class is its size, signature and first prefix, and the prefix only until the lists
are made.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.bytehash import mix
from riskloom.llm.common import batches_of, documents, records, release, same, saved
from riskloom.llm.components import components
from riskloom.llm.shingles import shingle_sets

ORDERS = 3
SKETCH_BITS = 18
SKETCH_BLOCKS = 64
#: Prefix tokens of one bucket, on average at most.
BUCKET_TOKENS = 1_000_000
#: Classes of a list that are worked on as one block.
BLOCK = 1024
#: Bytes that a signature is folded to at most inside cells; candidates are tried on whole signatures after that.
COARSE_BYTES = 128
#: Rows of cells that a task works on together; a cell of more rows is worked on alone.
STEP_ROWS = 1 << 14
#: Candidate pairs that a task gathers before it reduces them or passes them on.
STEP_PAIRS = 1 << 18
#: Rows that a Python task gets at once: those with two whole sets each have some 10 KB, and the JVM, the task's input
#: and its lists hold them at the same time.
BATCH_ROWS = 2000
#: Bits of the map that tells which texts may be wanted: 4 MB, whatever the input.
MAP_BITS = 1 << 25
#: Rounds that try each class's nearest in another component, before all that is left is tried.
NEAREST_ROUNDS = 2
_U8 = np.dtype("<u8")
_MASK = np.uint64((1 << SKETCH_BITS) - 1)


def _texts(batch) -> list[bytes]:
    return [t.as_buffer().to_pybytes() for t in batch["text"]]


def _bins(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (tokens & _MASK).astype(np.int64), ((tokens >> np.uint64(24)) & _MASK).astype(np.int64)


def _sketch(width: int):
    def go(batches):
        counts = np.zeros((2, 1 << SKETCH_BITS), dtype=np.int64)
        for b in batches:
            for s in shingle_sets(_texts(b), width):
                for row, at in zip(counts, _bins(s)):
                    np.add.at(row, at, 1)
        yield _blocks(counts.reshape(SKETCH_BLOCKS, -1))

    return go


def _blocks(counts: np.ndarray, first: int = 0):
    return pa.RecordBatch.from_arrays(
        [pa.array(np.arange(first, first + len(counts), dtype=np.int32)), pa.array([r.tobytes() for r in counts], pa.binary())], ["block", "counts"]
    )


def _add(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x, dtype=np.int64) for x in table["counts"].to_pylist())
    return pa.Table.from_batches([_blocks(total[None], table["block"][0].as_py())])


def token_sketch(rows: DataFrame, width: int) -> np.ndarray:
    """Two rows of 2**18 counts over the tokens of all documents: 4 MB, whatever the input."""
    parts = rows.select("text").mapInArrow(_sketch(width), "block int, counts binary")
    out = np.zeros((SKETCH_BLOCKS, (2 << SKETCH_BITS) // SKETCH_BLOCKS), dtype=np.int64)
    for r in parts.groupBy("block").applyInArrow(_add, parts.schema).collect():
        out[r["block"]] = np.frombuffer(r["counts"], dtype=np.int64)
    return out.reshape(2, -1)


def commonness(counts: np.ndarray) -> np.ndarray:
    """Classes of the sketch's counts: 0 for what chance explains, then one per doubling. As 8-bit numbers."""
    mean = counts.sum() / counts.size
    return np.log2(np.maximum(1, counts / (mean + 4 * np.sqrt(mean) + 1))).astype(np.uint8)


def prefix_length(n: int, percent: int) -> int:
    """Tokens of a set of n of which two linked sets must share one: n - ceil(n * percent / 100) + 1."""
    return n - -(-n * percent // 100) + 1


def signature(s: np.ndarray) -> np.ndarray:
    """Parities of tokens per bit. Its size depends on the size of the set only roughly, so that near sizes
    compare: bits differing are at most the tokens not shared, after folding to the smaller size."""
    words = 4
    while words * 32 < len(s):
        words *= 2
    bits = np.bincount((s >> np.uint64(40)).astype(np.int64) & (words * 64 - 1), minlength=words * 64) & 1
    return np.packbits(bits.astype(np.uint8))


def fold(sig: np.ndarray, size: int) -> np.ndarray:
    while len(sig) > size:
        half = len(sig) // 2
        sig = sig[:half] ^ sig[half:]
    return sig


def _ranks(s: np.ndarray, table: np.ndarray) -> np.ndarray:
    """What comes first in every order of tokens: the classes of how common they are."""
    x, y = _bins(s)
    return np.minimum(table[0][x], table[1][y]).astype(np.uint64) << np.uint64(56)


def _prefix(s: np.ndarray, rank: np.ndarray, k: int, left: int) -> np.ndarray:
    """The first ``left`` tokens of a set under order ``k``, sorted by value."""
    if left >= len(s):
        return s
    order = rank | (mix(s + np.uint64(k * 0x51ED27)) >> np.uint64(8))
    return np.sort(s[np.argpartition(order, left - 1)[:left]])


def _describe(width: int, percent: int, common):
    def go(batches):
        table = common.value
        for b in batches:
            out: list[list] = [[] for _ in range(6)]
            for s in shingle_sets(_texts(b), width):
                name = hashlib.blake2b(s.astype(_U8).tobytes(), digest_size=16).digest() if len(s) else None
                first = _prefix(s, _ranks(s, table), 0, prefix_length(len(s), percent)) if len(s) else s
                sig = signature(s)
                row = (name, name and int.from_bytes(name[:8], "little", signed=True), len(s), sig.tobytes(), fold(sig, COARSE_BYTES).tobytes(), first.astype(_U8).tobytes())
                for column, v in zip(out, row):
                    column.append(v)
            kinds = [pa.binary(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], b["text_key"], *[pa.array(v, t) for v, t in zip(out, kinds)]],
                ["doc_id", "text_key", "class", "short", "n", "sig", "coarse", "p0"],
            )

    return go


def _scatter(buckets: int):
    """Prefix tokens of many classes as one block of numbers per bucket: (token, class by its first 8 bytes)."""

    def go(batches):
        for b in batches:
            short = np.frombuffer(b"".join(c[:8] for c in b["class"].to_pylist()), dtype=_U8)
            tokens = [np.frombuffer(p, dtype=_U8) for p in b["p0"].to_pylist()]
            if not tokens:
                continue
            who = np.repeat(short, [len(t) for t in tokens])
            token = np.concatenate(tokens)
            at = (mix(token) % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(at, kind="stable")
            at, token, who = at[order], token[order], who[order]
            cut = np.flatnonzero(np.diff(at)) + 1
            yield pa.RecordBatch.from_arrays([
                pa.array(at[np.concatenate(([0], cut))] if len(at) else at, pa.int32()),
                pa.array([np.stack((t, w)).tobytes() for t, w in zip(np.split(token, cut), np.split(who, cut))] if len(at) else [], pa.binary()),
            ], ["bucket", "block"])

    return go


def _lists(table: pa.Table) -> pa.Table:
    """Lists of two and more classes that share a token; equal lists once, with how many tokens gave them."""
    blocks = [np.frombuffer(x, dtype=_U8).reshape(2, -1) for x in table["block"].to_pylist()]
    token, who = np.concatenate([x[0] for x in blocks]), np.concatenate([x[1] for x in blocks])
    order = np.lexsort((who, token))
    token, who = token[order], who[order]
    first = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
    size = np.diff(np.append(first, len(token)))
    known: dict[bytes, list] = {}
    for a, n in zip(first[size > 1].tolist(), size[size > 1].tolist()):
        members = who[a : a + n]
        key = hashlib.blake2b(members.tobytes(), digest_size=16).digest()
        known.setdefault(key, [members, 0])[1] += 1
    members = [m for m, _ in known.values()]
    sizes = [len(m) for m in members]
    return pa.table({
        "list": pa.array([k for k, n in zip(known, sizes) for _ in range(n)], pa.binary()),
        "short": pa.array(np.concatenate(members).view(np.int64) if members else [], pa.int64()),
        "weight": pa.array(np.repeat([w for _, w in known.values()], sizes) if members else [], pa.int64()),
    })


def _close(n: int, m: np.ndarray, apart: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of n and m tokens with ``apart`` differing signature bits may still be linked: the tokens not
    shared are at least that many, and at most (100 - percent) / (100 + percent) of all for linked sets."""
    return (100 * np.minimum(n, m) >= percent * np.maximum(n, m)) & ((100 + percent) * apart <= (100 - percent) * (n + m))


def _folds(sigs: list[bytes], size: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each signature size: (row of each signature that is as long or longer, these folded to it)."""
    out, held = {}, None
    for step in np.unique(size)[::-1].tolist():
        own = np.flatnonzero(size == step)
        rows = np.frombuffer(b"".join(sigs[i] for i in own.tolist()), dtype=np.uint8).reshape(-1, step)
        if held is not None:
            at, longer = held
            while longer.shape[1] > step:
                half = longer.shape[1] // 2
                longer = longer[:, :half] ^ longer[:, half:]
            own, rows = np.concatenate((own, at)), np.concatenate((rows, longer))
        held = own, rows
        place = np.full(len(size), -1)
        place[own] = np.arange(len(own))
        out[step] = place, rows
    return out


def _allowed(cell, n, comp, side, sigs, percent: int):
    """(i, j, signature bits apart) of the pairs across components within a cell that sizes and signatures allow.

    Rows come by cell, smaller sets first. Step k pairs every row with the one k places on; a row drops out when that
    lies in another cell or is too large, and so are all further ones.
    """
    size = np.array([len(x) for x in sigs])
    folds = _folds(sigs, size)
    active, k = np.arange(len(n) - 1), 1
    while len(active):
        active = active[active + k < len(n)]
        j = active + k
        active = active[(cell[j] == cell[active]) & (n[j] * percent <= n[active] * 100)]
        i, j = active, active + k
        pick = (comp[i] != comp[j]) & ((side[i] != side[j]) | (side[i] == 2))
        i, j = i[pick], j[pick]
        for step in np.unique(size[i]).tolist():
            place, rows = folds[step]
            at = size[i] == step
            x, y = i[at], j[at]
            apart = np.bitwise_count(rows[place[x]] ^ rows[place[y]]).sum(axis=1, dtype=np.int64)
            keep = _close(n[x], n[y], apart, percent)
            yield x[keep], y[keep], apart[keep]
        k += 1


def _cross(percent: int, nearest: bool):
    """Candidate pairs (a, b, d) of a partition of cells, sorted by cell and size. nearest: of each class only the
    nearest in another component, with its distance, once per step; otherwise all, some of them more than once. No
    more than about ``STEP_PAIRS`` are held."""
    names = ["a", "b", "d"]

    def reduced(held: list, classes: int) -> list:
        if not held:
            return []
        a, b, d = (np.concatenate([f[x] for f in held]) for x in range(3))
        if nearest:
            order = np.lexsort((b, d, a))
            order = order[np.concatenate(([True], np.diff(a[order]) != 0))]
        else:
            order = np.unique(a * (classes + 1) + b, return_index=True)[1]
        return [(a[order], b[order], d[order])]

    def work(table: pa.Table):
        table = table.combine_chunks()
        n, side, number = (table[c].to_numpy().astype(np.int64) for c in ("n", "side", "cell"))
        comp = table["root"].combine_chunks().dictionary_encode().indices.to_numpy()
        who = table["class"].combine_chunks().dictionary_encode()
        known = who.indices.to_numpy().astype(np.int64)
        held, pairs = [], 0
        for i, j, apart in _allowed(number, n, comp, side, table["coarse"].to_pylist(), percent):
            if not len(i):
                continue
            d, a, b = apart / np.maximum(1, n[i] + n[j]), known[i], known[j]
            if nearest:
                held.append((np.concatenate((a, b)), np.concatenate((b, a)), np.concatenate((d, d))))
            else:
                held.append((np.minimum(a, b), np.maximum(a, b), d))
            pairs += len(held[-1][0])
            if pairs >= STEP_PAIRS:
                held = reduced(held, len(who.dictionary))
                pairs = len(held[0][0])
                if not nearest and 2 * pairs >= STEP_PAIRS:
                    yield batch(who, held)
                    held, pairs = [], 0
        if held:
            yield batch(who, reduced(held, len(who.dictionary)))

    def batch(who, held: list) -> pa.RecordBatch:
        a, b, d = held[0]
        return pa.RecordBatch.from_arrays([who.dictionary.take(pa.array(a)), who.dictionary.take(pa.array(b)), pa.array(d)], names)

    def go(batches):
        held, rows = [], 0
        for b in batches:
            while b.num_rows:
                last = held[-1]["cell"][-1].as_py() if held else None
                # A step ends only where a cell does.
                if rows >= STEP_ROWS:
                    ends = pc.index(pc.not_equal(b["cell"], last), True).as_py()
                    take = b.num_rows if ends < 0 else ends
                    if take:
                        held.append(b.slice(0, take))
                        rows += take
                    b = b.slice(take)
                    if ends >= 0:
                        yield from work(pa.Table.from_batches(held))
                        held, rows = [], 0
                    continue
                part = b.slice(0, STEP_ROWS - rows)
                held.append(part)
                rows += part.num_rows
                b = b.slice(part.num_rows)
        if held:
            yield from work(pa.Table.from_batches(held))

    return go


def _signs_allow(percent: int):
    def go(batches):
        for b in batches:
            keep = []
            for n, m, x, y in zip(*(b[c].to_pylist() for c in ("xn", "yn", "xs", "ys"))):
                size = min(len(x), len(y))
                apart = np.bitwise_count(fold(np.frombuffer(x, np.uint8), size) ^ fold(np.frombuffer(y, np.uint8), size)).sum(dtype=np.int64)
                keep.append(bool(_close(n, m, apart, percent)))
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return go


def _sets(width: int, percent: int, common):
    """Whole sets, and the prefixes under the further orders as 32-bit numbers."""

    def go(batches):
        for b in batches:
            sets, more = [], [[] for _ in range(ORDERS - 1)]
            for s in shingle_sets(_texts(b), width):
                sets.append(s.astype(_U8).tobytes())
                rank, left = _ranks(s, common.value), prefix_length(len(s), percent)
                for k, column in enumerate(more, 1):
                    column.append(np.sort((_prefix(s, rank, k, left) >> np.uint64(32)).astype("<u4")).tobytes())
            yield pa.RecordBatch.from_arrays(
                [b["class"], pa.array(sets, pa.binary()), *[pa.array(m, pa.binary()) for m in more]],
                ["class", "tokens", *[f"p{k}" for k in range(1, ORDERS)]],
            )

    return go


def _linked(percent: int):
    """Pairs whose prefixes meet under every further order, and then whose whole sets are alike."""

    def go(batches):
        for b in batches:
            columns = [b[f"{side}{k}"].to_pylist() for k in range(1, ORDERS) for side in "xy"]
            keep = []
            for x, y, *prefix in zip(b["x"].to_pylist(), b["y"].to_pylist(), *columns):
                met = all(len(np.intersect1d(np.frombuffer(p, "<u4"), np.frombuffer(q, "<u4"))) for p, q in zip(prefix[::2], prefix[1::2]))
                if met:
                    x, y = np.frombuffer(x, _U8), np.frombuffer(y, _U8)
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    met = 100 * both >= percent * (len(x) + len(y) - both)
                keep.append(met)
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return go


def _may_be_among(rows: DataFrame, few: DataFrame) -> DataFrame:
    """The rows that are in ``few`` by (doc_id, text_key), and a small share of the others: no other text is shuffled
    to meet ``few``. A bitmap of hashes, of bounded size, goes to all tasks."""
    spot = F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(MAP_BITS))
    of = few.select(F.bitmap_bucket_number(spot).alias("part"), F.bitmap_bit_position(spot).alias("at"))
    bits = of.groupBy("part").agg(F.bitmap_construct_agg("at").alias("bits"))
    at = F.bitmap_bit_position(spot).cast("int")
    byte = F.conv(F.hex(F.substring(F.col("bits"), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), at % 8)) != 0
    marked = rows.withColumn("part", F.bitmap_bucket_number(spot)).join(F.broadcast(bits), "part")
    return marked.where(is_set).select(*rows.columns)


def _cells(lists: DataFrame, roots: DataFrame, small: DataFrame) -> DataFrame:
    """The lists that span components as rows (cell, class, n, coarse, root, side), cut into pairs of blocks.

    A list of up to ``BLOCK`` classes is one cell. In a longer one the classes of its largest component make blocks of
    their own, and these meet only the blocks of the others. ``side`` tells the two blocks of a cell apart, 2 where it
    is one block. Lists are chosen and cut by (list, short, root) alone; sizes and signatures join what is left.
    """
    spread = lists.join(roots, "short")
    parts = spread.groupBy("list", "root").agg(F.count("*").alias("c"))
    whole = parts.groupBy("list").agg(F.sum("c").alias("size"), F.max_by("root", F.struct("c", "root")).alias("big"), F.max("c").alias("most"))
    whole = whole.where("size > most")
    blocks = lambda c: F.ceil(c / F.lit(BLOCK)).cast("int")
    short = F.col("size") <= BLOCK
    k1 = F.when(short, 1).otherwise(blocks(F.col("most"))).alias("k1")
    k2 = F.when(short, 0).otherwise(blocks(F.col("size") - F.col("most"))).alias("k2")
    rows = spread.join(whole.select("list", "big", k1, k2), "list")
    in_big = (F.col("root") == F.col("big")) | (F.col("k2") == 0)
    spot = F.xxhash64("short")
    own = F.when(in_big, F.pmod(spot, F.col("k1"))).otherwise(F.col("k1") + F.pmod(spot, F.greatest("k2", F.lit(1)))).cast("int")
    first = F.when(in_big & (F.col("k2") > 0), F.col("k1")).otherwise(0)
    rows = rows.withColumn("i", own).withColumn("j", F.explode(F.sequence(first, F.greatest(F.col("k1") + F.col("k2") - 1, first))))
    side = F.when(F.col("i") == F.col("j"), 2).when(F.col("i") < F.col("j"), 0).otherwise(1)
    cell = F.xxhash64("list", F.least("i", "j"), F.greatest("i", "j"))
    rows = rows.select(cell.alias("cell"), "short", "root", side.cast("byte").alias("side"))
    return rows.join(small.select("short", "class", "n", "coarse"), "short").drop("short")


def classes_and_links(docs: DataFrame, width: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(members, links, roots): members (doc_id, text_key, class, n) of every row; links (a, b), enough of the
    links between classes to connect all that are connected; roots (node, root) of the linked classes."""
    with batches_of(docs.sparkSession, BATCH_ROWS):  # every Python step below is run at once
        return _classes_and_links(docs, width, percent)


def _classes_and_links(docs: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    spark = docs.sparkSession
    rows = records(docs).select("doc_id", "text_key", "text")
    common = spark.sparkContext.broadcast(commonness(token_sketch(rows, width)))
    columns = "doc_id long, text_key long, class binary, short long, n int, sig binary, coarse binary, p0 binary"
    known = saved(rows.mapInArrow(_describe(width, percent, common), columns))
    row = F.struct("doc_id", "text_key", "short", "n", "sig", "coarse", "p0")
    data = saved(known.where("n > 0").groupBy("class").agg(F.first(row).alias("row")).select("class", "row.*"))
    members = saved(known.select("doc_id", "text_key", "class", "n"))
    release(known)
    total = data.agg(F.sum(F.length("p0") / 8)).first()[0] or 0
    buckets = int(max(128, -(-total // BUCKET_TOKENS)))
    lists = saved(
        data.select("class", "p0").mapInArrow(_scatter(buckets), "bucket int, block binary")
        .groupBy("bucket").applyInArrow(_lists, "list binary, short long, weight long")
        .groupBy("list", "short").agg(F.sum("weight").alias("weight"))
    )
    # Only classes in a list can have a candidate; the first prefixes have done their work.
    listed = lists.select("short").distinct()
    small = saved(data.drop("p0").join(listed, "short", "left_semi"))
    release(data)
    made = "class binary, tokens binary" + "".join(f", p{k} binary" for k in range(1, ORDERS))

    def verified(pairs: DataFrame) -> DataFrame:
        pairs = saved(pairs)
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()
        # Saved, its size is known: while it is small no text is shuffled to meet it, and later few others than its own.
        one = saved(small.select("class", "doc_id", "text_key").join(wanted, "class"))
        near = _may_be_among(rows, one)
        texts = near.join(one, same(near, one, "doc_id", "text_key")).select("class", "text").dropDuplicates(["class"])
        sets = saved(texts.mapInArrow(_sets(width, percent, common), made))
        both = pairs
        for side, c in (("x", "a"), ("y", "b")):
            renamed = [F.col("class").alias(c), F.col("tokens").alias(side), *[F.col(f"p{k}").alias(f"{side}{k}") for k in range(1, ORDERS)]]
            both = both.join(sets.select(*renamed), c)
        out = saved(both.mapInArrow(_linked(percent), "a binary, b binary"))
        for table in (pairs, one, sets):
            release(table)
        return out

    # The smaller class that a class shares most prefix tokens with.
    heads = lists.groupBy("list").agg(F.min("short").alias("head"))
    tries = lists.join(heads, "list").where("short <> head").groupBy("short", "head").agg(F.sum("weight").alias("w"))
    tries = tries.groupBy("short").agg(F.max_by("head", F.struct("w", "head")).alias("head"))
    def allowed(pairs: DataFrame, key: str) -> DataFrame:
        """Pairs (x, y) by ``key`` as (a, b) by class, where sizes and whole signatures allow them."""
        x, y = (small.select(*[F.col(c).alias(d) for c, d in names]) for names in (
            ((key, "x"), ("class", "a"), ("n", "xn"), ("sig", "xs")), ((key, "y"), ("class", "b"), ("n", "yn"), ("sig", "ys"))
        ))
        return pairs.join(x, "x").join(y, "y").select(
            F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "xn", "yn", "xs", "ys"
        ).mapInArrow(_signs_allow(percent), "a binary, b binary")

    links = verified(allowed(tries.select(F.col("short").alias("x"), F.col("head").alias("y")), "short"))
    roots = saved(components(links))
    for step in range(NEAREST_ROUNDS + 1):
        last = step == NEAREST_ROUNDS
        rooted = small.select("class", "short").join(roots.withColumnRenamed("node", "class"), "class", "left").select(
            "short", F.coalesce("root", "class").alias("root")
        )
        cells = _cells(lists.select("list", "short"), rooted, small)
        dealt = cells.repartition("cell").sortWithinPartitions("cell", "n")
        found = dealt.mapInArrow(_cross(percent, not last), "a binary, b binary, d double")
        if not last:
            found = found.groupBy("a").agg(F.min_by("b", F.struct("d", "b")).alias("b"))
        found = saved(found.select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y")).distinct())
        if not found.count():
            break  # nothing is left across components
        fresh = verified(allowed(found, "class"))
        if fresh.count():
            links = links.unionByName(fresh)
            before, roots = roots, saved(components(links))
            release(before)
        release(found)
    release(lists)
    release(small)
    return members, links, roots


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(rec, doc_id, n_shingles, component_id) for every input row; ``rec`` holds all its columns.

    A row's set: the distinct runs of ``width`` words, A-Z in lower case; all words as one with fewer; empty
    without words (null text too), and then alone. Two rows link when 100 * shared >= percent * union; equal
    sets always do. component_id is the smallest id reachable, null ids left out. Tokens are 64-bit hashes.
    """
    members, _, roots = classes_and_links(docs, width, percent)
    wide = members.join(roots.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    least = wide.where("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("least"))
    out = wide.join(least, "root", "left").select(
        "doc_id", "text_key", F.col("n").cast("long").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id")
    ).distinct()
    rows = records(docs).drop("text")
    return rows.join(out, same(rows, out, "doc_id", "text_key"), "left").select(rows["rec"], rows["doc_id"], "n_shingles", "component_id")


def one_per_group(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The input's columns; of each group of linked rows the one with the smallest id (null ids last).

    Rows without words are nobody's copies and all stay. Of rows equal in id and text one stays.
    """
    members, _, roots = classes_and_links(docs, width, percent)
    wide = members.join(roots.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key")
    first = wide.where("root IS NOT NULL").groupBy("root").agg(F.min(order).alias("m")).select("m.doc_id", "m.text_key")
    alone = wide.where("root IS NULL").select("doc_id", "text_key").distinct()
    rows = records(docs).drop("text")
    keep = rows.join(first, same(rows, first, "doc_id", "text_key")).select(rows["*"]).dropDuplicates(["doc_id", "text_key"])
    rest = rows.join(alone, same(rows, alone, "doc_id", "text_key")).select(rows["*"])
    return keep.unionByName(rest).select("rec.*")


def op3_jaccard_join(spark, sf_dir) -> DataFrame:
    """One row per document; null and empty texts, repeated rows and ids as in ``near_duplicates``."""
    return near_duplicates(documents(spark, sf_dir), width=4, percent=85).select("doc_id", "n_shingles", "component_id")
