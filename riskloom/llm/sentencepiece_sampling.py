"""Distinct sampled segmentations by Gumbel top-k over the piece lattice.

Pieces of the public model get Zipf probabilities from their merge ranks; a character without a piece of its
own is spelled in byte pieces. No piece reaches past the start of a word, so a text's lattice is a chain of word
lattices. Those of the distinct words of a batch are built together: pieces are looked up by substring
hashes, and masses run backwards from the word ends. Drawing a segmentation piece by piece is a walk down
the tree of all segmentations.

Sampling without replacement is a best-first search over that tree with perturbed bounds: each open node stands
for "as this path up to piece t, then another piece", its bound is the maximum of Gumbel noise over all
segmentations below it, drawn from the node's mass and truncated at its parent's. The node with the highest
bound opens next, so segmentations come out in the order of their noise, all different. The bound left on top
after k of them is the threshold from which inclusion probabilities follow. All draws come from a hash of the
row key, so neither partitions nor batches change them.
"""

from __future__ import annotations

import functools
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.bytehash import mix, prefixes, substring
from riskloom.llm.common import documents, records

SAMPLES = 3
ALPHA = 1.0
SEED = 97
#: Texts are sampled together up to about this many characters.
CHUNK_CHARS = 2_000_000
#: log(-log(u)) of 53-bit numbers u lies between -36.8 and 3.7.
NOISE_SPAN = 41.0
SPACE = 0x2581
_ALL = (1 << 64) - 1
_STEP, _UNIT, _ROUND = (np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def uniform(keys: np.ndarray) -> np.ndarray:
    """Numbers inside (0, 1) from 64-bit keys."""
    return ((mix(keys) >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)


#: Bits of a hash that choose its place in a table.
PLACE_BITS = 18
_FAR = np.uint64(64 - PLACE_BITS)


def _table(hashes: np.ndarray, ids: np.ndarray):
    """(spread hashes in order, ids, where the hashes with each first bits begin, the most that share them)."""
    hashes = hashes * _STEP  # an odd number: different hashes stay different
    order = np.argsort(hashes)
    hashes, ids = hashes[order], ids[order]
    n = np.bincount((hashes >> _FAR).astype(np.int64), minlength=1 << PLACE_BITS)
    start = np.minimum(np.cumsum(n) - n, len(hashes) - 1).astype(np.int32)
    return hashes, ids, start, int(n.max())


def _look_up(table, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which of ``h`` are in the table, their ids)."""
    hashes, ids, start, most = table
    h = h * _STEP
    at = start[(h >> _FAR).astype(np.int64)]
    near = hashes[at]
    for _ in range(most - 1):
        later = np.flatnonzero(near < h)
        at[later] = np.minimum(at[later] + 1, len(hashes) - 1)
        near[later] = hashes[at[later]]
    on = np.flatnonzero(near == h)
    return on, ids[at[on]]


class Pieces:
    """The model's pieces with log probabilities, and tables of the hashes of pieces and of their beginnings."""

    def __init__(self, alpha: float = ALPHA):
        import public_tokenizers
        from sentencepiece import SentencePieceProcessor

        self.model = m = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
        size = m.vocab_size()
        rank = np.array([min(-m.get_score(i), size) for i in range(size)])
        logp = -alpha * np.log(rank + 10)
        usable = np.array([not (m.is_control(i) or m.is_unknown(i)) for i in range(size)])
        plain = usable & np.array([not m.is_byte(i) for i in range(size)])
        self.byte_id = {int(m.id_to_piece(i)[3:5], 16): i for i in range(size) if m.is_byte(i)}
        self.byte_ids = np.array([self.byte_id[b] for b in range(256)])
        logp[[i for i in self.byte_id.values()]] = -alpha * np.log(size + 10)
        self.logp = logp - np.log(np.exp(logp[usable]).sum())
        self.raw = [bytes([next(b for b, i in self.byte_id.items() if i == n)]) if m.is_byte(n) else m.id_to_piece(n).encode() for n in range(size)]
        self.raw_size = np.array([len(r) for r in self.raw])
        self.raw_at = np.concatenate(([0], np.cumsum(self.raw_size)[:-1]))
        self.raw_data = np.frombuffer(b"".join(self.raw), dtype=np.uint8)
        # The same with spaces for the space mark; the mark is a piece, so it is never spelled in bytes.
        spaced = [x if m.is_byte(n) else x.replace("▁".encode(), b" ") for n, x in enumerate(self.raw)]
        self.spaced_size = np.array([len(x) for x in spaced])
        self.spaced_at = np.concatenate(([0], np.cumsum(self.spaced_size)[:-1]))
        self.spaced_data = np.frombuffer(b"".join(spaced), dtype=np.uint8)
        begin: dict[int, dict[int, int]] = {}  # by length: hash of each beginning -> the piece it is, or -1
        for i in np.flatnonzero(plain).tolist():
            c = np.array([ord(x) for x in m.id_to_piece(i)])
            p = prefixes(c)
            for n in range(1, len(c) + 1):
                h = int(substring(p, np.array([0]), np.array([n]))[0])
                begin.setdefault(n, {}).setdefault(h, -1)
            begin[len(c)][h] = i
        self.begin = {n: _table(*(np.array(x, dtype=d) for x, d in zip(zip(*sorted(v.items())), (np.uint64, np.int64)))) for n, v in begin.items()}
        self.longest = max(begin)


@functools.lru_cache(maxsize=4)
def pieces(alpha: float) -> Pieces:
    return Pieces(alpha)


class Lattices:
    """The lattices of distinct words, laid out over their characters: edges sorted by source."""

    def __init__(self, known: Pieces, chars: np.ndarray, stop: np.ndarray):
        """chars: all words one after the other; stop: for each character the end of its word."""
        n, p = len(chars), prefixes(chars)
        source, length, name, logp, nth = [], [], [], [], []
        alive, single, choices = np.arange(n), np.zeros(n, dtype=bool), np.zeros(n, dtype=np.int64)

        def edges(at):
            source.append(at)
            nth.append(choices[at])
            choices[at] += 1

        for size in range(1, known.longest + 1):
            alive = alive[alive + size <= stop[alive]]
            if not len(alive):
                break
            on, piece = _look_up(known.begin[size], substring(p, alive, alive + size))
            alive = alive[on]
            hit = np.flatnonzero(piece >= 0)
            edges(alive[hit])
            length.append(np.full(len(hit), size))
            name.append(piece[hit])
            logp.append(known.logp[piece[hit]])
            if size == 1:
                single[alive[hit]] = True
        lost = np.flatnonzero(~single)  # spelled in bytes; the edge's name is the character, negative
        edges(lost)
        length.append(np.ones(len(lost), dtype=np.int64))
        name.append(-chars[lost].astype(np.int64))
        width = np.select([chars[lost] < 0x80, chars[lost] < 0x800, chars[lost] < 0x10000], [1, 2, 3], 4)
        logp.append(width * known.logp[known.byte_id[0]])
        # Words are worked through from their ends. Each place has an edge, so places are sorted and edges follow.
        far = stop - np.arange(n)
        by_far = np.argsort(far.astype(np.uint16) if far.max(initial=0) < 1 << 16 else far, kind="stable")
        many, far = choices[by_far], far[by_far]
        first = np.cumsum(many) - many
        begin = np.empty(n, dtype=np.int64)
        begin[by_far] = first
        to = begin[np.concatenate(source)] + np.concatenate(nth)

        def laid(column):
            out = np.empty(len(to), dtype=column.dtype)
            out[to] = column
            return out

        length, name, logp = (laid(np.concatenate(x)) for x in (length, name, logp))
        source = np.repeat(by_far, many)
        end, last = source + length, length == np.repeat(far, many)
        cuts = np.concatenate((np.flatnonzero(np.concatenate((far[:1] > 0, far[1:] != far[:-1]))), [n]))
        levels = np.append(first, len(source))[cuts]
        mass, value = np.zeros(n + 1), np.empty(len(source))
        for a, b, x, y in zip(levels[:-1].tolist(), levels[1:].tolist(), cuts[:-1].tolist(), cuts[1:].tolist()):
            value[a:b] = logp[a:b] + np.where(last[a:b], 0.0, mass[end[a:b]])
            mass[by_far[x:y]] = np.logaddexp.reduceat(value[a:b], first[x:y] - a)
        share = np.minimum(value - np.repeat(mass[by_far], many), 0.0)
        self.choices, self.first = choices, np.concatenate(([0], np.cumsum(choices)))
        back = np.arange(len(source)) + np.repeat(begin - self.first[:-1], choices)
        self.source, share = np.repeat(np.arange(n), choices), share[back]
        order = np.argsort(self.source - 0.5 * np.exp(share), kind="stable")  # likely pieces first, so that draws end soon
        self.share, back = share[order], back[order]
        self.length, self.name, self.last = length[back], name[back], last[back]
        chance = np.exp(self.share)
        self.others = choices[self.source] - 1
        self.rest = np.log(np.maximum(1 - chance, 1e-300))  # log share of the other edges of its source
        sums = np.concatenate(([0.0], np.cumsum(chance)))
        self.upto = sums[1:] - sums[self.first[self.source]]
        self.upto[self.first[1:] - 1] = 1.0
        self.stop = stop

    def walk(self, at: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """From each place to its word's end: (which start, edge) of all steps, in order."""
        who, which, edges, step = np.arange(len(at)), [], [], 0
        at, steps = at.copy(), np.zeros(len(at), dtype=np.int64)
        while len(who):
            u = uniform(keys[who] + np.uint64(step * int(_STEP) & _ALL))
            e = self.first[at]
            more = np.flatnonzero(self.upto[e] < u)
            while len(more):
                e[more] += 1
                more = more[self.upto[e[more]] < u[more]]
            which.append(who)
            edges.append(e)
            steps[who] += 1
            at = at + self.length[e]
            go = ~self.last[e]
            who, at, step = who[go], at[go], step + 1
        begin = np.cumsum(steps) - steps
        out = np.empty(int(steps.sum()), dtype=np.int64)
        for step, (w, e) in enumerate(zip(which, edges)):
            out[begin[w] + step] = e
        return np.repeat(np.arange(len(steps)), steps), out


class _Paths:
    """One new path for each of several texts, laid out one after the other, from the piece on where it leaves
    an earlier path; with the bounds of the nodes that leave it in turn."""

    def __init__(self, lattice: Lattices, tails, fork, base, bound, keys, shut, k):
        """tails: (edges, units) of each text; fork: its first piece's number; base: log mass before that piece;
        bound: the noise of the path; shut: other edges already taken at the fork; k: how many
        nodes of a path may be asked for."""
        self.tails, self.fork, self.bound = tails, fork, bound
        edges = np.concatenate([e for e, _ in tails]) if tails else np.zeros(0, np.int64)
        size = np.array([len(e) for e, _ in tails], dtype=np.int64)
        self.at = np.concatenate(([0], np.cumsum(size)))
        heads = self.at[:-1]
        own = lattice.share[edges]
        # Summed text by text, so that neighbours do not change the last digits.
        sums = np.zeros(len(own))
        for a, b in zip(heads.tolist(), self.at[1:].tolist()):
            np.cumsum(own[a : b - 1], out=sums[a + 1 : b])
        self.before = np.repeat(np.asarray(base, dtype=np.float64), size) + sums
        self.logp = (self.before + own)[self.at[1:] - 1] if tails else own
        rest, others = lattice.rest[edges], lattice.others[edges]
        for h, x in zip(heads.tolist(), shut):
            if x:
                taken = np.exp(own[h : h + 1]) + np.exp(lattice.share[x]).sum()
                rest[h] = np.log(np.maximum(1 - taken, 1e-300))[0]
                others[h] -= len(x)
        mass = np.where(others == 0, -np.inf, self.before + rest)
        enough = np.array([np.partition(mass[a:b], -k)[-k] if b - a > k else -np.inf for a, b in zip(heads.tolist(), self.at[1:].tolist())])
        # No node of much less mass can be among the k nearest.
        near = np.flatnonzero(mass >= np.repeat(enough - NOISE_SPAN, size))
        path = np.repeat(np.arange(len(size)), size)[near]
        number = near + (np.asarray(fork, dtype=np.int64) - heads)[path]
        with np.errstate(divide="ignore"):
            noise = np.log(-np.log(uniform(np.asarray(keys, dtype=np.uint64)[path] + number.astype(np.uint64) * _STEP)))
        # Below one path a node's bound falls as this rises, so only the least is turned into a bound.
        self.depth = np.full(len(edges), np.inf)
        self.depth[near] = noise - mass[near]
        self.best = self._bounds(np.minimum.reduceat(self.depth, heads), self.bound).tolist() if tails else []

    @staticmethod
    def _bounds(depth, bound):
        """The bounds of nodes, truncated at their paths'; of none, -inf."""
        return np.where(depth == np.inf, -np.inf, -np.logaddexp(-np.asarray(bound, dtype=np.float64), depth))

    def take(self, k: int) -> tuple[int, int]:
        """Close text k's best node; its place in the layout and its piece number."""
        a, b = int(self.at[k]), int(self.at[k + 1])
        at = a + int(np.argmin(self.depth[a:b]))
        self.depth[at] = np.inf
        self.best[k] = float(self._bounds(self.depth[a:b].min(), self.bound[k]))
        return at, at - a + self.fork[k]


def sample_texts(texts: list[str], seeds: np.ndarray, k: int, alpha: float):
    """For each text a list of (ids, log probability, noise, inclusion probability), highest noise first."""
    known = pieces(alpha)
    spaced = [known.model.normalize(t) for t in texts]
    sizes = np.array([len(t) for t in spaced])
    ends = np.cumsum(sizes)
    chars = np.frombuffer("".join(spaced).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    begin = np.zeros(len(chars) + 1, dtype=bool)
    mark = chars == SPACE
    begin[:-1] = mark & ~np.concatenate(([False], mark[:-1]))
    begin[np.concatenate(([0], ends))] = True
    start = np.flatnonzero(begin)[:-1]
    stop = np.append(start[1:], len(chars)) if len(start) else start
    text_of = np.searchsorted(ends, start, side="right")
    first_unit = np.searchsorted(text_of, np.arange(len(texts) + 1))
    name = mix(substring(prefixes(chars), start, stop) + (stop - start).astype(np.uint64))
    _, at, same_word = np.unique(name, return_index=True, return_inverse=True)
    size = (stop - start)[at]
    base = np.concatenate(([0], np.cumsum(size)[:-1])) if len(at) else np.zeros(0, np.int64)
    spread = np.repeat(start[at] - base, size) + np.arange(size.sum())
    lattice = Lattices(known, chars[spread], np.repeat(base + size, size))
    origin = base[same_word]
    number = np.arange(len(start)) - first_unit[text_of] if len(start) else start
    unit_key = mix(seeds[text_of] + number.astype(np.uint64) * _UNIT)

    def walks(rounds: int, docs: list[int], units: list[int], at_: list[int]):
        """Walk on from `at_` inside unit `units` (or from its end if at_ < 0) to the end of each text."""
        spans = [np.arange(first_unit[d] + u + (a < 0), first_unit[d + 1]) for d, u, a in zip(docs, units, at_)]
        which = np.concatenate(spans) if spans else np.zeros(0, np.int64)
        lens = np.array([len(s) for s in spans])
        places = origin[which]
        heads = np.concatenate(([0], np.cumsum(lens)[:-1])) if len(lens) else lens
        for h, a in zip(heads.tolist(), at_):
            if a >= 0:
                places[h] = a
        got, edges = lattice.walk(places, mix(unit_key[which] + np.uint64(rounds * int(_ROUND) & _ALL)))
        cut = np.searchsorted(got, np.concatenate(([0], np.cumsum(lens)))) if len(lens) else [0]
        unit = number[which[got]] if len(got) else got
        return [(edges[a:b], unit[a:b]) for a, b in zip(cut[:-1], cut[1:])]

    live = [d for d in range(len(texts)) if sizes[d]]
    tails = walks(0, live, [0] * len(live), [int(origin[first_unit[d]]) for d in live])
    noise = -np.log(-np.log(uniform(mix(seeds[live]) + _ROUND)))
    none: list = [()] * len(live)
    rounds_ = [_Paths(lattice, tails, [0] * len(live), np.zeros(len(live)), noise, mix(seeds[live] + _STEP), none, k)]
    full = {d: [e] for d, (e, _) in zip(live, tails)}  # the edges of each path of a text
    unit_of = {d: [u] for d, (_, u) in zip(live, tails)}
    where = {d: [(0, n)] for n, d in enumerate(live)}  # round and place of each path
    shut_at: dict[tuple[int, int, int], list[int]] = {}
    left = dict.fromkeys(live, -np.inf)
    for rounds in range(1, k + 1):
        jobs = []
        for d in live:
            if len(where[d]) < rounds:
                continue
            bounds = [rounds_[r].best[n] for r, n in where[d]]
            bound = max(bounds)
            if bound == -np.inf or rounds == k:
                left[d] = bound
                continue
            which = bounds.index(bound)
            r, n = where[d][which]
            at, t = rounds_[r].take(n)
            e = int(full[d][which][t])
            shut = [*shut_at.get((d, which, t), ()), e]
            a = int(lattice.source[e])
            free = [x for x in range(lattice.first[a], lattice.first[a + 1]) if x not in shut]
            weight = np.exp(lattice.share[free[0] : free[-1] + 1])[[x - free[0] for x in free]].cumsum()
            jobs.append((d, which, t, shut, bound, float(rounds_[r].before[at]), free, weight))
        if not jobs:
            continue
        docs = [j[0] for j in jobs]
        keys = mix(seeds[docs] + np.uint64(rounds * int(_UNIT) & _ALL))
        chosen = [j[6][min(int(np.searchsorted(j[7], u * j[7][-1])), len(j[6]) - 1)] for j, u in zip(jobs, uniform(keys).tolist())]
        source, size = lattice.source[chosen], lattice.length[chosen]
        after = np.where(source + size < lattice.stop[source], source + size, -1).tolist()
        rest = walks(rounds, docs, [int(unit_of[j[0]][j[1]][j[2]]) for j in jobs], after)
        tails = []
        for (d, which, t, shut, *_), e, (edges, units) in zip(jobs, chosen, rest):
            tails.append((np.concatenate(([e], edges)), np.concatenate((unit_of[d][which][t : t + 1], units))))
            full[d].append(np.concatenate((full[d][which][:t], tails[-1][0])))
            unit_of[d].append(np.concatenate((unit_of[d][which][:t], tails[-1][1])))
            shut_at[d, len(where[d]), t] = shut
            where[d].append((rounds, len(tails) - 1))
        rounds_.append(_Paths(lattice, tails, [j[2] for j in jobs], [j[5] for j in jobs], [j[4] for j in jobs], mix(keys + _STEP), [j[3] for j in jobs], k))
    ids = iter(_all_ids(known, lattice, [edges for d in live for edges in full[d]]))
    out = []
    for d in range(len(texts)):
        if not sizes[d]:
            out.append([(np.zeros(0, dtype="<u4"), 0.0, 0.0, 1.0)])
            continue
        rows = []
        for _, (r, n) in zip(full[d], where[d]):
            logp = float(rounds_[r].logp[n])
            inclusion = 1.0 if left[d] == -np.inf else float(-np.expm1(-np.exp(min(logp - left[d], 50.0))))
            rows.append((next(ids), logp, float(rounds_[r].bound[n]), inclusion))
        out.append(rows)
    return out


def _all_ids(known: Pieces, lattice: Lattices, paths: list[np.ndarray]) -> list[np.ndarray]:
    """The ids of many paths, looked up together; only paths with characters spelled in several bytes are treated
    singly."""
    names = lattice.name[np.concatenate(paths)] if paths else np.zeros(0, np.int64)
    ends = np.cumsum([len(p) for p in paths])
    lost = np.flatnonzero(names < 0)
    one = lost[names[lost] > -0x80]
    plain = names.astype("<u4")
    plain[one] = known.byte_ids[-names[one]]
    spelled = set(np.searchsorted(ends, lost[names[lost] <= -0x80], side="right").tolist())
    cuts = zip([0, *ends[:-1].tolist()], ends.tolist())
    return [_ids(known, names[a:b]) if n in spelled else plain[a:b] for n, (a, b) in enumerate(cuts)]


def _ids(known: Pieces, names: np.ndarray) -> np.ndarray:
    lost = np.flatnonzero(names < 0)
    if not len(lost):
        return names.astype("<u4")
    out, last = [], 0
    for i in lost.tolist():
        out.append(names[last:i])
        out.append([known.byte_id[b] for b in chr(-names[i]).encode("utf-8", "surrogatepass")])
        last = i + 1
    return np.concatenate([*out, names[last:]]).astype("<u4")


def decoded_crc32s(all_ids: list[np.ndarray], alpha: float = ALPHA) -> list[int]:
    """CRC-32 of ``decode_ids`` of each, with the pieces of all laid out in one go."""
    known = pieces(alpha)
    ids = np.concatenate(all_ids) if all_ids else np.zeros(0, dtype="<u4")
    size = known.spaced_size[ids]
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    at = np.repeat(known.spaced_at[ids] - (ends - size), size) + np.arange(total) if total else np.zeros(0, np.int64)
    text = memoryview(known.spaced_data[at].tobytes())
    upto = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum([len(x) for x in all_ids])))].tolist()
    return [zlib.crc32(text[a + (text[a : a + 1] == b" ") : b]) for a, b in zip(upto, upto[1:])]


def decode_ids(ids: np.ndarray, alpha: float = ALPHA) -> bytes:
    """UTF-8 of the normalised text: pieces one after the other, the first space left out."""
    known = pieces(alpha)
    size = known.raw_size[ids]
    total = int(size.sum())
    at = np.repeat(known.raw_at[ids] - np.concatenate(([0], np.cumsum(size)[:-1])) if len(ids) else size, size) + np.arange(total)
    text = known.raw_data[at].tobytes().replace("▁".encode(), b" ")
    return text[1:] if text[:1] == b" " else text


def _sampled(k: int, alpha: float, seed: int, with_ids: bool):
    kinds = [("doc_id", pa.int64()), ("text_key", pa.int64()), ("sample", pa.int32()), ("n_pieces", pa.int64()), ("ids_crc32", pa.int64()),
             ("decoded_crc32", pa.int64()), ("log_probability", pa.float64()), ("noise", pa.float64()), ("inclusion", pa.float64()), ("ids", pa.binary())]

    def go(batches):
        for b in batches:
            doc, key, texts = (b[c].to_pylist() for c in ("doc_id", "text_key", "text"))
            seeds = mix(np.array([(x or 0) & ((1 << 64) - 1) for x in doc], dtype=np.uint64) + np.uint64(seed * int(_STEP) & _ALL))
            ends = np.cumsum([len(t) for t in texts])
            a = 0
            while a < len(texts):
                z = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + CHUNK_CHARS)))
                rows, samples = [], sample_texts(texts[a:z], seeds[a:z], k, alpha)
                decoded = iter(decoded_crc32s([f[0] for found in samples for f in found], alpha))
                for i, t, found in zip(doc[a:z], key[a:z], samples):
                    for n, (ids, logp, noise, inclusion) in enumerate(found):
                        raw = ids.tobytes()
                        rows.append((i, t, n, len(ids), zlib.crc32(raw), next(decoded), logp, noise, inclusion, raw if with_ids else None))
                kept = kinds if with_ids else kinds[:-1]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), kept)], [n for n, _ in kept])
                a = z

    return go


def sample_segmentations(docs: DataFrame, k: int = SAMPLES, alpha: float = ALPHA, seed: int = SEED, with_ids: bool = True) -> DataFrame:
    """(doc_id, text_key, sample, n_pieces, ids_crc32, decoded_crc32, log_probability, noise, inclusion[, ids]).

    Up to k different segmentations of each row's whole text, numbered from 0 by falling noise; all there are
    when there are fewer. ``inclusion``: the chance to be among k, given the threshold; log_probability /
    inclusion weights give unbiased sums. ``ids``: little-endian unsigned 32-bit numbers. Null and empty texts
    have one empty segmentation. The id is the row key: rows with equal ids and texts get equal samples.
    """
    schema = "doc_id long, text_key long, sample int, n_pieces long, ids_crc32 long, decoded_crc32 long, log_probability double, noise double, inclusion double"
    return records(docs).select("doc_id", "text_key", "text").mapInArrow(_sampled(k, alpha, seed, with_ids), schema + ", ids binary" * with_ids)


def decode(samples: DataFrame, ids: str = "ids", alpha: float = ALPHA) -> DataFrame:
    """Adds ``decoded``: the text of each row's ids; null ids give null."""

    def go(batches):
        for b in batches:
            texts = [None if x is None else decode_ids(np.frombuffer(x, "<u4"), alpha).decode() for x in b[ids].to_pylist()]
            yield b.append_column("decoded", pa.array(texts, pa.string()))

    return samples.mapInArrow(go, samples.withColumn("decoded", F.lit("")).schema)


def op6_sentencepiece(spark, sf_dir) -> DataFrame:
    """Up to three samples per document; null and empty texts and repeated rows as in ``sample_segmentations``."""
    return sample_segmentations(documents(spark, sf_dir), with_ids=False).drop("text_key")
