"""Word shingles of many texts at once, as sorted arrays of 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from riskloom.llm.bytehash import mix, prefixes, substring

#: Texts are worked on together up to about this many bytes; a longer one is worked on alone.
CHUNK_BYTES = 1 << 20
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def chunks(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first, texts) in order."""
    first, size = 0, 0
    for n, t in enumerate(texts):
        if n > first and size + len(t) > CHUNK_BYTES:
            yield first, texts[first:n]
            first, size = n, 0
        size += len(t)
    if first < len(texts):
        yield first, texts[first:]


def shingle_sets(texts: list[bytes], width: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of ``width`` words (A-Z in lower case); of all its
    words when it has fewer; none without words."""
    for _, part in chunks(texts):
        data = _LOWER[np.frombuffer(b" ".join(part) + b" ", dtype=np.uint8)]
        space = _SPACE[data]
        before = np.concatenate(([True], space[:-1]))
        start, stop = np.flatnonzero(~space & before), np.flatnonzero(space & ~before)
        ends = np.cumsum([len(t) + 1 for t in part])
        first = np.searchsorted(start, np.concatenate(([0], ends)))
        words = mix(substring(prefixes(data), start, stop))
        runs = np.zeros(max(0, len(words) - width + 1), dtype=np.uint64)
        for k in range(width):
            runs = mix(runs + words[k : k + len(runs)])
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            if b - a >= width:
                yield np.unique(runs[a : b - width + 1])
            elif b > a:
                h = np.full(1, b - a, dtype=np.uint64)
                for w in words[a:b]:
                    h = mix(h * np.uint64(3) + w)
                yield h
            else:
                yield np.zeros(0, dtype=np.uint64)
