"""Content-defined anchors of long texts, found with array arithmetic.

A window is ``n`` consecutive units (words or bytes) of one text.  Among its
``k``-unit pieces the one with the smallest hash (the last of equals) is its
anchor, so equal windows have equal anchors at equal places, wherever they
stand.  Windows that follow each other and share an anchor form a run; one
row per run stands for all of its windows.

Hashes are polynomial over a fixed random table of bytes, modulo 2^64, and
scrambled; two independent ones (``which`` 0 and 1) make 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np

from larkspur.llm.common import mix64

# Text bytes handled at once; a longer text is a chunk of its own.
CHUNK_BYTES = 1 << 18
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
# Odd multipliers and their inverses modulo 2^64.
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


@lru_cache(maxsize=None)
def _tables(which: int) -> np.ndarray:
    return np.random.default_rng([20240229, which]).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@lru_cache(maxsize=4)
def _powers(which: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    def up(base: int) -> np.ndarray:
        factors = np.full(size, base, dtype=np.uint64)
        factors[0] = 1
        return np.multiply.accumulate(factors)

    base = MULTIPLIERS[which]
    return up(base), up(pow(base, -1, 1 << 64))


class Hasher:
    """Hashes of any span of a byte buffer."""

    def __init__(self, data: np.ndarray, which: int):
        size = max(CHUNK_BYTES, 1 << (len(data) + 1).bit_length())
        power, self.inverse = _powers(which, size)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_tables(which)[data] * power[:len(data)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.sums[end] - self.sums[start]) * self.inverse[start])


class Words:
    """The words of many texts in one buffer, joined by single spaces.

    ``start`` and ``end`` are the places of words in ``data``; words
    ``first[i]`` to ``first[i + 1]`` belong to text ``i``.
    """

    def __init__(self, texts: Sequence[bytes]):
        raw = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        space = SPACE[raw]
        before = np.concatenate(([True], space[:-1]))
        starts = np.flatnonzero(~space & before)
        ends = np.flatnonzero(space & ~before)
        kept = ~space
        kept[starts[1:] - 1] = True
        self.data = np.where(space, np.uint8(0x20), raw)[kept]
        place = np.cumsum(kept) - kept
        self.start, self.end = place[starts], place[ends - 1] + 1 if len(ends) else place[ends]
        bounds = np.cumsum([0] + [len(t) + 1 for t in texts])
        self.first = np.searchsorted(starts, bounds)


def chunks(texts: Sequence[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts that together are about ``limit`` bytes long."""
    first = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield first, i
            first, size = i, 0
        size += len(text) + 1
    if first < len(texts):
        yield first, len(texts)


def _sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive keys, by doubling."""
    have = 1
    while have * 2 <= width:
        keys = np.minimum(keys[:-have], keys[have:])
        have *= 2
    if have < width:
        keys = np.minimum(keys[:len(keys) - (width - have)], keys[width - have:])
    return keys


def runs(pieces: np.ndarray, first: np.ndarray, n: int, k: int) -> tuple[np.ndarray, ...]:
    """Runs of windows as ``(text, anchor, low, high)``, ``low`` to ``high`` inclusive.

    ``pieces[i]`` is the hash of the ``k`` units at ``i``; text ``j`` has
    units ``first[j]`` to ``first[j + 1]``.
    """
    width = n - k + 1
    if len(pieces) < width:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(4))
    # The same bits of the hash count in every buffer, so that equal windows agree.
    bits = np.uint64(max(28, int(len(pieces)).bit_length()))
    places = np.arange(len(pieces), dtype=np.uint64)
    top = (np.uint64(1) << bits) - np.uint64(1)
    least = _sliding_least((pieces >> bits << bits) | (top - places), width)
    # Windows that lie inside one text.
    open_ = np.zeros(len(least) + 1, dtype=np.int64)
    lows, highs = first[:-1], np.minimum(first[1:] - n + 1, len(least))
    some = highs > lows
    np.add.at(open_, lows[some], 1)
    np.add.at(open_, highs[some], -1)
    valid = np.flatnonzero(np.cumsum(open_[:-1]) > 0)
    if not len(valid):
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(4))
    anchor = (top - (least[valid] & top)).astype(np.int64)
    begins = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (valid[1:] != valid[:-1] + 1))))
    low = valid[begins]
    high = valid[np.concatenate((begins[1:], [len(valid)])) - 1]
    # Windows of different texts never share a run: they are not consecutive.
    text = np.searchsorted(first, low, side="right") - 1
    return text, anchor[begins], low, high


def merge_ranges(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal ranges ``[low, high)`` of overlapping or touching ones."""
    if not len(low):
        return low, high
    order = np.argsort(low, kind="stable")
    low, reach = low[order], np.maximum.accumulate(high[order])
    begins = np.concatenate(([True], low[1:] > reach[:-1]))
    last = np.concatenate((np.flatnonzero(begins)[1:], [len(low)])) - 1
    return low[begins], reach[last]
