"""Wavelet matrices: sequences of token ids as bit-planes with rank and select.

Different ids are numbered by falling frequency, so the upper planes are nearly
all zeros and compress well.  Plane ``l`` holds bit ``l`` (from the top) of each
number, in the order that stable partitions by the planes above have given.
Only the planes, the ids and the length are stored; the directories that answer
rank and select are counted when a matrix is opened.  All methods take arrays
of queries.
"""

from __future__ import annotations

import functools

import numpy as np

# Words of 64 bits that one entry of the upper directory spans.
SPAN = 8
# Elements that are partitioned at a time, so that they stay in the processor's cache.
STEP = 1 << 15


def _parted(values: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Values without a bit, then those with one, each in their order."""
    parts = [(values[i:i + STEP], bits[i:i + STEP]) for i in range(0, len(values), STEP)]
    return np.concatenate([v.compress(~b) for v, b in parts] + [v.compress(b) for v, b in parts]) if parts else values


def _merged(values: np.ndarray, bits: np.ndarray, zeros: int) -> np.ndarray:
    """Undoes ``_parted``; ``zeros`` values have no bit."""
    out, low, high = np.empty_like(values), 0, zeros
    for i in range(0, len(values), STEP):
        chunk = bits[i:i + STEP]
        clear, some = np.flatnonzero(~chunk), np.flatnonzero(chunk)
        here = out[i:i + STEP]
        here[clear], here[some] = values[low:low + len(clear)], values[high:high + len(some)]
        low, high = low + len(clear), high + len(some)
    return out


class Plane:
    """Bits with constant-time rank and logarithmic select."""

    def __init__(self, words: np.ndarray, size: int):
        self.words, self.size = words, size

    @functools.cached_property
    def _directory(self) -> tuple[np.ndarray, np.ndarray]:
        ones = np.zeros(-(-(len(self.words) + 1) // SPAN) * SPAN, dtype=np.int64)
        ones[:len(self.words)] = np.bitwise_count(self.words)
        spans = ones.reshape(-1, SPAN)
        before = np.concatenate(([0], np.cumsum(spans.sum(axis=1))[:-1]))
        return before, (np.cumsum(spans, axis=1) - spans).astype(np.uint16).ravel()

    @functools.cached_property
    def ones(self) -> int:
        return int(np.bitwise_count(self.words).sum())

    def bits(self) -> np.ndarray:
        """All bits, as booleans."""
        return np.unpackbits(self.words.view(np.uint8), count=self.size, bitorder="little").view(bool)

    def get(self, places: np.ndarray) -> np.ndarray:
        return (self.words[places >> 6] >> (places & 63).astype(np.uint64)) & np.uint64(1) != 0

    def rank(self, places: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        before, within = self._directory
        word = places >> 6
        padded = self.words[np.minimum(word, len(self.words) - 1)]
        low = padded & ((np.uint64(1) << (places & 63).astype(np.uint64)) - np.uint64(1))
        return before[word // SPAN] + within[word] + np.where(word < len(self.words), np.bitwise_count(low), 0)

    def select(self, bit: bool, numbers: np.ndarray) -> np.ndarray:
        """Places of the ones (or zeros) of these numbers, counted from 0."""
        before, within = self._directory
        word = np.arange(len(within))
        counts = before[word // SPAN] + within
        if not bit:
            counts = 64 * word - counts
        found = np.searchsorted(counts, numbers, side="right") - 1
        found = np.minimum(found, len(self.words) - 1)
        window = self.words[found] if bit else ~self.words[found]
        flags = np.unpackbits(np.ascontiguousarray(window).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        wanted = (numbers - counts[found] + 1)[:, None]
        return 64 * found + np.argmax(np.cumsum(flags, axis=1) == wanted, axis=1)


class WaveletMatrix:
    """A sequence of ids, held as planes."""

    def __init__(self, ids: np.ndarray, planes: np.ndarray, size: int):
        """``ids``: the different ids by number; ``planes``: 64-bit words, one row a plane, the top one first."""
        self.ids, self.size = ids, size
        self.planes = [Plane(row, size) for row in planes]
        self.zeros = [size - plane.ones for plane in self.planes]

    @classmethod
    def build(cls, tokens: np.ndarray) -> WaveletMatrix:
        counts = np.bincount(tokens) if len(tokens) else np.zeros(0, dtype=np.int64)
        some = np.flatnonzero(counts)
        ids = some[np.argsort(-counts[some], kind="stable")].astype("<u4")
        depth = max(0, len(ids) - 1).bit_length()
        number = np.zeros(len(counts), dtype=np.uint32 if depth > 16 else np.uint16)
        number[ids] = np.arange(len(ids))
        held = number[tokens]
        planes = np.zeros((depth, -(-len(held) // 64)), dtype="<u8")
        for level in range(depth):
            bits = (held & held.dtype.type(1 << (depth - 1 - level))) != 0
            packed = np.packbits(bits, bitorder="little")
            planes[level].view(np.uint8)[:len(packed)] = packed
            held = _parted(held, bits)
        return cls(ids, planes, len(tokens))

    def to_bytes(self) -> tuple[bytes, bytes]:
        """Ids and planes; with the length they make the matrix again."""
        return self.ids.astype("<u4").tobytes(), b"".join(plane.words.tobytes() for plane in self.planes)

    @classmethod
    def from_bytes(cls, ids: bytes, planes: bytes, size: int) -> WaveletMatrix:
        found = np.frombuffer(ids, dtype="<u4")
        depth = max(0, len(found) - 1).bit_length()
        return cls(found, np.frombuffer(planes, dtype="<u8").reshape(depth, -(-size // 64)), size)

    def tokens(self) -> np.ndarray:
        """All ids in order: partitions are undone from the lowest plane up."""
        held = np.zeros(self.size, dtype=np.uint32 if len(self.planes) > 16 else np.uint16)
        for level, plane in enumerate(reversed(self.planes)):
            bits, zeros = plane.bits(), self.zeros[len(self.planes) - 1 - level]
            held[zeros:] |= held.dtype.type(1 << level)
            held = _merged(held, bits, zeros)
        return self.ids[held] if self.size else np.zeros(0, dtype="<u4")

    def access(self, places: np.ndarray) -> np.ndarray:
        """Ids at these places."""
        places, number = np.array(places, dtype=np.int64), np.zeros(len(places), dtype=np.int64)
        for plane, zeros in zip(self.planes, self.zeros):
            bits, ones = plane.get(places), plane.rank(places)
            places = np.where(bits, zeros + ones, places - ones)
            number = 2 * number + bits
        return self.ids[number]

    def _number(self, token: int) -> int | None:
        found = np.flatnonzero(self.ids == token)
        return int(found[0]) if len(found) else None

    def _down(self, number: int, places: np.ndarray) -> np.ndarray:
        """Where places stand below all planes, on the way of ``number``."""
        for level, (plane, zeros) in enumerate(zip(self.planes, self.zeros)):
            ones = plane.rank(places)
            places = zeros + ones if number >> (len(self.planes) - 1 - level) & 1 else places - ones
        return places

    def count(self, token: int, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often ``token`` stands in each range ``[begin, end)``."""
        number = self._number(token)
        if number is None:
            return np.zeros(len(begin), dtype=np.int64)
        return self._down(number, np.asarray(end, dtype=np.int64)) - self._down(number, np.asarray(begin, dtype=np.int64))

    def occurrences(self, token: int, first: int = 0, last: int | None = None) -> np.ndarray:
        """Places of ``token``, from its occurrence ``first`` to before ``last``, counted from 0."""
        number = self._number(token)
        if number is None:
            return np.zeros(0, dtype=np.int64)
        low, high = self._down(number, np.array([0, self.size], dtype=np.int64))
        places = np.arange(low + first, high if last is None else min(high, low + last))
        for level, (plane, zeros) in enumerate(zip(reversed(self.planes), reversed(self.zeros))):
            bit = bool(number >> level & 1)
            places = plane.select(bit, places - zeros if bit else places)
        return places
