"""Monotone integer sequences in Elias-Fano form, in a memory-mapped file."""

from __future__ import annotations

import mmap
import tempfile

import numpy as np

# Elements decoded at a time.
BLOCK = 1 << 16


class EliasFano:
    """A non-decreasing sequence of 64-bit numbers.

    Low bits (whole bytes) stand in a plain array, high bits in unary: element
    ``i`` sets bit ``high + i``.  Of every ``BLOCK`` elements the first value
    and bit are kept, so a search decodes only blocks that its queries fall in.
    """

    def __init__(self, values: np.ndarray, store: Store):
        self.size = n = len(values)
        if not n:
            return
        values = values.astype(np.uint64)
        top = int(values[-1])
        self.low_bytes = max(0, (max(1, top // n).bit_length() - 1) // 8)
        shift = np.uint64(8 * self.low_bytes)
        low = values.astype("<u8").view(np.uint8).reshape(n, 8)[:, :self.low_bytes]
        self.low = store.put(np.ascontiguousarray(low)).reshape(n, self.low_bytes)
        self.shift = shift
        ones = (values >> shift if self.low_bytes < 8 else np.zeros(n, np.uint64)).astype(np.int64) + np.arange(n)
        unary = np.zeros((int(ones[-1]) // 8 + 1) * 8, dtype=np.uint8)
        unary[ones] = 1
        self.high = store.put(np.packbits(unary))
        self.first_values, self.first_bits = values[::BLOCK].copy(), np.append(ones[::BLOCK], ones[-1] + 1)

    def block(self, number: int) -> np.ndarray:
        """The values of one block."""
        begin, end = int(self.first_bits[number]), int(self.first_bits[number + 1])
        bits = np.unpackbits(self.high[begin // 8:(end + 7) // 8])[begin % 8:][:end - begin]
        ones = np.flatnonzero(bits) + begin
        start = number * BLOCK
        high = (ones - np.arange(start, start + len(ones))).astype(np.uint64) << self.shift
        low = np.zeros((len(ones), 8), dtype=np.uint8)
        low[:, :self.low_bytes] = self.low[start:start + len(ones)]
        return high | low.view("<u8").ravel()

    def values(self) -> np.ndarray:
        parts = [self.block(i) for i in range(-(-self.size // BLOCK))]
        return np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64)

    def at(self, places: np.ndarray) -> np.ndarray:
        """The values at ascending places."""
        out = np.zeros(len(places), dtype=np.uint64)
        if self.size:
            cuts = np.searchsorted(places, np.arange(len(self.first_values) + 1) * BLOCK)
            for number in np.flatnonzero(cuts[1:] > cuts[:-1]):
                asked = slice(cuts[number], cuts[number + 1])
                out[asked] = self.block(int(number))[places[asked] - number * BLOCK]
        return out

    def successors(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For ascending queries, the place of the least element not below each
        (``size`` if none), and whether it equals the query."""
        places, equal = np.full(len(queries), self.size, dtype=np.int64), np.zeros(len(queries), dtype=bool)
        if not self.size:
            return places, equal
        cuts = np.append(np.searchsorted(queries, self.first_values, side="left"), len(queries))
        places[:cuts[0]] = 0
        for number in range(len(self.first_values)):
            asked = slice(cuts[number], cuts[number + 1])
            if asked.start == asked.stop:
                continue
            values = self.block(number)
            found = np.searchsorted(values, queries[asked])
            places[asked] = number * BLOCK + found
            here = found < len(values)
            equal[asked] = here & (values[np.minimum(found, len(values) - 1)] == queries[asked])
        return places, equal


class Store:
    """Arrays in one file of the task's temporary folder, mapped into memory; it goes with the store."""

    def __init__(self):
        self.file = tempfile.TemporaryFile()

    def put(self, array: np.ndarray) -> np.ndarray:
        data = array.tobytes()
        if not data:
            return np.zeros(0, dtype=array.dtype)
        at = -(-self.file.seek(0, 2) // mmap.ALLOCATIONGRANULARITY) * mmap.ALLOCATIONGRANULARITY
        self.file.seek(at)
        self.file.write(data)
        self.file.flush()
        view = mmap.mmap(self.file.fileno(), len(data), offset=at, access=mmap.ACCESS_READ)
        return np.frombuffer(view, dtype=array.dtype)

    def close(self) -> None:
        self.file.close()
