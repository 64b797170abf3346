"""Counting quotient filters over packed word numbers, as sorted arrays and as bytes.

An n-gram of up to four words is packed into 4 * ``bits`` bits, as two halves. A Feistel
network permutes them; it can be inverted, so nothing is lost. The leading bits of the
result are the quotient, of which the first ``bucket`` bits name the filter's bucket and
the rest a slot in it; what is left is the remainder, kept in full. A filter holds, slot by
slot, its sorted remainders and their counts. Filters of one bucket merge by merging the
sorted entries and adding the counts of equal ones.
"""

from __future__ import annotations

import numpy as np

_ONE, _BYTE = np.uint64(1), np.uint64(8)
# Round keys of the permutation; any odd numbers do.
_ROUNDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)


def scrambled(x: np.ndarray, key: int) -> np.ndarray:
    x = (x ^ np.uint64(key)) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(29))


class Packing:
    """How n-grams are packed and permuted: ``bits`` to a word number, 12 to 31."""

    def __init__(self, highest: int):
        self.bits = max(12, int(highest).bit_length())
        if self.bits > 31:
            raise ValueError("word numbers must be below 2**31")
        self.half = 2 * self.bits
        self.mask = np.uint64((1 << self.half) - 1)

    def pairs(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        return (one.astype(np.uint64) << np.uint64(self.bits)) | two.astype(np.uint64)

    def words(self, half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low = np.uint64((1 << self.bits) - 1)
        return (half >> np.uint64(self.bits)).astype(np.int64), (half & low).astype(np.int64)

    def permuted(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for i, key in enumerate(_ROUNDS):
            if i % 2:
                low = low ^ (scrambled(high, key) & self.mask)
            else:
                high = high ^ (scrambled(low, key) & self.mask)
        return high, low

    def restored(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for i, key in reversed(list(enumerate(_ROUNDS))):
            if i % 2:
                low = low ^ (scrambled(high, key) & self.mask)
            else:
                high = high ^ (scrambled(low, key) & self.mask)
        return high, low


def merged(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries ``(high, low, count)`` of several filters as one, sorted and with equal ones
    added up."""
    high, low, count = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((low, high))
    high, low, count = high[order], low[order], count[order]
    first = np.flatnonzero(np.r_[True, (high[1:] != high[:-1]) | (low[1:] != low[:-1])][: len(high)])
    return high[first], low[first], np.add.reduceat(count, first) if len(first) else count


def _to_varints(values: np.ndarray) -> bytes:
    values = values.astype(np.uint64)
    sizes = np.ones(len(values), np.int64)
    for i in range(1, 10):
        sizes += values >> np.uint64(7 * i) > 0
    at = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), np.uint8)
    for i in range(int(sizes.max(initial=0))):
        some = sizes > i
        more = (sizes[some] > i + 1).astype(np.uint64) << np.uint64(7)
        out[at[some] + i] = ((values[some] >> np.uint64(7 * i)) & np.uint64(127)) | more
    return out.tobytes()


def _from_varints(data: np.ndarray) -> np.ndarray:
    if not len(data):
        return np.empty(0, np.uint64)
    first = np.r_[0, np.flatnonzero(data[:-1] < 128) + 1]
    place = np.arange(len(data)) - np.repeat(first, np.diff(np.r_[first, len(data)]))
    return np.add.reduceat((data & 127).astype(np.uint64) << (place * 7).astype(np.uint64), first)


def _to_bytes(values: np.ndarray, size: int) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size]).tobytes()


def _from_bytes(data: np.ndarray, size: int) -> np.ndarray:
    full = np.zeros((len(data) // max(1, size), 8), np.uint8)
    full[:, :size] = data.reshape(-1, size)
    return full.view("<u8").ravel()


class QuotientFilters:
    """Writes and reads the filters of all buckets of one packing."""

    def __init__(self, packing: Packing, bucket: int):
        self.packing = packing
        self.bucket = min(bucket, packing.half - 1)
        self.rest = packing.half - self.bucket

    def split(self, high: np.ndarray) -> np.ndarray:
        return (high >> np.uint64(self.rest)).astype(np.int64)

    def write(self, high: np.ndarray, low: np.ndarray, count: np.ndarray) -> bytes:
        """The sorted entries of one bucket. The slots are as many as suit their number:
        a filter grows by moving bits from the remainder to the quotient."""
        slot_bits = min(self.rest, max(0, len(high).bit_length() - 3))
        left = self.rest - slot_bits
        within = high & np.uint64((1 << self.rest) - 1)
        runs = _to_varints(np.bincount((within >> np.uint64(left)).astype(np.int64), minlength=1 << slot_bits))
        remainder = within & np.uint64((1 << left) - 1)
        head = np.array([len(high), slot_bits, len(runs)], "<u4").tobytes()
        size, low_size = (left + 7) // 8, (self.packing.half + 7) // 8
        return head + runs + _to_bytes(remainder, size) + _to_bytes(low, low_size) + _to_varints(count)

    def read(self, bucket: int, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n, slot_bits, run_bytes = np.frombuffer(data, "<u4", 3).tolist()
        left = self.rest - slot_bits
        size, low_size = (left + 7) // 8, (self.packing.half + 7) // 8
        parts = np.split(
            np.frombuffer(data, np.uint8, offset=12),
            np.cumsum([run_bytes, n * size, n * low_size]),
        )
        slots = np.repeat(np.arange(1 << slot_bits, dtype=np.uint64), _from_varints(parts[0]).astype(np.int64))
        remainder = _from_bytes(parts[1], size) if size else np.zeros(n, np.uint64)
        high = (np.uint64(bucket) << np.uint64(self.rest)) | (slots << np.uint64(left)) | remainder
        return high, _from_bytes(parts[2], low_size), _from_varints(parts[3]).astype(np.int64)
