"""A cuckoo filter on numpy arrays: set membership that can also forget."""

from __future__ import annotations

import numpy as np

SLOTS = 4
KICKS = 500
_MIX = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def _mixed(value: int) -> int:
    value ^= value >> 33
    value = (value * _MIX) & _MASK
    return value ^ (value >> 33)


def _mixed_all(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(_MIX)
    return values ^ (values >> np.uint64(33))


class CuckooFilter:
    """16-bit fingerprints of 64-bit hashes in buckets of four; grows when it is full.

    A hash that was added is always found. One that was not is found with a probability of about
    ``2 * SLOTS / 2 ** 16``. Only hashes that were added may be removed. The hashes added are kept
    by the caller (the reference counts), which lends them when the table has to grow.
    """

    def __init__(self, buckets: int = 64, table: np.ndarray | None = None):
        self.buckets = 1 << max(1, (buckets - 1).bit_length())
        self.table = np.zeros((self.buckets, SLOTS), np.uint16) if table is None else table

    @classmethod
    def of(cls, hashes: np.ndarray) -> CuckooFilter:
        """A filter of these distinct hashes, filled to at most about 80 %."""
        buckets = max(2, int(len(hashes) / (0.8 * SLOTS)) + 1)
        while True:
            made = cls(buckets)
            if all(made.add(int(h)) for h in made._filled(hashes)):
                return made
            buckets = made.buckets * 2

    def _filled(self, hashes: np.ndarray) -> np.ndarray:
        """Puts hashes into an empty table at once; those left over found both buckets full."""
        used = np.zeros(self.buckets, np.int64)
        last = np.uint64(self.buckets - 1)
        for second in (False, True):
            mark, bucket = self._homes(hashes)
            if second:
                bucket = (bucket ^ _mixed_all(mark)) & last
            order = np.argsort(bucket, kind="stable")
            bucket, mark = bucket[order].astype(np.int64), mark[order]
            starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])[: len(bucket)])
            sizes = np.diff(np.append(starts, len(bucket)))
            slot = used[bucket] + np.arange(len(bucket)) - np.repeat(starts, sizes)
            fits = slot < SLOTS
            self.table[bucket[fits], slot[fits]] = mark[fits].astype(np.uint16)
            used += np.bincount(bucket[fits], minlength=self.buckets)
            hashes = hashes[order[~fits]]
        return hashes

    def _homes(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Marks and first buckets."""
        hashes = _mixed_all(hashes.astype(np.uint64, copy=False))
        mark = hashes >> np.uint64(48)
        mark[mark == 0] = 1
        return mark, hashes & np.uint64(self.buckets - 1)

    @classmethod
    def loads(cls, blob: bytes) -> CuckooFilter:
        table = np.frombuffer(blob, np.uint16).reshape(-1, SLOTS).copy()
        return cls(len(table), table)

    def dumps(self) -> bytes:
        return self.table.tobytes()

    def _places(self, h: int) -> tuple[int, int, int]:
        h = _mixed(h & _MASK)
        mark = (h >> 48) or 1
        first = h & (self.buckets - 1)
        return mark, first, self._other(first, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return (bucket ^ _mixed(mark)) & (self.buckets - 1)

    def _put(self, bucket: int, mark: int) -> bool:
        row = self.table[bucket]
        for slot in range(SLOTS):
            if row[slot] == 0:
                row[slot] = mark
                return True
        return False

    def add(self, h: int) -> bool:
        """Whether there was room; if not, the filter must be made anew with more buckets."""
        mark, first, second = self._places(h)
        if self._put(first, mark) or self._put(second, mark):
            return True
        bucket = second
        for kick in range(KICKS):
            slot = kick % SLOTS
            mark, self.table[bucket, slot] = int(self.table[bucket, slot]), mark
            bucket = self._other(bucket, mark)
            if self._put(bucket, mark):
                return True
        return False

    def remove(self, h: int) -> bool:
        mark, first, second = self._places(h)
        for bucket in (first, second):
            row = self.table[bucket]
            for slot in range(SLOTS):
                if row[slot] == mark:
                    row[slot] = 0
                    return True
        return False

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        """Whether each hash may have been added."""
        mark, first = self._homes(hashes)
        second = (first ^ _mixed_all(mark)) & np.uint64(self.buckets - 1)
        mark = mark.astype(np.uint16)[:, None]
        return (self.table[first] == mark).any(1) | (self.table[second] == mark).any(1)
