"""Cuckoo filter over 128-bit keys, filled and read with whole-array steps.

A key leaves a 16-bit fingerprint in one of two buckets of four slots; the other bucket follows from the fingerprint, so a
fingerprint can be moved without its key, and taken out again. A filter answers "surely not" or "perhaps".
"""

from __future__ import annotations

import numpy as np

SLOTS = 4
#: Share of slots that a new filter fills at most, and rounds of moving before it counts as full.
LOAD, MOST_MOVES = 0.8, 400


class CuckooFilter:
    def __init__(self, table: np.ndarray):
        self.table = table
        self._mask = np.int64(len(table) - 1)

    @classmethod
    def for_keys(cls, keys: int) -> CuckooFilter:
        buckets = 1
        while buckets * SLOTS * LOAD < keys:
            buckets *= 2
        return cls(np.zeros((buckets, SLOTS), np.uint16))

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        return cls(np.frombuffer(data, np.uint16).reshape(-1, SLOTS).copy())

    def to_bytes(self) -> bytes:
        return self.table.tobytes()

    def _places(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprint and first bucket of each key."""
        print_ = (low & 0xFFFF).astype(np.uint16)
        print_[print_ == 0] = 1
        return print_, (high >> 20) & self._mask

    def _other(self, bucket: np.ndarray, print_: np.ndarray) -> np.ndarray:
        return bucket ^ ((print_.astype(np.int64) * 0x5BD1E995 >> 8) & self._mask)

    def insert(self, high: np.ndarray, low: np.ndarray) -> bool:
        """Add distinct keys; False, and an unchanged filter, if they do not fit."""
        before = self.table.copy()
        print_, bucket = self._places(high, low)
        rng = np.random.default_rng(len(high))
        for move in range(MOST_MOVES):
            order = np.argsort(bucket, kind="stable")
            bucket, print_ = bucket[order], print_[order]
            first = np.r_[True, bucket[1:] != bucket[:-1]]
            starts = np.flatnonzero(first)
            rank = np.arange(len(bucket)) - np.repeat(starts, np.diff(np.r_[starts, len(bucket)]))
            free = self.table[bucket] == 0
            fits = rank < free.sum(axis=1)
            slot = np.argsort(~free, axis=1, kind="stable")[np.arange(len(bucket)), np.minimum(rank, SLOTS - 1)]
            self.table[bucket[fits], slot[fits]] = print_[fits]
            bucket, print_, first = bucket[~fits], print_[~fits], first[~fits]
            if not len(bucket):
                return True
            if move:
                # one waiting key per full bucket takes the place of another fingerprint, which then waits
                lead = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
                victim = rng.integers(0, SLOTS, len(lead))
                out = self.table[bucket[lead], victim].copy()
                self.table[bucket[lead], victim] = print_[lead]
                print_[lead] = out
            bucket = self._other(bucket, print_)
        self.table[:] = before
        return False

    def contains(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        print_, bucket = self._places(high, low)
        here = (self.table[bucket] == print_[:, None]).any(axis=1)
        return here | (self.table[self._other(bucket, print_)] == print_[:, None]).any(axis=1)

    def remove(self, high: np.ndarray, low: np.ndarray) -> None:
        """Take out keys that are in the filter."""
        print_, bucket = self._places(high, low)
        for p, a, b in zip(print_, bucket, self._other(bucket, print_)):
            for place in (a, b):
                hit = np.flatnonzero(self.table[place] == p)
                if len(hit):
                    self.table[place, hit[0]] = 0
                    break
