"""Small whole-array helpers that run inside Python tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Characters handled at once inside a batch, whatever the batch holds; a single longer text is handled alone.
SLICE_CHARS = 1_000_000
#: Distinct words whose result a worker remembers before it starts afresh.
REMEMBERED = 200_000


def slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts that hold about ``SLICE_CHARS`` characters each."""
    begin, held = 0, 0
    for i, text in enumerate(texts):
        if i > begin and held + len(text) > SLICE_CHARS:
            yield begin, i
            begin, held = i, 0
        held += len(text)
    if begin < len(texts):
        yield begin, len(texts)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class PairTable:
    """Map from pairs of small integers to an integer, filled and read with whole-array steps (linear probing)."""

    def __init__(self, left: np.ndarray, right: np.ndarray, value: np.ndarray, absent: int):
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        bits = max(4, (4 * len(keys)).bit_length())
        self._shift = np.uint64(64 - bits)
        self._mask = (1 << bits) - 1
        self._absent = absent
        self._keys = np.full(1 << bits, -1, np.int64)
        self._values = np.full(1 << bits, absent, np.int64)
        slot = self._slot(keys)
        todo = np.arange(len(keys))
        while len(todo):
            free = todo[self._keys[slot[todo]] == -1]
            _, first = np.unique(slot[free], return_index=True)
            put = free[first]
            self._keys[slot[put]] = keys[put]
            self._values[slot[put]] = value[put]
            todo = np.setdiff1d(todo, put, assume_unique=True)
            slot[todo] = (slot[todo] + 1) & self._mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self._shift).astype(np.int64)

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        slot = self._slot(keys)
        found = self._keys[slot]
        out = np.where(found == keys, self._values[slot], self._absent)
        todo = np.flatnonzero((found != keys) & (found != -1))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & self._mask
            found = self._keys[slot[todo]]
            hit = found == keys[todo]
            out[todo[hit]] = self._values[slot[todo[hit]]]
            todo = todo[~hit & (found != -1)]
        return out
