"""Encodes each distinct unit of text once per worker and deals the results out with numpy."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from .buffers import ranges, text_hashes

#: Encodes distinct units: values of all units one after the other, and how many each unit has.
Encode = Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]


class UnitMemo:
    """Values of units by two 64-bit hashes in one; forgets everything beyond `most` units, which costs time only.

    Units reach `encode` sorted, or in any order without `in_order`.
    """

    def __init__(self, encode: Encode, dtype: type, most: int = 600_000, in_order: bool = True):
        self.encode, self.dtype, self.most, self.in_order = encode, dtype, most, in_order
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.checks = np.zeros(0, np.uint32)
        self.at = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int32)
        self.values = [np.zeros(0, self.dtype)]
        self.total = 0

    def lookup(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values of all units in order, and how many each unit has."""
        if not len(starts):
            return np.zeros(0, self.dtype), np.zeros(0, np.int64)
        keys, first, inverse = np.unique(text_hashes(data, starts, ends), return_index=True, return_inverse=True)
        starts, ends = starts[first], ends[first]
        checks = text_hashes(data, starts, ends, 1).astype(np.uint32)
        if len(self.keys) + len(keys) > self.most:
            self._clear()
        place = np.searchsorted(self.keys, keys)
        known = place < len(self.keys)
        near = np.minimum(place, max(0, len(self.keys) - 1))
        if len(self.keys):
            known &= (self.keys[near] == keys) & (self.checks[near] == checks)
        missing = np.flatnonzero(~known)
        if len(missing):
            raw = data.tobytes()
            units = [raw[s:e] for s, e in zip(starts[missing].tolist(), ends[missing].tolist(), strict=True)]
            order = sorted(range(len(units)), key=units.__getitem__) if self.in_order else list(range(len(units)))
            values, sizes = self.encode([units[i] for i in order])
            at = np.empty(len(units), np.int64)
            size = np.empty(len(units), np.int32)
            at[order] = self.total + np.cumsum(sizes) - sizes
            size[order] = sizes
            self.values = [np.concatenate([*self.values, values.astype(self.dtype)])]
            self.total += len(values)
            spot = place[missing]
            self.keys = np.insert(self.keys, spot, keys[missing])
            self.checks = np.insert(self.checks, spot, checks[missing])
            self.at = np.insert(self.at, spot, at)
            self.size = np.insert(self.size, spot, size)
            near = np.searchsorted(self.keys, keys)
        at, size = self.at[near][inverse], self.size[near][inverse].astype(np.int64)
        return self.values[0][ranges(at, size)], size
