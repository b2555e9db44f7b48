"""Mergeable Misra-Gries summaries over integer keys, as sorted arrays."""

from __future__ import annotations

import numpy as np


def add_up(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.flatnonzero(np.diff(ordered, prepend=ordered[:1] + 1))
    return ordered[new], np.add.reduceat(counts[order], new)


class Summary:
    """At most ``capacity`` counters.

    A key's counter is too low by ``error`` at most, and never too high; ``error`` times ``capacity + 1`` is at most the
    mass that was added. So with a capacity of mass // threshold, every key of ``threshold`` or more has a counter.
    This holds for any order of additions and merges.
    """

    def __init__(self, capacity: int):
        self.capacity, self.error, self.mass = capacity, 0, 0
        self.keys, self.counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self._waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self._room = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Adds distinct keys. Some additions wait until there are as many keys as counters, so that each costs little."""
        self.mass += int(counts.sum())
        self._waiting.append((keys, counts.astype(np.int64)))
        self._room += len(keys)
        if self._room > max(self.capacity, 1 << 16):
            self._shrink()

    def merge(self, other: Summary) -> None:
        other._shrink()
        mass, error = self.mass + other.mass, other.error
        self.add(other.keys, other.counts)
        self.mass, self.error = mass, self.error + error

    def _shrink(self) -> None:
        if not self._waiting:
            return
        keys, counts = zip((self.keys, self.counts), *self._waiting, strict=True)
        self._waiting, self._room = [], 0
        self.keys, self.counts = add_up(np.concatenate(keys), np.concatenate(counts))
        if len(self.keys) > self.capacity:
            # Taking the largest count that has no place from every counter removes it capacity + 1 times at least.
            less = int(np.partition(self.counts, len(self.counts) - self.capacity - 1)[len(self.counts) - self.capacity - 1])
            stays = self.counts > less
            self.keys, self.counts = self.keys[stays], self.counts[stays] - less
            self.error += less

    def may_reach(self, threshold: int) -> np.ndarray:
        """The keys, in order, that may have this count; all that have it are among them."""
        self._shrink()
        return self.keys[self.counts + self.error >= threshold]
