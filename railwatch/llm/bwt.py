"""Burrows-Wheeler transforms of sets of strings, and their merge by interleave refinement.

A transform lists the suffixes of its strings in order. For each it has the ``UNIT`` symbols that lead from the suffix
``UNIT`` places further on back to it (the transform's symbols, read as one number), and the rank of that further
suffix. Strings end with a symbol below all others. Suffixes are ordered by their first ``depth`` symbols.

Merging needs no texts and sorts nothing: an interleave of two transforms by the first symbols is refined to twice the
depth at a time. Both are in order already, so the refined order of the two is found by search of one in the other, by
the class of a suffix so far and the class of the suffix where that knowledge ends. Suffixes of one final class have a
common prefix of ``depth`` symbols: such intervals are the repeats.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from railwatch.llm import text as T

UNIT = 5
_BITS = np.uint64(9)


@dataclass
class Transform:
    symbols: np.ndarray  # packed, per suffix in order
    further: np.ndarray  # rank of the suffix UNIT places on, -1 past the end
    string: np.ndarray
    place: np.ndarray
    same: np.ndarray  # class of the first ``depth`` symbols, ascending


def _units(depth: int) -> list[int]:
    """Powers of two of units whose sum is the depth, largest first."""
    if depth % UNIT:
        raise ValueError(f"the depth must be a multiple of {UNIT}")
    n = depth // UNIT
    return [1 << k for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]


def _number(keys: np.ndarray) -> np.ndarray:
    """Class numbers from 0 on of ascending keys."""
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    number = new.astype(np.int32)
    number[:1] = 0
    return np.cumsum(number, out=number)


def _beyond(rank: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Classes of suffixes by rank, 0 for what is past the end, others from 1 on."""
    more = np.zeros(len(classes) + 1, np.int32)
    np.add(classes, np.int32(1), out=more[:-1])
    # A rank of -1 reads the last.
    return more[rank]


def _on(rank: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """``steps`` by rank, -1 for what is past the end."""
    return np.append(steps, np.int32(-1))[rank]


def _symbols(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The ``UNIT`` symbols from each place on as one number; past the end of a string they are 0."""
    # By widths that double, over the ends of strings; what is past them goes after.
    one = np.concatenate([data.astype(np.uint64) + np.uint64(1), np.zeros(UNIT, np.uint64)])
    packed, width = one, 1
    while 2 * width <= UNIT:
        packed = packed[:-width] << np.uint64(width) * _BITS | packed[width:]
        width *= 2
    for k in range(width, UNIT):
        packed = packed[: len(data) + UNIT - k] << _BITS | one[k:]
    packed = packed[: len(data)]
    for left in range(1, UNIT):
        last = at[1:] - left
        last = last[last >= at[:-1]]
        packed[last] &= ~((np.uint64(1) << np.uint64(UNIT - left) * _BITS) - np.uint64(1))
    return packed


def transform(data: np.ndarray, at: np.ndarray, first_string: int, depth: int) -> Transform:
    """Of the strings that the offsets cut the bytes into; they are numbered from ``first_string`` on."""
    size = np.diff(at)
    string = np.repeat(np.arange(len(size), dtype=np.int32), size)
    every = np.arange(len(data), dtype=np.int32)
    left = np.repeat(at[1:].astype(np.int32), size) - every
    symbols = _symbols(data, at)

    def further(units: int) -> np.ndarray:
        return np.where(left > units * UNIT, every + np.int32(units * UNIT), np.int32(-1))

    def beyond(units: int, classes: np.ndarray) -> np.ndarray:
        """Classes of the places so many units on, 0 for what is past the end, others from 1 on."""
        out = np.zeros(len(classes), np.int32)
        np.add(classes[units * UNIT :], np.int32(1), out=out[: len(classes[units * UNIT :])])
        out *= left > units * UNIT
        return out

    def both(first: np.ndarray, then: np.ndarray) -> np.ndarray:
        keys = first.astype(np.uint64)
        keys <<= half
        keys |= then.view(np.uint32)
        return keys

    def classes(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        order, ascending = T.order(keys, bits)
        out = np.empty(len(keys), np.int32)
        out[order] = _number(ascending)
        return out, order

    half = np.uint64((len(data) + 2).bit_length())
    of, order, bits = {}, np.zeros(0, np.int64), 2 * int(half)
    of[1], order = classes(symbols, UNIT * int(_BITS))
    parts = _units(depth)
    while (k := max(of)) < parts[0]:
        of[2 * k], order = classes(both(of[k], beyond(k, of[k])), bits)
    same, done = of[parts[0]], parts[0]
    for k in parts[1:]:
        same, order = classes(both(same, beyond(done, of[k])), bits)
        done += k
    rank = np.empty(len(data), np.int32)
    rank[order] = every
    on = further(1)[order]
    place = every - np.repeat(at[:-1].astype(np.int32), size)
    return Transform(
        symbols[order], _on(on, rank), string[order] + np.int32(first_string), place[order], same[order]
    )


def merge(a: Transform, b: Transform, depth: int) -> Transform:
    """The transform of both sets of strings."""
    na, nb = len(a.symbols), len(b.symbols)
    n = np.int64(na + nb + 2)

    def interleave(keys_a: np.ndarray, keys_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Places of both in the merged order, and their classes."""
        at_b = np.searchsorted(keys_a, keys_b, "right") + np.arange(nb)
        at_b = at_b.astype(np.int32)
        is_b = np.zeros(na + nb, bool)
        is_b[at_b] = True
        at_a = np.flatnonzero(~is_b).astype(np.int32)
        keys = np.empty(na + nb, keys_a.dtype)
        keys[at_a], keys[at_b] = keys_a, keys_b
        number = _number(keys)
        return at_a, at_b, number[at_a], number[at_b]

    at_a, at_b, ca, cb = interleave(a.symbols, b.symbols)
    of, step = {1: (ca, cb)}, {1: (a.further, b.further)}
    parts = _units(depth)
    while (k := max(of)) < parts[0]:
        (ca, cb), (sa, sb) = of[k], step[k]
        at_a, at_b, ca, cb = interleave(ca * n + _beyond(sa, ca), cb * n + _beyond(sb, cb))
        of[2 * k], step[2 * k] = (ca, cb), (_on(sa, sa), _on(sb, sb))
    ca, cb = of[parts[0]]
    sa, sb = step[parts[0]]
    for k in parts[1:]:
        at_a, at_b, ca, cb = interleave(ca * n + _beyond(sa, of[k][0]), cb * n + _beyond(sb, of[k][1]))
        ka, kb = step[k]
        sa, sb = _on(sa, ka), _on(sb, kb)

    def woven(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        out = np.empty(na + nb, x.dtype)
        out[at_a], out[at_b] = x, y
        return out

    further = woven(_on(a.further, at_a), _on(b.further, at_b))
    return Transform(
        woven(a.symbols, b.symbols), further, woven(a.string, b.string), woven(a.place, b.place), woven(ca, cb)
    )


def merge_all(data: np.ndarray, at: np.ndarray, depth: int, shard_bytes: int = 1 << 19) -> Transform:
    """Transforms of shards of about ``shard_bytes``, merged two by two."""
    cuts = [0]
    while cuts[-1] < len(at) - 1:
        cuts.append(max(cuts[-1] + 1, int(np.searchsorted(at, at[cuts[-1]] + shard_bytes, "right")) - 1))
    level = [transform(data[at[s] : at[e]], at[s : e + 1] - at[s], s, depth) for s, e in zip(cuts[:-1], cuts[1:], strict=True)]
    while len(level) > 1:
        level = [merge(level[i], level[i + 1], depth) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0] if level else transform(data[:0], np.zeros(1, np.int64), 0, depth)
