"""Array views of Arrow text columns: bytes, tokens, hashes.

Every helper works on a whole batch at once, so Python runs a few array operations per batch, none per row.
A null text is an empty one. Hashes are polynomials modulo 2^64 followed by a mixing step; they depend on the bytes
alone, so every executor computes the same ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# The white space that parts words, [\x20\x09-\x0D].
WHITE_SPACE = bytes([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(WHITE_SPACE)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# Odd multipliers of the polynomials, any would do.
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_MULTIPLIER), -1, 1 << 64))
_POWERS: dict[str, np.ndarray] = {}
CHUNK_BYTES = 4 << 20


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one after the other, and the offsets that part them (one more than rows)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    n = len(column)
    if column.null_count:
        column = column.fill_null(b"")
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def pieces(batch: pa.RecordBatch, column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``limit`` text bytes, to keep temporary arrays small; a longer text is a slice."""
    _, at = utf8(batch.column(column))
    start = 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(at, at[start] + limit, "right")) - 1)
        yield batch.slice(start, end - start)
        start = end


def _powers(name: str, base: np.uint64, n: int) -> np.ndarray:
    have = _POWERS.get(name)
    if have is None or len(have) < n:
        have = np.full(max(n, CHUNK_BYTES + 1), base, np.uint64)
        have[0] = 1
        _POWERS[name] = have = np.cumprod(have, dtype=np.uint64)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every bit of a 64-bit value over all bits of the result (one to one)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, other bytes as they are."""
    return _LOWER.take(data)


def is_space(data: np.ndarray) -> np.ndarray:
    return _IS_SPACE.take(data)


def tokens(data: np.ndarray, at: np.ndarray, is_space: np.ndarray = _IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+``, or runs of other bytes than ``is_space`` marks: first byte, byte after the last,
    and row, in text order."""
    inside = np.zeros(len(data) + 2, bool)
    np.logical_not(is_space.take(data), out=inside[1:-1])
    starts = inside[1:-1] & ~inside[:-2]
    ends = inside[1:-1] & ~inside[2:]
    # A word ends where its row ends.
    filled = at[:-1][at[1:] > at[:-1]]
    starts[filled] = inside[1:-1][filled]
    last = at[1:][at[1:] > at[:-1]] - 1
    ends[last] = inside[1:-1][last]
    first, after = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return first, after, np.searchsorted(at, first, "right") - 1


def span_hashes(data: np.ndarray, first: np.ndarray, after: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each span of bytes."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    # One more than the byte, so that a zero byte counts.
    terms = data.astype(np.uint64)
    terms += np.uint64(1 + seed)
    terms *= _powers("up", _MULTIPLIER, n)
    np.cumsum(terms, out=sums[1:])
    h = (sums[after] - sums[first]) * _powers("down", _INVERSE, n + 1)[first]
    return mix(h + (after - first).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def run_hashes(values: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each ``length`` consecutive values; the last ``length - 1`` places have none."""
    n = len(values) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    factor = (1 + 2 * seed) * int(_MULTIPLIER) | 1
    for k in range(length):
        out += values[k : k + n] * np.uint64(pow(factor, k, 1 << 64))
    return mix(out)


def order(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The stable ascending order of whole numbers below ``2 ** bits``, and the numbers in it. Key and place sorted as one
    number take a fraction of the time of ``argsort``."""
    shift = np.uint64(max(len(keys) - 1, 0).bit_length())
    # Where both do not fit, the key's upper bits are sorted; hashes that share these are few.
    lost = np.uint64(max(bits + int(shift) - 64, 0))
    packed = keys.astype(np.uint64, copy=False)
    packed = (packed >> lost if lost else packed) << shift
    packed |= np.arange(len(keys), dtype=np.uint64)
    packed.sort()
    found = (packed & ((np.uint64(1) << shift) - np.uint64(1))).view(np.int64)
    if lost:
        ascending = keys[found]
        if (ascending[1:] < ascending[:-1]).any():
            right = np.argsort(ascending, kind="stable")
            found, ascending = found[right], ascending[right]
        return found, ascending
    packed >>= shift
    return found, packed.astype(keys.dtype, copy=False)


def numbered(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers below ``2 ** bits``, ascending, and for each key the place of its number among them."""
    found, ascending = order(keys, bits)
    new = np.ones(len(keys), bool)
    new[1:] = ascending[1:] != ascending[:-1]
    number = np.empty(len(keys), np.int64)
    number[found] = np.cumsum(new) - 1
    return ascending[new], number


def gather(data: np.ndarray, first: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The spans copied one after the other, and their offsets."""
    size = after - first
    at = np.zeros(len(first) + 1, np.int64)
    np.cumsum(size, out=at[1:])
    return data[np.repeat(first - at[:-1], size) + np.arange(at[-1])], at


def binary_array(data: np.ndarray, at: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    """An Arrow column of binary (or text) values over bytes and offsets."""
    out = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(at) - 1, [None, pa.py_buffer(np.ascontiguousarray(at, np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    )
    return out.cast(kind or pa.binary())


def group_sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive offsets; an empty stretch gives 0."""
    total = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[at[1:]] - total[at[:-1]]
