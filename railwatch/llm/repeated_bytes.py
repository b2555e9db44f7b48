"""Suffix-array dedup: strings of bytes that also start in an earlier document.

A string of ``LENGTH`` bytes that two documents share has in both the same minimizer, the smallest hash of its 16-byte
pieces. So a document is cut into stretches of places with one minimizer, and stretches with the same minimizer meet in
the same slice: each slice can find its repeats alone. A first pass learns which minimizers several documents have; the
second sends the distinct stretches of only those. A minimizer with very many distinct stretches is hot: each of its
places goes to a slice by a hash of all its ``LENGTH`` bytes, if a further pass has found it in several documents. A slice
hashes the ``LENGTH`` bytes from each place on, which leaves it the runs of places that other documents may have, too. It builds
Burrows-Wheeler transforms of shards of these runs and merges them (``bwt``); suffixes with a common prefix of ``LENGTH`` bytes form intervals, whose smallest document goes
back to all blocks. The third pass removes what is covered. Of documents with the same whole text only the first takes
part: the others are repeats from end to end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railwatch.llm import bwt
from railwatch.llm import exchange as X
from railwatch.llm import text as T
from railwatch.sources.tables import store

LENGTH = 50
PIECE = 16
_LAST = np.iinfo(np.int64).max
# Every block sends to every slice, so few large ones make few messages; places hold several 64-bit numbers each while a block
# is worked on.
BLOCK_BYTES = 8 << 20
# Arrays of a chunk stay in a core's cache.
CHUNK_BYTES = 1 << 17
SLICES_PER_BLOCK = 2
# Hex digits of a text's digest that tell copies among rows of one doc_id.
DIGEST = 32
# A minimizer with more distinct stretches than this is hot: its places go to slices by all their bytes.
HOT_STRETCHES = 1 << 14
# In a block only a minimizer with more stretches than this has its distinct ones counted.
FEW_STRETCHES = 64


def _smallest(h: np.ndarray, n: int) -> np.ndarray:
    """The smallest of each ``n`` neighbours, by widths that double."""
    width = 1
    while 2 * width <= n:
        h = np.minimum(h[:-width], h[width:])
        width *= 2
    rest = n - width
    return np.minimum(h[: len(h) - rest], h[rest:]) if rest else h


def _piece_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``PIECE`` bytes from each place on."""
    # Eight bytes from each place on, as one number.
    eight = np.ndarray((len(data) - 7,), "<u8", np.ascontiguousarray(data), strides=(1,)).copy()
    h = eight[: len(data) - PIECE + 1] * np.uint64(0xBF58476D1CE4E5B9)
    high = np.empty_like(h)
    h ^= np.right_shift(h, np.uint64(31), out=high)
    h += eight[PIECE - 8 :]
    h *= np.uint64(0x94D049BB133111EB)
    h ^= np.right_shift(h, np.uint64(32), out=high)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= np.right_shift(h, np.uint64(29), out=high)
    return h


class _Stretches:
    """The stretches of a block's documents: row, first byte, bytes, minimizer; copies left out."""

    def __init__(self, docs: pa.Table, copies: dict[int, set[str]], length: int):
        self.data, self.at = T.utf8(docs.column("text"))
        ids = docs.column("doc_id").combine_chunks()
        self.doc = ids.fill_null(_LAST).to_numpy()
        self.is_copy = np.isin(self.doc, np.fromiter(copies, np.int64, len(copies))) & ids.is_valid().to_numpy(zero_copy_only=False)
        for r in np.flatnonzero(self.is_copy).tolist():
            # Rows that share an id may have other texts.
            self.is_copy[r] = _digest(self.data[self.at[r] : self.at[r + 1]]) in copies[int(self.doc[r])]
        rows, first, size, least = [], [], [], []
        start, n = 0, len(self.doc)
        while start < n:
            end = max(start + 1, int(np.searchsorted(self.at, self.at[start] + CHUNK_BYTES, "right")) - 1)
            a, b = int(self.at[start]), int(self.at[end])
            if b - a >= length:
                smallest = _smallest(_piece_hashes(self.data[a:b]), length - PIECE + 1)
                ok = np.zeros(len(smallest), bool)
                for r in range(start, end):
                    if not self.is_copy[r]:
                        s = int(self.at[r]) - a
                        ok[s : max(s, int(self.at[r + 1]) - a - length + 1)] = True
                change = np.ones(len(smallest), bool)
                change[1:] = (smallest[1:] != smallest[:-1]) | ~ok[:-1]
                starts = self.at[start:end] - a
                change[starts[starts < len(smallest)]] = True
                # A stretch ends before the next one, or where its document has no more places.
                stop = np.flatnonzero(change | ~ok)
                begins = ok[stop]
                begin, stop = stop[begins], np.append(stop[1:], len(smallest))[begins]
                first.append(begin + a)
                size.append(stop - begin + length - 1)
                least.append(smallest[begin])
                rows.append(np.searchsorted(self.at, begin + a, "right") - 1)
            start = end
        empty = np.zeros(0, np.int64)
        self.row, self.first, self.size = (np.concatenate(x) if x else empty for x in (rows, first, size))
        # The smallest of many hashes is small: mixed once more, it is spread evenly over slices.
        self.least = T.mix(np.concatenate(least) + np.uint64(1)) if least else np.zeros(0, np.uint64)

    def hashes(self, some: np.ndarray, seed: int) -> np.ndarray:
        """A hash of each of some stretches, these in text order."""
        first, after = self.first[some], self.first[some] + self.size[some]
        out, start = np.zeros(len(first), np.uint64), 0
        while start < len(first):
            # Some at a time keep temporary arrays small.
            end = max(start + 1, int(np.searchsorted(first, first[start] + CHUNK_BYTES, "right")))
            a, b = int(first[start]), int(after[start:end].max())
            out[start:end] = T.span_hashes(self.data[a:b], first[start:end] - a, after[start:end] - a, seed=seed)
            start = end
        return out

    def take(self, some: np.ndarray) -> None:
        self.row, self.first, self.size, self.least = self.row[some], self.first[some], self.size[some], self.least[some]

    def split(self, hot: np.ndarray, length: int) -> np.ndarray:
        """Makes each place of the hot stretches a stretch of its own, that a hash of all its bytes sends to its slice.
        Gives which stretches are such places."""
        places = np.where(hot, self.size - length + 1, 1)
        old = np.repeat(np.arange(len(hot)), places)
        step = np.arange(len(old)) - np.repeat(np.cumsum(places) - places, places)
        self.take(old)
        hot = hot[old]
        self.first = self.first + step
        self.size = np.where(hot, length, self.size)
        at = np.flatnonzero(hot)
        self.least[at] = T.mix(self.hashes(at, seed=5) + np.uint64(1))
        return hot

    def cells(self, slices: int) -> np.ndarray:
        """Slice of the minimizer (upper half) and its low 32 bits."""
        return X.slice_of(self.least, slices).astype(np.uint64) << np.uint64(32) | self.least & np.uint64(0xFFFFFFFF)


def _cell_cuts(cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    number = (cell >> np.uint64(32)).astype(np.int64)
    found = np.flatnonzero(np.diff(number, prepend=-1))
    return number[found], np.append(found, len(number))


def _digest(text: np.ndarray) -> str:
    return hashlib.sha256(text.tobytes()).hexdigest()[:DIGEST]


def _copies(told: dict) -> dict[int, set[str]]:
    """Digests of the texts that are copies, by doc_id."""
    out: dict[int, set[str]] = {}
    for payload in told.get("copies", {}).values():
        for pair in payload.decode().split():
            doc, digest = pair.split(":")
            out.setdefault(int(doc), set()).add(digest)
    return out


def _ask_minimizers(docs: pa.Table, told: dict, length: int, slices: int) -> Iterator[pa.RecordBatch]:
    yield from _ask_cells(docs.column("block")[0].as_py(), _Stretches(docs, _copies(told), length), slices)


def _ask_windows(docs: pa.Table, told: dict, length: int, slices: int) -> Iterator[pa.RecordBatch]:
    """The same for the places of hot stretches."""
    s = _Stretches(docs, _copies(told), length)
    s.take(np.flatnonzero(_hot(s, told, slices)))
    s.split(np.ones(len(s.row), bool), length)
    yield from _ask_cells(docs.column("block")[0].as_py(), s, slices)


def _ask_cells(block: int, s: _Stretches, slices: int) -> Iterator[pa.RecordBatch]:
    cell, row = s.cells(slices), s.doc[s.row]
    order, cell = T.order(cell, 32 + slices.bit_length())
    row = row[order]
    new = np.flatnonzero(np.diff(cell, prepend=cell[:1] + np.uint64(1)))
    several = np.maximum.reduceat(row, new) != np.minimum.reduceat(row, new) if len(new) else np.zeros(0, bool)
    count = np.diff(np.append(new, len(cell)))
    often = np.repeat(count > FEW_STRETCHES, count)
    if often.any():
        at = np.sort(order[often])
        group = np.empty(len(order), np.int64)
        group[order] = np.repeat(np.arange(len(new)), count)
        pair = np.unique(np.stack([group[at].astype(np.uint64), s.hashes(at, seed=0)]), axis=1)
        distinct = np.bincount(pair[0].astype(np.int64), minlength=len(new))
        count = np.where(count > FEW_STRETCHES, distinct, count)
    cell = cell[new]
    slices_, at = _cell_cuts(cell)
    low = cell.astype(np.uint32)
    cuts = list(zip(at[:-1].tolist(), at[1:].tolist(), strict=True))
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([block] * len(cuts), pa.int32()),
            pa.array(slices_, pa.int32()),
            pa.array([X.planes(low[a:b]) for a, b in cuts], pa.binary()),
            pa.array([np.packbits(several[a:b]).tobytes() for a, b in cuts], pa.binary()),
            pa.array([X.planes(count[a:b].astype(np.uint32)) for a, b in cuts], pa.binary()),
        ],
        ["block", "slice", "cells", "several", "stretches"],
    )


def _answer_minimizers(rows: pa.Table, hot_stretches: int) -> Iterator[pa.RecordBatch]:
    """Which minimizers stand in more than one document, and which of these are hot."""
    cells = [X.unplanes(c, np.uint32) for c in rows.column("cells").to_pylist()]
    several = [np.unpackbits(np.frombuffer(b, np.uint8), count=len(c)) for b, c in zip(rows.column("several").to_pylist(), cells, strict=True)]
    stretches = np.concatenate([X.unplanes(c, np.uint32) for c in rows.column("stretches").to_pylist()])
    distinct, number = T.numbered(np.concatenate(cells), 32)
    many = np.bincount(number, 1 + np.concatenate(several), len(distinct)) >= 2
    hot = many & (np.bincount(number, stretches, len(distinct)) > hot_stretches)
    ends = np.cumsum([len(c) for c in cells])
    out, some_hot = [], []
    for c, e in zip(cells, ends.tolist(), strict=True):
        mine = number[e - len(c) : e]
        # Without hot ones nothing is said of them.
        some_hot.append(bool(hot[mine].any()))
        out.append(np.packbits(many[mine]).tobytes() + (np.packbits(hot[mine]).tobytes() if some_hot[-1] else b""))
    yield X.answer_batch(rows, out).append_column("hot", pa.array(some_hot, pa.bool_()))


def _hot(s: _Stretches, told: dict, slices: int) -> np.ndarray:
    """Which stretches have a hot minimizer."""
    distinct, number = T.numbered(s.cells(slices), 32 + slices.bit_length())
    slice_number, at = _cell_cuts(distinct)
    said = {}
    for k, a, b in zip(slice_number.tolist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
        size = (b - a + 7) // 8
        said[k] = told["minimizers"][k][size:] or bytes(size)
    return X.join_bits(said, slice_number, at)[number]


def _same(hashes: np.ndarray, size: np.ndarray, slice_number: np.ndarray | None = None, slices: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """An order of strings by slice, in which the same ones are neighbours, and where another begins. A second sum over the
    same powers would follow from the first and the size, so these two tell as much."""
    bits = np.uint64((slices - 1).bit_length())
    key = hashes if not bits else slice_number.astype(np.uint64) << np.uint64(64) - bits | hashes >> bits
    order, _ = T.order(key, 64)
    one, size = hashes[order], size[order]
    new = np.ones(len(order), bool)
    # Of hashes that differ in what the slice leaves out alone, copies may be parted: that is one string more.
    new[1:] = (one[1:] != one[:-1]) | (size[1:] != size[:-1])
    if slice_number is not None:
        number = slice_number[order]
        new[1:] |= number[1:] != number[:-1]
    return order, new


class _Strings:
    """The distinct candidate stretches of a block, sorted by slice, each with its smallest document."""

    def __init__(self, s: _Stretches, told: dict, length: int, slices: int):
        shared = self._shared(s, told.get("minimizers", {}), slices)
        if told.get("windows"):
            hot = _hot(s, told, slices)
            s.take(np.flatnonzero(shared))
            window = s.split(hot[shared], length)
            shared = np.ones(len(window), bool)
            shared[window] = self._shared(s, told["windows"], slices, np.flatnonzero(window))
        self.index = np.flatnonzero(shared)
        number, doc = X.slice_of(s.least[self.index], slices), s.doc[s.row[self.index]]
        first, size = s.first[self.index], s.size[self.index]
        order, new = _same(s.hashes(self.index, seed=0), size, number, slices)
        self.lead = order[new]
        self.number = np.empty(len(order), np.int64)
        self.number[order] = np.cumsum(new) - 1
        self.first, self.after = first[self.lead], first[self.lead] + size[self.lead]
        self.doc = np.minimum.reduceat(doc[order], np.flatnonzero(new)) if len(order) else doc
        number = number[self.lead]
        found = np.flatnonzero(np.diff(number, prepend=-1))
        self.slices, self.slice_at = number[found], np.append(found, len(number))

    @staticmethod
    def _shared(s: _Stretches, told: dict[int, bytes], slices: int, some: np.ndarray | slice = slice(None)) -> np.ndarray:
        distinct, number = T.numbered(s.cells(slices)[some], 32 + slices.bit_length())
        slice_number, at = _cell_cuts(distinct)
        return X.join_bits(told, slice_number, at)[number]


def _ask_strings(docs: pa.Table, told: dict, length: int, slices: int) -> Iterator[pa.RecordBatch]:
    s = _Stretches(docs, _copies(told), length)
    x = _Strings(s, told, length, slices)
    block = docs.column("block")[0].as_py()
    for number, a, b in zip(x.slices.tolist(), x.slice_at[:-1].tolist(), x.slice_at[1:].tolist(), strict=True):
        data, at = T.gather(s.data, x.first[a:b], x.after[a:b])
        packed = np.concatenate([np.frombuffer(X.planes(v), np.uint8) for v in (np.diff(at), x.doc[a:b])] + [data])
        yield pa.RecordBatch.from_arrays(
            [*(pa.array([v], pa.int32()) for v in (block, number, b - a)), pa.array([X.pack(packed)], pa.binary())],
            ["block", "slice", "n", "strings"],
        )


def _chunks(at: np.ndarray) -> Iterator[tuple[int, int]]:
    """Some strings at a time, which keeps temporary arrays small."""
    start = 0
    while start < len(at) - 1:
        end = max(start + 1, int(np.searchsorted(at, at[start] + CHUNK_BYTES, "right")) - 1)
        yield start, end
        start = end


def _string_hashes(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    out = np.empty(len(at) - 1, np.uint64)
    for start, end in _chunks(at):
        some = at[start : end + 1] - at[start]
        out[start:end] = T.span_hashes(data[at[start] : at[end]], some[:-1], some[1:])
    return out


def _repeated(data: np.ndarray, at: np.ndarray, places: np.ndarray, doc: np.ndarray, length: int) -> np.ndarray:
    """The places of strings whose ``length`` bytes may also start in a string of another document: all that do, and what
    shares their hash."""
    hashes = np.empty(places[-1], np.uint64)
    for start, end in _chunks(at):
        a, p, q = at[start], places[start], places[end]
        first = np.repeat(at[start:end] - a - places[start:end] + p, np.diff(places[start : end + 1])) + np.arange(q - p)
        hashes[p:q] = T.span_hashes(data[a : at[end]], first, first + length)
    shift = np.uint64(len(hashes).bit_length())
    hashes = hashes >> shift << shift
    hashes |= np.arange(len(hashes), dtype=np.uint64)
    hashes.sort()
    found = (hashes & ((np.uint64(1) << shift) - np.uint64(1))).view(np.int64)
    hashes >>= shift
    new = np.ones(len(hashes) + 1, bool)
    new[1:-1] = hashes[1:] != hashes[:-1]
    several = ~(new[:-1] & new[1:])
    found, lead = found[several], np.flatnonzero(new[:-1][several])
    if not len(found):
        return found
    of = doc[np.searchsorted(places, found, "right") - 1]
    other = np.minimum.reduceat(of, lead) != np.maximum.reduceat(of, lead)
    return np.sort(found[np.repeat(other, np.diff(np.append(lead, len(found))))])


def least_documents(data: np.ndarray, at: np.ndarray, doc: np.ndarray, length: int, shard_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """For each place of each string where ``length`` bytes start: the smallest document of a string that has the same
    bytes anywhere. And the offsets of strings."""
    n = np.maximum(np.diff(at) - length + 1, 0)
    places = np.concatenate([[0], np.cumsum(n)])
    out = np.repeat(doc, n)
    # Most strings share a minimizer but no ``length`` bytes: transforms are made of the runs of places that may.
    found = _repeated(data, at, places, doc, length)
    if not len(found):
        return out, places
    string = np.searchsorted(places, found, "right") - 1
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1] + 1) | (string[1:] != string[:-1])
    lead = np.flatnonzero(new)
    first = at[string[lead]] + found[lead] - places[string[lead]]
    run, run_at = T.gather(data, first, first + np.diff(np.append(lead, len(found))) + length - 1)
    run, run_at, least, number = _distinct(run, run_at, doc[string[lead]])
    values, run_places = _least_of(run, run_at, least, length, shard_bytes)
    out[found] = T.gather(values, run_places[number], run_places[number + 1])[0]
    return out, places


def _least_of(data: np.ndarray, at: np.ndarray, doc: np.ndarray, length: int, shard_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """The same of strings that all have ``length`` bytes, by their merged transforms."""
    places = np.concatenate([[0], np.cumsum(np.diff(at) - length + 1)])
    out = np.zeros(places[-1], np.int64)
    t = bwt.merge_all(data, at, length, shard_bytes)
    whole = t.place < np.diff(at)[t.string] - length + 1
    string, place, same = t.string[whole], t.place[whole], t.same[whole]
    interval = np.flatnonzero(np.diff(same, prepend=same[0] - 1))
    least = np.minimum.reduceat(doc[string], interval)
    out[places[string] + place] = np.repeat(least, np.diff(np.append(interval, len(same))))
    return out, places


def _distinct(data: np.ndarray, at: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct strings, their offsets and smallest documents, and which of them each string is."""
    order, new = _same(_string_hashes(data, at), np.diff(at))
    lead = order[new]
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    return *T.gather(data, at[lead], at[lead + 1]), np.minimum.reduceat(doc[order], np.flatnonzero(new)), number


def _pack_runs(values: np.ndarray) -> bytes:
    """Numbers of which neighbours are mostly the same: each run's, then how long it is."""
    first = np.flatnonzero(np.diff(values, prepend=values[:1] + 1))
    return values[first].tobytes() + np.diff(np.append(first, len(values))).astype(np.int32).tobytes()


def _unpack_runs(raw: bytes) -> np.ndarray:
    n = len(raw) // 12
    return np.repeat(np.frombuffer(raw, np.int64, n), np.frombuffer(raw, np.int32, n, 8 * n))


def _answer_strings(rows: pa.Table, length: int, shard_bytes: int) -> Iterator[pa.RecordBatch]:
    sizes, docs, texts = [], [], []
    for n, raw in zip(rows.column("n").to_pylist(), rows.column("strings").to_pylist(), strict=True):
        sent = X.unpack(raw, np.uint8)
        sizes.append(X.unplanes(sent[: 8 * n], np.int64))
        docs.append(X.unplanes(sent[8 * n : 16 * n], np.int64))
        texts.append(sent[16 * n :])
    size, doc, data = map(np.concatenate, (sizes, docs, texts))
    at = np.concatenate([[0], np.cumsum(size)])
    # The same stretch from several blocks is one string.
    distinct, distinct_at, doc, number = _distinct(data, at, doc)
    least, places = least_documents(distinct, distinct_at, doc, length, shard_bytes)
    ends = np.cumsum([len(s) for s in sizes])
    out, start = [], 0
    for end in ends.tolist():
        mine = number[start:end]
        out.append(_pack_runs(T.gather(least, places[mine], places[mine + 1])[0]))
        start = end
    yield X.answer_batch(rows, out)


def _runs(begin: np.ndarray, length: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of bytes that strings of ``length`` cover, which begin at ascending places; the offsets part texts."""
    row = np.searchsorted(at, begin, "right")
    new = np.ones(len(begin), bool)
    new[1:] = (begin[1:] > begin[:-1] + length) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    return begin[first], begin[np.append(first[1:], len(begin))[: len(first)] - 1] + length


def _remove(docs: pa.Table, told: dict, length: int, slices: int, full: bool) -> Iterator[pa.RecordBatch]:
    s = _Stretches(docs, _copies(told), length)
    x = _Strings(s, told, length, slices)
    answers = told.get("strings", {})
    least = np.concatenate([np.zeros(0, np.int64), *(_unpack_runs(answers[n]) for n in x.slices.tolist())])
    places = np.concatenate([[0], np.cumsum(x.after - x.first - length + 1)])
    # Back from distinct strings to all stretches of the block.
    mine = x.number
    values, at = T.gather(least, places[mine], places[mine + 1])
    stretch = np.repeat(np.arange(len(mine)), np.diff(at))
    begin = s.first[x.index][stretch] + np.arange(len(values)) - at[:-1][stretch]
    begin = begin[values < s.doc[s.row[x.index]][stretch]]
    first, after = _runs(begin, length, s.at)
    size = np.diff(s.at)
    # Copies have no stretches.
    gone = s.is_copy & (size >= length)
    first, after = np.concatenate([first, s.at[:-1][gone]]), np.concatenate([after, s.at[1:][gone]])
    order = np.argsort(first)
    first, after = first[order], after[order]
    row = np.searchsorted(s.at, first, "right") - 1
    spans = np.bincount(row, minlength=len(size))
    n_removed = np.bincount(row, after - first, len(size)).astype(np.int64)
    # Stretches of what stays and what goes take turns.
    turns = np.diff(np.concatenate([[0], np.stack([first, after], axis=1).ravel(), [len(s.data)]]))
    stays = np.repeat(np.arange(len(turns)) % 2 == 0, turns)
    kept_at = s.at - np.concatenate([[0], np.cumsum(n_removed)])
    raw = s.data[stays].tobytes()
    texts = [raw[a:b] for a, b in zip(kept_at[:-1].tolist(), kept_at[1:].tolist(), strict=True)]
    out = {
        "doc_id": docs.column("doc_id").combine_chunks(),
        "n_bytes": pa.array(size),
        "n_removed": pa.array(n_removed),
        "n_spans": pa.array(spans),
        "kept_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
    }
    if full:
        out["kept"] = pa.array(texts, pa.binary())
    yield from pa.Table.from_pydict(out).to_batches(max_chunksize=5000)


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, full: bool = False, block_bytes: int = BLOCK_BYTES, shard_bytes: int = 1 << 19
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and the kept bytes with ``full``.

    A byte goes if a string of ``length`` bytes (a multiple of 5) that covers it also starts in a document of smaller
    doc_id. A null text has no bytes; a missing doc_id comes after all others, and rows that share a doc_id do not remove
    each other's bytes. Other columns are ignored, an empty table gives no rows. Answers are written to the shared
    folder between the passes.
    """
    if length < 2 * PIECE:
        raise ValueError(f"at least {2 * PIECE} bytes")
    n = X.number_of_blocks(docs, block_bytes)
    blocked = X.stored_blocks(docs.select("doc_id", "text"), n, block_bytes)
    ids = blocked.where(F.octet_length("text") >= length).select("block", "doc_id", F.sha2("text", 256).alias("digest"))
    firsts = ids.groupBy("digest").agg(F.min("doc_id").alias("first"))
    later = ids.join(firsts, "digest").where("doc_id > first").groupBy("block").agg(F.collect_set(F.concat_ws(":", F.col("doc_id").cast("string"), F.substring("digest", 1, DIGEST))).alias("ids"))
    later = later.select("block", F.lit(0).alias("slice"), F.concat_ws(" ", "ids").cast("binary").alias("payload"))
    copies = store(later, "copies")
    # A slice holds its transforms in memory, at about a hundred bytes for each byte of its repeated runs.
    slices = SLICES_PER_BLOCK * n
    ask = {"length": length, "slices": slices}
    answer = partial(_answer_minimizers, hot_stretches=HOT_STRETCHES)
    schema = "block int, slice int, cells binary, several binary, stretches binary"
    asked = X.in_stored_blocks(blocked, partial(_ask_minimizers, **ask), schema, copies=copies)
    learned = {"minimizers": store(X.in_slices(asked, slices, answer, X.ANSWER + ", hot boolean"), "minimizers")}
    if not learned["minimizers"].where("hot").isEmpty():
        asked = X.in_stored_blocks(blocked, partial(_ask_windows, **ask), schema, copies=copies, **learned)
        learned["windows"] = store(X.in_slices(asked, slices, answer, X.ANSWER + ", hot boolean"), "windows")
    schema = "block int, slice int, n int, strings binary"
    asked = X.in_stored_blocks(blocked, partial(_ask_strings, **ask), schema, copies=copies, **learned)
    strings = store(X.in_slices(asked, slices, partial(_answer_strings, length=length, shard_bytes=shard_bytes)), "strings")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * full
    return X.in_stored_blocks(blocked, partial(_remove, full=full, **ask), schema, copies=copies, **learned, strings=strings)
