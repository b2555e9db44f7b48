"""Substring dedup: windows of words that also start earlier, found behind a count-min prefilter.

Each block of documents counts the cells its windows fall into: a sparse partition sketch. Slices of the sketch merge
what all blocks counted into rows of counters and answer with the estimates, which are never too low. In a second pass
each block sends exact keys (128 bits of hash, with the smallest document) of only the windows that may be repeated, and
learns which of them also start in an earlier document. The third reading of the block removes the covered words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from railwatch.llm import exchange as X
from railwatch.llm import text as T
from railwatch.sources.tables import store

WINDOW = 20
SKETCH_ROWS = (0x9E3779B1, 0x85EBCA77)
SKETCH_BITS = 23


class _Windows:
    """The windows of a block: words, hashes, and distinct cells of the sketch with their counts."""

    def __init__(self, docs: pa.Table, window: int, slices: int):
        self.data, at = T.utf8(docs.column("text"))
        self.first, self.after, row = T.tokens(self.data, at)
        self.words = np.concatenate(
            [T.span_hashes(self.data[a:b], f - a, e - a) for a, b, f, e in self._stretches(at)] or [np.zeros(0, np.uint64)]
        )
        self.at = np.searchsorted(self.first, at)
        ids = docs.column("doc_id").combine_chunks()
        # A missing id comes after all others.
        self.doc = ids.fill_null(np.iinfo(np.int64).max).to_numpy()[row]
        self.place = np.arange(len(row)) - self.at[row]
        n = max(len(row) - window + 1, 0)
        self.start = np.flatnonzero(row[:n] == row[window - 1 :]) if n else np.zeros(0, np.int64)
        self.key = T.run_hashes(self.words, window)[self.start]
        # A cell is 32 low bits of the key within its slice.
        cell = X.slice_of(self.key, slices).astype(np.uint64) << np.uint64(32) | self.key & np.uint64(0xFFFFFFFF)
        self.order = np.argsort(cell)
        ordered = cell[self.order]
        new = np.flatnonzero(np.diff(ordered, prepend=ordered[:1] + np.uint64(1)))
        self.cell = ordered[new]
        self.of_cell = np.diff(np.append(new, len(ordered)))
        number = (self.cell >> np.uint64(32)).astype(np.int64)
        found = np.flatnonzero(np.diff(number, prepend=-1))
        self.slices, self.slice_at = number[found], np.append(found, len(number))

    def _stretches(self, at: np.ndarray) -> Iterator[tuple]:
        """The block in parts of about a chunk, each of whole words, to keep temporary arrays small."""
        start = 0
        while start < len(self.first):
            end = max(start + 1, int(np.searchsorted(self.after, self.first[start] + T.CHUNK_BYTES, "right")))
            yield self.first[start], self.after[end - 1], self.first[start:end], self.after[start:end]
            start = end

    def candidates(self, told: dict[int, bytes]) -> np.ndarray:
        """Numbers of the windows whose cell may be repeated."""
        repeated = X.join_bits(told, self.slices, self.slice_at)
        return np.sort(self.order[np.repeat(repeated, self.of_cell)])


def _ask_sketch(docs: pa.Table, told: dict, window: int, slices: int) -> Iterator[pa.RecordBatch]:
    w = _Windows(docs, window, slices)
    block = docs.column("block")[0].as_py()
    cells = w.cell.astype(np.uint32)
    counts = np.minimum(w.of_cell, 255).astype(np.uint8)
    cuts = list(zip(w.slice_at[:-1].tolist(), w.slice_at[1:].tolist(), strict=True))
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([block] * len(cuts), pa.int32()),
            pa.array(w.slices, pa.int32()),
            pa.array([X.planes(cells[a:b]) for a, b in cuts], pa.binary()),
            pa.array([counts[a:b].tobytes() for a, b in cuts], pa.binary()),
        ],
        ["block", "slice", "cells", "counts"],
    )


def sketch_places(cells: np.ndarray) -> list[np.ndarray]:
    """The counter of each cell in each row of a sketch."""
    shift = np.uint64(32 - SKETCH_BITS)
    return [(cells.astype(np.uint64) * np.uint64(m) & np.uint64(0xFFFFFFFF)) >> shift for m in SKETCH_ROWS]


def _merge_sketches(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """Adds up the partition sketches of a slice and answers which counts may be over one."""
    counters = [np.zeros(1 << SKETCH_BITS, np.uint8) for _ in SKETCH_ROWS]
    asked = []
    for cells, counts in zip(rows.column("cells").to_pylist(), rows.column("counts").to_pylist(), strict=True):
        cells = X.unplanes(cells, np.uint32)
        asked.append(cells)
        for counter, place in zip(counters, sketch_places(cells), strict=True):
            # Cells of one block can share a counter. From two on, the exact count makes no difference.
            np.add.at(counter, place, np.minimum(np.frombuffer(counts, np.uint8), 2))
            counter[place] = np.minimum(counter[place], 2)
    out = []
    for cells in asked:
        least = np.minimum(*(counter[place] for counter, place in zip(counters, sketch_places(cells), strict=True)))
        out.append(np.packbits(least >= 2).tobytes())
    yield X.answer_batch(rows, out)


class _Exact:
    """The candidate windows of a block, grouped by their exact keys."""

    def __init__(self, w: _Windows, told: dict[int, bytes], window: int, slices: int):
        number = w.candidates(told)
        self.start, key = w.start[number], w.key[number]
        second = np.zeros(len(number), np.uint64)
        for k in range(window):
            second += w.words[self.start + k] * np.uint64(pow(0xC2B2AE3D27D4EB4F, k + 1, 1 << 64))
        second = T.mix(second)
        order = np.lexsort((w.place[self.start], w.doc[self.start], second, key))
        self.start, key, second = self.start[order], key[order], second[order]
        new = np.ones(len(order), bool)
        new[1:] = (key[1:] != key[:-1]) | (second[1:] != second[:-1])
        self.first = np.flatnonzero(new)
        self.key, self.second = key[self.first], second[self.first]
        self.doc = w.doc[self.start[self.first]]
        self.group = np.cumsum(new) - 1
        self.slices, self.slice_at = X.cut(self.key, slices)

    def repeated(self, w: _Windows, told: dict[int, bytes]) -> np.ndarray:
        """First words of the windows that also start earlier."""
        elsewhere = X.join_bits(told, self.slices, self.slice_at)[self.group]
        lead = self.start[self.first][self.group]
        later = (w.doc[self.start] > w.doc[lead]) | (w.doc[self.start] == w.doc[lead]) & (w.place[self.start] > w.place[lead])
        return self.start[elsewhere | later]


def _ask_exact(docs: pa.Table, told: dict, window: int, slices: int) -> Iterator[pa.RecordBatch]:
    w = _Windows(docs, window, slices)
    e = _Exact(w, told.get("sketch", {}), window, slices)
    block = docs.column("block")[0].as_py()
    cuts = list(zip(e.slice_at[:-1].tolist(), e.slice_at[1:].tolist(), strict=True))
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([block] * len(cuts), pa.int32()),
            pa.array(e.slices, pa.int32()),
            *(pa.array([X.planes(x[a:b]) for a, b in cuts], pa.binary()) for x in (e.key, e.second, e.doc)),
        ],
        ["block", "slice", "key", "second", "doc"],
    )


def _answer_exact(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """For each key of each block, whether a block has it with a smaller document."""
    key, second, doc = (
        np.concatenate([X.unplanes(x, kind) for x in rows.column(c).to_pylist()])
        for c, kind in (("key", np.uint64), ("second", np.uint64), ("doc", np.int64))
    )
    size = np.array([len(k) // 8 for k in rows.column("key").to_pylist()])
    order = np.lexsort((doc, second, key))
    new = np.ones(len(key), bool)
    new[1:] = (np.diff(key[order]) != 0) | (np.diff(second[order]) != 0)
    least = doc[order][np.flatnonzero(new)][np.cumsum(new) - 1]
    later = np.zeros(len(key), bool)
    later[order] = doc[order] > least
    ends = np.cumsum(size)
    yield X.answer_batch(rows, [np.packbits(later[e - n : e]).tobytes() for n, e in zip(size.tolist(), ends.tolist(), strict=True)])


def _remove(docs: pa.Table, told: dict, window: int, slices: int, full: bool) -> Iterator[pa.RecordBatch]:
    w = _Windows(docs, window, slices)
    start = _Exact(w, told.get("sketch", {}), window, slices).repeated(w, told.get("exact", {}))
    edge = np.zeros(len(w.first) + 1, np.int64)
    np.add.at(edge, start, 1)
    np.subtract.at(edge, np.minimum(start + window, len(w.first)), 1)
    keep = np.cumsum(edge)[:-1] == 0
    # Kept words, each with a space behind it.
    first, after = w.first[keep], w.after[keep]
    size = after - first
    begin = np.cumsum(size + 1) - size - 1
    joined = np.full(int((size + 1).sum()), 0x20, np.uint8)
    joined[np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())] = T.gather(w.data, first, after)[0]
    kept_at = np.concatenate([[0], np.cumsum(keep)])[w.at]
    byte_at = np.append(begin, len(joined))[kept_at]
    raw = joined.tobytes()
    texts = [raw[a : max(a, b - 1)] for a, b in zip(byte_at[:-1].tolist(), byte_at[1:].tolist(), strict=True)]
    words = np.diff(w.at)
    out = {
        "doc_id": docs.column("doc_id").combine_chunks(),
        "n_words": pa.array(words),
        "n_removed": pa.array(words - np.diff(kept_at)),
        "kept_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
    }
    if full:
        out["kept"] = pa.array([t.decode("utf-8", "replace") for t in texts], pa.string())
    yield from pa.Table.from_pydict(out).to_batches(max_chunksize=5000)


def remove_repeats(docs: DataFrame, window: int = WINDOW, full: bool = False, block_bytes: int = X.BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256, and the kept text with ``full``.

    A word goes if a window of ``window`` words that covers it also starts earlier: in a document of smaller doc_id, or
    further ahead in the same. A null text has no words; a missing doc_id comes after all others; windows of rows that
    share a doc_id compare by their place alone, so repeated rows do not remove each other. Other columns are ignored,
    an empty table gives no rows. Answers are written to the shared folder between the passes.
    """
    n = X.number_of_blocks(docs, block_bytes)
    blocked = X.stored_blocks(docs.select("doc_id", "text"), n, block_bytes)
    ask = {"window": window, "slices": n}
    asked = X.in_stored_blocks(blocked, partial(_ask_sketch, **ask), "block int, slice int, cells binary, counts binary")
    sketch = store(X.in_slices(asked, n, _merge_sketches), "sketch")
    schema = "block int, slice int, key binary, second binary, doc binary"
    asked = X.in_stored_blocks(blocked, partial(_ask_exact, **ask), schema, sketch=sketch)
    exact = store(X.in_slices(asked, n, _answer_exact), "windows")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * full
    return X.in_stored_blocks(blocked, partial(_remove, full=full, **ask), schema, sketch=sketch, exact=exact)
