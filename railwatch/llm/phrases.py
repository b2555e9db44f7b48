"""Phrase collocations: frequent word n-grams of a language, scored by how much they hold together.

First pass: a block of documents counts its distinct n-grams and tells each hash partition about its own, as a summary of
24-bit cells. A partition merges what all blocks tell into one Misra-Gries summary, whose capacity exceeds its mass over
the threshold, and answers each block which of its cells may be frequent: no frequent n-gram is lost. Second pass: blocks
count the n-grams in those cells exactly, by their words. What is frequent then is cut, compared and ranked as tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from railwatch.llm import exchange as X
from railwatch.llm import text as T
from railwatch.llm.misra_gries import Summary
from railwatch.sources.tables import store

#: Documents without a language.
UNKNOWN = "und"
CELL_BITS = 24
#: Parts that a language's phrases are ranked in before their best are ranked together.
RANK_PARTS = 256

# What parts words within a piece, and what parts pieces.
WORD_SPACE, PIECE_MARKS = b"\x20\x09", b".,;:!?\x0a\x0b\x0c\x0d"
_PARTS_PIECES = np.zeros(256, bool)
_PARTS_PIECES[list(PIECE_MARKS)] = True
_PARTS_WORDS = _PARTS_PIECES.copy()
_PARTS_WORDS[list(WORD_SPACE)] = True


class _Grams:
    """The n-grams of a block within pieces: start, length and key of each, and the cells of each hash partition."""

    def __init__(self, docs: pa.Table, longest: int, slices: int):
        data, at = T.utf8(docs.column("text"))
        self.data = T.lower(data)
        self.first, self.after, self.row = T.tokens(self.data, at, _PARTS_WORDS)
        self.words = self._word_hashes()
        lang, lang_at = T.utf8(docs.column("lang"))
        self.lang = T.span_hashes(lang, lang_at[:-1], lang_at[1:], seed=1)
        self.breaks = np.zeros(len(self.first), np.int64)
        if len(self.first) > 1:
            # Marks before each word; no word holds one.
            marks = np.searchsorted(np.flatnonzero(_PARTS_PIECES[self.data]), self.first)
            np.cumsum((np.diff(marks) != 0) | (np.diff(self.row) != 0), out=self.breaks[1:])
        self.starts = [self._starts(n) for n in range(1, longest + 1)]
        self.mask, self.of = np.uint64((1 << CELL_BITS) - 1), np.uint64(slices)
        # Only the sorted cells are kept for all lengths at once; keys are made again when they are needed.
        ordered = np.empty(sum(map(len, self.starts)), np.uint64)
        end = 0
        for n, start in enumerate(self.starts, 1):
            ordered[end : end + len(start)] = self.cells(self.keys(n, start))
            end += len(start)
        ordered.sort()
        new = np.ones(len(ordered), bool)
        np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
        new = np.flatnonzero(new)
        self.distinct, total = ordered[new], len(ordered)
        del ordered
        self.times = np.diff(new, append=total)
        number = (self.distinct >> np.uint64(CELL_BITS)).astype(np.int32)
        found = np.flatnonzero(np.diff(number, prepend=-1))
        self.slices, self.slice_at = number[found], np.append(found, len(number))

    def cells(self, key: np.ndarray) -> np.ndarray:
        """Hash partition and cell in it."""
        part = (key >> np.uint64(32)) * self.of >> np.uint64(32)
        part <<= np.uint64(CELL_BITS)
        return part | key & self.mask

    def _word_hashes(self) -> np.ndarray:
        """Hashes of the words, some megabytes of text at a time."""
        out, start = [np.zeros(0, np.uint64)], 0
        while start < len(self.first):
            a = self.first[start]
            end = max(start + 1, int(np.searchsorted(self.after, a + T.CHUNK_BYTES, "right")))
            out.append(T.span_hashes(self.data[a : self.after[end - 1]], self.first[start:end] - a, self.after[start:end] - a))
            start = end
        return np.concatenate(out)

    def _starts(self, n: int) -> np.ndarray:
        """Words at which n words of one piece begin."""
        if len(self.first) < n:
            return np.zeros(0, np.int64)
        return np.flatnonzero(self.breaks[: len(self.breaks) - n + 1] == self.breaks[n - 1 :])

    def keys(self, n: int, start: np.ndarray) -> np.ndarray:
        runs = T.run_hashes(self.words, n)[start] if len(start) else np.zeros(0, np.uint64)
        return T.mix(runs + self.lang[self.row[start]] * np.uint64(2 * n + 1))

    def second(self, n: int, start: np.ndarray) -> np.ndarray:
        """A hash that has nothing to do with the key."""
        out = self.lang[self.row[start]] * np.uint64(0xD6E8FEB86659FD93)
        for k in range(n):
            out += self.words[start + k] * np.uint64(pow(0xC2B2AE3D27D4EB4F, k + 1, 1 << 64))
        return T.mix(out)

    def texts(self, n: int, start: np.ndarray) -> pa.Array:
        """The words of these n-grams, parted by single spaces."""
        words = (start[:, None] + np.arange(n)).ravel()
        first, after = self.first[words], self.after[words]
        size = after - first
        begin = np.cumsum(size + 1) - size - 1
        joined = np.full(int((size + 1).sum()), 0x20, np.uint8)
        joined[np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())] = T.gather(self.data, first, after)[0]
        ends = np.append(begin[::n], len(joined))
        # The space behind the last word goes.
        return T.binary_array(*T.gather(joined, ends[:-1], ends[1:] - 1), pa.string())


def _tell(docs: pa.Table, told: dict, threshold: int, longest: int, slices: int) -> Iterator[pa.RecordBatch]:
    """The summary of a block for each hash partition. It evicts nothing, so its error is none."""
    g = _Grams(docs, longest, slices)
    cells = (g.distinct & g.mask).astype(np.int32)
    # A block that has a cell often enough settles it; more makes no difference.
    times = np.minimum(g.times, min(threshold, 255)).astype(np.uint8)
    cuts = list(zip(g.slice_at[:-1].tolist(), g.slice_at[1:].tolist(), strict=True))
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([docs.column("block")[0].as_py()] * len(cuts), pa.int32()),
            pa.array(g.slices, pa.int32()),
            pa.array([X.planes(np.diff(cells[a:b], prepend=np.int32(0)).view(np.uint32)) for a, b in cuts], pa.binary()),
            pa.array([times[a:b].tobytes() for a, b in cuts], pa.binary()),
        ],
        ["block", "slice", "steps", "times"],
    )


def _merge(rows: pa.Table, threshold: int) -> Iterator[pa.RecordBatch]:
    """Merges the summaries that reach a hash partition and answers which cells may be frequent."""
    steps = [X.unplanes(s, np.uint32) for s in rows.column("steps").to_pylist()]
    times = [np.frombuffer(t, np.uint8) for t in rows.column("times").to_pylist()]
    enough = min(threshold, 255)
    mass = sum(int(t.sum(dtype=np.int64)) for t in times)
    merged = Summary(capacity=mass // enough)
    for step, t in zip(steps, times, strict=True):
        merged.add(np.cumsum(step, dtype=np.int64).astype(np.uint32), t)
    frequent = merged.may_reach(enough)
    out = []
    for step in steps:
        cells = np.cumsum(step, dtype=np.int64).astype(np.uint32)
        place = np.searchsorted(frequent, cells)
        bits = np.zeros(len(cells), bool)
        inside = place < len(frequent)
        bits[inside] = frequent[place[inside]] == cells[inside]
        out.append(np.packbits(bits).tobytes())
    yield X.answer_batch(rows, out)


def _count(docs: pa.Table, told: dict, longest: int, slices: int) -> Iterator[pa.RecordBatch]:
    """Exact counts of the block's n-grams that may be frequent, and of its words by language (as size 0)."""
    g = _Grams(docs, longest, slices)
    langs = docs.column("lang").combine_chunks()
    words = pa.table({"lang": langs, "f": pa.array(np.bincount(g.row, minlength=docs.num_rows))}).group_by("lang").aggregate([("f", "sum")])
    yield _rows(words.column("lang").combine_chunks(), pa.array([""] * words.num_rows), 0, words.column("f_sum").combine_chunks())
    frequent = g.distinct[X.join_bits(told.get("frequent", {}), g.slices, g.slice_at)] if len(g.distinct) else g.distinct
    maybe = np.zeros(1 << CELL_BITS, bool)
    maybe[(frequent & g.mask).astype(np.int64)] = True
    for n, start in enumerate(g.starts, 1):
        key = g.keys(n, start)
        cell = g.cells(key)
        some = np.flatnonzero(maybe[(cell & g.mask).astype(np.int64)])
        place = np.searchsorted(frequent, cell[some])
        some = some[(place < len(frequent)) & (frequent[np.minimum(place, max(len(frequent) - 1, 0))] == cell[some])] if len(some) else some
        if not len(some):
            continue
        start, key = start[some], key[some]
        second = g.second(n, start)
        order = np.lexsort((second, key))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(key[order]) != 0) | (np.diff(second[order]) != 0)
        new = np.flatnonzero(new)
        lead = start[order[new]]
        times = np.diff(np.append(new, len(order)))
        for a in range(0, len(lead), 20_000):
            some = lead[a : a + 20_000]
            yield _rows(langs.take(pa.array(g.row[some])), g.texts(n, some), n, pa.array(times[a : a + 20_000]))


def _rows(lang: pa.Array, phrase: pa.Array, size: int, f: pa.Array) -> pa.RecordBatch:
    sizes = pa.array(np.full(len(phrase), size, np.int32))
    return pa.RecordBatch.from_arrays([lang, phrase, sizes, f.cast(pa.int64())], ["lang", "phrase", "size", "f"])


def ngram_counts(docs: DataFrame, threshold: int, longest: int, block_bytes: int = X.BLOCK_BYTES) -> DataFrame:
    """lang, phrase, size and f of each n-gram of up to ``longest`` words with f >= ``threshold``, and all words of a
    language as the row of size 0."""
    n = X.number_of_blocks(docs, block_bytes)
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(F.col("lang"), F.lit(UNKNOWN)).alias("lang"))
    blocked = known.withColumn("block", F.pmod(F.xxhash64("doc_id", "text", "lang"), F.lit(n)).cast("int"))
    ask = {"longest": longest, "slices": n}
    told = X.in_blocks(
        blocked, n, partial(_tell, threshold=threshold, **ask), "block int, slice int, steps binary, times binary", extra=("lang",)
    )
    frequent = store(X.in_slices(told, n, partial(_merge, threshold=threshold)), "frequent")
    counts = X.in_blocks(
        blocked, n, partial(_count, **ask), "lang string, phrase string, size int, f long", extra=("lang",), frequent=frequent
    )
    exact = counts.groupBy("lang", "phrase", "size").agg(F.sum("f").alias("f"))
    return exact.filter((F.col("f") >= threshold) | (F.col("size") == 0))


def _joined(words, first, count):
    return F.array_join(F.slice(words, first, count), " ")


def _cuts(grams: DataFrame) -> DataFrame:
    """lang, phrase, a and the cut of least score: score, k, l, r."""
    words = F.split("phrase", " ")
    cuts = grams.filter("size > 1").select(
        "lang", "phrase", F.col("f").alias("a"), words.alias("words"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    )
    parts = cuts.select(
        "lang", "phrase", "a", "k", _joined(F.col("words"), 1, F.col("k")).alias("left"), _joined(F.col("words"), F.col("k") + 1, F.size("words")).alias("right")
    )
    known = grams.filter("size > 0")
    left = known.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = known.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    # The product needs more than 64 bits; decimal division gives whole numbers.
    score = F.expr("(CAST(2000000 AS DECIMAL(7, 0)) * CAST(a AS DECIMAL(19, 0))) div (CAST(l AS DECIMAL(19, 0)) + CAST(r AS DECIMAL(19, 0)))")
    scored = parts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).withColumn("score", score)
    least = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    return scored.groupBy("lang", "phrase", "a").agg(least).select("lang", "phrase", "a", "cut.*")


def _covered(grams: DataFrame, percent: int) -> DataFrame:
    """lang, phrase and the count of the most frequent longer phrase that holds it."""
    whole = grams.filter("size > 2").select("lang", "f", "size", F.split("phrase", " ").alias("words"))
    sizes = whole.withColumn("n", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
    places = sizes.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("n") + 1)))
    inside = places.select("lang", _joined(F.col("words"), F.col("at"), F.col("n")).alias("phrase"), "f")
    return inside.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))


def collocations(
    docs: DataFrame,
    *,
    least: int = 30,
    longest: int = 4,
    covered_percent: int = 80,
    top: int = 2000,
    block_bytes: int = X.BLOCK_BYTES,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score: the best ``top`` phrases of each language.

    Words and phrases are counted in all whole texts, A-Z lower-cased, within pieces. A phrase of 2 to ``longest`` words is
    a candidate if it occurs ``least`` times (a). Cutting it in two gives parts that occur l and r times and the score
    floor(2000000 a / (l + r)); the lowest cut counts, of equal ones the first. A candidate goes if a longer candidate
    holds it and occurs ``covered_percent`` of a hundred times as often or more. n counts the language's words.

    A null text has no words, a null lang is ``und``. Ties of score go by a, then by the bytes of the phrase. Repeated
    rows count as often as they stand there; ids only deal rows into blocks, so missing ones change nothing. Other columns
    are ignored, an empty table gives no rows. A very long text is a block by itself and needs memory in proportion.
    """
    grams = store(ngram_counts(docs, least, longest, block_bytes), "ngrams")
    covered = _covered(grams, covered_percent)
    free = _cuts(grams).join(covered, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * covered_percent)
    )
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # The best of each part, then the best of those, so that no task ranks a whole language.
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    in_part = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
    best = free.withColumn("part", part).withColumn("place", in_part).filter(F.col("place") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    ranked = best.withColumn("rank", rank).filter(F.col("rank") <= top)
    words = grams.filter("size = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
