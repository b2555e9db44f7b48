"""Benchmark decontamination: BM25 over an inverted index of test items, searched by block-max WAND.

The items are the indexed texts, each passage of a document is a query. Passages are windows of words, half overlapping
and twice as long as the longest item, so any occurrence of an item lies whole in one of them. A score is BM25 as a share
of the item's score against itself, so one threshold fits items of any length. Postings are cut into blocks of items with
the largest weight in each. A first step bounds all passages of a batch at once, block by block: the largest weights of the
passage's rarer words, and all that frequent words could add. Few passages have a block that can reach the threshold;
they go through WAND, which skips blocks by the largest weights of all words and returns every item at or above it. Hits are verified: shares of the word n-grams of the item's question (all sentences but the
last) and of its answer (the last one, or the last third of a single sentence) that stand in the passage.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railwatch.llm import text as T
from railwatch.llm.shared import share
from railwatch.sources.tables import store

K1, B = 1.2, 0.75
GRAM = 3
LEAST_PASSAGE = 64
_FOLD = T.lower(np.arange(256, dtype=np.uint8))
_FOLD[[b for b in range(128) if not chr(b).isalnum()]] = 0x20
_SENTENCE_END = re.compile(r"(?<=[.?!])\s+")


def fold(data: np.ndarray) -> np.ndarray:
    """Lower case for ASCII and two-byte Latin letters, other ASCII signs as spaces; one byte stays one byte."""
    out = _FOLD[data]
    if len(data) > 1:
        upper = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        out[1:][upper] += 0x20
    return out


def words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the folded words of all texts, and offsets of texts in them."""
    data = fold(data)
    first, after, _ = T.tokens(data, at)
    return T.span_hashes(data, first, after), np.searchsorted(first, at)


def _text_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return words(*T.utf8(pa.array(texts, pa.string())))


def question_and_answer(text: str) -> tuple[str, str]:
    parts = _SENTENCE_END.split(text.strip())
    if len(parts) > 1:
        return text.strip()[: -len(parts[-1])], parts[-1]
    single = text.split()
    cut = len(single) - max(1, len(single) // 3)
    return " ".join(single[:cut]), " ".join(single[cut:])


def grams(hashes: np.ndarray) -> np.ndarray:
    """Distinct hashes of the n-grams of one text; of all its words together if it has fewer than n."""
    n = min(GRAM, len(hashes))
    return np.unique(T.run_hashes(hashes, n, n)) if n else hashes


def _distinct_pairs(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The distinct words of each text, text by text."""
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    order = np.lexsort((h, text))
    text, h = text[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (text[1:] != text[:-1]) | (h[1:] != h[:-1])
    return h[new]


def _statistics(h: np.ndarray, at: np.ndarray) -> Statistics:
    length = np.diff(at)
    terms, frequency = np.unique(_distinct_pairs(h, at), return_counts=True)
    return Statistics(len(length), float(length.mean()) if len(length) else 0.0, int(length.max(initial=0)), terms, frequency)


class Statistics(NamedTuple):
    """What the weights of an item depend on beside itself: all items, whichever index they are in."""

    items: int
    mean_words: float
    most_words: int
    #: Words, in order, and the items each stands in.
    terms: np.ndarray
    frequency: np.ndarray


class Index:
    """Items by word, with weights, blocks of items and their largest weights. Without ``stats`` they are all items."""

    def __init__(
        self, ids: list[int | None], texts: list[str], stats: Statistics | None = None, block: int = 4, frequent: float = 0.1
    ):
        # Items without an id come last.
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
        texts = [texts[i] or "" for i in order]
        h, at = _text_words(texts)
        good = np.flatnonzero(np.diff(at))
        self.ids = [ids[order[i]] for i in good]
        texts = [texts[i] for i in good]
        h, at = _text_words(texts)
        n, length = len(texts), np.diff(at)
        if stats is None:
            stats = _statistics(h, at)
        self.stride = int(max(LEAST_PASSAGE, stats.most_words))
        self.block = block
        self.terms, term = np.unique(h, return_inverse=True)
        pair, count = np.unique(np.stack([term, np.repeat(np.arange(n), length)]), axis=1, return_counts=True)
        term, item = pair
        frequency = stats.frequency[np.searchsorted(stats.terms, self.terms)]
        idf = np.log(1 + (stats.items - frequency + 0.5) / (frequency + 0.5))
        norm = K1 * (1 - B + B * length[item] / max(stats.mean_words, 1)) if n else np.zeros(0)
        weight = idf[term] * count * (K1 + 1) / (count + norm)
        weight /= np.bincount(item, weight, n)[item]
        self.at = np.searchsorted(term, np.arange(len(self.terms) + 1))
        self.item, self.weight = item, weight
        self.most = np.maximum.reduceat(weight, self.at[:-1]) if n else np.zeros(0)
        # Blocks of the item axis: largest weight per word and block.
        blocks, where = np.unique(np.stack([term, item // block]), axis=1, return_inverse=True)
        self.block_most = np.zeros(blocks.shape[1])
        np.maximum.at(self.block_most, where.ravel(), weight)
        self.block_number = blocks[1]
        self.block_at = np.searchsorted(blocks[0], np.arange(len(self.terms) + 1))
        self.lists = [x.tolist() for x in (item, weight, self.block_number, self.block_most)]
        # Frequent words stand in more than this share of items; what they can add to an item is known beforehand.
        self.rare = frequency <= max(1, frequent * stats.items)
        self.blocks = -(-n // block)
        added = np.bincount(item, np.where(self.rare[term], 0, weight), n)
        self.frequent_most = np.zeros(self.blocks)
        np.maximum.at(self.frequent_most, np.arange(n) // block, added)
        halves = [question_and_answer(t) for t in texts]
        self.question = [grams(_text_words([q])[0]) for q, _ in halves]
        self.answer = [grams(_text_words([a])[0]) for _, a in halves]

    def find_terms(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of words, -1 for words of no item."""
        if not len(self.terms):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        return np.where(self.terms[at] == hashes, at, -1)

    def search(self, terms: list[int], threshold: float) -> list[tuple[int, float]]:
        """Block-max WAND: every item whose weights over these (distinct) words sum to the threshold."""
        # One cursor per word: next item, largest weight, place and end of its postings, place and end of its blocks.
        items, weights, numbers, block_most = self.lists
        cursors = []
        for t in terms:
            a, b = int(self.at[t]), int(self.at[t + 1])
            cursors.append([items[a], float(self.most[t]), a, b, int(self.block_at[t]), int(self.block_at[t + 1])])
        found, slack = [], 1e-9

        def advance(c: list, target: int) -> None:
            c[2] = bisect_left(items, target, c[2], c[3])
            c[0] = items[c[2]] if c[2] < c[3] else -1

        while True:
            cursors = sorted((c for c in cursors if c[0] >= 0), key=lambda c: c[0])
            bound, pivot = 0.0, -1
            for k, c in enumerate(cursors):
                bound += c[1]
                if bound >= threshold - slack:
                    pivot = k
                    break
            if pivot < 0:
                return found
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            block, bound = item // self.block, 0.0
            for c in cursors[: pivot + 1]:
                c[4] = i = bisect_left(numbers, block, c[4], c[5])
                if i < c[5] and numbers[i] == block:
                    bound += block_most[i]
            if bound < threshold - slack:
                # Nothing in this block: on to the next one, or to the next cursor's item if that comes first.
                target = (block + 1) * self.block
                if pivot + 1 < len(cursors):
                    target = min(target, cursors[pivot + 1][0])
                for c in cursors[: pivot + 1]:
                    advance(c, max(target, item + 1))
                continue
            if cursors[0][0] == item:
                score = sum(weights[c[2]] for c in cursors[: pivot + 1])
                if score >= threshold - slack:
                    found.append((item, score))
                for c in cursors[: pivot + 1]:
                    advance(c, item + 1)
            else:
                for c in cursors[:pivot]:
                    advance(c, item)


def possible(index: Index, term: np.ndarray, word_at: np.ndarray, count: np.ndarray, threshold: float) -> np.ndarray:
    """Passages with a block that could reach the threshold; ``count`` passages per document, numbered through."""
    first = np.cumsum(count) - count
    place = np.flatnonzero((term >= 0) & index.rare[term])
    doc = np.searchsorted(word_at, place, "right") - 1
    # A word lies in the passage that starts in its stride, and in the one before.
    last = (place - word_at[doc]) // index.stride
    passage = np.concatenate([first[doc] + np.minimum(last, count[doc] - 1), (first[doc] + last - 1)[(last > 0) & (last < count[doc])]])
    words_of = np.concatenate([term[place], term[place][(last > 0) & (last < count[doc])]])
    key = np.unique(passage * len(index.terms) + words_of)
    passage, words_of = np.divmod(key, len(index.terms))
    found = [np.zeros(0, np.int64)]
    total = int(count.sum())
    step = max(1, (1 << 21) // index.blocks)
    for start in range(0, total, step):
        a, b = np.searchsorted(passage, [start, start + step])
        size = index.block_at[words_of[a:b] + 1] - index.block_at[words_of[a:b]]
        at = np.cumsum(size) - size
        posting = np.repeat(index.block_at[words_of[a:b]] - at, size) + np.arange(size.sum())
        cell = np.repeat(passage[a:b] - start, size) * index.blocks + index.block_number[posting]
        n = min(step, total - start)
        bound = np.bincount(cell, index.block_most[posting], n * index.blocks).reshape(n, index.blocks)
        found.append(start + np.flatnonzero((bound + index.frequent_most >= threshold - 1e-6).any(axis=1)))
    return np.concatenate(found)


def search_texts(index: Index, data: np.ndarray, at: np.ndarray, threshold: float, overlap: float) -> list[tuple]:
    """Rows (document, item id, score, question share, answer share) of verified hits, the best passage of each pair."""
    if not index.ids:
        return []
    h, word_at = words(data, at)
    term = index.find_terms(h)
    # Passages start at every stride; a document always has one, at its start.
    count = np.maximum(-(-np.diff(word_at) // index.stride) - 1, 1)
    first = np.cumsum(count) - count
    best: dict[tuple[int, int], tuple] = {}
    for w in possible(index, term, word_at, count, threshold).tolist():
        doc = int(np.searchsorted(first, w, "right")) - 1
        start = int(word_at[doc] + (w - first[doc]) * index.stride)
        end = min(start + 2 * index.stride, int(word_at[doc + 1]))
        some = np.unique(term[start:end])
        here: dict[int, np.ndarray] = {}
        for item, score in index.search(some[some >= 0].tolist(), threshold):
            shares = [_share(part, h[start:end], here) for part in (index.question[item], index.answer[item])]
            key, row = (doc, item), (doc, index.ids[item], score, *shares)
            if min(shares) >= overlap and (key not in best or row[2:] > best[key][2:]):
                best[key] = row
    return [best[k] for k in sorted(best)]


def _share(part: np.ndarray, passage: np.ndarray, here: dict[int, np.ndarray]) -> float:
    """The share of n-grams of an item's part that the passage has."""
    if not len(part):
        return 1.0
    found = 0.0
    # A part of a single n-gram may have fewer than n words.
    for size in (GRAM,) if len(part) > 1 else range(1, GRAM + 1):
        if size not in here:
            here[size] = np.unique(T.run_hashes(passage, size, size))
        found = max(found, float(np.isin(part, here[size]).mean()))
    return found


def _search_batches(batches: Iterator[pa.RecordBatch], shared, threshold: float, overlap: float) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in T.pieces(whole):
            rows = search_texts(shared.value, *T.utf8(batch.column("text")), threshold, overlap)
            doc, item, score, question, answer = zip(*rows, strict=True) if rows else ([], [], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(doc, pa.int64())),
                    pa.array(item, pa.int64()),
                    pa.array(score, pa.float64()),
                    pa.array(question, pa.float64()),
                    pa.array(answer, pa.float64()),
                ],
                ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"],
            )


def _term_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per distinct word of each text, and one per text with words that has their number instead."""
    for batch in batches:
        h, at = words(*T.utf8(batch.column("text")))
        term, length = _distinct_pairs(h, at).view(np.int64), np.diff(at)
        length = length[length > 0]
        yield pa.RecordBatch.from_arrays([pa.array(term), pa.nulls(len(term), pa.int64())], ["term", "words"])
        yield pa.RecordBatch.from_arrays([pa.nulls(len(length), pa.int64()), pa.array(length)], ["term", "words"])


def _indexes(items: DataFrame, index_bytes: int) -> Iterator[Index]:
    items = items.where(F.length(F.trim("text")) > 0).select(F.col("item_id").cast("long").alias("item_id"), "text")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = -(-total // index_bytes) or 1
    if shards == 1:
        found = items.collect()
        yield Index([r.item_id for r in found], [r.text for r in found])
        return
    # Weights come from all items, so that hits do not depend on the number of indexes.
    rows = items.select("text").mapInArrow(_term_rows, "term long, words long")
    known = store(rows.where("term IS NOT NULL").groupBy("term").agg(F.count(F.lit(1)).alias("n")), "terms")
    count, all_words, most = rows.agg(F.count("words"), F.sum("words"), F.max("words")).first()
    for shard in range(shards):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)) == shard)
        of_part = part.select("text").mapInArrow(_term_rows, "term long, words long").where("term IS NOT NULL").select("term")
        # As many words as an index of this size has.
        got = known.join(of_part.distinct(), "term", "left_semi").toArrow()
        terms = got.column("term").to_numpy().view(np.uint64)
        order = np.argsort(terms)
        stats = Statistics(count, all_words / max(count, 1), most or 0, terms[order], got.column("n").to_numpy()[order])
        found = part.collect()
        yield Index([r.item_id for r in found], [r.text for r in found], stats)


def contaminated(
    docs: DataFrame, items: DataFrame, threshold: float = 0.7, overlap: float = 0.5, index_bytes: int = 32 << 20
) -> DataFrame:
    """Pairs of a document and a test item it holds: doc_id, item_id, score, question_overlap, answer_overlap.

    Every passage of every document is searched. The index is sent to all executors, so it is built over about
    ``index_bytes`` of items; more items make more indexes, each searched by all passages, with the weights of one. Each
    item is reported by itself, also those that share an id or have none. Null and empty texts on either side match nothing, an empty table gives no rows; items with the same text are each reported; other columns are
    ignored. A document that is there twice is reported twice.
    """
    work = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = None
    for index in _indexes(items, index_bytes):
        shared = share(docs.sparkSession, index)
        hits = work.mapInArrow(
            partial(_search_batches, shared=shared, threshold=threshold, overlap=overlap),
            "doc_id long, item_id long, score double, question_overlap double, answer_overlap double",
        )
        found = hits if found is None else found.unionAll(hits)
    return found


def _clean_batches(batches: Iterator[pa.RecordBatch], shared, threshold: float, overlap: float) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in T.pieces(whole):
            clean = np.ones(batch.num_rows, bool)
            clean[[row[0] for row in search_texts(shared.value, *T.utf8(batch.column("text")), threshold, overlap)]] = False
            yield batch.filter(pa.array(clean))


def drop_contaminated(
    docs: DataFrame, items: DataFrame, threshold: float = 0.7, overlap: float = 0.5, index_bytes: int = 32 << 20
) -> DataFrame:
    """The rows of ``docs`` that hold no test item, with all their columns."""
    for index in _indexes(items, index_bytes):
        shared = share(docs.sparkSession, index)
        docs = docs.mapInArrow(partial(_clean_batches, shared=shared, threshold=threshold, overlap=overlap), docs.schema)
    return docs
