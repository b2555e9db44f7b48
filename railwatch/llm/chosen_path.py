"""N-gram Jaccard join by chosen paths.

A document is the set of its runs of five words; equal sets are one node. A node's sketch holds its smallest hash under
each of ``PLACES`` random orders, so two nodes agree in a place with the probability of their Jaccard similarity. In
each run nodes walk down a tree: a path chooses one place, sometimes two (1.25 on average, the inverse of the
similarity), and nodes go on with those that have the same hash there, so that similar nodes stay together on one path
on average. Buckets that are small enough are compared by brute force, larger ones are split further for some levels.
Runs are repeated until a pair at the threshold is met with the target recall.

The comparison of sketches only proposes: what it links is put together into components, and within a component all
pairs are verified on their exact sets. A bucket or component of any size is compared in cells of two chunks each, so
no task grows with it, and cells send on sums and trees of links, not pairs.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railwatch.llm import text as T
from railwatch.llm.components import components
from railwatch.sources.tables import store

WORDS = 5
PLACES = 64
SIMILARITY = 0.8
TARGET_RECALL = 0.9999
LEVELS = 4
SMALL = 4096
CHUNK = 128
SKETCH_CHUNK = 512
# Sketches of a pair at the threshold agree in fewer places than asked for about once in this many pairs.
SKETCH_MISSES = 10**10
_ORDERS = np.random.default_rng(11).integers(1, 1 << 63, PLACES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(data: np.ndarray, at: np.ndarray, words: int = WORDS) -> list[np.ndarray]:
    """The set of each document as sorted hashes of its runs of words; of all its words if it has fewer."""
    first, after, _ = T.tokens(data, at)
    h = T.span_hashes(data, first, after)
    run = T.run_hashes(h, words, 5)
    word_at = np.searchsorted(first, at)
    out = []
    for a, b in zip(word_at[:-1].tolist(), word_at[1:].tolist(), strict=True):
        if b - a >= words:
            out.append(np.unique(run[a : b - words + 1]))
        else:
            out.append(T.run_hashes(h[a:b], b - a, b - a) if b > a else h[:0])
    return out


def sketch(grams: np.ndarray) -> bytes:
    least = np.full(PLACES, np.iinfo(np.uint64).max)
    for start in range(0, len(grams), 4096):
        np.minimum(least, (grams[start : start + 4096, None] * _ORDERS).min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32).tobytes()


def _features(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in T.pieces(whole):
            sets = shingles(*T.utf8(batch.column("text")), words)
            one = [int(g.sum(dtype=np.uint64)) for g in sets]
            two = [int(T.mix(g + np.uint64(1)).sum(dtype=np.uint64)) for g in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("doc_id", "row", "text_hash")),
                    pa.array(np.array(one, np.uint64).view(np.int64)),
                    pa.array(np.array(two, np.uint64).view(np.int64)),
                    pa.array([len(g) for g in sets], pa.int64()),
                    pa.array([sketch(g) for g in sets], pa.binary()),
                ],
                ["doc_id", "row", "text_hash", "one", "two", "size", "sketch"],
            )


def runs_needed(similarity: float = SIMILARITY, levels: int = LEVELS, recall: float = TARGET_RECALL) -> int:
    """Runs after which a pair of this similarity has met with the given probability, if every bucket is split at
    every level."""
    extra, met = 1 / similarity - 1, 1.0
    for _ in range(levels):
        miss = 1 - similarity * met
        met = 1 - (1 - extra) * miss - extra * miss**2
    return math.ceil(math.log(1 - recall) / math.log(1 - met))


def sketch_agrees(similarity: float = SIMILARITY) -> int:
    """In how many places sketches of a pair at the similarity agree, but for one in ``SKETCH_MISSES`` pairs."""
    below = 0.0
    for k in range(PLACES):
        below += math.comb(PLACES, k) * similarity**k * (1 - similarity) ** (PLACES - k)
        if below > 1 / SKETCH_MISSES:
            return k
    return PLACES


def next_paths(path: np.ndarray, sketches: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Places in the arrays and child paths: the path alone chooses where it looks, the sketch where it leads."""
    rows, out = [], []
    second = T.mix(path ^ np.uint64(0xA5A5A5A5)) < np.uint64((1 / similarity - 1) * (1 << 64))
    for k, some in enumerate((np.arange(len(path)), np.flatnonzero(second))):
        look = T.mix(path[some] + np.uint64(17 + k))
        place = (look % np.uint64(PLACES)).astype(np.int64)
        rows.append(some)
        out.append(T.mix(look ^ T.mix(sketches[some, place].astype(np.uint64) + np.uint64(3))))
    return np.concatenate(rows), np.concatenate(out)


def _sketch_matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(T.utf8(column)[0].tobytes(), np.uint32).reshape(-1, PLACES)


def _roots(batches: Iterator[pa.RecordBatch], runs: int, similarity: float) -> Iterator[pa.RecordBatch]:
    starts = T.mix(np.arange(1, runs + 1, dtype=np.uint64))
    for batch in batches:
        sketches, node = _sketch_matrix(batch.column("sketch")), batch.column("node").to_numpy()
        row, path = next_paths(np.repeat(starts, len(node)), np.tile(sketches, (runs, 1)), similarity)
        yield pa.RecordBatch.from_arrays([pa.array(path.view(np.int64)), pa.array(np.tile(node, runs)[row])], ["path", "node"])


def _deeper(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        row, path = next_paths(batch.column("path").to_numpy().view(np.uint64), _sketch_matrix(batch.column("sketch")), similarity)
        yield pa.RecordBatch.from_arrays([pa.array(path.view(np.int64)), batch.column("node").take(pa.array(row))], ["path", "node"])


def in_cells(df: DataFrame, group: str, size: Column, work: Callable, schema: str, chunk: int = CHUNK) -> DataFrame:
    """``work(table, first, second)`` for each cell of each group: the rows of ``df`` in one chunk (second is None) or
    in two, each pair of rows of a group being in exactly one cell as such a pair. ``size`` is the group's size."""
    chunks = F.ceil(size / chunk).cast("int")
    own = F.pmod(F.xxhash64(group, "node"), chunks).cast("int")
    cells = df.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    cells = cells.withColumns({"side": (F.col("own") == high).cast("int"), "high": high, "low": low})
    cells = cells.withColumn("cell", F.xxhash64(group, "low", "high")).drop("other")
    columns = cells.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def whole(table: pa.Table) -> Iterator[pa.RecordBatch]:
            cell = table.column("cell").to_numpy()
            cuts = [*np.flatnonzero(np.diff(cell, prepend=cell[0] - 1)).tolist(), len(cell)]
            low, high, side = (table.column(c).to_numpy() for c in ("low", "high", "side"))
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if b - a > 1:
                    yield from work(table.slice(a, b - a), None if low[a] == high[a] else side[a:b].astype(bool))

        for batch in batches:
            if not batch.num_rows:
                continue
            cell = batch.column(columns.index("cell")).to_numpy()
            # The last cell of a batch may go on in the next.
            end = int(np.searchsorted(cell, cell[-1])) if cell[0] != cell[-1] else 0
            if end:
                yield from whole(pa.Table.from_batches([*held, batch.slice(0, end)]).combine_chunks())
                held = []
            elif held and held[-1].column(columns.index("cell"))[-1].as_py() != cell[0]:
                yield from whole(pa.Table.from_batches(held).combine_chunks())
                held = []
            held.append(batch.slice(end))
        if held:
            yield from whole(pa.Table.from_batches(held).combine_chunks())

    return cells.repartition("cell").sortWithinPartitions("cell", "node").mapInArrow(run, schema)


def _tree(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of each row to the first row of its part of the (symmetric) graph, for rows that have any."""
    n = len(linked)
    label = np.arange(n)
    while True:
        new = np.minimum(label, np.where(linked, label[None, :], n).min(axis=1))
        new = new[new]
        if (new == label).all():
            break
        label = new
    some = np.flatnonzero(label != np.arange(n))
    return some, label[some]


def _compare_sketches(cell: pa.Table, side: np.ndarray | None, agrees: int) -> Iterator[pa.RecordBatch]:
    s = _sketch_matrix(cell.column("sketch").combine_chunks())
    linked = np.stack([(s == row).sum(axis=1) >= agrees for row in s])
    np.fill_diagonal(linked, False)
    if side is not None:
        linked &= side[:, None] != side[None, :]
    a, b = _tree(linked)
    if len(a):
        node = cell.column("node").to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array(node[a]), pa.array(node[b])], ["a", "b"])


def intersections(sets: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of all pairwise intersections of sets of hashes."""
    n = len(sets)
    row = np.repeat(np.arange(n), [len(s) for s in sets])
    term, number, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    # Only hashes that several sets have.
    shared = count > 1
    place = np.cumsum(shared) - 1
    some = shared[number]
    row, number = row[some], place[number[some]]
    order = np.argsort(number, kind="stable")
    row, number = row[order], number[order]
    out = np.zeros((n, n), np.float32)
    for start in range(0, int(shared.sum()), columns):
        a, b = np.searchsorted(number, [start, start + columns])
        has = np.zeros((n, min(columns, int(shared.sum()) - start)), np.float32)
        has[row[a:b], number[a:b] - start] = 1
        out += has @ has.T
    return out


def _verify(cell: pa.Table, side: np.ndarray | None, similarity: float, words: int) -> Iterator[pa.RecordBatch]:
    node, copies = cell.column("node").to_numpy(), cell.column("copies").to_numpy()
    # A row that stands in the table several times has come several times.
    first = np.flatnonzero(np.diff(node, prepend=node[0] - 1))
    node, copies = node[first], copies[first]
    sets = shingles(*T.utf8(cell.column("text").take(pa.array(first))), words)
    size = np.array([len(s) for s in sets], np.float64)
    common = intersections(sets).astype(np.float64)
    linked = common >= similarity * (size[:, None] + size[None, :] - common) - 1e-9
    linked &= common > 0
    np.fill_diagonal(linked, False)
    if side is not None:
        linked &= side[first][:, None] != side[first][None, :]
    number = linked @ copies
    a, b = _tree(linked)
    link = np.arange(len(node))
    link[a] = b
    some = number > 0
    if some.any():
        yield pa.RecordBatch.from_arrays([pa.array(node[some]), pa.array(node[link][some]), pa.array(number[some])], ["a", "b", "links"])


def similar_documents(docs: DataFrame, similarity: float = SIMILARITY, words: int = WORDS, recall: float = TARGET_RECALL) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; others are ignored): doc_id, class_id (the smallest doc_id among the
    documents it is linked to over any number of links, its own if none), n_links (rows of other documents at the
    similarity or above, copies each counted), group_id (smallest doc_id with an equal set), row (its place in the table),
    class_row (the place of the class's first document).

    The set of a document is its runs of ``words`` words, all its words together if it has fewer; a text without words
    (empty or null) has no links, not even to another one. A missing doc_id comes after all others; repeated rows count
    as copies. An empty table gives no rows. The similarity is over a half, as a path chooses at most two places, and
    under 1.
    """
    if not 0.5 < similarity < 1:
        raise ValueError("a similarity over 0.5 and under 1")
    # Written once: ids of rows, sets and sketches are then the same for all jobs.
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.monotonically_increasing_id().alias("row"), F.xxhash64("text").alias("text_hash"))
    schema = "doc_id long, row long, text_hash long, one long, two long, size long, sketch binary"
    rows = store(rows.mapInArrow(partial(_features, words=words), schema), "sets")
    # A text without words is a set of its own.
    own = F.when(F.col("size") == 0, F.col("row"))
    keyed = rows.withColumn("own", F.coalesce(own, F.lit(-1)))
    key = ["one", "two", "size", "own"]

    def first_of(doc: str, row: str) -> Column:
        return F.struct(F.isnull(doc).alias("missing"), F.col(doc).alias("doc_id"), F.col(row).alias("row"))

    nodes = keyed.groupBy(*key).agg(F.min("row").alias("node"), F.count(F.lit(1)).alias("copies"), F.min(first_of("doc_id", "row")).alias("lead"))
    nodes = store(nodes, "nodes")
    known = nodes.where("size > 0").join(rows.select(F.col("row").alias("node"), "doc_id", "text_hash", "sketch"), "node")
    known = store(known.select("node", "copies", "doc_id", "text_hash", "sketch"), "known")
    # Nodes with the same whole sketch would stay together on every path: one goes, the others are linked to it.
    leads = store(known.groupBy("sketch").agg(F.min("node").alias("node")), "leads")
    same = known.join(leads.select("sketch", F.col("node").alias("b")), "sketch").where("node <> b")
    proposed = same.select(F.col("node").alias("a"), "b")

    buckets = leads.mapInArrow(partial(_roots, runs=runs_needed(similarity, recall=recall), similarity=similarity), "path long, node long")
    for level in range(LEVELS):
        buckets = store(buckets, "paths")
        sizes = store(buckets.groupBy("path").agg(F.count(F.lit(1)).alias("members")).where("members > 1"), "sizes")
        last = level == LEVELS - 1 or sizes.where(F.col("members") > SMALL).isEmpty()
        ready = sizes if last else sizes.where(F.col("members") <= SMALL)
        members = buckets.join(ready, "path").join(leads, "node")
        found = in_cells(members, "path", F.col("members"), partial(_compare_sketches, agrees=sketch_agrees(similarity)), "a long, b long", SKETCH_CHUNK)
        proposed = proposed.unionAll(store(found, "proposed"))
        if last:
            break
        large = buckets.join(sizes.where(F.col("members") > SMALL).select("path"), "path").join(leads, "node")
        buckets = large.select("path", "node", "sketch").mapInArrow(partial(_deeper, similarity=similarity), "path long, node long")

    part = components(proposed)
    part_size = part.groupBy("component").agg(F.count(F.lit(1)).alias("members"))
    missing = F.lit(-(1 << 63))
    asked = part.join(part_size, "component").join(known.drop("sketch"), "node")
    asked = asked.select("node", "component", "members", "copies", F.coalesce("doc_id", missing).alias("id"), "text_hash")
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), missing).alias("id"), F.xxhash64("text").alias("text_hash"), "text")
    texts = asked.join(texts, ["id", "text_hash"]).select("node", "component", "members", "copies", "text")
    verified = in_cells(texts, "component", F.col("members"), partial(_verify, similarity=similarity, words=words), "a long, b long, links long")
    verified = store(verified, "verified")
    links = verified.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    classes = components(verified.select("a", "b"))

    of_node = nodes.join(links, "node", "left").join(classes, "node", "left")
    of_node = of_node.withColumn("component", F.coalesce("component", "node"))
    least = of_node.groupBy("component").agg(F.min("lead").alias("first"))
    of_node = of_node.join(least, "component").select(
        *key,
        F.col("first.doc_id").alias("class_id"),
        F.col("first.row").alias("class_row"),
        F.col("lead.doc_id").alias("group_id"),
        "copies",
        F.coalesce("links", F.lit(0)).alias("links"),
    )
    out = keyed.join(of_node, key)
    linked = F.when(F.col("size") > 0, F.col("links") + F.col("copies") - 1).otherwise(0)
    return out.select("doc_id", "class_id", linked.cast("long").alias("n_links"), "group_id", "row", "class_row")


def keep_one_per_class(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The first document of each class (by doc_id, then place), with all columns; ``docs`` must be a stored table, as
    it is read again."""
    found = similar_documents(docs, similarity).where(F.col("row") != F.col("class_row")).select(F.col("row").alias("__row"))
    places = docs.withColumn("__row", F.monotonically_increasing_id())
    return places.join(found, "__row", "left_anti").select(*[f"`{c}`" for c in docs.columns])
