"""Exact duplicates by a tree of merged digest runs.

Each input partition is a run: its rows' digests, sorted, one row per digest. In every round a node of the tree takes
the runs of ``fan_in`` nodes of the round before and merges them, keeping for each digest the row that stays and the
number of rows. So that the root is not one task, a node's run is cut into ranges of digests, the more the fewer nodes
are left: each round has about as many tasks, each of about as many rows. Copies meet early and travel on as one row,
so a text that a third of all rows share reaches the last round in ``fan_in`` rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railwatch.llm import text as T
from railwatch.sources.tables import store

_RUNS = "digest binary, n_bytes long, keep_points long, keep_id long, keep_row long, group_size long"


def _digests(batches: Iterator[pa.RecordBatch], id_column: str) -> Iterator[pa.RecordBatch]:
    spaces = np.zeros(256, bool)
    spaces[list(T.WHITE_SPACE)] = True
    for whole in batches:
        for batch in T.pieces(whole):
            data, at = T.utf8(batch.column("text"))
            keep = ~spaces[data]
            before = np.concatenate([[0], np.cumsum(keep)])[at]
            normal, points = data[keep].tobytes(), T.group_sums((data & 0xC0) != 0x80, at)
            digest = [hashlib.sha256(normal[a:b]).digest() for a, b in zip(before[:-1], before[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(id_column),
                    batch.column("row"),
                    pa.array(digest, pa.binary()),
                    pa.array(np.diff(before)),
                    pa.array(points),
                ],
                ["doc_id", "row", "digest", "n_bytes", "n_points"],
            )


def digests(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``row`` (its place in the table), SHA-256 of the text without white space, its
    bytes, and the code points of the original text. The upper bits of ``row`` are the partition, so the run."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.monotonically_increasing_id().alias("row"))
    schema = "doc_id long, row long, digest binary, n_bytes long, n_points long"
    return rows.mapInArrow(partial(_digests, id_column="doc_id"), schema)


def merge_runs(runs: pa.Table) -> pa.Table:
    """Several sorted runs as one: per digest the row that stays (most code points, then smallest id, then place) and
    the rows counted so far. Two texts are equal if digest and length agree. The stable sort finds the presorted runs
    and merges them."""
    n = runs.num_rows
    if not n:
        return runs
    digest = np.frombuffer(b"".join(runs.column("digest").to_pylist()), ">u8").reshape(n, 4)
    number = {c: runs.column(c).to_numpy() for c in ("n_bytes", "keep_points", "keep_row", "group_size")}
    ids = runs.column("keep_id")
    # A missing id comes after all others.
    missing = ids.is_null().to_numpy()
    ids = ids.fill_null(0).to_numpy()
    keys = (number["keep_row"], ids, missing, -number["keep_points"], number["n_bytes"], *digest.T[::-1])
    order = np.lexsort(keys)
    digest, length = digest[order], number["n_bytes"][order]
    new = np.ones(n, bool)
    new[1:] = (digest[1:] != digest[:-1]).any(axis=1) | (length[1:] != length[:-1])
    first = np.flatnonzero(new)
    sizes = np.add.reduceat(number["group_size"][order], first)
    out = runs.take(pa.array(order[first]))
    return out.set_column(out.schema.get_field_index("group_size"), "group_size", pa.array(sizes))


def merge_tree(rows: DataFrame, runs: int, tasks: int, fan_in: int = 8) -> DataFrame:
    """One row per distinct text from the rows of ``digests``: columns of ``_RUNS``."""
    level = rows.select(
        "digest",
        "n_bytes",
        F.col("n_points").alias("keep_points"),
        F.col("doc_id").alias("keep_id"),
        F.col("row").alias("keep_row"),
        F.lit(1).cast("long").alias("group_size"),
        F.shiftright("row", 33).alias("node"),
    )
    # First within each partition: the sorted run it starts with.
    level = level.mapInArrow(_merge_node, _RUNS + ", node long")
    nodes = runs
    while True:
        nodes = -(-nodes // fan_in)
        ranges = -(-tasks // nodes)
        node = F.floor(F.col("node") / fan_in)
        # The first four bytes of a digest, as a share of their range.
        lead = F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long")
        level = level.withColumns({"node": node, "range": F.floor(lead * ranges / F.lit(1 << 32))})
        merged = level.repartitionById(nodes * ranges, (F.col("node") * ranges + F.col("range")).cast("int"))
        level = merged.select("node", *[c.split()[0] for c in _RUNS.split(", ")]).mapInArrow(_merge_node, _RUNS + ", node long")
        if nodes == 1:
            return level.drop("node")


def _merge_node(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All batches of a task, node by node; a task of the tree has one node, a task of the scan one or a few."""
    names = [c.split()[0] for c in _RUNS.split(", ")] + ["node"]
    by_node: dict[int, list[pa.RecordBatch]] = {}
    for batch in batches:
        batch = batch.select(names)
        nodes = batch.column("node").to_numpy()
        for node in np.unique(nodes):
            by_node.setdefault(int(node), []).append(batch.filter(pa.array(nodes == node)))
    for node in sorted(by_node):
        out = merge_runs(pa.Table.from_batches(by_node.pop(node)).combine_chunks())
        yield from out.to_batches(max_chunksize=50_000)


def exact_duplicates(docs: DataFrame, rows_per_task: int = 100_000, fan_in: int = 8) -> DataFrame:
    """One row per row of ``docs`` (columns doc_id and text; others are ignored): doc_id, keep_id, group_size, kept,
    text_sha256, row.

    Equal texts are identical without white space; a null text is an empty one. Of equal texts the one with the most
    code points stays, then the smallest doc_id, then the first row, so repeated rows leave one; a missing doc_id comes
    last. An empty table gives no rows. The digests are written to the shared folder once, as several jobs read them.
    """
    spark = docs.sparkSession
    rows = store(digests(docs), "digests")
    count, last = rows.agg(F.count(F.lit(1)), F.max(F.shiftright("row", 33))).first()
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-count // rows_per_task))
    groups = merge_tree(rows, (last or 0) + 1, tasks, fan_in)
    # A plain join: Spark splits the digest of a very frequent text over several tasks.
    return rows.join(groups, ["digest", "n_bytes"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "row",
    )


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns; ``docs`` must be a stored table, as it is read again."""
    gone = exact_duplicates(docs).where("not kept").select(F.col("row").alias("__row"))
    places = docs.withColumn("__row", F.monotonically_increasing_id())
    return places.join(gone, "__row", "left_anti").select(*[f"`{c}`" for c in docs.columns])
