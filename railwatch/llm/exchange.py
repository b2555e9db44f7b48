"""Questions from blocks of documents to slices of a key space, and answers back.

Documents are dealt into blocks by a hash of id and text, or as they come and stored. A block asks each slice about its distinct keys in one row of
packed arrays; the slice puts together what all blocks sent and answers each row with an array in the order of its keys.
A block can then be read again, with its answers beside it. A key that stands in a third of all documents reaches its
slice once per block, so no task grows with the number of its copies; blocks and slices stay the same size as data grow.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from railwatch.llm import text as T
from railwatch.sources.tables import scratch_path

BLOCK_BYTES = 8 << 20
ANSWER = "block int, slice int, payload binary"


def number_of_blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> int:
    """So many that each has about ``block_bytes`` of text, and at least the session's shuffle partitions."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // block_bytes))


def blocks(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, text and block of each document."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return ids.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int"))


def stored_blocks(docs: DataFrame, n: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents, with their ``block``, as a table of the shared folder in ``n`` buckets, which ``in_stored_blocks``
    reads as they lie: however many passes follow, texts are never shuffled.

    A task deals its rows into blocks of about ``block_bytes`` as they come; what it has written stays as it is, so all
    passes see the same blocks. Numbers of blocks are hashed to 31 bits: two that meet are one larger block.
    """
    ids = docs.withColumn("doc_id", F.col("doc_id").cast("long"))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, before = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            at = T.utf8(batch.column("text"))[1] + before
            before = int(at[-1])
            number = T.mix((at[:-1] // block_bytes + task).astype(np.uint64)) >> np.uint64(33)
            yield batch.append_column("block", pa.array(number.astype(np.int32)))

    dealt = ids.mapInArrow(deal, StructType([*ids.schema.fields, StructField("block", IntegerType())]))
    return _buckets(dealt, _most_buckets(docs.sparkSession, n), "block", "blocks")


def in_stored_blocks(stored: DataFrame, work: Callable, schema: str, **answers: DataFrame) -> DataFrame:
    """``in_blocks`` over a table of ``stored_blocks``: only the answers are shuffled."""

    def run(docs: pa.Table, rows: pa.Table | None = None) -> pa.Table:
        told: dict[str, dict[int, bytes]] = {}
        if rows is not None:
            for kind, part, payload in zip(*(rows.column(c).to_pylist() for c in ("kind", "slice", "payload")), strict=True):
                told.setdefault(kind, {})[part] = payload
        out = list(work(docs.combine_chunks(), told)) if docs.num_rows else []
        return pa.Table.from_batches(out) if out else pa.table({})

    docs = stored.groupBy("block")
    rows = None
    for kind, df in answers.items():
        some = df.select("block", F.lit(kind).alias("kind"), "slice", "payload")
        rows = some if rows is None else rows.unionAll(some)
    if rows is None:
        return docs.applyInArrow(lambda docs: run(docs), schema)
    return docs.cogroup(rows.groupBy("block")).applyInArrow(lambda docs, rows: run(docs, rows), schema)


def _buckets(df: DataFrame, n: int, column: str, name: str) -> DataFrame:
    """The rows as a new table of the shared folder in ``n`` buckets of the column."""
    table = f"railwatch_{name}_{uuid.uuid4().hex}"
    writer = df.write.bucketBy(n, column).option("compression", "zstd")
    writer.option("path", scratch_path(df.sparkSession, name)).saveAsTable(table)
    return df.sparkSession.table(table)


def _most_buckets(spark: SparkSession, n: int) -> int:
    return min(n, int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000")))


def stored_slices(rows: DataFrame, n: int) -> DataFrame:
    """Rows by ``slice`` as a table of the shared folder, which ``in_stored_slices`` reads as they lie, pass after pass."""
    buckets = _most_buckets(rows.sparkSession, n)
    return _buckets(rows.repartition(buckets, "slice"), buckets, "slice", "slices")


def in_stored_slices(stored: DataFrame, work: Callable, schema: str) -> DataFrame:
    """``in_slices`` over a table of ``stored_slices``, without a shuffle."""
    return stored.groupBy("slice").applyInArrow(lambda rows: pa.Table.from_batches(work(rows.combine_chunks())), schema)


def in_blocks(
    blocked: DataFrame, n: int, work: Callable, schema: str, extra: tuple[str, ...] = (), **answers: DataFrame
) -> DataFrame:
    """``work(documents, answers)`` for each block, giving record batches: its documents (a table of block, doc_id, text
    and the ``extra`` columns, rows in any order) and, by name, its answers by slice."""
    keep, asked_before = ["block", "doc_id", "text", *extra], bool(answers)
    rows = blocked.select(*keep)
    for kind, df in answers.items():
        rows = rows.unionByName(df.select("block", F.lit(kind).alias("kind"), "slice", "payload"), allowMissingColumns=True)
    if not answers:
        rows = rows.withColumn("kind", F.lit(None).cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        table = pa.Table.from_batches(got)
        is_answer = table.column("kind").is_valid()
        told: dict[str, dict[int, bytes]] = {}
        if asked_before:
            told_rows = table.filter(is_answer)
            for kind, part, payload in zip(*(told_rows.column(c).to_pylist() for c in ("kind", "slice", "payload")), strict=True):
                told.setdefault(kind, {})[part] = payload
        docs = table.filter(pc.invert(is_answer)).select(keep).combine_chunks()
        if docs.num_rows:
            yield from work(docs, told)

    return rows.repartitionById(n, F.col("block")).mapInArrow(run, schema)


def in_slices(asked: DataFrame, n: int, work: Callable, schema: str = ANSWER) -> DataFrame:
    """``work(rows)`` for each slice, giving record batches from the rows of all blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if got:
            yield from work(pa.Table.from_batches(got).combine_chunks())

    return asked.repartitionById(n, F.col("slice")).mapInArrow(run, schema)


def slice_of(keys: np.ndarray, n: int) -> np.ndarray:
    """The slice of a 64-bit key: equal ranges of its upper half, so that sorted keys are sorted by slice."""
    return ((keys >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def cut(keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The slices sorted keys lie in, and the offsets of each slice's keys."""
    number = slice_of(keys, n)
    found = np.flatnonzero(np.diff(number, prepend=-1))
    return number[found], np.append(found, len(keys))


def planes(values: np.ndarray) -> bytes:
    """Sorted integers byte by byte, which compresses well."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.dtype.itemsize).T).tobytes()


def unplanes(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, len(data) // size).T).view(kind).ravel()


def pack(values: np.ndarray) -> bytes:
    """Integers byte by byte, compressed: planes that repeat in part take the bits they need, which lz4 leaves as they are."""
    raw = planes(values)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(data: bytes, kind: type) -> np.ndarray:
    return unplanes(pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True), kind)


def pack_ascending(values: np.ndarray) -> bytes:
    """Ascending integers by their steps."""
    return pack(np.diff(values, prepend=values.dtype.type(0)))


def unpack_ascending(data: bytes, kind: type) -> np.ndarray:
    return np.cumsum(unpack(data, kind), dtype=kind)


def answer_batch(rows: pa.Table, payloads: list[bytes]) -> pa.RecordBatch:
    columns = [rows.column("block").combine_chunks(), rows.column("slice").combine_chunks(), pa.array(payloads, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["block", "slice", "payload"])


def join_bits(told: dict[int, bytes], slices: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The answers of all slices as one array of booleans in the order of the keys."""
    out = np.zeros(at[-1], bool)
    for s, a, b in zip(slices.tolist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
        out[a:b] = np.unpackbits(np.frombuffer(told[s], np.uint8), count=b - a)
    return out
