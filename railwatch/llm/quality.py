"""Quality classifier: supervised subword embeddings.

A document is four bags of hashed features: words, differences of neighbouring words (a repeated word always gives the
same one), and byte n-grams of two lengths. Each bucket has a learned vector; a bag is the mean of its vectors, a
document the mean of its bags, and a softmax layer gives the classes. numpy trains it by stochastic gradient descent on
the whole texts of a bounded sample of labelled rows (``SAMPLE_ROWS``, the first ones by a hash of the id). Each of them
sends its distinct buckets and how often it has them, so at most two megabytes however long its text is. One task trains on
them; only what scoring needs, a number per bucket, comes to the driver. Scoring reads whole
texts, too: as mean and softmax input are linear, it adds up one number per bucket, the product of its vector with the
output weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railwatch.llm import text as T
from railwatch.llm.shared import share

SAMPLE_ROWS = 4000
BUCKETS = 1 << 16
SIZE = 12
GRAMS = (3, 5)
BAGS = 2 + len(GRAMS)


def bags(data: np.ndarray, at: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per kind of feature: the buckets of all documents one after the other, and the offsets of documents."""
    first, after, row = T.tokens(data, at)
    words = T.span_hashes(data, first, after)
    token_at = np.searchsorted(first, at)
    mask = np.uint64(BUCKETS - 1)
    pair = row[1:] == row[:-1]
    steps = T.mix(words[1:] - words[:-1])[pair]
    out = [(words & mask, token_at), (steps & mask, np.concatenate([[0], np.cumsum(pair)])[np.maximum(token_at - 1, 0)])]
    wide = data.astype(np.uint64)
    for n in GRAMS:
        grams = T.run_hashes(wide, n, n)
        # A gram lies in one document: only starts up to n - 1 bytes before its end count.
        per_doc = np.maximum(np.diff(at) - n + 1, 0)
        ok = np.ones(len(data), bool)
        for k in range(1, n):
            ends = at[1:] - k
            ok[ends[ends >= at[:-1]]] = False
        out.append(((grams & mask)[ok[: len(grams)]], np.concatenate([[0], np.cumsum(per_doc)])))
    return [(b.astype(np.int64) + k * BUCKETS, o) for k, (b, o) in enumerate(out)]


def pack_features(data: np.ndarray, at: np.ndarray) -> list[bytes]:
    """Per document: the number of its distinct buckets in each bag, how often it has each, and the buckets."""
    out = [(np.zeros(BAGS, np.uint32), [], []) for _ in range(len(at) - 1)]
    for k, (bucket, o) in enumerate(bags(data, at)):
        for i in np.flatnonzero(np.diff(o)).tolist():
            ids, count = np.unique(bucket[o[i] : o[i + 1]], return_counts=True)
            out[i][0][k] = len(ids)
            out[i][1].append(count.astype(np.uint32).tobytes())
            out[i][2].append((ids - k * BUCKETS).astype(np.uint16).tobytes())
    return [b"".join([sizes.tobytes(), *counts, *ids]) for sizes, counts, ids in out]


def unpack_features(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a document and their shares; each bag that has any adds up to the same share."""
    sizes = np.frombuffer(packed, np.uint32, BAGS).astype(np.int64)
    n = int(sizes.sum())
    count = np.frombuffer(packed, np.uint32, n, 4 * BAGS)
    bag = np.repeat(np.arange(BAGS), sizes)
    ids = np.frombuffer(packed, np.uint16, n, 4 * (BAGS + n)).astype(np.int32) + (bag * BUCKETS).astype(np.int32)
    total = np.bincount(bag, count, BAGS)
    return ids, (count / (total[bag] * max(1, np.count_nonzero(sizes)))).astype(np.float32)


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in T.pieces(whole):
            found = pa.array(pack_features(*T.utf8(batch.column("text"))), pa.binary())
            names = ["doc_id", "label", "text_hash"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), found], [*names, "features"])


class Model:
    """Vectors of the buckets and the output layer over two classes."""

    def __init__(self, seed: int = 7):
        random = np.random.default_rng(seed)
        self.vectors = random.uniform(-1 / SIZE, 1 / SIZE, (BAGS * BUCKETS, SIZE)).astype(np.float32)
        self.output = np.zeros((SIZE, 2), np.float32)
        self.bias = np.zeros(2, np.float32)

    def fit(self, packed: list[bytes], labels: np.ndarray, epochs: int = 12, rate: float = 0.4, batch: int = 32) -> Model:
        """Descent on packed documents; only those of a step are unpacked."""
        return _descend(self, packed, labels, epochs, rate, batch)

    def bucket_logits(self) -> np.ndarray:
        """What each feature adds to the log odds of class 1."""
        return self.vectors @ (self.output[:, 1] - self.output[:, 0])

    @property
    def offset(self) -> float:
        return float(self.bias[1] - self.bias[0])


def _descend(model: Model, packed: list[bytes], labels: np.ndarray, epochs: int = 12, rate: float = 0.4, batch: int = 32) -> Model:
    if not len(labels):
        return model
    random = np.random.default_rng(1)
    model.bias[:] = np.log((np.bincount(labels, minlength=2) + 1) / (len(labels) + 2))
    steps, done = epochs * -(-len(labels) // batch), 0
    for _ in range(epochs):
        order = random.permutation(len(labels))
        for some in np.array_split(order, -(-len(order) // batch)):
            lr = rate * (1 - done / steps)
            done += 1
            found = [unpack_features(packed[i]) for i in some]
            mean = np.stack([weight @ model.vectors.take(ids, axis=0) for ids, weight in found])
            logits = mean @ model.output + model.bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(some)), labels[some]] -= 1
            # Both classes' errors are one number and its negative, so all of a step's gradients lie along one line:
            # one number per bucket, added up over the documents, tells how far its vector moves.
            line = model.output[:, 1] - model.output[:, 0]
            far = np.concatenate([weight * error for (_, weight), error in zip(found, p[:, 1], strict=True)])
            move = np.bincount(np.concatenate([ids for ids, _ in found]), far, len(model.vectors)).astype(np.float32)
            moved = np.flatnonzero(move)
            model.output -= lr * mean.T @ p
            model.bias -= 0.05 * lr * p.sum(axis=0)
            # The mean spreads a document's gradient over its features; the factor makes up for that.
            model.vectors[moved] = model.vectors.take(moved, axis=0) - move[moved, None] * (np.float32(lr * 8) * line)
    return model


@dataclass
class Trained:
    """What scoring needs of a model."""

    logits: np.ndarray
    offset: float

    def bucket_logits(self) -> np.ndarray:
        return self.logits


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: list[tuple[bytes, int]] = []
    for batch in batches:
        found += zip(batch.column("features").to_pylist(), batch.column("label").to_pylist(), strict=True)
    found.sort()
    # By the function: a task may carry the driver's class.
    model = _descend(Model(), [f for f, _ in found], np.array([k for _, k in found], np.int64))
    yield pa.RecordBatch.from_arrays([pa.array([model.bucket_logits().tobytes()], pa.binary()), pa.array([model.offset])], ["logits", "offset"])


def scores(data: np.ndarray, at: np.ndarray, logits: np.ndarray, offset: float) -> np.ndarray:
    """Probability of class 1 per document."""
    total, kinds = np.zeros(len(at) - 1), np.zeros(len(at) - 1)
    for bucket, o in bags(data, at):
        n = np.diff(o)
        total += T.group_sums(logits[bucket], o) / np.maximum(n, 1)
        kinds += n > 0
    return 1 / (1 + np.exp(-np.clip(offset + total / np.maximum(kinds, 1), -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, usable: Column, rows: int = SAMPLE_ROWS) -> Model | Trained:
    """A model from at most ``rows`` documents with a label of 0 or 1 for which ``usable`` (over doc_id) holds. Without
    any, it gives even odds. Of documents that share an id, the one with the least hash of its text teaches; an id with
    both labels teaches both."""
    sample = labels.where(usable & F.col("quality").isin(0, 1)).select("doc_id", F.col("quality").cast("int").alias("label"))
    sample = sample.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(rows).distinct()
    # At most ``rows`` rows of two numbers.
    chosen = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).join(F.broadcast(sample), "doc_id")
    id_type = chosen.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, label int, text_hash long, features binary"
    one = chosen.select("doc_id", "label", "text_hash", "text").mapInArrow(_sample_features, schema)
    one = one.groupBy("doc_id", "label").agg(F.min_by("features", "text_hash").alias("features"))
    # The sample is bounded, so one task holds it; the driver, which runs many jobs, gets a megabyte of it.
    trained = one.select("label", "features").coalesce(1).mapInArrow(_train, "logits binary, offset double")
    for row in trained.toLocalIterator():
        return Trained(np.frombuffer(row.logits, np.float32), row.offset)
    return Model()


def _score_batches(batches: Iterator[pa.RecordBatch], shared, offset: float, keep: list[str]) -> Iterator[pa.RecordBatch]:
    logits = shared.value
    for whole in batches:
        for batch in T.pieces(whole):
            score = scores(*T.utf8(batch.column("text")), logits, offset)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(score)], [*keep, "score"])


def score_documents(docs: DataFrame, model: Model | Trained, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of every row and ``score``, the probability that the quality is good. An empty or null text
    scores as the offset alone says; repeated rows each get their (same) score, a table without rows gives none. A kept
    column of the name ``score`` gives way to the score. Very long texts are read whole, one batch after the other."""
    keep = tuple(c for c in dict.fromkeys(keep) if c != "score")
    shared = docs.sparkSession.sparkContext.broadcast(model.bucket_logits().astype(np.float32))
    work = docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys((*keep, "text"))])
    types = {f.name: f.dataType.simpleString() for f in work.schema.fields}
    schema = ", ".join(f"`{c}` {types[c]}" for c in keep) + ", score double"
    return work.mapInArrow(partial(_score_batches, shared=shared, offset=model.offset, keep=list(keep)), schema)


def _keep_batches(batches: Iterator[pa.RecordBatch], shared, offset: float, least: float) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in T.pieces(whole):
            yield batch.filter(pa.array(scores(*T.utf8(batch.column("text")), shared.value, offset) >= least))


def keep_good(docs: DataFrame, model: Model | Trained, least: float = 0.3) -> DataFrame:
    """The rows of ``docs`` whose score is ``least`` or more, with all their columns."""
    shared = share(docs.sparkSession, model.bucket_logits().astype(np.float32))
    return docs.mapInArrow(partial(_keep_batches, shared=shared, offset=model.offset, least=least), docs.schema)
