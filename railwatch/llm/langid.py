"""Language identification by a byte convolutional network.

Texts are cut into windows of a fixed number of bytes. Filters of several widths run over each window, every filter's
largest response in the window is kept, and a softmax layer turns them into languages; a document's languages are the
softmax of its windows' mean outputs. numpy trains the network on all windows of the whole texts of a bounded sample of
labelled rows (about ``SAMPLE_ROWS`` per language, drawn by a hash of the id).
A filter over bytes is a table per place, so tables over pairs of bytes answer two places at once when scoring.
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

SAMPLE_ROWS = 400
WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 8
UNKNOWN = "und"
_REACH = max(WIDTHS) - 1


def windows(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows of all documents, with the bytes a filter at their end reaches (zeros beyond the text), and offsets of
    documents in them."""
    data = T.lower(data)
    count = -(-np.diff(at) // WINDOW)
    window_at = np.concatenate([[0], np.cumsum(count)])
    row = np.repeat(np.arange(len(count)), count)
    start = at[row] + (np.arange(window_at[-1]) - window_at[row]) * WINDOW
    place = start[:, None] + np.arange(WINDOW + _REACH)
    padded = np.append(data, 0) if len(data) else np.zeros(1, np.uint8)
    return np.where(place < at[row + 1][:, None], padded[np.minimum(place, len(padded) - 1)], 0).astype(np.uint8), window_at


@dataclass
class Network:
    languages: list[str]
    filters: list[np.ndarray]  # per width: place, byte, filter
    output: np.ndarray
    bias: np.ndarray

    def pair_tables(self) -> list[list[np.ndarray]]:
        """Per width, responses by the pair of bytes at each even place; the last of an odd width by one byte."""
        out = []
        for f in self.filters:
            tables = [(f[k][:, None] + f[k + 1][None]).reshape(65536, -1) for k in range(0, len(f) - 1, 2)]
            out.append(tables + [f[-1]] * (len(f) % 2))
        return out


def responses(w: np.ndarray, tables: list[list[np.ndarray]]) -> np.ndarray:
    """Each filter's largest response per window, negative ones as 0."""
    pair = w[:, :-1].astype(np.int32) << 8 | w[:, 1:]
    out = []
    for width, parts in zip(WIDTHS, tables, strict=True):
        total = None
        for k, table in enumerate(parts):
            index = pair[:, 2 * k : 2 * k + WINDOW] if len(table) > 256 else w[:, 2 * k : 2 * k + WINDOW]
            got = table.take(index, axis=0)
            total = got if total is None else np.add(total, got, out=total)
        assert width <= 2 * len(parts)
        out.append(np.maximum(total.max(axis=1), 0))
    return np.concatenate(out, axis=1)


def train(w: np.ndarray, labels: np.ndarray, languages: list[str], epochs: int = 10, batch: int = 64, seed: int = 3) -> Network:
    """Adam on the cross entropy of single windows; half of them are cut short, so that short texts are known too."""
    random = np.random.default_rng(seed)
    shapes = [(k, 256, FILTERS) for k in WIDTHS] + [(len(WIDTHS) * FILTERS, len(languages)), (len(languages),)]
    weights = [random.normal(0, 0.15, s).astype(np.float32) for s in shapes]
    first, second = [np.zeros_like(x) for x in weights], [np.zeros_like(x) for x in weights]
    step, steps = 0, max(1, epochs * -(-len(w) // batch))
    net = Network(languages, weights[:-2], weights[-2], weights[-1])
    for _ in range(epochs if len(w) else 0):
        order = random.permutation(len(w))
        for some in np.array_split(order, -(-len(order) // batch)):
            x = w[some].copy()
            cut = np.where(random.random(len(x)) < 0.5, random.integers(8, WINDOW, len(x)), WINDOW + _REACH)
            x[np.arange(x.shape[1]) >= cut[:, None]] = 0
            maxima, places = [], []
            for f in net.filters:
                total = sum(f[k][x[:, k : k + WINDOW]] for k in range(len(f)))
                place = total.argmax(axis=1)
                places.append(place)
                maxima.append(np.take_along_axis(total, place[:, None], axis=1)[:, 0])
            raw = np.concatenate(maxima, axis=1)
            hidden = np.maximum(raw, 0)
            logits = hidden @ net.output + net.bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(x)), labels[some]] -= 1
            p /= len(x)
            back = (p @ net.output.T) * (raw > 0)
            gradient = [np.zeros_like(f) for f in net.filters]
            for n, (g, place) in enumerate(zip(gradient, places, strict=True)):
                part = back[:, n * FILTERS : (n + 1) * FILTERS]
                for k in range(len(g)):
                    at = np.take_along_axis(x, place + k, axis=1)
                    np.add.at(g[k], (at, np.arange(FILTERS)[None]), part)
            gradient += [hidden.T @ p, p.sum(axis=0)]
            step += 1
            rate = 0.01 * (1 - step / (steps + 1)) + 1e-4
            for x_, g, a, b in zip(weights, gradient, first, second, strict=True):
                a += 0.1 * (g - a)
                b += 0.01 * (g * g - b)
                x_ -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
    return net


def _sample_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in T.pieces(whole):
            w, at = windows(*T.utf8(batch.column("text")))
            lang = batch.column("lang").take(pa.array(np.repeat(np.arange(len(at) - 1), np.diff(at))))
            yield pa.RecordBatch.from_arrays([lang, pa.array([x.tobytes() for x in w], pa.binary())], ["lang", "window"])


def fit(docs: DataFrame, usable: Column, rows: int = SAMPLE_ROWS) -> Network:
    """A network from the rows with text and lang for which ``usable`` (over doc_id) holds; without any, it knows no
    language. About ``rows`` rows per language, all where there are fewer."""
    labelled = docs.where(usable & F.col("text").isNotNull() & F.col("lang").isNotNull())
    # One number per language comes to the driver, so that no text is shuffled for the choice.
    chance = {r.lang: min(1.0, rows / r["count"]) for r in labelled.groupBy("lang").count().collect()}
    of_lang = F.create_map(*[F.lit(x) for pair in sorted(chance.items()) for x in pair]) if chance else F.create_map()
    chosen = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.try_element_at(of_lang, "lang") * (1 << 20) if chance else F.lit(False)
    got = labelled.where(chosen).select("lang", "text").mapInArrow(_sample_windows, "lang string, window binary")
    got = got.toArrow()
    names = np.array(got.column("lang").to_pylist(), object)
    raw = got.column("window").to_pylist()
    order = sorted(range(len(raw)), key=lambda i: (names[i], raw[i]))
    languages = sorted(set(names.tolist()))
    w = np.frombuffer(b"".join(raw[i] for i in order), np.uint8).reshape(len(raw), WINDOW + _REACH)
    return train(w, np.array([languages.index(names[i]) for i in order], np.int64), languages)


def predict(net: Network, tables, data: np.ndarray, at: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Language and its probability per document."""
    n = len(at) - 1
    has_letter = T.group_sums(((data | 32) - 97 < 26), at) > 0
    for i in np.flatnonzero(~has_letter & (np.diff(at) > 0)).tolist():
        has_letter[i] = any(map(str.isalpha, data[at[i] : at[i + 1]].tobytes().decode("utf-8", "replace")))
    if not net.languages:
        return [UNKNOWN] * n, np.zeros(n)
    w, window_at = windows(data, at)
    some = [responses(w[a : a + 2048], tables) @ net.output + net.bias for a in range(0, len(w), 2048)]
    logits = np.concatenate(some) if some else np.zeros((0, len(net.languages)), np.float32)
    total = np.zeros((len(logits) + 1, len(net.languages)))
    np.cumsum(logits, axis=0, out=total[1:])
    mean = (total[window_at[1:]] - total[window_at[:-1]]) / np.maximum(np.diff(window_at), 1)[:, None]
    p = np.exp(mean - mean.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    best = p.argmax(axis=1)
    names = [net.languages[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), has_letter.tolist(), strict=True)]
    return names, np.where(has_letter, p[np.arange(n), best], 0.0)


def _predict_batches(batches: Iterator[pa.RecordBatch], shared, keep: list[str]) -> Iterator[pa.RecordBatch]:
    net = shared.value
    tables = net.pair_tables() if net.languages else []
    for whole in batches:
        for batch in T.pieces(whole):
            names, score = predict(net, tables, *T.utf8(batch.column("text")))
            columns = [*(batch.column(c) for c in keep), pa.array(names, pa.string()), pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "lang_pred", "score"])


def identify(docs: DataFrame, net: Network, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of every row, ``lang_pred`` and ``score``. A null text, one without a letter, and any text
    if the network knows no language give ``und`` and 0. Of languages with the same score the first by name is taken.
    Whole texts are read, in windows, however long they are; repeated rows each get a row, a table without rows gives
    none. Kept columns of the names ``lang_pred`` and ``score`` give way to the results."""
    keep = tuple(c for c in dict.fromkeys(keep) if c not in ("lang_pred", "score"))
    shared = docs.sparkSession.sparkContext.broadcast(net)
    work = docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys((*keep, "text"))])
    types = {f.name: f.dataType.simpleString() for f in work.schema.fields}
    schema = ", ".join(f"`{c}` {types[c]}" for c in keep) + ", lang_pred string, score double"
    return work.mapInArrow(partial(_predict_batches, shared=shared, keep=list(keep)), schema)
