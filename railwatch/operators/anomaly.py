"""Isolation Forest over window features (Liu, Ting, Zhou: Isolation Forest, ICDM 2008).

Spark draws the samples by hash, groups them by tree and scores every row; Python sees at most ``sample_size`` rows of one
tree, or one batch of rows to score. Every random number is a part of an MD5, so that any engine that has it
fits the same forest. The model is a table of at most ``trees * 2 * sample_size`` nodes.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from hashlib import md5
from math import ceil, log, log2
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

import railwatch
from railwatch.config import ForestConfig
from railwatch.functions import count_where
from railwatch.operators.health import FEATURES
from railwatch.sources.tables import append_log, read_if_present

# The function that grows a tree travels to the executors with the job, so that those need no copy of the package.
cloudpickle.register_pickle_by_value(railwatch)

_NODE_SCHEMA = "tree_id int, node_id int, feature int, split double, rows int, depth int"
_LEAF = -1
#: Rows that walk the trees at once, which bounds the arrays of a batch.
_TOGETHER = 2_000
_SCORE_DIGITS = 6
# Thirteen hexadecimal digits are a number below RANGE; PRIME is the largest prime below it.
RANGE, PRIME = 2**52, 2**52 - 47
#: Paths are whole numbers of this part of a step, so that their sum does not depend on an order.
PATH_UNIT = 1e-9
EULER = 0.5772156649015329


class Forest(NamedTuple):
    """Nodes in heap order per tree (the children of n are 2n and 2n+1) and what is needed to score with them. A row goes
    to 2n if its feature is below the split."""

    nodes: DataFrame
    features: tuple[str, ...]
    sample_size: int
    threshold: float


def _hash_number(text: Column, part: int = 0) -> Column:
    """A number below RANGE that depends on nothing but the text; there are two of them."""
    return F.conv(F.substring(F.md5(text), 1 + 13 * part, 13), 16, 10).cast("bigint")


def _key_text(key: str | Column, seed: int) -> Column:
    return F.concat_ws(":", (F.col(key) if isinstance(key, str) else key).cast("string"), F.lit(seed))


def hash_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """The ``n`` rows first in the order of a seeded hash of the key: the same rows in every run."""
    return df.orderBy(F.md5(_key_text(key, seed)), key).limit(n)


def hash_split(df: DataFrame, key: str, held_out: float, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Training rows and held-out rows, apart by the key."""
    part = _hash_number(_key_text(key, seed)) / F.lit(float(RANGE))
    return df.filter(part >= held_out), df.filter(part < held_out)


def _complete(df: DataFrame, key: str, features: Sequence[str]) -> DataFrame:
    """Rows that have all features, with the key as text."""
    return df.select(F.col(key).cast("string").alias("row_key"), *[F.col(f).cast("double").alias(f) for f in features]).na.drop()


def _tree_samples(complete: DataFrame, need: int, chance: float, cfg: ForestConfig) -> DataFrame:
    """For each tree the ``need`` rows of smallest draw, if so many have a draw below ``chance``.

    A row's draws for all trees come from two hash numbers a and b, as a + tree * b modulo a prime: one MD5 a row, whatever
    the number of trees. Only the trees that draw a row make a copy of it; copies of a key are combined before they are
    counted.
    """
    text = _key_text("row_key", cfg.seed)
    numbered = complete.withColumns({"a": _hash_number(text) % PRIME, "b": _hash_number(text, 1) % PRIME})
    draws = F.filter(
        F.transform(
            F.sequence(F.lit(0), F.lit(cfg.trees - 1)),
            lambda t: F.struct(t.alias("tree_id"), ((F.col("a") + t * F.col("b")) % PRIME).alias("draw")),
        ),
        lambda d: d["draw"] < int(chance * PRIME) + 1,
    )
    candidates = numbered.withColumn("drawn", F.explode(draws)).select(*complete.columns, "drawn.*")
    candidates = candidates.dropDuplicates(["tree_id", "row_key"])
    order = Window.partitionBy("tree_id").orderBy("draw", "row_key")
    return candidates.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= need)


def _max_depth(rows: int) -> int:
    return ceil(log2(max(rows, 2)))


def _unit_numbers(text: str) -> tuple[float, float]:
    """Two numbers in [0, 1) from the hash numbers of a text."""
    digest = md5(text.encode()).hexdigest()
    return int(digest[:13], 16) / RANGE, int(digest[13:26], 16) / RANGE


def _grow_tree(sample: pd.DataFrame, features: Sequence[str], cfg: ForestConfig) -> pd.DataFrame:
    tree_id = int(sample["tree_id"].iloc[0])
    values = sample[list(features)].to_numpy(dtype=float)
    deepest = _max_depth(cfg.sample_size)
    nodes, open_nodes = [], [(1, 0, np.arange(len(values)))]
    while open_nodes:
        node, depth, rows = open_nodes.pop(0)
        low, high = values[rows].min(axis=0), values[rows].max(axis=0)
        usable = np.flatnonzero(high > low)
        if depth == deepest or len(usable) == 0:
            nodes.append((tree_id, node, _LEAF, 0.0, len(rows), depth))
            continue
        pick, place = _unit_numbers(f"{cfg.seed}:{tree_id}:{node}")
        feature = int(usable[int(pick * len(usable))])
        split = high[feature] - place * (high[feature] - low[feature])
        # Above the minimum, also when rounding says otherwise: no side may be empty.
        split = float(split if split > low[feature] else high[feature])
        right = values[rows, feature] >= split
        nodes.append((tree_id, node, feature, split, len(rows), depth))
        open_nodes += [(2 * node, depth + 1, rows[~right]), (2 * node + 1, depth + 1, rows[right])]
    return pd.DataFrame(nodes, columns=["tree_id", "node_id", "feature", "split", "rows", "depth"])


def _mean_path(n: int) -> float:
    """The mean length of an unsuccessful search in a binary search tree of n rows."""
    if n <= 2:
        return 1.0 if n == 2 else 0.0
    return 2 * (log(n - 1) + EULER) - 2 * (n - 1) / n


def _path_units(rows: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """The path that ends at a node, in whole parts of a step."""
    return np.round([(d + _mean_path(int(r))) / PATH_UNIT for r, d in zip(rows, depth, strict=True)]).astype(np.int64)


def fit_iforest(
    df: DataFrame, key: str, features: Sequence[str] = FEATURES, cfg: ForestConfig = ForestConfig()
) -> Forest:
    """Fits the forest; rows with a missing feature take no part. Runs jobs: a count, the trees, the threshold.

    ``key`` identifies a row. The threshold is the score that ``contamination`` of the training rows exceed.
    """
    spark = df.sparkSession
    complete = _complete(df, key, features)
    # Rows that can be drawn: complete ones, each key once.
    rows = complete.agg(F.count_distinct("row_key")).first()[0]
    if rows == 0:
        raise ValueError("no rows to fit")
    names, need = tuple(features), min(cfg.sample_size, rows)
    # Six standard deviations more than needed; should a tree still come short, all draw again with twice the chance.
    chance = min(1.0, (need + 6 * need**0.5 + 20) / rows)
    while True:
        # The one collect: nodes of the model, bounded by trees and sample size, not by the data.
        samples = _tree_samples(complete, need, chance, cfg)
        found = samples.groupBy("tree_id").applyInPandas(lambda s: _grow_tree(s, names, cfg), _NODE_SCHEMA).toArrow()
        roots = [r for n, r in zip(found["node_id"].to_pylist(), found["rows"].to_pylist(), strict=True) if n == 1]
        if chance == 1.0 or (len(roots) == cfg.trees and set(roots) == {need}):
            break
        chance = min(1.0, 2 * chance)
    nodes = spark.createDataFrame(found, schema=_NODE_SCHEMA)
    model = Forest(nodes, names, need, 0.0)
    scores = anomaly_scores(df, model).select("score")
    return model._replace(threshold=_score_threshold(scores, cfg.contamination))


def _score_threshold(scores: DataFrame, contamination: float) -> float:
    """The exact quantile of the scores. They have six digits, so the histogram has at most a million rows."""
    histogram = scores.filter(F.col("score").isNotNull()).groupBy("score").agg(F.count(F.lit(1)).alias("rows"))
    up_to = Window.orderBy("score").rowsBetween(Window.unboundedPreceding, 0)
    ranked = histogram.withColumns({"rank": F.sum("rows").over(up_to), "all_rows": F.sum("rows").over(Window.partitionBy())})
    row = ranked.filter(F.col("rank") >= F.col("all_rows") * (1.0 - contamination)).agg(F.min("score").alias("t")).first()
    return float(row["t"])


def _dense(nodes: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nodes as arrays [tree, node]: feature, split and the path that ends at the node."""
    trees = nodes["tree_id"].rank(method="dense").astype(int).to_numpy() - 1
    shape = (trees.max() + 1, int(nodes["node_id"].max()) + 1)
    at = (trees, nodes["node_id"].to_numpy())
    feature, split, path = np.full(shape, _LEAF), np.zeros(shape), np.zeros(shape, np.int64)
    feature[at], split[at] = nodes["feature"], nodes["split"]
    path[at] = _path_units(nodes["rows"].to_numpy(), nodes["depth"].to_numpy())
    return feature, split, path


def _scores(x: np.ndarray, feature: np.ndarray, split: np.ndarray, path: np.ndarray, scale: float) -> np.ndarray:
    tree = np.arange(len(feature))[None, :]
    row = np.arange(len(x))[:, None]
    node = np.ones((len(x), len(feature)), dtype=int)
    while True:
        f = feature[tree, node]
        inner = f != _LEAF
        if not inner.any():
            break
        right = x[row, np.where(inner, f, 0)] >= split[tree, node]
        node = np.where(inner, 2 * node + right, node)
    mean = path[tree, node].sum(axis=1) / len(feature) * PATH_UNIT
    return np.where(np.isnan(x).any(axis=1), np.nan, np.round(np.power(2.0, -mean / scale), _SCORE_DIGITS))


def anomaly_scores(df: DataFrame, model: Forest) -> DataFrame:
    """Adds ``score`` in (0, 1], higher for rows that are isolated sooner; null where a feature is missing.

    The nodes travel with the function; rows stay where they are, and only features go through Python.
    """
    arrays, scale = _dense(model.nodes.toPandas()), _mean_path(model.sample_size) or 1.0

    @F.pandas_udf("double")
    def score(rows: pd.DataFrame) -> pd.Series:
        x = rows.to_numpy(dtype=float)
        parts = [_scores(x[i : i + _TOGETHER], *arrays, scale) for i in range(0, len(x), _TOGETHER)]
        return pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return df.withColumn("score", score(F.struct(*[F.col(f).cast("double") for f in model.features])))


def score_iforest(df: DataFrame, model: Forest) -> DataFrame:
    """Adds ``score`` and ``is_anomaly`` (1 where the score exceeds the threshold)."""
    flag = F.when(F.col("score") > model.threshold, 1).otherwise(0)
    return anomaly_scores(df, model).withColumn("is_anomaly", flag)


def evaluate(scored: DataFrame, label: str = "label") -> DataFrame:
    """Precision, recall and F1 of ``is_anomaly`` against a 0/1 label, 0 where undefined."""
    hit, truth = F.col("is_anomaly") == 1, F.col(label) == 1
    counts = scored.agg(
        F.coalesce(count_where(hit & truth), F.lit(0)).alias("tp"),
        F.coalesce(count_where(hit & ~truth), F.lit(0)).alias("fp"),
        F.coalesce(count_where(~hit & truth), F.lit(0)).alias("fn"),
    )
    share = lambda part, whole: F.when(whole > 0, part / whole).otherwise(F.lit(0.0))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.select(
        "tp",
        "fp",
        "fn",
        share(tp, tp + fp).alias("precision"),
        share(tp, tp + fn).alias("recall"),
        share(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


_VERSIONS = "versions"


def save_iforest(model: Forest, path: str) -> str:
    """Adds a version of the model and gives its name.

    The nodes are written first, to a folder of their own; the version exists once its one row is in the log of versions.
    Nothing is overwritten, so whoever reads while it is written sees the version before, whole.
    """
    spark = model.nodes.sparkSession
    name = uuid.uuid4().hex
    model.nodes.coalesce(1).write.mode("error").parquet(f"{path}/nodes-{name}")
    entry = spark.range(1).select(
        F.lit(name).alias("version"),
        F.current_timestamp().alias("saved_at"),
        F.array(*[F.lit(f) for f in model.features]).alias("features"),
        F.lit(model.sample_size).cast("bigint").alias("sample_size"),
        F.lit(model.threshold).cast("double").alias("threshold"),
    )
    append_log(entry.coalesce(1), f"{path}/{_VERSIONS}")
    return name


def model_versions(spark: SparkSession, path: str) -> DataFrame:
    """version, saved_at, features, sample_size and threshold of each version that is complete."""
    found = read_if_present(spark, f"{path}/{_VERSIONS}")
    if found is None:
        raise ValueError(f"no model in {path}")
    return found


def load_iforest(spark: SparkSession, path: str, version: str | None = None) -> Forest:
    """The model of this version, or the newest."""
    versions = model_versions(spark, path)
    if version is not None:
        versions = versions.filter(F.col("version") == version)
    meta = versions.orderBy(F.col("saved_at").desc(), "version").first()
    if meta is None:
        raise ValueError(f"no version {version} in {path}")
    nodes = spark.read.schema(_NODE_SCHEMA).parquet(f"{path}/nodes-{meta['version']}")
    return Forest(nodes, tuple(meta["features"]), meta["sample_size"], meta["threshold"])
