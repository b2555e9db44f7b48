from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from railwatch.config import ForestConfig
from railwatch.operators import anomaly
from railwatch.operators.health import FEATURES

# Made up for these tests: quiet windows vary by a tenth of a unit around 10; trouble moves some features.
QUIET, SPREAD = 10.0, 0.1
TROUBLE = {f"{name} and its neighbour": [i, i - 1] for i, name in enumerate(FEATURES)} | {"all": list(range(len(FEATURES)))}


@pytest.fixture(scope="module")
def windows(spark):
    random = np.random.default_rng(1)
    parts = [("normal", [], 4000), *((kind, moved, 60) for kind, moved in TROUBLE.items())]
    frames = []
    for kind, moved, n in parts:
        values = random.normal(QUIET, SPREAD, (n, len(FEATURES)))
        values[:, moved] += 40 * SPREAD
        frames.append(pd.DataFrame(values, columns=list(FEATURES)).assign(kind=kind))
    data = pd.concat(frames, ignore_index=True)
    data["id"] = data.index.astype(str)
    return spark.createDataFrame(data).cache()


@pytest.fixture(scope="module")
def model(windows):
    return anomaly.fit_iforest(windows.filter("kind = 'normal'"), "id", cfg=ForestConfig(trees=100))


def test_training_rows_are_flagged_at_the_contamination(windows, model):
    flagged = anomaly.score_iforest(windows.filter("kind = 'normal'"), model).agg(F.avg("is_anomaly")).first()[0]
    assert flagged == pytest.approx(0.03, abs=0.002)


def test_planted_trouble_is_found(windows, model):
    scored = anomaly.score_iforest(windows.withColumn("label", (F.col("kind") != "normal").cast("int")), model)
    means = {r.kind: r.score for r in scored.groupBy("kind").agg(F.avg("score").alias("score")).collect()}
    assert all(means[kind] > means["normal"] + 0.1 for kind in TROUBLE)
    result = anomaly.evaluate(scored).first()
    assert result.recall > 0.85 and result.precision > 0.6


def test_scores_equal_a_walk_through_the_nodes(windows, model):
    """Brute force: one row, one tree, one node at a time."""
    nodes = {(n.tree_id, n.node_id): n for n in model.nodes.collect()}
    trees = {t for t, _ in nodes}
    assert len(trees) == 100
    # Every inner node has both children, and they share its rows.
    for (tree, node), n in nodes.items():
        if n.feature >= 0:
            assert nodes[tree, 2 * node].rows + nodes[tree, 2 * node + 1].rows == n.rows
            assert min(nodes[tree, 2 * node].rows, nodes[tree, 2 * node + 1].rows) > 0
    harmonic = lambda n: math.log(n) + 0.5772156649015329
    expected_path = lambda n: 0.0 if n <= 1 else 1.0 if n == 2 else 2 * harmonic(n - 1) - 2 * (n - 1) / n
    for row in anomaly.anomaly_scores(windows.filter("id % 500 = 3"), model).collect():
        total = 0.0
        for tree in trees:
            node = 1
            while nodes[tree, node].feature >= 0:
                n = nodes[tree, node]
                node = 2 * node + (row[FEATURES[n.feature]] >= n.split)
            total += nodes[tree, node].depth + expected_path(nodes[tree, node].rows)
        assert row.score == pytest.approx(2 ** (-total / len(trees) / expected_path(256)), abs=1e-6)


def test_same_scores_for_any_partitioning(windows):
    cfg = ForestConfig(trees=20, sample_size=64)
    normal = windows.filter("kind = 'normal'")
    scores = []
    for n in (1, 7):
        data = normal.repartition(n)
        fitted = anomaly.fit_iforest(data, "id", cfg=cfg)
        scores.append((fitted.threshold, {r.id: r.score for r in anomaly.anomaly_scores(data, fitted).collect()}))
    assert scores[0] == scores[1]


def test_tree_samples_are_exact_also_with_copies(spark):
    copies = spark.range(3000).selectExpr("IF(id < 1000, 0, id) AS id", "CAST(id % 10 AS double) AS x")
    cfg = ForestConfig(trees=10, sample_size=50)
    samples = anomaly._tree_samples(anomaly._complete(copies, "id", ["x"]), 50, 1.0, cfg)
    assert {r["count"] for r in samples.groupBy("tree_id").count().collect()} == {50}
    assert samples.groupBy("tree_id", "row_key").count().filter("count > 1").count() == 0
    # Drawing fewer candidates changes none of the rows.
    some = anomaly._tree_samples(anomaly._complete(copies, "id", ["x"]), 50, 0.06, cfg)
    rows = lambda df: sorted((r.tree_id, r.row_key) for r in df.collect())
    assert rows(some) == rows(samples)


@pytest.mark.parametrize("missing", [0.0, 0.95])
def test_each_tree_has_its_rows_whatever_is_missing(spark, missing):
    rows = 20_000
    data = spark.range(rows).selectExpr("id", f"IF(id % 100 < {missing * 100}, NULL, CAST(hash(id) AS double)) AS x")
    for sample_size in (256, 5000):
        cfg = ForestConfig(trees=8, sample_size=sample_size)
        model = anomaly.fit_iforest(data, "id", ["x"], cfg)
        need = min(sample_size, round(rows * (1 - missing)))
        assert model.sample_size == need
        assert [r.rows for r in model.nodes.filter("node_id = 1").collect()] == [need] * 8


def test_missing_features_and_constant_data(spark):
    data = spark.createDataFrame([(i, 1.0 if i else None) for i in range(20)], "id int, x double")
    fitted = anomaly.fit_iforest(data, "id", ["x"], ForestConfig(trees=5, sample_size=8))
    scored = {r.id: (r.score, r.is_anomaly) for r in anomaly.score_iforest(data, fitted).collect()}
    assert scored[0] == (None, 0)
    assert len({scored[i] for i in range(1, 20)}) == 1


def test_no_rows_is_an_error(spark):
    with pytest.raises(ValueError):
        anomaly.fit_iforest(spark.createDataFrame([], "id int, x double"), "id", ["x"])


def test_save_and_load(spark, windows, model, folder):
    with pytest.raises(ValueError, match="no model"):
        anomaly.load_iforest(spark, folder)
    first = anomaly.save_iforest(model, folder)
    # A writer that ends before its version is in the log leaves nothing that a reader sees.
    model.nodes.limit(3).write.parquet(f"{folder}/nodes-unfinished")
    loaded = anomaly.load_iforest(spark, folder)
    assert loaded[1:] == model[1:]
    second = anomaly.save_iforest(model._replace(threshold=0.25), folder)
    assert anomaly.load_iforest(spark, folder).threshold == 0.25
    assert anomaly.load_iforest(spark, folder, first)[1:] == model[1:]
    assert {r.version for r in anomaly.model_versions(spark, folder).collect()} == {first, second}
    with pytest.raises(ValueError, match="no version"):
        anomaly.load_iforest(spark, folder, "unfinished")
    some = windows.limit(50)
    score = lambda m: {r.id: r.score for r in anomaly.anomaly_scores(some, m).collect()}
    assert score(loaded) == score(model)


def test_evaluate_counts(spark):
    pairs = [(1, 1)] * 3 + [(1, 0)] + [(0, 1)] * 2 + [(0, 0)] * 4
    row = anomaly.evaluate(spark.createDataFrame(pairs, "is_anomaly int, label int")).first()
    assert row[:] == (3, 1, 2, 0.75, 0.6, pytest.approx(2 / 3))
    none = anomaly.evaluate(spark.createDataFrame([(0, 0)], "is_anomaly int, label int")).first()
    assert none[:] == (0, 0, 0, 0.0, 0.0, 0.0)


def test_samples_and_splits_by_hash(spark):
    ids = spark.range(2000)
    first = {r.id for r in anomaly.hash_sample(ids, "id", 100).collect()}
    assert len(first) == 100 and first == {r.id for r in anomaly.hash_sample(ids.repartition(5), "id", 100).collect()}
    train, held_out = anomaly.hash_split(ids, "id", 0.2)
    assert train.count() + held_out.count() == 2000 and 300 < held_out.count() < 500
    assert train.intersect(held_out).count() == 0
