"""Connected components of a graph given as pairs of numbers, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railwatch.sources.tables import store


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the smallest node in it) for every node of ``edges`` (columns a, b).

    Each round links every node to its smallest neighbour and is written to the shared folder; rounds end when nothing
    changes. Smallest neighbours are aggregated before the shuffle, and plain joins let Spark split the rows of a node
    with very many neighbours.
    """
    edges = store(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = store(small.unionAll(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            roots = edges.select("b").distinct()
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots.select(F.col("b").alias("node"), F.col("b").alias("component")))
        before = state
