"""Keys that are hot on both sides of a join."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from railwatch.config import SkewConfig
from railwatch.operators import skew
from railwatch.operators.skew import HotKey, skew_join
from railwatch.sources.tables import ROW_POSITION, read_table, scratch_path
from tests.helpers import rows

CFG = SkewConfig(rows_per_task=100)


def tables(spark, left_hot=450, right_hot=350):
    """Two copies of every row, a key that is hot on both sides, one on each, and rows without a key."""
    key = lambda hot: F.when(F.col("id") < hot, "both").when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("k"), F.col("id") % 50))
    left = spark.range(900).select(key(left_hot).alias("k"), (F.col("id") / 2).cast("int").alias("a"))
    right = spark.range(800).select(key(right_hot).alias("k"), (F.col("id") / 2).cast("int").alias("b"))
    return left, right


@pytest.mark.parametrize("how", ["inner", "left", "full", "left_semi", "left_anti"])
@pytest.mark.parametrize("sizes", [(450, 350), (450, 0), (0, 350), (0, 0)])
def test_grid_gives_the_plain_join(spark, how, sizes):
    """Also where the list is stale and one of the sides, or both, does not hold the key."""
    left, right = tables(spark, *sizes)
    hot = dict(left_hot=[HotKey("both", 450), HotKey(None, 130)], right_hot=[HotKey("both", 350), HotKey("k3", 300), HotKey(None, 100)])
    assert rows(skew_join(left, right, "k", how, cfg=CFG, **hot)) == rows(left.join(right, "k", how))


def test_cells_are_even_and_small(spark):
    left, right = tables(spark)
    left, right = (df.withColumn("n", F.monotonically_increasing_id()) for df in (left, right))
    sides = skew._spread([HotKey("both", 450)], [HotKey("both", 350)], CFG)
    assert sides == [("both", "grid", 5, 4)]
    spread = spark.createDataFrame(sides, "__key string, __side string, __fan int, __columns int")
    counts = {}
    for me, df in (("left", left), ("right", right)):
        salted = skew._salt(df.filter("k = 'both'"), spread, "k", me, ("n",), F.broadcast)
        counts[me] = [r["count"] for r in salted.groupBy("__salt").count().collect()]
    assert len(counts["left"]) == len(counts["right"]) == 20
    assert sum(counts["left"]) == 450 * 4 and sum(counts["right"]) == 350 * 5
    for found in counts.values():
        assert max(found) < 2 * sorted(found)[10]


def test_plan_sends_few_keys_and_leaves_many_to_spark(spark, monkeypatch):
    left, right = tables(spark)
    join = lambda: skew_join(left, right, "k", "inner", left_hot=[HotKey("both", 450)], cfg=CFG)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in join()
    monkeypatch.setattr(skew, "MOST_SENT", 0)
    assert "strategy=broadcast" not in join()


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
def test_row_positions_of_any_format(spark, folder, fmt):
    """Copies of a row get positions of their own, the same in every run."""
    spark.range(500).selectExpr("1 AS id").repartition(3).write.format(fmt).save(f"{folder}/t")
    read = lambda: [r[ROW_POSITION] for r in read_table(spark, f"{folder}/t", fmt, row_position=True).collect()]
    first = read()
    assert len(set(first)) == 500 and sorted(read()) == sorted(first)


def test_scratch_folder_must_be_shared(spark):
    class Elsewhere:
        """A session of a cluster."""

        class conf:  # noqa: N801
            get = staticmethod(lambda name, default=None: "file:/tmp/warehouse" if "warehouse" in name else None)

        class sparkContext:  # noqa: N801
            master = "spark://somewhere:7077"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(Elsewhere, "x")
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
