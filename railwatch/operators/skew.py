"""Joins on keys of which a few may hold a large share of all rows.

AQE splits large partitions of a sort-merge join, but not on the side an outer join preserves nothing of, nor in a
full outer join. Here the hot keys are found first, by a pass over the key column alone; only their rows are spread
over several tasks. Without hot keys the join is the plain one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railwatch.config import SkewConfig

_SALT, _FAN, _COLUMNS, _SIDE = "__salt", "__fan", "__columns", "__side"
_GRID = "grid"
#: Hot keys that are broadcast, a few megabytes.
MOST_SENT = 50_000


class HotKey(NamedTuple):
    key: object
    rows: int


def find_hot_keys(key: str, *tables: DataFrame, cfg: SkewConfig = SkewConfig()) -> list[list[HotKey]]:
    """For each table the keys with more rows than one task should take; null counts as a key.

    Runs one job over the key columns. The counts are estimates from a share of the rows; keys close to the limit may
    go either way, which costs time at most. A table has no more hot keys than its rows over ``cfg.rows_per_task``.
    """
    share = min(1.0, cfg.seen_rows / cfg.rows_per_task)
    sampled = [
        df.select(F.col(key).alias("key"), F.lit(i).alias("table")).sample(share, seed=cfg.seed) for i, df in enumerate(tables)
    ]
    counted = reduce(DataFrame.unionByName, sampled).groupBy("table", "key").agg(F.count(F.lit(1)).alias("seen"))
    hot = counted.filter(F.col("seen") > cfg.rows_per_task * share)
    found: list[list[HotKey]] = [[] for _ in tables]
    for row in hot.collect():
        found[row["table"]].append(HotKey(row["key"], round(row["seen"] / share)))
    return found


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    how: str = "inner",
    *,
    left_hot: Sequence[HotKey] = (),
    right_hot: Sequence[HotKey] = (),
    left_salt: Sequence[str] = (),
    right_salt: Sequence[str] = (),
    cfg: SkewConfig = SkewConfig(),
) -> DataFrame:
    """``left.join(right, on, how)`` for inner, left, full, left_semi and left_anti, with hot keys spread.

    Rows of a hot key get one of n salts on the side where the key is hot; the few rows of the other side are
    repeated once per salt. Rows of a key that is hot on both sides are dealt over a grid: a left row has a line and is
    repeated for its columns, a right row has a column and is repeated for its lines, so each pair meets once, in the cell
    where they cross, and a cell holds no more rows of either side than a task takes. The salt is a hash of the row, or of the named salt columns, which the join drops; so a
    task that runs again gives the same one. A repeated row that meets no partner under its salt is dropped: its
    key is on the other side and has partners under another salt. For outer joins that is made sure of first: a hot
    key that the salted side does not hold is joined as any other, so a list found in other rows costs time at most.
    """
    if how not in ("inner", "left", "full", "left_semi", "left_anti"):
        raise ValueError(f"no such join here: {how}")
    if how in ("left_semi", "left_anti"):
        if right_hot:
            right, right_salt = right.select(on).distinct(), ()
        right_hot = ()
    sides = _spread(left_hot, right_hot, cfg)
    if not sides:
        return left.drop(*left_salt).join(right.drop(*right_salt), on, how)

    spread = left.sparkSession.createDataFrame(
        sides,
        T.StructType(
            [
                T.StructField("__key", left.schema[on].dataType),
                T.StructField(_SIDE, T.StringType()),
                T.StructField(_FAN, T.IntegerType()),
                T.StructField(_COLUMNS, T.IntegerType()),
            ]
        ),
    )
    # So few are sent to all tasks; for more keys Spark judges by their size.
    known = F.broadcast if len(sides) <= MOST_SENT else lambda keys: keys
    if how in ("left", "full"):
        held = [_keys_held(df, spread, on, side) for side, df in (("left", left), ("right", right))]
        grid = spread.filter(F.col(_SIDE) == _GRID)
        for df in (left, right):
            grid = _held_by(df, grid, on)
        spread = held[0].unionByName(held[1]).unionByName(grid)
    salted_left = _salt(left, spread, on, "left", left_salt, known)
    salted_right = _salt(right, spread, on, "right", right_salt, known)
    kept_left = [c for c in left.columns if c not in left_salt]
    kept_right = [c for c in right.columns if c not in right_salt]
    if how in ("left_semi", "left_anti"):
        return salted_left.join(salted_right.select(on, _SALT), [on, _SALT], how).select(*kept_left)

    joined = salted_left.withColumnRenamed(_SIDE, "__left_side").withColumn("__in_left", F.lit(True)).join(
        salted_right.withColumnRenamed(_SIDE, "__right_side").withColumn("__in_right", F.lit(True)), [on, _SALT], how
    )
    if how in ("left", "full"):
        copied = lambda side, by: F.coalesce(F.col(side).isin(by, _GRID), F.lit(False))
        lone_copy = (F.col("__in_right").isNull() & copied("__left_side", "right")) | (
            F.col("__in_left").isNull() & copied("__right_side", "left")
        )
        joined = joined.filter(~lone_copy)
    return joined.select(on, *[c for c in kept_left + kept_right if c != on])


def _spread(left_hot, right_hot, cfg: SkewConfig) -> list[tuple]:
    """One (key, side to salt, salts, columns) per hot key; one that is hot on both sides gets a grid of lines and columns.

    A null key has no partners: its rows are salted on their own side and nothing is repeated for it.
    """
    parts = lambda rows: -(-rows // cfg.rows_per_task)
    left, right = ({h.key: parts(h.rows) for h in hot} for hot in (left_hot, right_hot))
    out = [(None, f"{side}-null", hot[None], 1) for side, hot in (("left", left), ("right", right)) if None in hot]
    for key in {**left, **right}:
        if key is None:
            continue
        if key in left and key in right:
            out.append((key, _GRID, left[key], right[key]))
        else:
            out.append((key, "left", left[key], 1) if key in left else (key, "right", right[key], 1))
    return out


def _held_by(df: DataFrame, spread: DataFrame, on: str) -> DataFrame:
    """Those of the keys that the rows hold."""
    keys = df.select(F.col(on).alias("__found")).join(spread.select("__key"), F.col("__found") == F.col("__key"), "left_semi").distinct()
    return spread.join(keys, F.col("__key") == F.col("__found"), "left_semi")


def _keys_held(df: DataFrame, spread: DataFrame, on: str, me: str) -> DataFrame:
    """The hot keys salted on this side that its rows do hold; a null key has no partners, so it stays."""
    mine = spread.filter(F.col(_SIDE).isin(me, f"{me}-null"))
    return _held_by(df, mine, on).unionByName(mine.filter(F.col("__key").isNull()))


def _salt(df: DataFrame, spread: DataFrame, on: str, me: str, salt_by: Sequence[str], known: Callable) -> DataFrame:
    """Adds the salts: own rows of a key salted here get one, rows of a key salted on the other side get all, and those of
    a key in a grid get the cells of their line or column."""
    row_hash = F.xxhash64(*(salt_by or df.columns))
    mine = spread.filter(F.col(_SIDE).isin(me, f"{me}-null") | ~F.col(_SIDE).endswith("null"))
    own = F.pmod(row_hash, F.col(_FAN)).cast("int")
    if me == "left":
        cells = F.transform(F.sequence(F.lit(0), F.col(_COLUMNS) - 1), lambda c: own * F.col(_COLUMNS) + c)
    else:
        column = F.pmod(row_hash, F.col(_COLUMNS)).cast("int")
        cells = F.transform(F.sequence(F.lit(0), F.col(_FAN) - 1), lambda line: line * F.col(_COLUMNS) + column)
    salts = (
        F.when(F.col(_SIDE).isin(me, f"{me}-null"), F.array(own))
        .when(F.col(_SIDE) == _GRID, cells)
        .when(F.col(_SIDE).isNotNull(), F.sequence(F.lit(0), F.col(_FAN) - 1))
        .otherwise(F.array(F.lit(0)))
    )
    return df.join(known(mine), df[on].eqNullSafe(mine["__key"]), "left").select(
        *[df[c] for c in df.columns if c not in salt_by], F.col(_SIDE), F.explode(salts).alias(_SALT)
    )
