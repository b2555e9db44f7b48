"""Data-quality checks of marts and dead-letter tables."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railwatch.functions import count_where
from railwatch.sources.tables import read_if_present


class Check(NamedTuple):
    """``violated`` is true for a bad row; null counts as no violation."""

    name: str
    violated: Column


def not_null(column: str) -> Check:
    return Check(f"{column} has no nulls", F.col(column).isNull())


def between(column: str, low: float | None = None, high: float | None = None) -> Check:
    """Both bounds belong to the range; None leaves that side open."""
    if low is None and high is None:
        raise ValueError("give at least one bound")
    tests = [F.col(column) < low] if low is not None else []
    tests += [F.col(column) > high] if high is not None else []
    bounds = ", ".join("-" if bound is None else str(bound) for bound in (low, high))
    return Check(f"{column} is in [{bounds}]", reduce(Column.__or__, tests))


def at_most(column: str, limit: str) -> Check:
    return Check(f"{column} never exceeds {limit}", F.col(column) > F.col(limit))


def ops_mart_checks() -> list[Check]:
    return [
        not_null("payment_method"),
        not_null("merchant_category"),
        between("total_transactions", 0),
        between("total_volume_inr", 0),
        between("avg_response_time_ms", 0, 60000),
        at_most("success_count", "total_transactions"),
    ]


def recon_mart_checks() -> list[Check]:
    return [
        not_null("merchant_id"),
        between("total_settled_transactions", 0),
        between("delayed_count", 0),
        at_most("delayed_count", "total_settled_transactions"),
    ]


def run_checks(df: DataFrame, table: str, checks: list[Check]) -> DataFrame:
    """One row per check. All checks of a table share one pass over the columns they name."""
    counts = df.agg(*[F.coalesce(count_where(c.violated), F.lit(0)).alias(f"c{i}") for i, c in enumerate(checks)])
    rows = [F.struct(F.lit(c.name).alias("check"), F.col(f"c{i}").alias("violations")) for i, c in enumerate(checks)]
    return counts.select(F.inline(F.array(*rows))).select(
        F.lit(table).alias("table"), "check", "violations", (F.col("violations") == 0).alias("success")
    )


def summarise(results: DataFrame) -> DataFrame:
    return results.groupBy("table").agg(
        count_where(F.col("success")).alias("passed"), F.count(F.lit(1)).alias("checks")
    )


def dlq_status(dlq: DataFrame | None, table: str, spark: SparkSession) -> DataFrame:
    """PASS when the table is empty, ATTENTION when it is not, SKIP when there is none."""
    if dlq is None:
        return spark.range(1).select(
            F.lit(table).alias("table"), F.lit(None).cast("bigint").alias("malformed"), F.lit("SKIP").alias("status")
        )
    counted = dlq.agg(F.count(F.lit(1)).alias("malformed"))
    status = F.when(F.col("malformed") == 0, "PASS").otherwise("ATTENTION")
    return counted.select(F.lit(table).alias("table"), "malformed", status.alias("status"))


def dlq_health(spark: SparkSession, tables: dict[str, str | DataFrame | None], fmt: str = "parquet") -> DataFrame:
    """The status of each dead-letter table of the list, given by its path or its rows."""
    found = {name: read_if_present(spark, t, fmt) if isinstance(t, str) else t for name, t in tables.items()}
    return reduce(DataFrame.unionByName, [dlq_status(dlq, name, spark) for name, dlq in found.items()])
