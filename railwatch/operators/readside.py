"""What dashboards and reports ask of the marts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railwatch.functions import band, display_or_none, rate_pct, safe_rate_pct

# Texts of the reports.
OPS_TEXT = "Total transactions: %d, success rate: %s%%, total volume: ₹%s"
SETTLEMENT_TEXT = "Total settled: %d, delayed: %d (%s%%), amount discrepancy: ₹%s"
EVENT_TEXT = "%s: %s (banks: %s)"
NO_EVENTS_TEXT = "No correlation events recorded."


def _total(c: str) -> Column:
    return F.coalesce(F.sum(c), F.lit(0))


def kpi_ops(mart: DataFrame) -> DataFrame:
    """Totals over the ops mart; an empty mart gives zeros."""
    totals = mart.agg(
        _total("total_transactions").cast("bigint").alias("total_transactions"),
        _total("success_count").cast("bigint").alias("success_count"),
        _total("total_volume_inr").cast("double").alias("total_volume_inr"),
    )
    return totals.withColumn("success_rate_pct", safe_rate_pct("success_count", "total_transactions"))


def kpi_by_method(mart: DataFrame, weighted: bool = False) -> DataFrame:
    """Totals per payment method with the band of the success rate.

    Latency is the mean of the mart rows' means; ``weighted`` weighs each by its transactions. Here and below, rows
    without the grouping value are left out.
    """
    latency = F.avg("avg_response_time_ms")
    if weighted:
        known = F.when(F.col("avg_response_time_ms").isNotNull(), F.col("total_transactions"))
        latency = F.sum(F.col("avg_response_time_ms") * known) / F.sum(known)
    totals = mart.filter(F.col("payment_method").isNotNull()).groupBy("payment_method").agg(
        F.sum("total_transactions").alias("total_transactions"),
        F.sum("success_count").alias("success_count"),
        latency.alias("avg_response_time_ms"),
    )
    rated = totals.withColumn("success_rate_pct", rate_pct("success_count", "total_transactions"))
    return rated.withColumn("band", band("success_rate_pct"))


def volume_by(mart: DataFrame, column: str = "merchant_category") -> DataFrame:
    """Volume per value of a column, 0 where all amounts are unknown."""
    return mart.filter(F.col(column).isNotNull()).groupBy(column).agg(_total("total_volume_inr").alias("total_volume_inr"))


def health_pivot(mart: DataFrame, dates: list[date] | None = None, prefix: str = "upi_") -> DataFrame:
    """Successes with one row per bank and one column per day, 0 where there were none.

    Without ``dates`` Spark first lists the days of the mart.
    """
    banks = mart.filter(F.col("payment_method").startswith(prefix))
    return banks.groupBy("payment_method").pivot("event_date", dates).agg(F.sum("success_count")).na.fill(0)


def kpi_settlement(mart: DataFrame) -> DataFrame:
    totals = mart.agg(
        _total("total_settled_transactions").cast("bigint").alias("total_settled_transactions"),
        _total("delayed_count").cast("bigint").alias("delayed_count"),
        _total("amount_discrepancy").cast("double").alias("amount_discrepancy"),
    )
    on_time = F.col("total_settled_transactions") - F.col("delayed_count")
    return totals.withColumns(
        {
            "match_rate_pct": safe_rate_pct(on_time, "total_settled_transactions"),
            "delay_rate_pct": safe_rate_pct("delayed_count", "total_settled_transactions"),
        }
    )


def top_merchants(mart: DataFrame, n: int = 15) -> DataFrame:
    """The merchants with the largest discrepancy; one whose amounts are all unknown counts as 0."""
    known = mart.filter(F.col("merchant_id").isNotNull())
    totals = known.groupBy("merchant_id").agg(_total("amount_discrepancy").alias("amount_discrepancy"))
    return totals.orderBy(F.desc("amount_discrepancy"), "merchant_id").limit(n)


def recent(df: DataFrame, time_column: str = "detected_at", n: int | None = None, ties: tuple[str, ...] = ()) -> DataFrame:
    """Newest first; ``n`` keeps the newest n. ``ties`` orders rows of the same time."""
    ordered = df.orderBy(F.desc(time_column), *ties)
    return ordered if n is None else ordered.limit(n)


def ops_summary(kpi: DataFrame) -> DataFrame:
    """The one-line text of ``kpi_ops``."""
    rate, volume = F.format_number("success_rate_pct", 2), F.format_number("total_volume_inr", 0)
    return kpi.select(F.format_string(OPS_TEXT, "total_transactions", rate, volume).alias("summary"))


def settlement_summary(kpi: DataFrame) -> DataFrame:
    """The one-line text of ``kpi_settlement``."""
    rate, gap = F.format_number("delay_rate_pct", 1), F.format_number("amount_discrepancy", 0)
    text = F.format_string(SETTLEMENT_TEXT, "total_settled_transactions", "delayed_count", rate, gap)
    return kpi.select(text.alias("summary"))


def event_lines(events: DataFrame) -> DataFrame:
    """One line of text per classification event."""
    line = F.format_string(EVENT_TEXT, "detected_at", "classification", display_or_none("affected_banks"))
    return events.select("detected_at", line.alias("line"))


def events_text(events: DataFrame, n: int = 5) -> DataFrame:
    """One row: the lines of the newest ``n`` events, newest first, or a text that says there are none."""
    newest = event_lines(recent(events, n=n, ties=("classification", "affected_banks")))
    newest_first = lambda a, b: F.when(a["detected_at"] > b["detected_at"], -1).when(a["detected_at"] < b["detected_at"], 1).when(
        a["line"] < b["line"], -1
    ).when(a["line"] > b["line"], 1).otherwise(0)
    lines = F.array_sort(F.collect_list(F.struct("detected_at", "line")), newest_first)
    text = F.array_join(F.transform(lines, lambda r: r["line"]), "\n")
    return newest.agg(F.coalesce(F.nullif(text, F.lit("")), F.lit(NO_EVENTS_TEXT)).alias("text"))


def latest_report(reports: DataFrame) -> DataFrame:
    return recent(reports, "generated_at", 1, ("report",))
