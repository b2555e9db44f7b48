"""Whose failure is it: one bank's, the shared rail's or the platform's."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railwatch.config import AttributionConfig
from railwatch.functions import as_of_time, complement_pct, count_where, csv_list, display_or_none, iso_text, severity

# The four classifications.
SHARED_RAIL, PLATFORM, BANK, HEALTHY = "NPCI_SIDE_ISSUE", "PLATFORM_SIDE_ISSUE", "BANK_SIDE_ISSUE", "HEALTHY"

# Fixed value: text of an alert, with classification, banks and time.
ALERT_TEXT = ":rotating_light: *%s* detected\nAffected: %s\nTime: %s"


def attribute_failures(
    snapshot: DataFrame, cfg: AttributionConfig = AttributionConfig(), *, by: str | None = None, as_of=None
) -> DataFrame:
    """Classifies a snapshot of banks, or each ``by`` group (such as ``window``) of a history.

    A bank fails at ``cfg.failure_rate_pct`` or more. Enough failing banks mean the shared rail; a single one the
    platform when it is also slow, else the bank. A snapshot without rows gives no row. The list of failing banks
    has one entry per bank, as the input has one row per bank and group.
    """
    failing = complement_pct("success_rate_pct") >= cfg.failure_rate_pct
    slow = failing & (F.col("avg_response_time_ms") >= cfg.slow_response_ms)
    groups = snapshot.groupBy(by) if by else snapshot.groupBy()
    counted = groups.agg(
        F.count(F.lit(1)).alias("banks_seen"),
        count_where(failing).alias("failing"),
        count_where(slow).alias("failing_slow"),
        F.collect_list(F.when(failing, F.col("payment_method"))).alias("failing_banks"),
    ).filter("banks_seen > 0")
    only_one = F.col("failing") == 1
    classification = (
        F.when(F.col("failing") >= cfg.shared_rail_banks, SHARED_RAIL)
        .when(only_one & (F.col("failing_slow") == 1), PLATFORM)
        .when(only_one, BANK)
        .otherwise(HEALTHY)
    )
    named = counted.withColumn("classification", classification)
    banks = F.when(F.col("classification") == HEALTHY, F.lit("")).otherwise(csv_list(F.col("failing_banks")))
    key = [by] if by else []
    return named.select(*key, "classification", banks.alias("affected_banks"), iso_text(as_of_time(as_of)).alias("detected_at"))


def bank_history(silver: DataFrame, cfg: AttributionConfig = AttributionConfig()) -> DataFrame:
    """The attribution of every window of the bank methods; a window is dated by its end."""
    banks = silver.filter(F.col("payment_method").isin(*cfg.banks))
    history = attribute_failures(banks, cfg, by="window")
    return history.withColumn("detected_at", iso_text(F.col("window.end")))


def alert_feed(events: DataFrame) -> DataFrame:
    """The events to alert on, with the text of the alert."""
    banks = F.replace("affected_banks", F.lit(","), F.lit(", "))
    message = F.format_string(ALERT_TEXT, "classification", banks, "detected_at")
    return events.filter(F.col("classification") != HEALTHY).select(
        "classification", "affected_banks", "detected_at", message.alias("message")
    )


def with_severity(events: DataFrame) -> DataFrame:
    """Events as a page shows them: severity by classification, 'none' where no bank is affected."""
    return events.withColumns(
        {"severity": severity("classification"), "affected_display": display_or_none("affected_banks")}
    )
