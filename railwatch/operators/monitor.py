"""Health of the streams themselves: lag and age of their last progress."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railwatch.config import MonitorConfig
from railwatch.functions import age_minutes, as_of_time, iso_text, number_text

# Texts of the alerts.
CRITICAL_LAG_TEXT = ":rotating_light: CRITICAL Kafka lag on `%s`: %d messages. Restarting `%s` with increased parallelism."
ELEVATED_LAG_TEXT = ":warning: Elevated Kafka lag on `%s`: %d messages."
STALE_TEXT = ":rotating_light: Streaming job `%s` appears %s (last checkpoint %s min ago). Attempting automatic restart."


def lag_severity(lags: DataFrame, cfg: MonitorConfig = MonitorConfig()) -> DataFrame:
    """``group_id, lag`` per partition to one row per group.

    A group without any lag has lag 0; a negative lag means it could not be read, so the group is UNKNOWN and
    raises no alarm.
    """
    total = F.when(F.min("lag") < 0, F.lit(-1)).otherwise(F.coalesce(F.sum("lag"), F.lit(0)))
    lag = F.col("total_lag")
    level = (
        F.when(lag < 0, "UNKNOWN").when(lag > cfg.lag_critical, "CRITICAL").when(lag > cfg.lag_alert, "ALERT").otherwise("OK")
    )
    return lags.groupBy("group_id").agg(total.cast("bigint").alias("total_lag")).withColumn("severity", level)


def lag_alerts(severities: DataFrame) -> DataFrame:
    """The text of each alert. ``stream_name``, where there is one, names the stream that reads for the group."""
    stream = "stream_name" if "stream_name" in severities.columns else "group_id"
    message = F.when(F.col("severity") == "CRITICAL", F.format_string(CRITICAL_LAG_TEXT, "group_id", "total_lag", stream)).when(
        F.col("severity") == "ALERT", F.format_string(ELEVATED_LAG_TEXT, "group_id", "total_lag")
    )
    return severities.filter(F.col("severity").isin("ALERT", "CRITICAL")).withColumn("message", message)


def stream_lag(streams: DataFrame, lags: DataFrame, cfg: MonitorConfig = MonitorConfig()) -> DataFrame:
    """One row per monitored stream from the lags of its partitions; one that reports nothing is UNKNOWN."""
    known = lag_severity(lags, cfg).withColumnRenamed("group_id", "stream_name")
    rows = streams.join(known, "stream_name", "left")
    return rows.select(
        "stream_name",
        F.coalesce("total_lag", F.lit(-1)).cast("bigint").alias("total_lag"),
        F.coalesce("severity", F.lit("UNKNOWN")).alias("severity"),
    )


def staleness_alerts(states: DataFrame) -> DataFrame:
    """The text of each stream that is stale or was never seen."""
    text = F.format_string(STALE_TEXT, "stream_name", "status", number_text("age_minutes"))
    return states.filter(F.col("status") != "HEALTHY").withColumn("message", text)


def stream_staleness(streams: DataFrame, progress: DataFrame, *, as_of=None, cfg: MonitorConfig = MonitorConfig()) -> DataFrame:
    """The state of each monitored stream.

    ``streams`` has ``stream_name``; ``progress`` has ``stream_name, progress_time``, as ``checkpoint_times`` gives it.
    """
    latest = progress.groupBy("stream_name").agg(F.max("progress_time").alias("latest"))
    now = as_of_time(as_of)
    age = age_minutes(now, F.col("latest"))
    status = (
        F.when(F.col("latest").isNull(), "NO_CHECKPOINT_FOUND").when(age > cfg.stale_minutes, "STALE").otherwise("HEALTHY")
    )
    return streams.join(latest, "stream_name", "left").select(
        "stream_name", status.alias("status"), age.alias("age_minutes"), iso_text(now).alias("checked_at")
    )
