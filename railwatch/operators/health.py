"""Health of payment methods over windows of event time."""

from __future__ import annotations

from decimal import Decimal

from math import gcd

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from railwatch.config import BANK_METHODS, WindowConfig
from railwatch.functions import as_of_time, complement_pct, count_where, rate_pct
from railwatch.sources.tables import read_table

SUCCESS, TIMEOUT = "success", "timeout"
WINDOW_DATE = "window_date"
#: Size of a quantile sketch, and the error of its ranks (1.33 % of all rows at 200, a little more after merges).
SKETCH_K, SKETCH_RANK_ERROR = 400, 0.01


def _seconds(duration: str) -> int:
    seconds = pd.Timedelta(duration).total_seconds()
    if seconds < 1 or seconds != int(seconds):
        raise ValueError(f"not whole seconds: {duration}")
    return int(seconds)


def _measures() -> list[Column]:
    latency = F.col("response_time_ms")
    return [
        F.count(F.lit(1)).alias("total_transactions"),
        count_where(F.col("status") == SUCCESS).alias("success_count"),
        count_where(F.col("status") == TIMEOUT).alias("timeout_count"),
        F.sum(latency.cast("bigint")).alias("latency_sum"),
        F.count(latency).alias("latency_rows"),
    ]


_SUMS = ("total_transactions", "success_count", "timeout_count", "latency_sum", "latency_rows")


def _window_sums(txns: DataFrame, cfg: WindowConfig, tumbling: bool) -> DataFrame:
    """Sums per (window, method).

    A sliding window would copy every event once per window it is in. Here events are first added up in slots of
    the greatest common divisor of length and slide, which no window cuts, and only the slots are copied.
    """
    length, slide = _seconds(cfg.length), _seconds(cfg.length if tumbling else cfg.slide)
    slot = gcd(length, slide)
    slots = txns.groupBy(F.window("event_time", f"{slot} seconds").alias("window"), "payment_method").agg(*_measures())
    if slot == length:
        return slots
    return (
        slots.select(F.col("window.start").alias("slot"), "payment_method", *_SUMS)
        .groupBy(F.window("slot", f"{length} seconds", f"{slide} seconds").alias("window"), "payment_method")
        .agg(*[F.sum(c).alias(c) for c in _SUMS])
    )


def _with_rates(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "success_rate_pct": rate_pct("success_count", "total_transactions"),
            "timeout_rate_pct": rate_pct("timeout_count", "total_transactions"),
        }
    )


def window_health(txns: DataFrame, cfg: WindowConfig = WindowConfig(), *, tumbling: bool = False) -> DataFrame:
    """Counts, mean latency and rates per window and payment method, for batches and streams.

    A stream needs its watermark before; each window comes out once the watermark has passed its end. Rows without
    event time are in no window.
    """
    if txns.isStreaming:
        slide = None if tumbling else cfg.slide
        counted = txns.groupBy(F.window("event_time", cfg.length, slide).alias("window"), "payment_method").agg(*_measures())
    else:
        counted = _window_sums(txns, cfg, tumbling)
    latency = F.when(F.col("latency_rows") > 0, F.col("latency_sum") / F.col("latency_rows"))
    counted = counted.select(
        "window", "payment_method", "total_transactions", "success_count", "timeout_count", latency.alias("avg_response_time_ms")
    )
    return _with_rates(counted)


def closed_windows(health: DataFrame, cfg: WindowConfig, newest: Column) -> DataFrame:
    """The windows a stream that has seen events up to ``newest`` has emitted."""
    return health.filter(F.col("window.end") <= newest - F.expr(f"INTERVAL {_seconds(cfg.watermark)} SECONDS"))


def _percentile_name(p: float | Decimal) -> str:
    return f"p{Decimal(str(p)) * 100:f}".rstrip("0").rstrip(".").replace(".", "_")


def bank_health(txns: DataFrame, unit: str = "hour", probs: tuple[float, ...] = (0.5, 0.95)) -> DataFrame:
    """Counts, success rate, mean and percentiles of latency per method and time bucket.

    Percentiles are exact discrete ones. Latency is whole milliseconds, so rows are first counted per (method, bucket,
    latency), which is hash-aggregated before the shuffle; the ranks then run over distinct latencies, however many
    rows a bucket holds.
    """
    histogram = txns.groupBy(
        F.col("payment_method").alias("bank"),
        F.date_trunc(unit, "event_time").alias(f"{unit}_bucket"),
        F.col("response_time_ms"),
    ).agg(F.count(F.lit(1)).alias("rows"), count_where(F.col("status") == SUCCESS).alias("successes"))

    bucket = Window.partitionBy("bank", f"{unit}_bucket")
    known = F.when(F.col("response_time_ms").isNotNull(), F.col("rows"))
    ranked = histogram.withColumns(
        {
            "rank": F.sum(known).over(bucket.orderBy("response_time_ms").rowsBetween(Window.unboundedPreceding, 0)),
            "known_rows": F.sum(known).over(bucket),
        }
    )
    latency_sum = F.sum(F.col("response_time_ms").cast("bigint") * F.col("rows"))
    percentiles = [
        F.min(F.when(F.col("rank") >= F.ceil(F.col("known_rows") * F.lit(p)), F.col("response_time_ms"))).alias(
            f"{_percentile_name(p)}_response_time_ms"
        )
        # As decimals: the rank of a double such as 0.55 of 100 rows would be one too high.
        for p in (Decimal(str(p)) for p in probs)
    ]
    out = ranked.groupBy("bank", f"{unit}_bucket").agg(
        F.sum("rows").alias("total_transactions"),
        F.sum("successes").alias("success_count"),
        (latency_sum / F.max("known_rows")).alias("avg_response_time_ms"),
        *percentiles,
    )
    return out.withColumn("success_rate_pct", rate_pct("success_count", "total_transactions"))


def latency_sketches(txns: DataFrame, unit: str = "hour", k: int = SKETCH_K) -> DataFrame:
    """Counts and a quantile sketch of latency per method and time bucket: a mart that can be merged into longer buckets
    (``merge_sketches``) without its rows. A sketch is a few kilobytes, however many rows it stands for."""
    return txns.groupBy(F.col("payment_method").alias("bank"), F.date_trunc(unit, "event_time").alias("bucket")).agg(
        F.count(F.lit(1)).alias("total_transactions"),
        count_where(F.col("status") == SUCCESS).alias("success_count"),
        F.sum(F.col("response_time_ms").cast("bigint")).alias("latency_sum"),
        F.count("response_time_ms").alias("latency_rows"),
        F.kll_sketch_agg_bigint(F.col("response_time_ms").cast("bigint"), F.lit(k)).alias("latency_sketch"),
    )


def merge_sketches(sketches: DataFrame, unit: str = "day") -> DataFrame:
    """The buckets of ``latency_sketches`` put together into longer ones."""
    sums = [F.sum(c).alias(c) for c in ("total_transactions", "success_count", "latency_sum", "latency_rows")]
    merged = F.kll_merge_agg_bigint("latency_sketch").alias("latency_sketch")
    return sketches.groupBy("bank", F.date_trunc(unit, "bucket").alias("bucket")).agg(*sums, merged)


def health_of_sketches(sketches: DataFrame, probs: tuple[float, ...] = (0.5, 0.95)) -> DataFrame:
    """What ``bank_health`` gives, with percentiles whose rank is off by ``SKETCH_RANK_ERROR`` at most in 99 of 100 sketches."""
    percentiles = [
        F.when(F.col("latency_rows") > 0, F.kll_sketch_get_quantile_bigint("latency_sketch", F.lit(p))).alias(f"{_percentile_name(p)}_response_time_ms")
        for p in probs
    ]
    return sketches.select(
        "bank",
        "bucket",
        "total_transactions",
        "success_count",
        F.when(F.col("latency_rows") > 0, F.col("latency_sum") / F.col("latency_rows")).alias("avg_response_time_ms"),
        *percentiles,
        rate_pct("success_count", "total_transactions").alias("success_rate_pct"),
    )


def newest_windows(spark: SparkSession, path: str, methods: tuple[str, ...] = BANK_METHODS, fmt: str = "parquet") -> DataFrame:
    """``latest_snapshot`` of a stored table of windows.

    Of a table parted by ``window_date`` (``dated_windows``) the newest date is known from the names of its files, and only
    it is read. Methods without a window on that date are looked for in the dates before, in one go.
    """
    silver = read_table(spark, path, fmt)
    if WINDOW_DATE not in silver.columns:
        return latest_snapshot(silver, methods)
    dates = {part for file in silver.inputFiles() for part in file.split("/") if part.startswith(f"{WINDOW_DATE}=")}
    if not dates:
        return latest_snapshot(silver.drop(WINDOW_DATE), methods)
    newest = F.lit(max(dates).split("=")[1]).cast("date")
    today = silver.filter(F.col(WINDOW_DATE) == newest).drop(WINDOW_DATE)
    # At most one row per method.
    seen = {r["payment_method"] for r in today.filter(F.col("payment_method").isin(*methods)).select("payment_method").distinct().collect()}
    missing = tuple(m for m in methods if m not in seen)
    found = latest_snapshot(today, methods)
    if not missing or len(dates) == 1:
        return found
    before = silver.filter(F.col(WINDOW_DATE) < newest).drop(WINDOW_DATE)
    return found.unionByName(latest_snapshot(before, missing))


def dated_windows(silver: DataFrame) -> DataFrame:
    """Windows with the date of their end, to part their table by."""
    return silver.withColumn(WINDOW_DATE, F.to_date("window.end"))


def latest_snapshot(
    silver: DataFrame, methods: tuple[str, ...] | None = BANK_METHODS, *, max_age: str | None = None, as_of=None
) -> DataFrame:
    """The newest window of each payment method.

    Windows are unique per method, so the newest row is taken column by column with ``max_by`` over the window end:
    one hash aggregation, combined before the shuffle, instead of a self-join or a sort of all windows of a method.
    ``max_age`` leaves out methods whose newest window is older.
    """
    if methods is not None:
        silver = silver.filter(F.col("payment_method").isin(*methods))
    end = F.col("window.end")
    if max_age:
        silver = silver.filter(end >= as_of_time(as_of) - F.expr(f"INTERVAL {_seconds(max_age)} SECONDS"))
    newest = lambda c: F.max_by(c, end)
    values = ("total_transactions", "success_rate_pct", "avg_response_time_ms", "timeout_rate_pct")
    latest = silver.groupBy("payment_method").agg(
        newest(F.col("window.start")).alias("start"), F.max(end).alias("end"), *[newest(F.col(c)).alias(c) for c in values]
    )
    return latest.select("payment_method", F.struct("start", "end").alias("window"), *values)


def window_features(
    txns: DataFrame,
    banks: tuple[str, ...] = BANK_METHODS,
    cfg: WindowConfig = WindowConfig(),
    *,
    baseline_windows: int = 12,
    tumbling: bool = False,
) -> DataFrame:
    """One row of five features per window over all methods: the input of the anomaly model.

    ``volume_zscore`` compares a window with the windows started in the ``baseline_windows`` slides before it; it is
    0 where they are fewer than two or all alike.
    """
    counted = _window_sums(txns, cfg, tumbling)
    failure = complement_pct(rate_pct("success_count", "total_transactions"))
    per_window = counted.groupBy("window").agg(
        *[F.sum(c).alias(c) for c in _SUMS],
        F.max(F.when(F.col("payment_method").isin(*banks), failure)).alias("worst_bank"),
    )
    step = _seconds(cfg.length if tumbling else cfg.slide)
    scored = _volume_zscore(per_window, step, baseline_windows)
    return scored.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        rate_pct("success_count", "total_transactions").alias("success_rate_pct"),
        F.when(F.col("latency_rows") > 0, F.col("latency_sum") / F.col("latency_rows")).alias("avg_response_time_ms"),
        "volume_zscore",
        rate_pct("timeout_count", "total_transactions").alias("timeout_rate_pct"),
        F.coalesce("worst_bank", F.lit(0.0)).alias("max_single_bank_failure_rate"),
    )


FEATURES = (
    "success_rate_pct",
    "avg_response_time_ms",
    "volume_zscore",
    "timeout_rate_pct",
    "max_single_bank_failure_rate",
)


def _volume_zscore(per_window: DataFrame, step: int, baseline_windows: int) -> DataFrame:
    """Adds ``volume_zscore``.

    The series has no key to partition by, so it is cut into stretches of time. Each window also goes, as context, to
    the stretch after its own; a stretch is at least as long as the baseline, so no row misses its past.
    """
    reach = step * baseline_windows
    stretch = max(reach, 86_400)
    start = F.unix_micros(F.col("window.start").cast("timestamp")) / 1_000_000
    own = F.floor(start / stretch)
    placed = per_window.withColumns({"start_s": start.cast("bigint"), "own": own}).select(
        "*", F.posexplode(F.array("own", F.col("own") + 1)).alias("is_context", "stretch")
    )
    past = Window.partitionBy("stretch").orderBy("start_s").rangeBetween(-reach, -1)
    volume = F.col("total_transactions")
    mean, spread = F.avg(volume).over(past), F.stddev_samp(volume).over(past)
    zscore = F.when(spread > 0, (volume - mean) / spread).otherwise(F.lit(0.0))
    return placed.withColumn("volume_zscore", zscore).filter(F.col("is_context") == 0)
