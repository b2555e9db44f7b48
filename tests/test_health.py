from __future__ import annotations

import re
import statistics
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from railwatch.config import BANK_METHODS, WindowConfig
from railwatch.operators.health import (
    bank_health,
    closed_windows,
    dated_windows,
    health_of_sketches,
    latency_sketches,
    latest_snapshot,
    merge_sketches,
    newest_windows,
    window_features,
    window_health,
)
from tests.helpers import SILVER, at, rows, txn


def sample(spark):
    items = []
    for i in range(400):
        items.append(
            dict(
                transaction_id=str(i),
                payment_method=["upi_hdfc", "upi_axis", "gpay"][i % 3],
                status=["success", "success", "failed", "timeout"][(i * 7) % 4],
                response_time_ms=None if i % 11 == 0 else (i * 37) % 900,
                event_time=at("10:00:00") + timedelta(seconds=(i * 53) % 3600),
            )
        )
    return txn(spark, *items)


@pytest.mark.parametrize("length,slide", [("5 minutes", "1 minute"), ("10 minutes", "4 minutes"), ("90 seconds", "60 seconds")])
def test_slots_give_the_same_as_plain_sliding_windows(spark, length, slide):
    txns = sample(spark)
    plain = txns.groupBy(F.window("event_time", length, slide), "payment_method").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("status") == "success").alias("good"),
        F.count_if(F.col("status") == "timeout").alias("late"),
        F.avg("response_time_ms").alias("latency"),
    )
    expected = plain.select(
        "window", "payment_method", "n", "good", "late", "latency", F.col("good") / F.col("n") * 100, F.col("late") / F.col("n") * 100
    )
    assert rows(window_health(txns, WindowConfig(length, slide))) == rows(expected)


def test_tumbling_windows(spark):
    txns = sample(spark)
    got = window_health(txns, WindowConfig("10 minutes"), tumbling=True)
    assert got.agg(F.sum("total_transactions")).first()[0] == 400
    assert got.select(F.countDistinct("window")).first()[0] == 6


@pytest.mark.parametrize("length", ["500 milliseconds", "90500 milliseconds", "0 seconds"])
def test_windows_are_whole_seconds(spark, length):
    with pytest.raises(ValueError):
        window_health(txn(spark, {}), WindowConfig(length))


def test_rows_without_event_time_are_in_no_window(spark):
    txns = txn(spark, dict(event_time=None), dict(transaction_id="1"))
    assert window_health(txns).agg(F.sum("total_transactions")).first()[0] == 5


def test_window_without_any_latency(spark):
    row = window_health(txn(spark, dict(response_time_ms=None)), tumbling=True).first()
    assert row.avg_response_time_ms is None and row.success_rate_pct == 100.0


def test_closed_windows(spark):
    health = window_health(txn(spark, dict(event_time=at("10:03:30"))))
    closed = closed_windows(health, WindowConfig(), F.lit(at("10:06:00")))
    assert [r.window.end for r in closed.orderBy("window").collect()] == [at("10:04:00"), at("10:05:00")]


def test_bank_health_percentiles_match_the_built_in(spark):
    txns = sample(spark)
    got = bank_health(txns, probs=(0.5, 0.95))
    bucket = F.date_trunc("hour", "event_time")
    expected = txns.groupBy("payment_method", bucket).agg(
        F.count("*"),
        F.count_if(F.col("status") == "success"),
        F.avg("response_time_ms"),
        F.percentile_approx("response_time_ms", 0.5, 1_000_000),
        F.percentile_approx("response_time_ms", 0.95, 1_000_000),
        F.count_if(F.col("status") == "success") / F.count("*") * 100,
    )
    assert rows(got) == rows(expected)


def test_bank_health_without_latency(spark):
    row = bank_health(txn(spark, dict(response_time_ms=None), dict(response_time_ms=None))).first()
    assert (row.total_transactions, row.avg_response_time_ms, row.p50_response_time_ms) == (2, None, None)


def silver(spark, *items):
    data = [((at(s), at(e)), m, 10, rate, latency, 0.0) for s, e, m, rate, latency in items]
    return spark.createDataFrame(data, SILVER)


def test_latest_snapshot_takes_each_methods_own_newest_window(spark):
    table = silver(
        spark,
        ("10:00:00", "10:05:00", "upi_hdfc", 50.0, 1.0),
        ("10:01:00", "10:06:00", "upi_hdfc", 90.0, 2.0),
        ("10:00:00", "10:05:00", "upi_axis", 70.0, 3.0),
        ("10:02:00", "10:07:00", "gpay", 10.0, 4.0),
    )
    got = {r.payment_method: (r.window.end, r.success_rate_pct) for r in latest_snapshot(table).collect()}
    assert got == {"upi_hdfc": (at("10:06:00"), 90.0), "upi_axis": (at("10:05:00"), 70.0)}
    fresh = latest_snapshot(table, None, max_age="1 minute", as_of=at("10:07:00"))
    assert {r.payment_method for r in fresh.collect()} == {"upi_hdfc", "gpay"}


def test_latest_snapshot_of_nothing(spark):
    assert latest_snapshot(spark.createDataFrame([], SILVER)).count() == 0


def test_volume_zscore_against_brute_force(spark):
    volumes, start = {}, at("10:00:00")
    items = []
    for i in range(60):
        # Gaps, and stretches of time apart from each other.
        moment = start + timedelta(minutes=5 * i + (i // 20) * 3000)
        volumes[moment] = 1 + (i * i) % 7
        items += [dict(transaction_id=f"{i}-{k}", event_time=moment) for k in range(volumes[moment])]
    cfg = WindowConfig("5 minutes", "5 minutes")
    got = {r.window_start: r.volume_zscore for r in window_features(txn(spark, *items), cfg=cfg, baseline_windows=4).collect()}
    assert len(got) == 60
    for moment, n in volumes.items():
        past = [v for m, v in volumes.items() if moment - timedelta(minutes=20) <= m < moment]
        spread = statistics.stdev(past) if len(past) > 1 else 0
        assert got[moment] == pytest.approx((n - statistics.mean(past)) / spread if spread else 0.0)


def test_features_of_one_window(spark):
    txns = txn(
        spark,
        dict(payment_method="upi_hdfc", status="failed", response_time_ms=100),
        dict(payment_method="upi_hdfc", response_time_ms=300),
        dict(payment_method="gpay", status="timeout", response_time_ms=None),
        dict(payment_method="upi_axis", response_time_ms=200),
    )
    row = window_features(txns, tumbling=True).first()
    assert row[2:] == (50.0, 200.0, 0.0, 25.0, 50.0)


def test_percentile_ranks_are_exact(spark):
    txns = spark.range(100).selectExpr(
        "'m' AS payment_method", "'success' AS status", "CAST(id + 1 AS int) AS response_time_ms", "timestamp'2024-01-01 10:00:00' AS event_time"
    )
    row = bank_health(txns, probs=(0.55, 0.995, 0.999)).first()
    assert (row.p55_response_time_ms, row.p99_5_response_time_ms, row.p99_9_response_time_ms) == (55, 100, 100)


def test_newest_windows_of_a_dated_table_read_one_date(spark, folder):
    days = ("2024-01-01", "2024-01-02", "2024-01-03")
    moments = [(m, f"{d} 10:00:00") for d in days for m in BANK_METHODS]
    data = txn(spark, *[dict(payment_method=m, event_time=at(t)) for m, t in moments])
    silver = window_health(data)
    dated_windows(silver).write.partitionBy("window_date").parquet(f"{folder}/all")
    got = newest_windows(spark, f"{folder}/all")
    assert rows(got) == rows(latest_snapshot(silver))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == len(re.findall(r"PartitionFilters: \[[^\]]*window_date#\d+ = 2024-01-03", plan)) > 0
    # A bank that was silent on the last day comes from the days before.
    some = silver.filter("NOT (payment_method = 'upi_sbi' AND window.end > '2024-01-02')")
    dated_windows(some).write.partitionBy("window_date").parquet(f"{folder}/some")
    assert rows(newest_windows(spark, f"{folder}/some")) == rows(latest_snapshot(some))
    # A table without dates is read whole.
    some.write.parquet(f"{folder}/plain")
    assert rows(newest_windows(spark, f"{folder}/plain")) == rows(latest_snapshot(some))
    assert newest_windows(spark, f"{folder}/some", ("nobody",)).count() == 0


def test_sketches_merge_into_days(spark):
    """Ranks of days put together from hours; a bucket without latencies has no percentiles."""
    data = spark.range(24_000).selectExpr(
        "'upi_hdfc' AS payment_method", "timestamp'2024-01-01' + make_interval(0, 0, 0, 0, 0, 0, id * 3.6) AS event_time",
        "IF(id % 4 = 0, 'failed', 'success') AS status", "CAST(id * 7919 % 24000 AS int) AS response_time_ms",
    )
    silent = txn(spark, dict(payment_method="upi_axis", response_time_ms=None))
    data = data.unionByName(silent.select(*data.columns))
    daily = {r.bank: r for r in health_of_sketches(merge_sketches(latency_sketches(data))).collect()}
    day = daily["upi_hdfc"]
    assert (day.total_transactions, day.success_rate_pct, day.avg_response_time_ms) == (24_000, 75.0, 11_999.5)
    assert abs(day.p50_response_time_ms - 12_000) < 600 and abs(day.p95_response_time_ms - 22_800) < 600
    assert (daily["upi_axis"].p50_response_time_ms, daily["upi_axis"].avg_response_time_ms) == (None, None)
