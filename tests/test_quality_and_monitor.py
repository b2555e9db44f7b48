from __future__ import annotations

import json
from datetime import timedelta

import pytest

from railwatch import schemas
from railwatch.config import MonitorConfig
from railwatch.operators import monitor, quality
from railwatch.sources.progress import checkpoint_times, lag_from_listing, lag_from_progress
from railwatch.sources.tables import append_json_log, read_or_empty
from tests.helpers import at, rows


def test_checks(spark):
    df = spark.createDataFrame([(1, 5, "a"), (None, 5, None), (-1, None, "b"), (9, 5, "c")], "x int, y int, s string")
    checks = [
        quality.not_null("s"),
        quality.between("x", 0),
        quality.between("x", None, 8),
        quality.between("x", 0, 8),
        quality.at_most("x", "y"),
        quality.between("y", 5, 5),
    ]
    got = quality.run_checks(df, "t", checks).collect()
    assert [r.violations for r in got] == [1, 1, 1, 2, 1, 0]
    assert [r.success for r in got] == [False] * 5 + [True]
    assert {r.table for r in got} == {"t"} and got[1].check == "x is in [0, -]"
    assert rows(quality.summarise(quality.run_checks(df, "t", checks))) == [("t", 1, 6)]


def test_empty_table_passes_every_check(spark):
    for schema, checks in ((schemas.MART_OPS, quality.ops_mart_checks()), (schemas.MART_RECON, quality.recon_mart_checks())):
        got = quality.run_checks(spark.createDataFrame([], schema), "t", checks)
        assert [r.violations for r in got.collect()] == [0] * len(checks)


def test_a_range_needs_a_bound():
    with pytest.raises(ValueError):
        quality.between("x")


def test_checks_of_a_table_share_one_pass(spark):
    df = spark.range(10).selectExpr("id AS x", "id AS y")
    plan = quality.run_checks(df, "t", [quality.not_null("x"), quality.at_most("x", "y")])
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("Range (") == 1


def test_dlq_health(spark, folder):
    row = spark.createDataFrame([("x", at("10:00:00"))], schemas.DLQ)
    row.write.parquet(f"{folder}/full")
    row.limit(0).write.parquet(f"{folder}/empty")
    got = quality.dlq_health(spark, {n: f"{folder}/{n}" for n in ("full", "empty", "absent")})
    assert rows(got) == [("absent", None, "SKIP"), ("empty", 0, "PASS"), ("full", 1, "ATTENTION")]


def test_missing_table_is_empty_but_other_errors_are_raised(spark, folder):
    assert read_or_empty(spark, f"{folder}/absent", schemas.DLQ).collect() == []
    with pytest.raises(Exception, match="no_such_format"):
        read_or_empty(spark, folder, schemas.DLQ, fmt="no_such_format")


LINES = [
    ("g1", "TOPIC PARTITION CURRENT-OFFSET LOG-END-OFFSET LAG"),
    ("g1", "  transactions   0   100   3100   3000  consumer-1"),
    ("g1", "transactions 1 0 2000 2000"),
    ("g2", "transactions 0 0 5001 5001"),
    ("g3", "transactions 0 0 20000 20000"),
    ("g4", "transactions 0 0 20001 20001"),
    ("g5", None),
    ("g6", "no such group"),
    ("g7", "transactions 0 - 50 -"),
]


def test_lag_listing(spark):
    lags = lag_from_listing(spark.createDataFrame(LINES, "group_id string, line string"))
    severities = monitor.lag_severity(lags)
    assert rows(severities) == [
        ("g1", 5000, "OK"),
        ("g2", 5001, "ALERT"),
        ("g3", 20000, "ALERT"),
        ("g4", 20001, "CRITICAL"),
        ("g5", -1, "UNKNOWN"),
        ("g6", 0, "OK"),
        ("g7", 0, "OK"),
    ]
    assert [r.message for r in monitor.lag_alerts(severities).orderBy("group_id").collect()][2] == (
        ":rotating_light: CRITICAL Kafka lag on `g4`: 20001 messages. Restarting `g4` with increased parallelism."
    )


def test_lag_from_query_progress(spark):
    progress = {
        "sources": [
            {"endOffset": {"transactions": {"0": 10, "1": 5}}, "latestOffset": {"transactions": {"0": 25, "1": 5, "2": 7}}},
            {"endOffset": None, "latestOffset": {"settlements": {"0": 3}}},
        ]
    }
    df = spark.createDataFrame([("q", json.dumps(progress))], "group_id string, progress string")
    assert sorted(r.lag for r in lag_from_progress(df).collect()) == [0, 3, 7, 15]
    assert rows(monitor.lag_severity(lag_from_progress(df), MonitorConfig(lag_alert=20))) == [("q", 25, "ALERT")]


def test_staleness(spark):
    now = at("10:00:00")
    streams = spark.createDataFrame([("fresh",), ("edge",), ("old",), ("never",)], "stream_name string")
    ages = [("fresh", 1), ("fresh", 90), ("edge", 8), ("old", 8.01), ("unwatched", 1)]
    progress = spark.createDataFrame([(n, now - timedelta(minutes=m)) for n, m in ages], "stream_name string, progress_time timestamp")
    got = {r.stream_name: (r.status, r.age_minutes) for r in monitor.stream_staleness(streams, progress, as_of=now).collect()}
    assert got["fresh"] == ("HEALTHY", 1.0) and got["edge"] == ("HEALTHY", 8.0)
    assert got["old"] == ("STALE", pytest.approx(8.01)) and got["never"] == ("NO_CHECKPOINT_FOUND", None)
    assert len(got) == 4


def test_staleness_log(spark, folder):
    streams = spark.createDataFrame([("a",)], "stream_name string")
    for _ in range(2):
        append_json_log(monitor.stream_staleness(streams, checkpoint_times(spark, {"a": f"{folder}/none"}), as_of=at("10:00:00")), f"{folder}/log")
    logged = spark.read.schema(schemas.STREAM_HEALTH).json(f"{folder}/log")
    assert rows(logged) == [("a", "NO_CHECKPOINT_FOUND", None, "2024-01-01T10:00:00.000000+00:00")] * 2
