from __future__ import annotations

import json
import time
from datetime import timedelta
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from railwatch import schemas
from railwatch.config import WindowConfig
from railwatch.operators.health import closed_windows, window_health
from railwatch.operators.monitor import lag_severity, stream_staleness
from railwatch.operators.parse import EVENT_SPECS, PAYOUTS, SETTLEMENTS, TRANSACTIONS, parse_topic, staged_transactions
from railwatch.sources.progress import checkpoint_times, lag_from_progress
from railwatch.sources.streams import event_stream
from railwatch.plans.stream_tables import topic_table
from railwatch.sources.tables import read_table
from railwatch.streaming.pipelines import (
    WINDOWS,
    Sink,
    finish,
    progress_rows,
    reconcile_stream,
    settle_salts,
    start_pipeline,
    untimed,
)
from tests.helpers import at, rows


def transaction(i: int, moment, **fields) -> str:
    event = dict(
        transaction_id=f"t{i}",
        payment_method="upi_hdfc",
        amount_inr=100.0,
        status="timeout" if i % 4 == 0 else "success",
        response_time_ms=100 + i,
        timestamp=moment.strftime("%Y-%m-%dT%H:%M:%S.%f+00:00") if moment else "soon",
    )
    return json.dumps({**event, **fields})


def drop(spark, folder, values):
    """One more file of raw records in the source folder."""
    data = [(str(i), v, at("10:00:00")) for i, v in enumerate(values)]
    spark.createDataFrame(data, schemas.BRONZE).coalesce(1).write.mode("append").parquet(f"{folder}/in")


def run(spark, folder, spec=TRANSACTIONS, *outputs):
    raw = event_stream(spark, spec.topic, "parquet", path=f"{folder}/in", schema=schemas.BRONZE, max_per_trigger=1)
    queries = start_pipeline(raw, spec, Sink(f"{folder}/out", f"{folder}/checkpoints", once=True), *outputs)
    finish(queries)
    return queries


def table(spark, folder, name):
    return topic_table(spark, f"{folder}/out", name)


def test_one_source_feeds_bronze_dead_letters_and_windows(spark, folder):
    good = [transaction(i, at("10:00:00") + timedelta(seconds=13 * i)) for i in range(60)]
    bad = ["{", "[1]", None, "{}"]
    drop(spark, folder, good + bad + [transaction(99, None)])
    run(spark, folder, TRANSACTIONS, WINDOWS)

    assert table(spark, folder, "bronze_transactions").count() == 65
    assert table(spark, folder, "dlq_transactions").count() == 4
    typed = parse_topic(table(spark, folder, "bronze_transactions"), TRANSACTIONS).valid
    newest = typed.agg(F.max("event_time")).first()[0]
    expected = closed_windows(window_health(typed), WindowConfig(), F.lit(newest))
    got = table(spark, folder, "silver_transactions")
    assert got.count() > 0
    assert rows(got.select(*expected.columns)) == rows(expected)
    staged = staged_transactions(typed)
    assert rows(table(spark, folder, "typed_transactions").select(*staged.columns)) == rows(staged)


@pytest.mark.parametrize("spec", [SETTLEMENTS, PAYOUTS])
def test_row_level_topics_keep_late_rows(spark, folder, spec):
    for moment in ("2024-01-01T12:00:00+00:00", "2024-01-01T08:00:00+00:00"):
        drop(spark, folder, [json.dumps({spec.key: moment, spec.time_column: moment}), "{"])
    run(spark, folder, spec)
    got = table(spark, folder, f"silver_{spec.topic}")
    assert sorted(r.event_time for r in got.collect()) == [at("08:00:00"), at("12:00:00")]
    assert set(got.columns) == set(EVENT_SPECS[spec.topic].schema.names) | {"kafka_timestamp", "event_time"}
    assert table(spark, folder, f"dlq_{spec.topic}").count() == 2


def test_restart_resumes_without_repeating(spark, folder):
    drop(spark, folder, [transaction(i, at("10:00:00")) for i in range(5)])
    run(spark, folder)
    drop(spark, folder, [transaction(i, at("10:30:00")) for i in range(5, 8)] + ["{"])
    run(spark, folder)
    run(spark, folder)
    assert sorted(r.transaction_id for r in table(spark, folder, "silver_transactions").collect()) == [f"t{i}" for i in range(8)]
    assert table(spark, folder, "bronze_transactions").count() == 9
    assert table(spark, folder, "dlq_transactions").count() == 1


def test_late_events(spark, folder):
    """Within the watermark a late event counts; far behind it, and one batch after it moved on, it is dropped."""
    batches = [
        [("a", "10:00:30")],
        [("b", "10:20:00")],
        [("c", "10:19:10")],
        [("late", "10:00:40"), ("d", "10:20:30")],
        [("e", "10:40:00")],
    ]
    for batch in batches:
        drop(spark, folder, [transaction(1, at(t), payment_method=m) for m, t in batch])
        run(spark, folder, TRANSACTIONS, WINDOWS)
    silver = table(spark, folder, "silver_transactions")
    got = silver.groupBy("payment_method").agg(F.count("*").alias("windows"), F.max("total_transactions").alias("n"))
    assert rows(got) == [("a", 5, 1), ("b", 5, 1), ("c", 5, 1), ("d", 5, 1)]


def test_checkpoints_and_progress_tell_the_health_of_streams(spark, folder):
    drop(spark, folder, [transaction(1, at("10:00:00"))])
    queries = run(spark, folder)
    checkpoints = {"bronze": f"{folder}/checkpoints/landed_transactions", "absent": f"{folder}/checkpoints/absent"}
    times = checkpoint_times(spark, checkpoints)
    assert times.count() >= 1 and {r.stream_name for r in times.collect()} == {"bronze"}
    streams = spark.createDataFrame([(n,) for n in checkpoints], "stream_name string")
    states = {r.stream_name: r.status for r in stream_staleness(streams, times).collect()}
    assert states == {"bronze": "HEALTHY", "absent": "NO_CHECKPOINT_FOUND"}
    # A file source reports no topic offsets, so there is nothing to lag behind.
    progress = progress_rows(spark, queries)
    assert progress.count() == 1
    assert rows(lag_severity(lag_from_progress(progress))) == [("landed_transactions", 0, "OK")]


def test_source_rows_are_read_once_for_all_tables(spark, folder):
    """Four tables, two runs: as many rows come from the source as there are."""
    good = [transaction(i, at("10:00:00") + timedelta(seconds=13 * i)) for i in range(60)]
    drop(spark, folder, [*good, "{", "[1]"])
    read = []
    for more in ([], [transaction(70, at("10:40:00")), "{}"]):
        if more:
            drop(spark, folder, more)
        queries = run(spark, folder, TRANSACTIONS, WINDOWS)
        read.append([sum(p["numInputRows"] for p in q.recentProgress) for q in queries])
    assert read == [[62, 60], [2, 1]]
    # The windows read only the columns they need.
    plan = queries[1]._jsq.explainInternal(False)
    assert "kafka_timestamp" not in plan and "merchant_id" not in plan and "value" not in plan.replace("plan_value", "")


def test_failure_in_mid_batch_repeats_nothing(spark, folder):
    """A file of the batch cannot be read: what other tasks wrote is no part of any table, then or after the restart."""
    drop(spark, folder, [transaction(i, at("10:00:00")) for i in range(40)] + ["{"])
    broken = Path(folder) / "in" / "part-broken.parquet"
    broken.write_bytes(b"PAR1 this is no table PAR1")

    def start():
        raw = event_stream(spark, "transactions", "parquet", path=f"{folder}/in", schema=schemas.BRONZE)
        return start_pipeline(raw, TRANSACTIONS, Sink(f"{folder}/out", f"{folder}/checkpoints", once=True), {})

    with pytest.raises(StreamingQueryException):
        finish(start())
    whole = spark.createDataFrame([("w", transaction(50, at("10:01:00")), at("10:00:00"))], schemas.BRONZE).toPandas()
    whole.to_parquet(broken, coerce_timestamps="us")
    finish(start())
    assert sorted(r.transaction_id for r in table(spark, folder, "typed_transactions").collect()) == sorted([f"t{i}" for i in range(40)] + ["t50"])
    assert table(spark, folder, "bronze_transactions").count() == 42
    assert table(spark, folder, "dlq_transactions").count() == 1


def test_windows_start_before_the_first_batch(spark, folder):
    """Without ``once`` all queries run side by side."""
    drop(spark, folder, [transaction(i, at("10:00:00") + timedelta(seconds=30 * i)) for i in range(60)])
    raw = event_stream(spark, "transactions", "parquet", path=f"{folder}/in", schema=schemas.BRONZE)
    queries = start_pipeline(raw, TRANSACTIONS, Sink(f"{folder}/out", f"{folder}/checkpoints", interval="1 second"), WINDOWS)
    try:
        for _ in range(120):
            time.sleep(0.5)
            assert all(q.exception() is None for q in queries)
            # A file is there once its batch is about to be committed; the next one begins after that.
            if any(Path(f"{folder}/out/silver_transactions").glob("*.parquet")) and not queries[1].status["isTriggerActive"]:
                break
    finally:
        for q in queries:
            q.stop()
    assert read_table(spark, f"{folder}/out/silver_transactions").count() > 0


T_SCHEMA = "transaction_id string, merchant_id string, amount_inr double, status string, event_time timestamp"
S_SCHEMA = "settlement_id string, transaction_id string, settled_amount_inr double, event_time timestamp"


def reconciled(spark, folder, txns, settled, **options):
    spark.createDataFrame(txns, T_SCHEMA).write.parquet(f"{folder}/t")
    spark.createDataFrame(settled, S_SCHEMA).write.parquet(f"{folder}/s")
    t = spark.readStream.schema(T_SCHEMA).parquet(f"{folder}/t")
    s = spark.readStream.schema(S_SCHEMA).parquet(f"{folder}/s")
    sink = Sink(f"{folder}/out", f"{folder}/checkpoints", once=True)
    finish([sink.start(reconcile_stream(t, s, **options), "joined"), sink.start(untimed(t, s), "untimed")])
    return [read_table(spark, f"{folder}/out/{name}") for name in ("joined", "untimed")]


TXNS = [
    ("t1", "m", 10.0, "success", at("10:00:00")),
    ("t2", "m", 20.0, "success", at("10:00:00")),
    ("t3", "m", 5.0, "failed", at("10:00:00")),
    ("t4", "m", 7.0, "success", at("11:59:00")),
    ("t5", "m", 8.0, "success", at("10:05:00")),
    ("t6", "m", 8.0, "success", None),
    (None, "m", 9.0, "success", at("10:00:00")),
]
SETTLED = [
    ("s1", "t1", 10.0, at("10:20:00")),
    ("s2", "t2", 20.0, at("10:31:00")),
    ("s3", "t3", 5.0, at("10:01:00")),
    ("s5", "t5", 8.0, at("10:04:10")),
    ("s6", "t6", 8.0, None),
    ("s7", None, 9.0, at("10:00:00")),
    ("s9", "t9", 1.0, at("12:00:00")),
]


@pytest.mark.parametrize("hot", [(), ("t1", "t2", "t9")])
def test_stream_join_gives_all_kinds(spark, folder, hot):
    joined, no_time = reconciled(spark, folder, TXNS, SETTLED, hot=hot, salts=4)
    got = sorted(((r.kind, r.transaction_id, r.settlement_id) for r in settle_salts(joined).collect()), key=repr)
    # t4 and s9 can still find partners; s2 came a minute late; s5 came early, by less than the tolerance.
    assert got == sorted(
        [
            ("MATCHED", "t1", "s1"),
            ("MATCHED", "t5", "s5"),
            ("OVERDUE", "t2", None),
            ("OVERDUE", None, None),
            ("ORPHAN", "t2", "s2"),
            ("ORPHAN", "t3", "s3"),
            ("ORPHAN", None, "s7"),
        ],
        key=repr,
    )
    assert sorted((r.kind, r.transaction_id, r.settlement_id) for r in no_time.fillna("-").collect()) == [
        ("UNTIMED", "t6", "-"),
        ("UNTIMED", "t6", "s6"),
    ]


def test_hot_id_is_kept_in_several_state_partitions(spark, folder):
    txns = [("h", "m", 1.0, "success", at("10:00:00"))] * 2 + [("late", "m", 1.0, "success", at("10:00:00"))] * 2 + [("end", "m", 1.0, "failed", at("13:00:00"))]
    settled = [(f"s{i}", "h", 1.0, at("10:00:00") + timedelta(seconds=i % 900)) for i in range(2000)]
    settled += [("x", "late", 1.0, at("13:00:00"))]
    txns += [("z", "m", 1.0, "success", at("13:00:00"))]
    joined, _ = reconciled(spark, folder, txns, settled, hot=["h", "late"], salts=8)
    per_salt = {r.salt: r["count"] for r in joined.filter("kind = 'MATCHED'").groupBy("salt").count().collect()}
    assert len(per_salt) == 8 and sum(per_salt.values()) == 4000 and max(per_salt.values()) < 700
    kinds = {(r.kind, r.transaction_id): r["count"] for r in settle_salts(joined).groupBy("kind", "transaction_id").count().collect()}
    # Both copies of the unsettled transaction are overdue, once each.
    assert kinds == {("MATCHED", "h"): 4000, ("OVERDUE", "late"): 2}


def test_reconciliation_keeps_its_state_on_disk(spark, folder):
    """Spark's own state store holds all rows of both sides on the executors' heaps."""
    from railwatch.streaming import pipelines

    before = {key: spark.conf.get(key, "") for key in pipelines.STATE_ON_DISK}
    provider = next(iter(before))
    try:
        for key in before:
            spark.conf.unset(key)
        reconciled(spark, folder, TXNS, SETTLED)
        assert spark.conf.get(provider) == pipelines.STATE_ON_DISK[provider]
        kept = [x.suffix for x in Path(f"{folder}/checkpoints/joined/state").rglob("*.*")]
        assert ".changelog" in kept and ".delta" not in kept
        spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
        pipelines.keep_state_on_disk(spark)
        assert spark.conf.get(provider).endswith("HDFSBackedStateStoreProvider")
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value else spark.conf.unset(key)


def test_parted_streams_do_not_sort_their_rows(spark, folder):
    """Without the setting a task of the landing query sorts all its rows by route."""
    setting = "spark.sql.maxConcurrentOutputFileWriters"
    spark.conf.set(setting, 0)
    try:
        drop(spark, folder, [transaction(i, at("10:00:00")) for i in range(4)])
        raw = event_stream(spark, "transactions", "parquet", path=f"{folder}/in", schema=schemas.BRONZE)
        finish(start_pipeline(raw, TRANSACTIONS, Sink(f"{folder}/out", f"{folder}/checkpoints", once=True)))
        assert int(spark.conf.get(setting)) >= 2
        spark.conf.set(setting, 7)
        finish(start_pipeline(raw, TRANSACTIONS, Sink(f"{folder}/out", f"{folder}/checkpoints", once=True)))
        assert int(spark.conf.get(setting)) == 7
    finally:
        spark.conf.unset(setting)


def test_replay_deals_large_batches_over_files(spark, folder, monkeypatch):
    """Files of the source hold a bounded number of rows; batches and rows stay the same."""
    from railwatch.plans import queries

    day = F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 8600)
    events = spark.range(300).select(
        F.col("id").alias("event_id"), day.alias("ts"), (F.col("id") % 9).alias("user_id"), F.lit("click").alias("event_type"),
        F.lit(1.5).alias("value"), F.lit("{}").alias("props"),
    )
    events.write.parquet(f"{folder}/events.parquet")
    found, dealt = [], []
    for most in (1_000_000, 20):
        monkeypatch.setattr(queries, "ROWS_OF_FILE", most)
        monkeypatch.setattr(queries, "scratch_path", lambda spark, name, most=most: f"{folder}/{most}-{name}")
        found.append(sorted(map(tuple, queries.stream_restart(spark, folder).collect())))
        dealt.append(len(list(Path(f"{folder}/{most}-restart-source").glob("*.parquet"))))
    assert found[0] == found[1]
    assert {part: n for table, part, n in found[0] if table == "batches"} == {"run 0": 2, "run 1": 1, "run 2": 3}
    assert dealt[0] == 6 and dealt[1] > 12
