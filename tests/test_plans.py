"""What the plans must look like, whatever the size of the tables."""

from __future__ import annotations

import re

import pytest

from railwatch.operators import health, marts, reconcile
from railwatch.sources.tables import read_table, write_mart
from tests.helpers import at, settlement, txn


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scans(text: str) -> list[str]:
    return [line for line in text.splitlines() if "FileScan" in line]


def exchanges(text: str) -> int:
    return len(re.findall(r"Exchange hashpartitioning", text))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("plans"))
    write_mart(txn(spark, *[dict(transaction_id=str(i)) for i in range(50)]), f"{root}/t", partition_by="event_date")
    write_mart(settlement(spark, *[dict(settlement_id=f"s{i}", transaction_id=str(i)) for i in range(50)]), f"{root}/s")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield read_table(spark, f"{root}/t"), read_table(spark, f"{root}/s")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_status_and_dates_are_filtered_at_the_scan(stored):
    txns, settlements = stored
    days = txns.filter(txns.event_date >= at("10:00:00").date())
    scan = scans(plan(reconcile.enrich_payments(days, settlements)))[0]
    assert "EqualTo(status,success)" in scan
    assert "event_date" in scan.split("PartitionFilters: [")[1].split("]")[0]


def test_only_needed_columns_are_read(stored):
    txns, settlements = stored
    for scan, expected in zip(
        scans(plan(marts.mart_recon(txns, settlements))),
        [{"transaction_id", "merchant_id", "amount_inr", "status"}, {"transaction_id", "settled_amount_inr", "delay_seconds"}],
    ):
        assert set(re.findall(r"(\w+):", scan.split("ReadSchema: struct<")[1])) == expected
    scan = scans(plan(marts.mart_ops(txns)))[0]
    assert "transaction_id" not in scan.split("ReadSchema:")[1]


@pytest.mark.parametrize(
    "make,shuffles",
    [
        (lambda t, s: reconcile.enrich_payments(t, s), 2),
        (lambda t, s: reconcile.mismatch_log(t, s), 2),
        (lambda t, s: reconcile.overdue(t, s), 2),
        # Both inputs once, and the sums per merchant and day.
        (lambda t, s: marts.mart_recon(t, s), 3),
        (lambda t, s: marts.mart_ops(t), 1),
        # Slots, then windows made of slots.
        (lambda t, s: health.window_health(t), 2),
        (lambda t, s: health.window_health(t, tumbling=True), 1),
        (lambda t, s: health.bank_health(t), 2),
    ],
)
def test_number_of_shuffles(stored, make, shuffles):
    text = plan(make(*stored))
    assert exchanges(text) == shuffles
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_events_are_added_up_before_windows_copy_them(stored):
    text = plan(health.window_health(stored[0]))
    # Plans print from the last step to the first.
    assert text.index("Expand") < text.rindex("Exchange") < text.rindex("HashAggregate") < text.index("FileScan")


def test_aggregations_are_hash_based(stored):
    txns, settlements = stored
    silver = health.window_health(txns)
    for df in (silver, health.latest_snapshot(silver), health.bank_health(txns), marts.mart_recon(txns, settlements)):
        assert "SortAggregate" not in plan(df)


def test_no_python_in_the_plans_of_core_operators(stored):
    txns, settlements = stored
    for df in (health.window_features(txns), reconcile.mismatch_log(txns, settlements), marts.mart_recon(txns, settlements)):
        assert "Python" not in plan(df) and "InPandas" not in plan(df)
