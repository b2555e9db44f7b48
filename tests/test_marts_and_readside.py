from __future__ import annotations

from datetime import date

import pytest

from railwatch import schemas
from railwatch.operators import readside
from railwatch.operators.marts import mart_correlation, mart_ops, mart_payout
from railwatch.plans.jobs import register_payment_views
from railwatch.functions import number_text, safe_rate_pct
from tests.helpers import at, rows, settlement, txn

DAY = date(2024, 1, 1)


def test_ops_mart(spark):
    txns = txn(
        spark,
        dict(amount_inr=10.0),
        dict(amount_inr=None, status="timeout", response_time_ms=None),
        dict(amount_inr=5.0, status="failed", response_time_ms=700),
        dict(payment_method="gpay", amount_inr=None),
    )
    assert rows(mart_ops(txns)) == [
        (DAY, "gpay", "mobility", 1, 1, 0, None, 500.0),
        (DAY, "upi_hdfc", "mobility", 3, 1, 1, 15.0, 600.0),
    ]


@pytest.mark.parametrize("kind", ["string", "timestamp"])
def test_payout_mart(spark, kind):
    time = {"string": "2024-01-01T23:30:00+00:00", "timestamp": at("23:30:00")}[kind]
    payouts = spark.createDataFrame(
        [(time, "p", "driver", "paid", 10.0, 5), (time, "p", "driver", "delayed", 20.0, 40), (time, "p", "driver", "failed", None, None)],
        f"expected_payout_time {kind}, platform string, recipient_type string, payout_status string, payout_amount_inr double, delay_minutes int",
    )
    assert rows(mart_payout(payouts)) == [(DAY, "p", "driver", 3, 1, 1, 30.0, 22.5)]
    assert mart_payout(payouts).columns == schemas.MART_PAYOUT.names


def ops_mart(spark, *items):
    return spark.createDataFrame([(DAY, *i) for i in items], schemas.MART_OPS)


MART = [
    ("upi_hdfc", "mobility", 10, 9, 1, 100.0, 300.0),
    ("upi_hdfc", "ecommerce", 30, 30, 0, 50.0, 500.0),
    ("gpay", "mobility", 10, 5, 0, None, None),
    ("gpay", "transit", 0, 0, 0, None, None),
]


def test_kpis(spark):
    mart = ops_mart(spark, *MART)
    assert readside.kpi_ops(mart).first()[:] == (50, 44, 150.0, 88.0)
    assert readside.ops_summary(readside.kpi_ops(mart)).first()[0] == "Total transactions: 50, success rate: 88.00%, total volume: ₹150"
    assert rows(readside.kpi_by_method(mart)) == [
        ("gpay", 10, 5, None, 50.0, "red"),
        ("upi_hdfc", 40, 39, 400.0, 97.5, "green"),
    ]
    assert {r[0]: r.avg_response_time_ms for r in readside.kpi_by_method(mart, weighted=True).collect()} == {"gpay": None, "upi_hdfc": 450.0}
    assert rows(readside.volume_by(mart)) == [("ecommerce", 50.0), ("mobility", 100.0), ("transit", 0.0)]


def test_rows_without_the_grouping_value_are_left_out(spark):
    mart = ops_mart(spark, (None, None, 10, 9, 1, 100.0, 300.0), ("gpay", "mobility", 0, 0, 0, None, None))
    assert rows(readside.kpi_by_method(mart)) == [("gpay", 0, 0, None, None, "red")]
    assert rows(readside.volume_by(mart)) == [("mobility", 0.0)]
    assert readside.kpi_ops(mart).first()[:] == (10, 9, 100.0, 90.0)
    assert rows(readside.top_merchants(recon_mart(spark, (None, 1, 0, 5.0), ("m", 1, 0, 1.0)))) == [("m", 1.0)]


def test_kpis_of_empty_marts(spark):
    assert readside.kpi_ops(ops_mart(spark)).first()[:] == (0, 0, 0.0, 0.0)
    empty = spark.createDataFrame([], schemas.MART_RECON)
    assert readside.kpi_settlement(empty).first()[:] == (0, 0, 0.0, 0.0, 0.0)


def test_pivot_fills_gaps(spark):
    other = date(2024, 1, 2)
    cells = [(DAY, "upi_hdfc", 3), (other, "upi_axis", 4), (DAY, "gpay", 9), (DAY, None, 9)]
    mart = spark.createDataFrame([(day, m, "a", 1, n, 0, 1.0, 1.0) for day, m, n in cells], schemas.MART_OPS)
    expected = [("upi_axis", 0, 4), ("upi_hdfc", 3, 0)]
    assert rows(readside.health_pivot(mart)) == expected
    assert rows(readside.health_pivot(mart, [DAY, other])) == expected
    assert readside.health_pivot(mart, [other]).columns == ["payment_method", "2024-01-02"]


def recon_mart(spark, *items):
    return spark.createDataFrame([(DAY, m, n, d, 0.0, 0.0, gap) for m, n, d, gap in items], schemas.MART_RECON)


def test_settlement_kpis_and_top_merchants(spark):
    mart = recon_mart(spark, ("m1", 6, 2, 10.5), ("m2", 2, 0, None), ("m1", 2, 0, 1.0), ("m3", 0, 0, -4.0), ("m0", 0, 0, 11.5))
    kpi = readside.kpi_settlement(mart)
    assert kpi.first()[:] == (10, 2, 19.0, 80.0, 20.0)
    assert readside.settlement_summary(kpi).first()[0] == "Total settled: 10, delayed: 2 (20.0%), amount discrepancy: ₹19"
    assert [tuple(r) for r in readside.top_merchants(mart, 3).collect()] == [("m0", 11.5), ("m1", 11.5), ("m2", 0.0)]


def test_recent(spark):
    log = spark.createDataFrame([("HEALTHY", "", f"2024-01-01T10:0{i}") for i in range(7)], schemas.CORRELATION_EVENT)
    assert [r.detected_at[-1] for r in readside.recent(log, n=5).collect()] == list("65432")
    assert readside.recent(log).count() == 7
    assert readside.event_lines(readside.recent(log, n=1)).first().line == "2024-01-01T10:06: HEALTHY (banks: none)"
    assert mart_correlation(log).columns == schemas.CORRELATION_EVENT.names


def test_views_answer_sql(spark):
    register_payment_views(
        txn(spark, dict(transaction_id="a"), dict(transaction_id="b", payment_method="gpay")),
        settlement(spark, dict(settlement_id="s", transaction_id="a", delay_seconds=200)),
    )
    got = spark.sql("SELECT transaction_id, is_delayed FROM payment_enriched")
    assert rows(got) == [("a", True), ("b", False)]
    assert spark.sql("SELECT sum(total_transactions) FROM bank_health_hourly").first()[0] == 2
    assert spark.sql("SELECT count(*) FROM bank_transactions").first()[0] == 1


def test_number_text(spark):
    values = [1.0, 0.0, 5.25, 12345678.5, 1e9, -3.1, 0.001, 1e15, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert [r[0] for r in df.select(number_text("x")).collect()] == [str(v) for v in values]


def test_safe_rate(spark):
    df = spark.createDataFrame([(1, 4), (1, 0), (0, 0)], "a int, b int")
    assert [r[0] for r in df.select(safe_rate_pct("a", "b")).collect()] == [25.0, 0.0, 0.0]
