"""Small helpers of the tests."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame


def rows(df: DataFrame) -> list[tuple]:
    """All rows, in an order that does not depend on the plan."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def at(text: str) -> datetime:
    return datetime.fromisoformat(f"2024-01-01 {text}" if len(text) <= 8 else text)


TXN = (
    "transaction_id string, merchant_id string, merchant_category string, payment_method string, amount_inr double,"
    " status string, response_time_ms int, event_time timestamp, event_date date"
)
SETTLEMENT = (
    "settlement_id string, transaction_id string, merchant_id string, settled_amount_inr double,"
    " settlement_status string, delay_seconds int, event_time timestamp"
)
SILVER = (
    "window struct<start: timestamp, end: timestamp>, payment_method string, total_transactions bigint,"
    " success_rate_pct double, avg_response_time_ms double, timeout_rate_pct double"
)


def txn(spark, *items: dict) -> DataFrame:
    """Transactions with defaults for what a test does not name."""
    base = dict(
        transaction_id=None,
        merchant_id="m1",
        merchant_category="mobility",
        payment_method="upi_hdfc",
        amount_inr=100.0,
        status="success",
        response_time_ms=500,
        event_time=at("10:00:00"),
    )
    data = [{**base, **item} for item in items]
    data = [{**d, "event_date": d["event_time"].date() if d["event_time"] else None} for d in data]
    names = [f.split()[0] for f in TXN.split(", ")]
    return spark.createDataFrame([tuple(d[n] for n in names) for d in data], TXN)


def settlement(spark, *items: dict) -> DataFrame:
    base = dict(
        settlement_id=None,
        transaction_id=None,
        merchant_id="m1",
        settled_amount_inr=100.0,
        settlement_status="settled",
        delay_seconds=60,
        event_time=at("10:05:00"),
    )
    names = [f.split()[0] for f in SETTLEMENT.split(", ")]
    return spark.createDataFrame([tuple({**base, **i}[n] for n in names) for i in items], SETTLEMENT)
