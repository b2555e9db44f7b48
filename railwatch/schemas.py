"""Schemas of the event streams and of the tables derived from them."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def _table(**fields: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields.items()])


def plus(schema: T.StructType, **fields: str) -> T.StructType:
    """The schema with further columns at its end."""
    return T.StructType(schema.fields + _table(**fields).fields)


# Field names, order and types of the JSON events and of the stored tables.
TRANSACTION = _table(
    transaction_id="string",
    user_id="string",
    merchant_id="string",
    merchant_category="string",
    payment_method="string",
    amount_inr="double",
    currency="string",
    status="string",
    bank_response_code="string",
    response_time_ms="int",
    is_international="boolean",
    device_type="string",
    city="string",
    timestamp="string",
)
SETTLEMENT = _table(
    settlement_id="string",
    transaction_id="string",
    merchant_id="string",
    settled_amount_inr="double",
    settlement_status="string",
    bank_reference_number="string",
    settlement_timestamp="string",
    expected_settlement_time="string",
    actual_settlement_time="string",
    delay_seconds="int",
)
PAYOUT = _table(
    payout_id="string",
    recipient_id="string",
    recipient_type="string",
    platform="string",
    payout_amount_inr="double",
    payout_status="string",
    expected_payout_time="string",
    actual_payout_time="string",
    delay_minutes="int",
    bank_account_hash="string",
)
BRONZE = _table(key="string", value="string", kafka_timestamp="timestamp")
DLQ = _table(json_value="string", kafka_timestamp="timestamp")
CORRELATION_EVENT = _table(classification="string", affected_banks="string", detected_at="string")
MISMATCH = _table(
    mismatch_type="string",
    transaction_id="string",
    merchant_id="string",
    detail="string",
    detected_at="string",
)
MART_OPS = _table(
    event_date="date",
    payment_method="string",
    merchant_category="string",
    total_transactions="bigint",
    success_count="bigint",
    timeout_count="bigint",
    total_volume_inr="double",
    avg_response_time_ms="double",
)
MART_RECON = _table(
    event_date="date",
    merchant_id="string",
    total_settled_transactions="bigint",
    delayed_count="bigint",
    total_txn_amount="double",
    total_settled_amount="double",
    amount_discrepancy="double",
)
MART_PAYOUT = _table(
    event_date="date",
    platform="string",
    recipient_type="string",
    total_payouts="bigint",
    delayed_count="bigint",
    paid_count="bigint",
    total_payout_volume_inr="double",
    avg_delay_minutes="double",
)
REPORT = _table(report="string", generated_at="string")
STREAM_HEALTH = _table(stream_name="string", status="string", age_minutes="double", checked_at="string")
