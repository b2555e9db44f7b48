"""From raw JSON text to typed rows and a dead-letter branch."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

from railwatch import schemas
from railwatch.functions import to_event_time

_CORRUPT = "_corrupt_record"


class EventSpec(NamedTuple):
    """What the pipeline must know of one topic."""

    topic: str
    schema: StructType | str
    key: str
    time_column: str | None


TRANSACTIONS = EventSpec("transactions", schemas.TRANSACTION, "transaction_id", "timestamp")
SETTLEMENTS = EventSpec("settlements", schemas.SETTLEMENT, "settlement_id", "settlement_timestamp")
PAYOUTS = EventSpec("payouts", schemas.PAYOUT, "payout_id", "expected_payout_time")
EVENT_SPECS = {spec.topic: spec for spec in (TRANSACTIONS, SETTLEMENTS, PAYOUTS)}


class Parsed(NamedTuple):
    valid: DataFrame
    dlq: DataFrame


def parse_events(
    bronze: DataFrame,
    schema: StructType | str,
    key: str,
    time_column: str | None = None,
    *,
    value: str = "value",
    strict: bool = True,
) -> Parsed:
    """Splits raw rows into typed valid rows and malformed ones. Works on batches and streams.

    ``schema`` is a struct type or its DDL text.

    A permissive parse turns broken JSON into a struct of nulls, so a null test on the struct alone misses it.
    ``strict`` also sends a row to the dead letters when the parser reports it corrupt or its key is null;
    ``strict=False`` keeps only the null test.
    """
    extra = ["kafka_timestamp"] if "kafka_timestamp" in bronze.columns else []
    schema = _struct(schema)
    routed = _routed(bronze, schema, key, value, strict, [F.col(value).alias("json_value"), *extra])
    valid = routed.filter(~F.col("bad")).select(*[f"data.{name}" for name in schema.names], *extra)
    if time_column:
        event_time = to_event_time(time_column)
        valid = valid.withColumns({"event_time": event_time, "event_date": F.to_date(event_time)})
    return Parsed(valid, routed.filter("bad").select("json_value", *extra))


def _struct(schema: StructType | str) -> StructType:
    return StructType.fromDDL(schema) if isinstance(schema, str) else schema


def _routed(bronze: DataFrame, schema: StructType, key: str, value: str, strict: bool, keep: list) -> DataFrame:
    """The columns ``keep``, the parsed record as ``data`` and whether it is malformed (``bad``)."""
    # A record that does not fit the schema lands in its last field as text.
    full = schemas.plus(schema, **{_CORRUPT: "string"})
    data = F.from_json(value, full, {"columnNameOfCorruptRecord": _CORRUPT})
    bad = F.col("data").isNull()
    if strict:
        bad = bad | F.col(f"data.{_CORRUPT}").isNotNull() | F.col(f"data.{key}").isNull()
    # As the output of a generator the parsed record is computed once per row; as a plain column the optimizer would
    # repeat the parse in the filter and in every test of it.
    return bronze.select(*keep, F.explode(F.array(data)).alias("data")).withColumn("bad", bad)


def landed_events(raw: DataFrame, spec: EventSpec, strict: bool = True) -> DataFrame:
    """Every raw record with its route (``valid`` or ``dlq``) and, where it is valid, its typed ``event`` and time."""
    schema = _struct(spec.schema)
    routed = _routed(raw, schema, spec.key, "value", strict, ["key", "value", "kafka_timestamp"])
    event = F.struct(*[F.col(f"data.{name}").alias(name) for name in schema.names])
    good = routed.select(
        "key", "value", "kafka_timestamp", F.when(F.col("bad"), "dlq").otherwise("valid").alias("route"), F.when(~F.col("bad"), event).alias("event")
    )
    time = to_event_time(f"event.{spec.time_column}") if spec.time_column else F.lit(None).cast("timestamp")
    return good.withColumn("event_time", time).withColumn("event_date", F.to_date("event_time"))


def landed_schema(spec: EventSpec) -> StructType:
    """Of the stored table. The column it is parted by comes last, where readers of files put it: a stream over them
    goes by place."""
    event = T.StructType([*schemas.BRONZE.fields, T.StructField("event", _struct(spec.schema))])
    return schemas.plus(event, event_time="timestamp", event_date="date", route="string")


def bronze_rows(landed: DataFrame) -> DataFrame:
    """All records as they came."""
    return landed.select("key", "value", "kafka_timestamp")


def dead_letters(landed: DataFrame) -> DataFrame:
    return landed.filter("route = 'dlq'").select(F.col("value").alias("json_value"), "kafka_timestamp")


def valid_events(landed: DataFrame, spec: EventSpec, *extra: str) -> DataFrame:
    """The typed rows, as ``parse_topic`` gives them."""
    time = ["event_time", "event_date"] if spec.time_column else []
    return landed.filter("route = 'valid'").select("event.*", "kafka_timestamp", *time, *extra)


def parse_topic(bronze: DataFrame, spec: EventSpec, strict: bool = True) -> Parsed:
    return parse_events(bronze, spec.schema, spec.key, spec.time_column, strict=strict)


def staged_transactions(valid: DataFrame) -> DataFrame:
    """The columns of a transaction that marts and views use."""
    return valid.filter(F.col("transaction_id").isNotNull()).drop(
        "currency", "is_international", "device_type", "timestamp", "kafka_timestamp"
    )


def staged_settlements(valid: DataFrame) -> DataFrame:
    return valid.drop("settlement_timestamp", "expected_settlement_time", "actual_settlement_time", "kafka_timestamp")
