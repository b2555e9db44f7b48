from __future__ import annotations

import json

import pytest

from railwatch import schemas
from railwatch.operators.parse import (
    EVENT_SPECS,
    SETTLEMENTS,
    TRANSACTIONS,
    parse_events,
    parse_topic,
    staged_settlements,
    staged_transactions,
)
from railwatch.sources.streams import decode_envelope
from tests.helpers import at, rows

GOOD = '{"a": 1, "b": "x", "t": "2024-01-01T10:00:00.000001+00:00"}'
CASES = {
    "valid": (GOOD, True),
    "extra field": ('{"a": 1, "z": 5}', True),
    "bad time": ('{"a": 1, "t": "soon"}', True),
    "no time": ('{"a": 1}', True),
    "cut off": ("{bad", False),
    "empty text": ("", False),
    "null": (None, False),
    "array": ("[1]", False),
    "null literal": ("null", False),
    "no key": ("{}", False),
    "null key": ('{"a": null, "b": "x"}', False),
    "wrong type": ('{"a": "zz"}', False),
}
SCHEMA = schemas.plus(schemas._table(a="int", b="string"), t="string")


def bronze(spark, values):
    data = [(str(i), v, at("10:00:00")) for i, v in enumerate(values)]
    return spark.createDataFrame(data, schemas.BRONZE)


@pytest.mark.parametrize("case", CASES)
def test_each_record_goes_to_one_branch(spark, case):
    text, good = CASES[case]
    valid, dlq = parse_events(bronze(spark, [text]), SCHEMA, "a", "t")
    assert (valid.count(), dlq.count()) == ((1, 0) if good else (0, 1))


def test_dead_letters_keep_the_text_as_it_came(spark):
    bad = [text for text, good in CASES.values() if not good]
    dlq = parse_events(bronze(spark, bad), SCHEMA, "a").dlq
    assert dlq.columns == schemas.DLQ.names
    assert sorted(map(str, (r.json_value for r in dlq.collect()))) == sorted(map(str, bad))


def test_schema_as_ddl_text(spark):
    table = bronze(spark, [t for t, _ in CASES.values()])
    by_type, by_text = parse_events(table, SCHEMA, "a"), parse_events(table, "a INT, b STRING, t STRING", "a")
    assert rows(by_text.valid) == rows(by_type.valid) and rows(by_text.dlq) == rows(by_type.dlq)


def test_lenient_routing_only_tests_for_null(spark):
    valid, dlq = parse_events(bronze(spark, [t for t, _ in CASES.values()]), SCHEMA, "a", strict=False)
    assert dlq.count() == 2
    assert valid.count() == len(CASES) - 2


def test_event_time(spark):
    valid = parse_events(bronze(spark, [GOOD, '{"a": 2, "t": "soon"}', '{"a": 3}']), SCHEMA, "a", "t").valid
    got = {r.a: (r.event_time, r.event_date) for r in valid.collect()}
    assert got[1] == (at("10:00:00").replace(microsecond=1), at("10:00:00").date())
    assert got[2] == got[3] == (None, None)


@pytest.mark.parametrize("topic", EVENT_SPECS)
def test_every_topic_reads_its_own_schema(spark, topic):
    spec = EVENT_SPECS[topic]
    value = {f.name: {"string": "x", "double": 1.5, "integer": 7, "boolean": True}[f.dataType.typeName()] for f in spec.schema}
    value[spec.time_column] = "2024-01-01T10:00:00+00:00"
    valid = parse_topic(bronze(spark, [json.dumps(value), "{"]), spec).valid
    row = valid.collect()[0].asDict()
    assert {k: row[k] for k in value} == value
    assert row["event_time"] == at("10:00:00")


def test_staging_keeps_the_columns_marts_use(spark):
    staged = staged_transactions(parse_topic(bronze(spark, ["{"]), TRANSACTIONS).valid)
    assert not {"currency", "is_international", "device_type", "timestamp"} & set(staged.columns)
    assert {"event_time", "event_date", "bank_response_code", "city"} <= set(staged.columns)
    settled = staged_settlements(parse_topic(bronze(spark, ["{"]), SETTLEMENTS).valid)
    assert "actual_settlement_time" not in settled.columns and "event_date" in settled.columns


def test_record_is_parsed_once_per_row(spark):
    plan = parse_topic(bronze(spark, [GOOD]), TRANSACTIONS).valid._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1


def test_envelope_decodes_bytes(spark):
    records = spark.createDataFrame([(bytearray(b"k"), bytearray("₹".encode()), at("10:00:00"))], "key binary, value binary, timestamp timestamp")
    assert rows(decode_envelope(records)) == [("k", "₹", at("10:00:00"))]
