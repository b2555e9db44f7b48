"""The tables of the stream pipelines by name, wherever their rows are."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from railwatch.operators.parse import (
    EVENT_SPECS,
    EventSpec,
    bronze_rows,
    dead_letters,
    landed_schema,
    staged_settlements,
    staged_transactions,
    valid_events,
)
from railwatch.sources.tables import FILE_FORMATS, ROW_POSITION, landed_name, read_if_present, read_table


#: The columns of a topic that marts and views use.
STAGED = {"transactions": staged_transactions, "settlements": staged_settlements}


def topic_table(
    spark: SparkSession, root: str, name: str, fmt: str = "parquet", *, spec: EventSpec | None = None, row_position: bool = False
) -> DataFrame:
    """``bronze_<topic>``, ``dlq_<topic>``, ``silver_<topic>`` (typed rows) or ``typed_<topic>`` (those that marts use).

    A table of that name is read as it is. Where there is none, it is the part of ``landed_<topic>`` that it stands for;
    only the columns and partitions asked for are read.
    """
    if read_if_present(spark, f"{root}/{name}", fmt) is not None:
        return read_table(spark, f"{root}/{name}", fmt, row_position=row_position)
    kind, topic = name.split("_", 1)
    spec = spec or EVENT_SPECS[topic]
    # With its schema, so that one without typed rows yet has their columns, too.
    schema = landed_schema(spec) if fmt in FILE_FORMATS else None
    landed = read_table(spark, f"{root}/{landed_name(topic)}", fmt, row_position, schema)
    if kind == "bronze":
        return bronze_rows(landed)
    if kind == "dlq":
        return dead_letters(landed)
    valid = valid_events(landed, spec, *([ROW_POSITION] if row_position else []))
    if kind == "typed" and topic in STAGED:
        return STAGED[topic](valid)
    return valid.drop("event_date")


def topic_table_if_present(spark: SparkSession, root: str, name: str, fmt: str = "parquet") -> DataFrame | None:
    kind, topic = name.split("_", 1)
    if any(read_if_present(spark, f"{root}/{n}", fmt) is not None for n in (name, landed_name(topic))):
        return topic_table(spark, root, name, fmt)
    return None
