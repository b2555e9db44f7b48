"""Event streams: one factory for the broker and for files, and the decoding of the envelope."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_FILE_LIMIT = "maxFilesPerTrigger"


def event_stream(
    spark: SparkSession,
    topic: str,
    fmt: str = "kafka",
    *,
    bootstrap: str = "localhost:9092",
    path: str | None = None,
    schema: StructType | None = None,
    max_per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """A stream of ``key, value, kafka_timestamp``.

    ``kafka`` subscribes to the topic from its first record and reads at most ``max_per_trigger`` records per
    batch; by default all there are. Any other format reads files with the same three columns and limits files.
    """
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        reader = reader.option("kafka.bootstrap.servers", bootstrap).option("subscribe", topic)
        reader = reader.option("startingOffsets", "earliest")
        if max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
        return decode_envelope(reader.options(**options).load())
    if schema is not None:
        reader = reader.schema(schema)
    if max_per_trigger:
        reader = reader.option(_FILE_LIMIT, max_per_trigger)
    return reader.options(**options).load(path)


def decode_envelope(df: DataFrame) -> DataFrame:
    """Broker records to text; the broker's own time stays as ``kafka_timestamp``."""
    return df.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.col("timestamp").alias("kafka_timestamp"),
    )
