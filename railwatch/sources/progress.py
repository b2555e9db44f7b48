"""What running streams leave behind: checkpoint files, progress records and consumer-group listings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from railwatch.sources.tables import append_log, read_if_present

# The columns of a consumer-group listing, parted by white space; all but the first are numbers.
LISTING = ("TOPIC", "PARTITION", "CURRENT-OFFSET", "LOG-END-OFFSET", "LAG")
UNKNOWN_LAG = -1


def checkpoint_times(spark: SparkSession, checkpoints: dict[str, str]) -> DataFrame:
    """``stream_name, progress_time`` per offset file; a stream without checkpoint gives no row.

    Only file metadata is read. The dictionary is the list of monitored streams, not data.
    """
    found = []
    for name, path in checkpoints.items():
        files = read_if_present(spark, f"{path}/offsets", "binaryFile")
        if files is not None:
            time = F.col("modificationTime").alias("progress_time")
            found.append(files.select(F.lit(name).alias("stream_name"), time))
    if not found:
        return spark.createDataFrame([], "stream_name string, progress_time timestamp")
    return reduce(DataFrame.unionByName, found)


def lag_from_listing(lines: DataFrame) -> DataFrame:
    """``group_id, line`` to ``group_id, lag``: null for lines without a lag, -1 where no listing was had.

    A line has a lag if a word and as many numbers as the listing has stand at its beginning; more columns may follow.
    """
    # One look at each line. Possessive parts cannot be tried again, so it takes one step per character.
    numbers = len(LISTING) - 2
    pattern = r"^\s*+\S++(?:\s++[0-9]++){%d}\s++([0-9]++)(?:\s|$)" % numbers
    lag = F.regexp_extract("line", pattern, 1).try_cast("bigint")
    return lines.select("group_id", F.when(F.col("line").isNull(), F.lit(UNKNOWN_LAG)).otherwise(lag).alias("lag"))


def append_progress(spark: SparkSession, queries: list[StreamingQuery], path: str) -> None:
    """Adds what each query last reported to a log, for monitors in other applications; a few rows, asked of the driver."""
    rows = [(q.name, q.lastProgress.json) for q in queries if q.lastProgress]
    append_log(spark.createDataFrame(rows, "group_id string, progress string"), path)


def latest_progress(log: DataFrame) -> DataFrame:
    """The newest record of each stream of a log of progress."""
    time = F.get_json_object("progress", "$.timestamp").try_cast("timestamp")
    return log.groupBy("group_id").agg(F.max_by("progress", F.struct(time, "progress")).alias("progress"))


def lag_from_progress(progress: DataFrame) -> DataFrame:
    """``group_id, progress`` (JSON of a StreamingQueryProgress) to the lag of each topic partition.

    Spark commits no offsets to consumer groups, so a Spark stream's lag is in its own progress. A stream without
    progress has the lag -1; one whose source has no partitions has nothing to lag behind: one row, without a lag.
    """
    unknown = progress.filter(F.col("progress").isNull()).select("group_id", F.lit(UNKNOWN_LAG).cast("bigint").alias("lag"))
    schema = "sources array<struct<endOffset string, latestOffset string>>"
    offsets = "map<string, map<string, bigint>>"
    sources = progress.filter(F.col("progress").isNotNull()).select(
        "group_id", F.explode_outer(F.from_json("progress", schema)["sources"]).alias("source")
    )
    topics = sources.select(
        "group_id",
        F.from_json("source.endOffset", offsets).alias("read"),
        F.explode_outer(F.from_json("source.latestOffset", offsets)).alias("topic", "latest"),
    )
    partitions = topics.select(
        "group_id", F.try_element_at("read", F.col("topic")).alias("read"), F.explode_outer("latest").alias("part", "end")
    )
    start = F.coalesce(F.try_element_at("read", F.col("part")), F.lit(0))
    return partitions.select("group_id", (F.col("end") - start).alias("lag")).unionByName(unknown)
