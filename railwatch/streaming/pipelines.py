"""Stream pipelines: raw, dead-letter and typed or windowed tables from one topic."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from railwatch.config import WindowConfig
from railwatch.operators.health import WINDOW_DATE, dated_windows, window_health
from railwatch.operators.parse import EventSpec, landed_events, landed_schema, valid_events
from railwatch.sources.tables import FILE_FORMATS, ensure_folder, landed_name


_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
#: A landed table has two routes; a table by date may get late rows of some days in one batch.
OPEN_FILES = 16


def keep_files_open(spark: SparkSession, n: int = OPEN_FILES) -> None:
    """Lets writes keep up to ``n`` files of a parted table open in a task, unless the session sets a number itself.
    Otherwise Spark sorts all rows of the task by partition first, which takes memory and spills in proportion to them;
    here that begins with the ``n+1``-th partition of a task. File sinks read this from the session batch by batch, so
    it stays set."""
    if int(spark.conf.get(_WRITERS)) == 0:
        spark.conf.set(_WRITERS, n)


_STATE = "spark.sql.streaming.stateStore"
#: State in RocksDB, of which a bounded part is in memory; each batch uploads what it changed. Rows are not counted, which
#: would look each one up before it is put.
STATE_ON_DISK = {
    f"{_STATE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STATE}.rocksdb.boundedMemoryUsage": "true",
    f"{_STATE}.rocksdb.changelogCheckpointing.enabled": "true",
    f"{_STATE}.rocksdb.trackTotalNumberOfRows": "false",
}


def keep_state_on_disk(spark: SparkSession) -> None:
    """Lets state lie on the executors' disks, by ``STATE_ON_DISK``, but for what the session sets itself. Spark's own
    choice keeps all of it on their heaps. Streams read this from the session when they first start, so it stays set."""
    for key, value in STATE_ON_DISK.items():
        if not spark.conf.get(key, ""):
            spark.conf.set(key, value)


@dataclass(frozen=True)
class Sink:
    """Where the tables of a pipeline go; each query has a checkpoint of its own."""

    tables: str
    checkpoints: str
    fmt: str = "parquet"
    once: bool = False
    interval: str | None = None

    def start(self, df: DataFrame, name: str, *partition_by: str) -> StreamingQuery:
        writer = df.writeStream.format(self.fmt).outputMode("append").queryName(name)
        if partition_by:
            keep_files_open(df.sparkSession)
            writer = writer.partitionBy(*partition_by)
        writer = writer.option("checkpointLocation", f"{self.checkpoints}/{name}")
        if self.once:
            writer = writer.trigger(availableNow=True)
        elif self.interval:
            writer = writer.trigger(processingTime=self.interval)
        return writer.start(f"{self.tables}/{name}")


def watermarked(events: DataFrame, cfg: WindowConfig = WindowConfig()) -> DataFrame:
    return events.withWatermark("event_time", cfg.watermark)


def silver_windows(valid: DataFrame, cfg: WindowConfig = WindowConfig()) -> DataFrame:
    """The windowed health of typed transactions, each window once it is closed."""
    return window_health(watermarked(valid, cfg), cfg)


def silver_windows_by_date(valid: DataFrame, cfg: WindowConfig = WindowConfig()) -> DataFrame:
    return dated_windows(silver_windows(valid, cfg))


class Output(NamedTuple):
    """A table made of the typed rows."""

    make: Callable[[DataFrame], DataFrame]
    partition_by: str | None = None


#: Raw records, dead letters and typed rows only.
ROWS: dict[str, Output] = {}
#: Windows for the health of methods as well.
WINDOWS = {"silver": Output(silver_windows)}
#: The same in a table parted by date, of which the newest windows can be had without the history.
WINDOWS_BY_DATE = {"silver": Output(silver_windows_by_date, WINDOW_DATE)}


def start_pipeline(
    raw: DataFrame, spec: EventSpec, sink: Sink, outputs: dict[str, Output] = ROWS, *, strict: bool = True
) -> list[StreamingQuery]:
    """Reads a raw stream once, parses each record once and writes it once, to the table ``landed_<topic>``.

    That table is parted by route. Raw records, dead letters and typed rows are its columns and partitions
    (``topic_table``), so nothing is stored twice and none can be ahead of the others: a batch is committed to
    all three at once, also after a failure in its midst. It is not parted by date, as one old record would then make a
    file of its own; records arrive about in the order of their dates, so the ranges in the files serve as well. Each of ``outputs`` is a query of its own with its own checkpoint
    over the committed typed rows; it reads the columns it needs, not the source. With ``once`` the landing query has
    ended when the others start, so that they see all of it.
    """
    landing = sink.start(landed_events(raw, spec, strict), landed_name(spec.topic), "route")
    queries = [landing]
    if outputs:
        if sink.once:
            finish(queries)
        valid = valid_events(landed_stream(raw.sparkSession, sink, spec), spec)
        for name, output in outputs.items():
            parts = [output.partition_by] if output.partition_by else []
            queries.append(sink.start(output.make(valid), f"{name}_{spec.topic}", *parts))
    return queries


def landed_stream(spark: SparkSession, sink: Sink, spec: EventSpec) -> DataFrame:
    """What a landing query commits, as a stream."""
    path = f"{sink.tables}/{landed_name(spec.topic)}"
    # A stream of files may start before the first batch is there.
    ensure_folder(spark, path)
    reader = spark.readStream.format(sink.fmt)
    return (reader.schema(landed_schema(spec)) if sink.fmt in FILE_FORMATS else reader).load(path)


def finish(queries: list[StreamingQuery]) -> None:
    """Waits until all have ended, as those of ``once`` do by themselves. If one fails, the others are stopped and its
    error is raised."""
    try:
        while active := [q for q in queries if q.isActive]:
            active[0].awaitTermination(0.2)
            for query in queries:
                if error := query.exception():
                    raise error
        for query in queries:
            query.awaitTermination()
    except Exception:
        for query in queries:
            query.stop()
        raise


def progress_rows(spark: SparkSession, queries: list[StreamingQuery]) -> DataFrame:
    """The last progress of each query as ``group_id, progress``, the input of ``lag_from_progress``."""
    rows = [(q.name, q.lastProgress.json if q.lastProgress else None) for q in queries]
    return spark.createDataFrame(rows, "group_id string, progress string")


_RECONCILED = ("transaction_id", "merchant_id", "amount_inr", "txn_time", "settlement_id", "settled_amount_inr", "settled_time")


def _sides(txns: DataFrame, settlements: DataFrame) -> tuple[DataFrame, DataFrame]:
    t = txns.filter(F.col("status") == "success").select(
        F.col("transaction_id").alias("txn_id"), "merchant_id", "amount_inr", F.col("event_time").alias("txn_time")
    )
    s = settlements.select("transaction_id", "settlement_id", "settled_amount_inr", F.col("event_time").alias("settled_time"))
    return t, s


def untimed(txns: DataFrame, settlements: DataFrame) -> DataFrame:
    """Successful transactions and settlements without a time, in the columns of ``reconcile_stream``: no watermark ever
    passes a missing time, so they take no part there. Keeps no state."""
    t, s = _sides(txns, settlements)
    t = t.filter(F.col("txn_time").isNull()).withColumnRenamed("txn_id", "transaction_id")
    rows = t.unionByName(s.filter(F.col("settled_time").isNull()), allowMissingColumns=True)
    return rows.select(F.lit("UNTIMED").alias("kind"), *_RECONCILED, F.lit(0).alias("salt"), F.lit(1).alias("salts"))


def reconcile_stream(
    txns: DataFrame,
    settlements: DataFrame,
    *,
    watermark: str = "60 seconds",
    max_delay: str = "30 minutes",
    early: str = "1 minute",
    hot: Sequence[str] = (),
    salts: int = 16,
) -> DataFrame:
    """Successful transactions and settlements as both arrive; ``kind`` says what a row is.

    MATCHED: a transaction with a settlement from ``early`` before it (by the clocks of the senders) to ``max_delay`` after
    it, given out at once. OVERDUE: a transaction without one, and ORPHAN: a settlement without one (also one without a
    transaction id), each given out once the watermarks have passed the time in which its partner could still come.
    Both inputs need ``transaction_id`` and ``event_time``; ``untimed`` gives the rows without a time.

    The state is kept by transaction id. Of ``hot`` ids (a list of bounded size, as ``find_hot_keys`` makes it) settlements
    are dealt over ``salts`` keys and transactions are repeated for each, so that no state partition holds all of an id.
    A repeated transaction may be overdue for some salts only: ``settle_salts`` puts that right when the table is read.
    Rows without an id are spread over the salts, too. State is all rows of the last ``max_delay``, so it lies on disk.
    """
    keep_state_on_disk(txns.sparkSession)
    t, s = _sides(txns, settlements)
    t, s = t.filter(F.col("txn_time").isNotNull()), s.filter(F.col("settled_time").isNotNull())
    is_hot = lambda c: F.col(c).isin(*hot) if hot else F.lit(False)
    spread = lambda *c: F.pmod(F.xxhash64(*c), F.lit(salts)).cast("int")
    # The state finds missing ids equal, so those of the two sides get salts that are not.
    own = F.when(F.col("txn_id").isNull(), -1 - spread("merchant_id", "amount_inr", "txn_time")).otherwise(F.lit(0))
    t = t.select(
        "*",
        F.lit(True).alias("paid"),
        F.when(is_hot("txn_id"), F.lit(salts)).otherwise(F.lit(1)).alias("salts"),
        F.explode(F.when(is_hot("txn_id"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(own))).alias("t_salt"),
    )
    dealt = F.coalesce(is_hot("transaction_id"), F.lit(True))
    s = s.select("*", F.lit(True).alias("settled"), F.when(dealt, spread("settlement_id")).otherwise(F.lit(0)).alias("s_salt"))
    in_time = (F.col("settled_time") >= F.col("txn_time") - F.expr(f"INTERVAL {early}")) & (
        F.col("settled_time") <= F.col("txn_time") + F.expr(f"INTERVAL {max_delay}")
    )
    joined = t.withWatermark("txn_time", watermark).join(
        s.withWatermark("settled_time", watermark),
        (F.col("txn_id") == F.col("transaction_id")) & (F.col("t_salt") == F.col("s_salt")) & in_time,
        "fullOuter",
    )
    kind = F.when(F.col("paid").isNull(), "ORPHAN").when(F.col("settled").isNull(), "OVERDUE").otherwise("MATCHED")
    return joined.select(
        kind.alias("kind"),
        F.coalesce("txn_id", "transaction_id").alias("transaction_id"),
        *_RECONCILED[1:],
        F.coalesce("t_salt", "s_salt").alias("salt"),
        F.coalesce("salts", F.lit(1)).alias("salts"),
    )


def settle_salts(reconciled: DataFrame) -> DataFrame:
    """The rows of ``reconcile_stream`` without salts: a repeated transaction is overdue if it is for every salt.

    Only the overdue rows of hot ids are grouped; all others pass.
    """
    repeated = (F.col("kind") == "OVERDUE") & (F.col("salts") > 1)
    columns = ["kind", *_RECONCILED]
    groups = reconciled.filter(repeated).groupBy(*columns, "salts").agg(
        F.count_distinct("salt").alias("overdue_for"), F.count_if(F.col("salt") == 0).alias("rows")
    )
    overdue = groups.filter(F.col("overdue_for") == F.col("salts"))
    # A transaction that is there several times is overdue as often.
    overdue = overdue.withColumn("n", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
    return reconciled.filter(~repeated).select(*columns).unionByName(overdue.select(*columns))
