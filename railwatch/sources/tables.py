"""Batch tables: reads by path, views, marts, logs and exports."""

from __future__ import annotations

import uuid
from urllib.parse import urlparse

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_ABSENT = {"PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND"}
ROW_POSITION = "row_position"
FILE_FORMATS = ("parquet", "orc", "json", "csv", "text", "avro")


def read_table(
    spark: SparkSession, path: str, fmt: str = "parquet", row_position: bool = False, schema: StructType | None = None, **options
) -> DataFrame:
    """A table by path.

    ``row_position`` adds a hash of file and row number. It is the same in every attempt of a task and differs
    between copies of a row, so joins can spread copies by it. Formats that do not number their rows get the number
    within the task instead, which the split of the file makes the same in every attempt.
    """
    reader = spark.read.format(fmt).options(**options)
    df = (reader.schema(schema) if schema else reader).load(path)
    if row_position:
        number = F.col("_metadata.row_index") if fmt == "parquet" else F.monotonically_increasing_id()
        position = F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), number)
        df = df.select("*", position.alias(ROW_POSITION))
    return df


def read_or_empty(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """The table, or no rows of the given schema where it does not exist; other errors are raised."""
    found = read_if_present(spark, path, fmt)
    return spark.createDataFrame([], schema) if found is None else found


def read_if_present(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    try:
        df = spark.read.format(fmt).load(path)
        df.schema
        return df
    except AnalysisException as error:
        if error.getCondition() in _ABSENT:
            return None
        raise


def landed_name(topic: str) -> str:
    return f"landed_{topic}"


def ensure_folder(spark: SparkSession, path: str) -> None:
    """Makes a folder of the file system that the path names."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)


def sql_table(path: str, fmt: str = "parquet") -> str:
    """The name by which SQL text reads a table by path."""
    return f"{fmt}.`{path}`"


def register_views(tables: dict[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def write_mart(df: DataFrame, path: str, fmt: str = "parquet", partition_by: str | None = None) -> int:
    """Overwrites the table with its new schema and gives the rows written, counted during the write."""
    written = Observation()
    # AQE cuts a large date into several files and joins small ones. Counted after that shuffle, in the tasks that
    # write: a map task that runs again would count its rows twice.
    writer = df.hint("rebalance", partition_by) if partition_by else df
    writer = writer.observe(written, F.count(F.lit(1)).alias("rows"))
    out = writer.write.format(fmt).mode("overwrite").option("overwriteSchema", "true")
    if partition_by:
        out = out.partitionBy(partition_by)
    out.save(path)
    return written.get["rows"]


def append_log(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    df.write.format(fmt).mode("append").option("mergeSchema", "true").save(path)


def read_log(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """An appended log whose files may differ in schema."""
    return read_table(spark, path, fmt, mergeSchema="true")


def append_json_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header row. One file is for marts a desktop tool opens; it passes through one task."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)


def report_rows(spark: SparkSession, report: str, generated_at: str) -> DataFrame:
    return spark.range(1).select(F.lit(report).alias("report"), F.lit(generated_at).alias("generated_at"))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder all executors share, as named by the session.

    Without ``spark.checkpoint.dir`` that is the warehouse, if it is shared: a folder of the driver's own disk is refused
    unless everything runs on one machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir")
        local = spark.sparkContext.master.startswith("local")
        if not local and (urlparse(base).scheme or "file") == "file":
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share; {base} is on one machine")
    return f"{base.rstrip('/')}/railwatch-{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str) -> DataFrame:
    """The rows written to a new table of the shared folder and read from there: for plans that several jobs use."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
