from __future__ import annotations

import json
import os

import pytest

from railwatch import schemas
from railwatch.config import WindowConfig
from railwatch.operators.health import window_health
from railwatch.plans import jobs
from railwatch.sources.streams import event_stream
from railwatch.sources.tables import append_log, export_csv, read_log, read_table, report_rows, scratch_path, sql_table, store, write_mart
from tests.helpers import SILVER, at, rows, settlement


def test_overwrite_replaces_schema_and_counts(spark, folder):
    path = f"{folder}/mart"
    assert write_mart(spark.range(10).selectExpr("id AS a", "id AS b"), path) == 10
    assert write_mart(spark.range(3).selectExpr("'x' AS b"), path) == 3
    assert rows(read_table(spark, path)) == [("x",)] * 3


def test_partitioned_write_prunes(spark, folder):
    path = f"{folder}/typed"
    dated = spark.range(100).selectExpr("id", "date_add(date'2024-01-01', CAST(id % 4 AS int)) AS event_date")
    assert write_mart(dated, path, partition_by="event_date") == 100
    day = read_table(spark, path).filter("event_date = date'2024-01-02'")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert day.count() == 25


def test_appended_logs_merge_their_columns(spark, folder):
    path = f"{folder}/log"
    append_log(report_rows(spark, "all well", "t1"), path)
    append_log(report_rows(spark, "still well", "t2").selectExpr("*", "1 AS score"), path)
    assert rows(read_log(spark, path).select("report", "generated_at", "score")) == [("all well", "t1", None), ("still well", "t2", 1)]


@pytest.mark.parametrize("single", [True, False])
def test_csv_export(spark, folder, single):
    df = spark.createDataFrame([("a,b", 1.5), ("c", None)], "s string, d double").repartition(2)
    export_csv(df, f"{folder}/csv", single_file=single)
    back = spark.read.schema(df.schema).option("header", True).csv(f"{folder}/csv")
    assert rows(back) == rows(df)
    files = [f for f in os.listdir(f"{folder}/csv") if f.endswith(".csv")]
    assert len(files) == (1 if single else 2)


def test_scratch_is_in_the_folder_the_session_names(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert store(spark.range(5).toDF("id"), "five").count() == 5


def test_sql_by_path(spark, folder):
    spark.range(5).write.parquet(f"{folder}/t")
    assert spark.sql(f"SELECT sum(id) FROM {sql_table(folder + '/t')}").first()[0] == 10


def test_row_positions_are_stable_and_tell_copies_apart(spark, folder):
    spark.range(100).selectExpr("1 AS x").repartition(3).write.parquet(f"{folder}/t")
    read = lambda: rows(read_table(spark, f"{folder}/t", row_position=True))
    first = read()
    assert len(set(first)) == 100 and read() == first


def test_broker_source_needs_the_broker_package(spark):
    # The package is not part of plain Spark; with it the same call subscribes to the topic.
    with pytest.raises(Exception, match="[Kk]afka"):
        event_stream(spark, "transactions")


def raw_transaction(i: int, **fields) -> str:
    event = dict(
        transaction_id=f"t{i}",
        merchant_id="m1",
        merchant_category="mobility",
        payment_method="upi_hdfc",
        amount_inr=100.0,
        status="success",
        response_time_ms=400,
        timestamp=f"2024-01-01T10:{i % 60:02}:00.000000+00:00",
    )
    return json.dumps({**event, **fields})


def test_jobs_from_bronze_to_marts(spark, folder):
    values = [raw_transaction(i, status="failed" if i % 3 == 2 else "success") for i in range(30)] + ["{", "{}"]
    bronze = spark.createDataFrame([(None, v, at("10:00:00")) for v in values], schemas.BRONZE)
    bronze.write.parquet(f"{folder}/bronze_transactions")
    settlement(
        spark,
        dict(settlement_id="s1", transaction_id="t1", delay_seconds=500),
        dict(settlement_id="s2", transaction_id="t3", settled_amount_inr=0.0),
        dict(settlement_id="s3", transaction_id="t2"),
    ).write.parquet(f"{folder}/silver_settlements")

    assert jobs.type_transactions(spark, folder) == 30
    typed = read_table(spark, f"{folder}/typed_transactions")
    write_mart(window_health(typed, WindowConfig()), f"{folder}/silver_transactions")
    jobs.run_attribution(spark, folder, as_of=at("11:00:00"))
    written = jobs.build_marts(spark, folder)
    assert written == {"mart_ops_dashboard_metrics": 1, "mart_settlement_reconciliation": 1, "mart_correlation_summary": 1}

    recon = read_table(spark, f"{folder}/mart_settlement_reconciliation").first()
    assert (recon.total_settled_transactions, recon.delayed_count, recon.amount_discrepancy) == (20, 1, 1900.0)
    assert rows(read_table(spark, f"{folder}/mart_correlation_summary")) == [("BANK_SIDE_ISSUE", "upi_hdfc", "2024-01-01T11:00:00.000000+00:00")]

    jobs.run_reconciliation(spark, folder, as_of=at("2024-01-02 00:00:00"))
    counts = read_table(spark, f"{folder}/gold_settlement_mismatches").groupBy("mismatch_type").count()
    assert set(map(tuple, counts.collect())) == {("SETTLEMENT_DELAYED", 18), ("ORPHAN_SETTLEMENT", 1), ("AMOUNT_MISMATCH", 1)}

    results, dlq = jobs.run_quality(spark, folder)
    assert results.filter("success").count() == results.count() == 10
    assert rows(dlq) == [("dlq_settlements", None, "SKIP"), ("dlq_transactions", None, "SKIP")]
    jobs.export_marts(spark, folder, f"{folder}/export")
    assert spark.read.option("header", True).csv(f"{folder}/export/mart_correlation_summary").count() == 1


def test_attribution_without_windows_logs_nothing(spark, folder):
    spark.createDataFrame([], SILVER).write.parquet(f"{folder}/silver_transactions")
    jobs.run_attribution(spark, folder)
    assert read_table(spark, f"{folder}/gold_correlation_events").count() == 0
