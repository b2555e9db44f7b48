"""The scheduled jobs: typed tables, marts, attribution, reconciliation, checks and exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from railwatch import schemas
from railwatch.config import BANK_METHODS, AttributionConfig, ReconConfig, SkewConfig
from railwatch.operators import attribution, marts, quality
from railwatch.operators.health import bank_health, newest_windows
from railwatch.operators.parse import TRANSACTIONS, parse_topic, staged_transactions
from railwatch.operators.reconcile import NO_SKEW, ReconSkew, enrich_payments, mismatch_log, read_for_join
from railwatch.plans.stream_tables import topic_table, topic_table_if_present
from railwatch.sources.tables import (
    ROW_POSITION,
    append_log,
    export_csv,
    read_if_present,
    read_or_empty,
    read_table,
    register_views,
    write_mart,
)

EXPORTED_MARTS = ("mart_ops_dashboard_metrics", "mart_settlement_reconciliation", "mart_correlation_summary")
DLQ_TABLES = ("dlq_transactions", "dlq_settlements")


def type_transactions(spark: SparkSession, root: str, fmt: str = "parquet") -> int:
    """Bronze JSON to typed rows, by date, for a table the stream did not write.

    Parsed once here; jobs on the typed rows prune columns and dates at the scan.
    """
    bronze = read_table(spark, f"{root}/bronze_transactions", fmt)
    typed = staged_transactions(parse_topic(bronze, TRANSACTIONS).valid)
    return write_mart(typed, f"{root}/typed_transactions", fmt, partition_by="event_date")


def _payments(spark: SparkSession, root: str, fmt: str, cfg: SkewConfig):
    return read_for_join(
        lambda position: (
            topic_table(spark, root, "typed_transactions", fmt, row_position=position),
            topic_table(spark, root, "silver_settlements", fmt, row_position=position),
        ),
        cfg,
    )


def build_marts(
    spark: SparkSession, root: str, cfg: ReconConfig = ReconConfig(), skew: SkewConfig = SkewConfig(), fmt: str = "parquet"
) -> dict[str, int]:
    """Writes the marts from the typed tables and gives the rows of each. A mart without input is left out."""
    txns, settlements, hot = _payments(spark, root, fmt, skew)
    found = {
        "mart_ops_dashboard_metrics": marts.mart_ops(txns),
        "mart_settlement_reconciliation": marts.mart_recon(txns, settlements, cfg, skew=hot),
    }
    events = read_if_present(spark, f"{root}/gold_correlation_events", fmt)
    if events is not None:
        found["mart_correlation_summary"] = marts.mart_correlation(events)
    payouts = topic_table_if_present(spark, root, "silver_payouts", fmt)
    if payouts is not None:
        found["mart_payout_health"] = marts.mart_payout(payouts)
    return {name: write_mart(df, f"{root}/{name}", fmt) for name, df in found.items()}


def run_attribution(
    spark: SparkSession, root: str, cfg: AttributionConfig = AttributionConfig(), *, as_of=None, fmt: str = "parquet"
) -> None:
    """Appends the classification of the newest windows to the log; without windows it appends no row."""
    newest = newest_windows(spark, f"{root}/silver_transactions", cfg.banks, fmt)
    result = attribution.attribute_failures(newest, cfg, as_of=as_of)
    append_log(result, f"{root}/gold_correlation_events", fmt)


def run_reconciliation(
    spark: SparkSession,
    root: str,
    cfg: ReconConfig = ReconConfig(),
    *,
    as_of=None,
    skew: SkewConfig = SkewConfig(),
    fmt: str = "parquet",
) -> None:
    """Appends all mismatches to the log."""
    txns, settlements, hot = _payments(spark, root, fmt, skew)
    log = mismatch_log(txns, settlements, cfg, as_of=as_of, skew=hot)
    append_log(log, f"{root}/gold_settlement_mismatches", fmt)


def run_quality(spark: SparkSession, root: str, fmt: str = "parquet") -> tuple[DataFrame, DataFrame]:
    """Check results of both marts, and the state of the dead-letter tables."""
    ops = read_or_empty(spark, f"{root}/mart_ops_dashboard_metrics", schemas.MART_OPS, fmt)
    recon = read_or_empty(spark, f"{root}/mart_settlement_reconciliation", schemas.MART_RECON, fmt)
    results = quality.run_checks(ops, "mart_ops_dashboard_metrics", quality.ops_mart_checks()).unionByName(
        quality.run_checks(recon, "mart_settlement_reconciliation", quality.recon_mart_checks())
    )
    return results, quality.dlq_health(
        spark, {name: topic_table_if_present(spark, root, name, fmt) for name in DLQ_TABLES}, fmt
    )


def export_marts(spark: SparkSession, root: str, out: str, fmt: str = "parquet", single_file: bool = False) -> None:
    for name in EXPORTED_MARTS:
        export_csv(read_table(spark, f"{root}/{name}", fmt), f"{out}/{name}", single_file=single_file)


def register_payment_views(
    txns: DataFrame, settlements: DataFrame, cfg: ReconConfig = ReconConfig(), *, skew: ReconSkew = NO_SKEW
) -> None:
    """Temporary views for SQL users; Catalyst inlines them into the query that names them. Hot ids are spread in them, too."""
    plain, settled = txns.drop(ROW_POSITION), settlements.drop(ROW_POSITION)
    register_views(
        {
            "staged_transactions": plain,
            "staged_settlements": settled,
            "bank_health_hourly": bank_health(plain),
            "payment_enriched": enrich_payments(txns, settlements, cfg, skew=skew),
            "bank_transactions": plain.filter(plain["payment_method"].isin(*BANK_METHODS)),
        }
    )
