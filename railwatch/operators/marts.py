"""The aggregate marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railwatch.config import ReconConfig
from railwatch.functions import count_where, to_event_time
from railwatch.operators.reconcile import NO_SKEW, ReconSkew, successful
from railwatch.operators.skew import skew_join


def mart_ops(txns: DataFrame) -> DataFrame:
    """Volume, outcome and latency per day, payment method and merchant category."""
    return txns.groupBy("event_date", "payment_method", "merchant_category").agg(
        F.count(F.lit(1)).alias("total_transactions"),
        count_where(F.col("status") == "success").alias("success_count"),
        count_where(F.col("status") == "timeout").alias("timeout_count"),
        F.sum("amount_inr").alias("total_volume_inr"),
        F.avg("response_time_ms").alias("avg_response_time_ms"),
    )


def _discrepancy(df: DataFrame) -> DataFrame:
    return df.withColumn("amount_discrepancy", F.col("total_txn_amount") - F.col("total_settled_amount"))


def mart_recon(
    txns: DataFrame, settlements: DataFrame, cfg: ReconConfig = ReconConfig(), *, skew: ReconSkew = NO_SKEW
) -> DataFrame:
    """Settled against expected amounts of successful transactions per day and merchant.

    A transaction counts once per settlement it has, and once when it has none, as in the row-level join. Here the
    settlements are added up per transaction id before the join, on the partitioning the join needs anyway: an id
    with very many settlements is combined in the map tasks, and the join gives one row per transaction.
    """
    late = F.col("delay_seconds") > cfg.settlement_delay_seconds
    per_id = settlements.groupBy("transaction_id").agg(
        F.count(F.lit(1)).alias("settlements"),
        count_where(late).alias("delayed"),
        F.sum("settled_amount_inr").alias("settled"),
    )
    paid = successful(txns).select("transaction_id", "event_date", "merchant_id", "amount_inr", *skew.txn_salt)
    pairs = F.coalesce(F.col("settlements"), F.lit(1))
    return _discrepancy(
        skew_join(paid, per_id, "transaction_id", "left", left_hot=skew.txn_hot, left_salt=skew.txn_salt, cfg=skew.cfg)
        .groupBy("event_date", "merchant_id")
        .agg(
            F.sum(pairs).alias("total_settled_transactions"),
            F.sum(F.coalesce(F.col("delayed"), F.lit(0))).alias("delayed_count"),
            F.sum(F.col("amount_inr") * pairs).alias("total_txn_amount"),
            F.sum("settled").alias("total_settled_amount"),
        )
    )


def mart_recon_from_rows(enriched: DataFrame) -> DataFrame:
    """The same mart from the row-level view of enriched payments, where that is stored already."""
    return _discrepancy(
        enriched.groupBy("event_date", "merchant_id").agg(
            F.count(F.lit(1)).alias("total_settled_transactions"),
            count_where(F.col("is_delayed")).alias("delayed_count"),
            F.sum("amount_inr").alias("total_txn_amount"),
            F.sum("settled_amount_inr").alias("total_settled_amount"),
        )
    )


def mart_payout(payouts: DataFrame) -> DataFrame:
    """Payouts, delays and volume per planned day, platform and type of recipient."""
    planned = F.col("expected_payout_time")
    if dict(payouts.dtypes)["expected_payout_time"] == "string":
        planned = to_event_time(planned)
    return (
        payouts.withColumn("event_date", F.to_date(planned))
        .groupBy("event_date", "platform", "recipient_type")
        .agg(
            F.count(F.lit(1)).alias("total_payouts"),
            count_where(F.col("payout_status") == "delayed").alias("delayed_count"),
            count_where(F.col("payout_status") == "paid").alias("paid_count"),
            F.sum("payout_amount_inr").alias("total_payout_volume_inr"),
            F.avg("delay_minutes").alias("avg_delay_minutes"),
        )
    )


def mart_correlation(events: DataFrame) -> DataFrame:
    return events.select("classification", "affected_banks", "detected_at")
