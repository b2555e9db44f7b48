"""Settlements against the transactions they settle."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railwatch.config import ReconConfig, SkewConfig
from railwatch.functions import as_of_time, iso_text, number_text
from railwatch.operators.skew import HotKey, find_hot_keys, skew_join
from railwatch.sources.tables import ROW_POSITION

# The types of mismatch and the text of the detail of each.
DELAYED, ORPHAN, AMOUNT = "SETTLEMENT_DELAYED", "ORPHAN_SETTLEMENT", "AMOUNT_MISMATCH"
DELAYED_TEXT, ORPHAN_TEXT, AMOUNT_TEXT = "amount_inr=%s", "settlement_id=%s", "txn=%s settled=%s"

_KEY = "transaction_id"


@dataclass(frozen=True)
class ReconSkew:
    """What the joins know of transaction ids that hold very many rows. The default is that there are none."""

    txn_hot: Sequence[HotKey] = ()
    settlement_hot: Sequence[HotKey] = ()
    txn_salt: Sequence[str] = ()
    settlement_salt: Sequence[str] = ()
    cfg: SkewConfig = SkewConfig()

    def txns_left(self) -> dict:
        return {
            "left_hot": self.txn_hot,
            "right_hot": self.settlement_hot,
            "left_salt": self.txn_salt,
            "right_salt": self.settlement_salt,
            "cfg": self.cfg,
        }

    def settlements_left(self) -> dict:
        return {
            "left_hot": self.settlement_hot,
            "right_hot": self.txn_hot,
            "left_salt": self.settlement_salt,
            "right_salt": self.txn_salt,
            "cfg": self.cfg,
        }


NO_SKEW = ReconSkew()


def measure_skew(
    txns: DataFrame, settlements: DataFrame, cfg: SkewConfig = SkewConfig(), keys: tuple[DataFrame, DataFrame] | None = None
) -> ReconSkew:
    """Looks for hot ids of successful transactions and of settlements, in one job over the two columns, or over ``keys``.

    Tables read with ``row_position`` are spread by it, so that copies of one row part too.
    """
    salt = lambda df: (ROW_POSITION,) if ROW_POSITION in df.columns else ()
    txn_hot, settlement_hot = find_hot_keys(_KEY, *(keys or (successful(txns), settlements)), cfg=cfg)
    return ReconSkew(txn_hot, settlement_hot, salt(txns), salt(settlements), cfg)


def read_for_join(
    read: Callable[[bool], tuple[DataFrame, DataFrame]],
    cfg: SkewConfig = SkewConfig(),
    keys: tuple[DataFrame, DataFrame] | None = None,
) -> tuple[DataFrame, DataFrame, ReconSkew]:
    """Transactions, settlements and their skew.

    ``read`` gets whether to add row positions; they are read only when there are hot ids to spread by them. ``keys``,
    where the tables come out of joins, has the transaction ids of successful transactions and of settlements as they
    are stored, so that the search for hot ids runs no join.
    """
    txns, settlements = read(False)
    skew = measure_skew(txns, settlements, cfg, keys)
    if not (skew.txn_hot or skew.settlement_hot):
        return txns, settlements, skew
    txns, settlements = read(True)
    return txns, settlements, replace(skew, txn_salt=(ROW_POSITION,), settlement_salt=(ROW_POSITION,))


def successful(txns: DataFrame) -> DataFrame:
    return txns.filter(F.col("status") == "success")


def is_overdue(event_time: Column, cfg: ReconConfig, as_of) -> Column:
    """Times are compared as times; at exactly the threshold a transaction is not yet overdue."""
    return event_time < as_of_time(as_of) - F.expr(f"INTERVAL {cfg.settlement_delay_seconds} SECONDS")


def amounts_differ(cfg: ReconConfig) -> Column:
    """Not equal, or further apart than the tolerance; a missing amount differs from nothing."""
    expected, settled = F.col("amount_inr"), F.col("settled_amount_inr")
    if cfg.amount_tolerance > 0:
        return F.abs(expected - settled) > cfg.amount_tolerance
    return expected != settled


def enrich_payments(
    txns: DataFrame,
    settlements: DataFrame,
    cfg: ReconConfig = ReconConfig(),
    *,
    skew: ReconSkew = NO_SKEW,
) -> DataFrame:
    """Every successful transaction with each of its settlements, or with none."""
    t = successful(txns).select(
        _KEY,
        "merchant_id",
        "payment_method",
        "amount_inr",
        "status",
        F.col("event_time").alias("transaction_time"),
        "event_date",
        *skew.txn_salt,
    )
    s = settlements.select(
        _KEY, "settlement_id", "settled_amount_inr", "settlement_status", "delay_seconds", *skew.settlement_salt
    )
    joined = skew_join(t, s, _KEY, "left", **skew.txns_left())
    late = F.coalesce(F.col("delay_seconds") > cfg.settlement_delay_seconds, F.lit(False))
    return joined.select(
        _KEY,
        "merchant_id",
        "payment_method",
        "amount_inr",
        "status",
        "transaction_time",
        "settlement_id",
        "settled_amount_inr",
        "settlement_status",
        "delay_seconds",
        late.alias("is_delayed"),
        "event_date",
    )


def overdue(
    txns: DataFrame,
    settlements: DataFrame,
    cfg: ReconConfig = ReconConfig(),
    *,
    as_of=None,
    skew: ReconSkew = NO_SKEW,
) -> DataFrame:
    """Successful transactions older than the threshold without a settlement, and each pair whose settlement has no id."""
    t = successful(txns).filter(is_overdue(F.col("event_time"), cfg, as_of)).select(_KEY, "merchant_id", "amount_inr", *skew.txn_salt)
    s = settlements.select(_KEY, "settlement_id", *skew.settlement_salt)
    pairs = skew_join(t, s, _KEY, "left", **skew.txns_left())
    return pairs.filter(F.col("settlement_id").isNull()).select(_KEY, "merchant_id", "amount_inr")


def orphans(
    txns: DataFrame,
    settlements: DataFrame,
    *,
    skew: ReconSkew = NO_SKEW,
) -> DataFrame:
    """Settlements of no successful transaction. One without a transaction id is an orphan too."""
    t = successful(txns).select(_KEY, *skew.txn_salt)
    lone = skew_join(settlements, t, _KEY, "left_anti", **skew.settlements_left())
    return lone.drop(ROW_POSITION)


def amount_mismatch(
    txns: DataFrame,
    settlements: DataFrame,
    cfg: ReconConfig = ReconConfig(),
    *,
    skew: ReconSkew = NO_SKEW,
) -> DataFrame:
    """Settled transactions whose amount is not the settled one. A failed settlement carries 0 and so is one."""
    t = successful(txns).select(_KEY, "merchant_id", "amount_inr", *skew.txn_salt)
    s = settlements.filter(F.col("settlement_id").isNotNull()).select(_KEY, "settled_amount_inr", *skew.settlement_salt)
    joined = skew_join(t, s, _KEY, "inner", **skew.txns_left())
    return joined.filter(amounts_differ(cfg)).select(
        _KEY, "merchant_id", F.col("amount_inr").alias("txn_amount"), F.col("settled_amount_inr").alias("settled_amount")
    )


def mismatch_log(
    txns: DataFrame,
    settlements: DataFrame,
    cfg: ReconConfig = ReconConfig(),
    *,
    as_of=None,
    skew: ReconSkew = NO_SKEW,
) -> DataFrame:
    """All mismatches as one log: the rows of ``overdue``, ``orphans`` and ``amount_mismatch``.

    The three exclude each other, so a single full outer join finds them all: each side is shuffled once. A pair
    whose settlement has no id counts as a transaction without settlement.
    """
    t = successful(txns).select(
        _KEY,
        F.col("merchant_id").alias("txn_merchant"),
        "amount_inr",
        "event_time",
        F.lit(True).alias("in_txns"),
        *skew.txn_salt,
    )
    s = settlements.select(
        _KEY,
        F.col("merchant_id").alias("settlement_merchant"),
        "settlement_id",
        "settled_amount_inr",
        *skew.settlement_salt,
    )
    pairs = skew_join(t, s, _KEY, "full", **skew.txns_left())
    in_txns, settled = F.col("in_txns").isNotNull(), F.col("settlement_id").isNotNull()
    kind = (
        F.when(~in_txns, ORPHAN)
        .when(~settled & is_overdue(F.col("event_time"), cfg, as_of), DELAYED)
        .when(settled & amounts_differ(cfg), AMOUNT)
    )
    detail = (
        F.when(F.col("mismatch_type") == DELAYED, F.format_string(DELAYED_TEXT, number_text("amount_inr")))
        .when(F.col("mismatch_type") == ORPHAN, F.format_string(ORPHAN_TEXT, F.coalesce("settlement_id", F.lit("None"))))
        .otherwise(F.format_string(AMOUNT_TEXT, number_text("amount_inr"), number_text("settled_amount_inr")))
    )
    return (
        pairs.withColumn("mismatch_type", kind)
        .filter(F.col("mismatch_type").isNotNull())
        .select(
            "mismatch_type",
            _KEY,
            F.when(in_txns, F.col("txn_merchant")).otherwise(F.col("settlement_merchant")).alias("merchant_id"),
            detail.alias("detail"),
            iso_text(as_of_time(as_of)).alias("detected_at"),
        )
    )


def mismatch_counts(log: DataFrame) -> DataFrame:
    return log.groupBy("mismatch_type").agg(F.count(F.lit(1)).alias("mismatches"))
