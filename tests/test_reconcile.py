from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from railwatch.config import ReconConfig, SkewConfig
from railwatch.operators import reconcile as rc
from railwatch.operators.marts import mart_recon, mart_recon_from_rows
from railwatch.operators.skew import HotKey, find_hot_keys, skew_join
from railwatch.sources.tables import read_table
from tests.helpers import at, rows, settlement, txn

AS_OF = at("10:10:00")
SMALL = SkewConfig(rows_per_task=20, seen_rows=1000)


def fixture(spark):
    txns = txn(
        spark,
        dict(transaction_id="matched"),
        dict(transaction_id="old"),
        dict(transaction_id="young", event_time=at("10:09:00")),
        dict(transaction_id="at_cutoff", event_time=at("10:07:00")),
        dict(transaction_id="over_cutoff", event_time=at("10:06:59")),
        dict(transaction_id="failed", status="failed"),
        dict(transaction_id="off", amount_inr=250.5),
        dict(transaction_id="no_amount", amount_inr=None),
        dict(transaction_id="big", amount_inr=12345678.25),
        dict(transaction_id=None),
    )
    settlements = settlement(
        spark,
        dict(settlement_id="s1", transaction_id="matched"),
        dict(settlement_id="s2", transaction_id="off", settled_amount_inr=0.0, settlement_status="failed"),
        dict(settlement_id="s3", transaction_id="off"),
        dict(settlement_id="s4", transaction_id="nowhere", merchant_id="m9"),
        dict(settlement_id="s5", transaction_id="failed"),
        dict(settlement_id="s6", transaction_id="no_amount"),
        dict(settlement_id="s7", transaction_id=None),
        dict(settlement_id="s8", transaction_id="big", settled_amount_inr=1.0),
        dict(settlement_id="s9", transaction_id="matched", delay_seconds=181),
    )
    return txns, settlements


def test_overdue(spark):
    got = rc.overdue(*fixture(spark), as_of=AS_OF)
    assert {r.transaction_id for r in got.collect()} == {"old", "over_cutoff", None}


def test_orphans(spark):
    assert {r.settlement_id for r in rc.orphans(*fixture(spark)).collect()} == {"s4", "s5", "s7"}


def test_everything_is_an_orphan_without_transactions(spark):
    txns, settlements = fixture(spark)
    assert rc.orphans(txns.limit(0), settlements).count() == settlements.count()


def test_amount_mismatch_and_tolerance(spark):
    txns, settlements = fixture(spark)
    got = {(r.transaction_id, r.txn_amount, r.settled_amount) for r in rc.amount_mismatch(txns, settlements).collect()}
    assert got == {("off", 250.5, 0.0), ("off", 250.5, 100.0), ("big", 12345678.25, 1.0)}
    wide = rc.amount_mismatch(txns, settlements, ReconConfig(amount_tolerance=200.0))
    assert {(r.transaction_id, r.settled_amount) for r in wide.collect()} == {("off", 0.0), ("big", 1.0)}


def test_log_is_the_union_of_the_branches(spark):
    txns, settlements = fixture(spark)
    log = rc.mismatch_log(txns, settlements, as_of=AS_OF)
    lines = {(r.mismatch_type, r.transaction_id, r.detail) for r in log.collect()}
    assert lines == {
        ("SETTLEMENT_DELAYED", "old", "amount_inr=100.0"),
        ("SETTLEMENT_DELAYED", "over_cutoff", "amount_inr=100.0"),
        ("SETTLEMENT_DELAYED", None, "amount_inr=100.0"),
        ("ORPHAN_SETTLEMENT", "nowhere", "settlement_id=s4"),
        ("ORPHAN_SETTLEMENT", "failed", "settlement_id=s5"),
        ("ORPHAN_SETTLEMENT", None, "settlement_id=s7"),
        ("AMOUNT_MISMATCH", "off", "txn=250.5 settled=0.0"),
        ("AMOUNT_MISMATCH", "off", "txn=250.5 settled=100.0"),
        ("AMOUNT_MISMATCH", "big", "txn=12345678.25 settled=1.0"),
    }
    assert {r.merchant_id for r in log.filter("transaction_id = 'nowhere'").collect()} == {"m9"}
    assert {r.detected_at for r in log.collect()} == {"2024-01-01T10:10:00.000000+00:00"}
    counts = {r.mismatch_type: r.mismatches for r in rc.mismatch_counts(log).collect()}
    assert counts == {"SETTLEMENT_DELAYED": 3, "ORPHAN_SETTLEMENT": 3, "AMOUNT_MISMATCH": 3}


def test_log_shuffles_each_side_once(spark):
    plan = rc.mismatch_log(*fixture(spark), as_of=AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2


def test_enriched_fans_out_and_keeps_unsettled(spark):
    got = rc.enrich_payments(*fixture(spark))
    by_id = got.groupBy("transaction_id").count().collect()
    assert {r[0]: r[1] for r in by_id}["off"] == 2
    assert got.filter("transaction_id = 'old'").first().is_delayed is False
    assert [r.is_delayed for r in got.filter("settlement_id = 's9'").collect()] == [True]


def test_recon_mart_equals_the_row_level_form(spark):
    txns, settlements = fixture(spark)
    txns = txns.filter("transaction_id is not null")
    assert rows(mart_recon(txns, settlements)) == rows(mart_recon_from_rows(rc.enrich_payments(txns, settlements)))


def test_recon_mart_without_settlements(spark):
    txns, settlements = fixture(spark)
    row = mart_recon(txns.filter("transaction_id = 'old'"), settlements).first()
    assert (row.total_settled_transactions, row.delayed_count, row.total_settled_amount, row.amount_discrepancy) == (1, 0, None, None)


# --- hot keys ------------------------------------------------------------------------------------------------


def skewed(spark, folder):
    """A third of each side on one id, copies among them; a hot id on one side only; hot nulls."""
    rng = random.Random(7)
    t = [dict(transaction_id="hot", amount_inr=float(i % 3)) for i in range(100)]
    t += [dict(transaction_id=str(i), amount_inr=100.0 + i % 2) for i in range(80)]
    t += [dict(transaction_id="only_t")] * 60 + [dict(transaction_id=None)] * 50
    t += [dict(transaction_id="failed_hot", status="failed")] * 60
    s = [dict(settlement_id="copy", transaction_id="hot", settled_amount_inr=1.0)] * 70
    s += [dict(settlement_id=f"h{i}", transaction_id="hot", settled_amount_inr=float(i % 3)) for i in range(20)]
    s += [dict(settlement_id=f"s{i}", transaction_id=str(rng.randrange(120)), delay_seconds=rng.randrange(400)) for i in range(150)]
    s += [dict(settlement_id=f"o{i}", transaction_id="only_s") for i in range(60)]
    s += [dict(settlement_id=f"f{i}", transaction_id="failed_hot") for i in range(40)]
    s += [dict(settlement_id=f"n{i}", transaction_id=None) for i in range(50)]
    txn(spark, *t).write.parquet(f"{folder}/t")
    settlement(spark, *s).write.parquet(f"{folder}/s")
    return lambda position: (
        read_table(spark, f"{folder}/t", row_position=position),
        read_table(spark, f"{folder}/s", row_position=position),
    )


def test_hot_keys_are_found(spark, folder):
    txns, settlements = skewed(spark, folder)(False)
    hot_txns, hot_settlements = find_hot_keys("transaction_id", txns, settlements, cfg=SMALL)
    assert dict(hot_txns) == {"hot": 100, "only_t": 60, None: 50, "failed_hot": 60}
    assert dict(hot_settlements) == {"hot": 90, "only_s": 60, "failed_hot": 40, None: 50}
    assert find_hot_keys("transaction_id", txns, settlements) == [[], []]


@pytest.mark.parametrize("how", ["inner", "left", "full", "left_anti", "left_semi"])
@pytest.mark.parametrize("position", [False, True])
def test_skew_join_equals_the_plain_join(spark, folder, how, position):
    left, right = skewed(spark, folder)(position)
    salt = ["row_position"] if position else []
    left = left.select("transaction_id", "amount_inr", *salt)
    right = right.select("transaction_id", "settlement_id", "settled_amount_inr", *salt)
    left_hot, right_hot = find_hot_keys("transaction_id", left, right, cfg=SMALL)
    got = skew_join(left, right, "transaction_id", how, left_hot=left_hot, right_hot=right_hot, left_salt=salt, right_salt=salt, cfg=SMALL)
    expected = left.drop(*salt).join(right.drop(*salt), "transaction_id", how)
    assert got.columns == expected.columns
    assert rows(got) == rows(expected)


def test_other_joins_are_refused(spark):
    with pytest.raises(ValueError):
        skew_join(spark.range(1), spark.range(1), "id", "right")


def test_hot_key_is_spread_over_tasks(spark, folder):
    left, right = skewed(spark, folder)(True)
    salt = ["row_position"]
    right = right.select("transaction_id", "settlement_id", *salt)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        (hot,) = find_hot_keys("transaction_id", right, cfg=SMALL)
        one = left.select("transaction_id").filter("transaction_id = 'hot'").limit(1)
        joined = skew_join(one, right, "transaction_id", "left", right_hot=hot, right_salt=salt, cfg=SMALL)
        tasks = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(r[1] for r in tasks) == 90
    assert len(tasks) > 1


def test_operators_under_skew_equal_the_plain_ones(spark, folder):
    read = skewed(spark, folder)
    txns, settlements = read(False)
    hot_txns, hot_settlements, skew = rc.read_for_join(read, SMALL)
    assert skew.txn_hot and skew.settlement_hot
    pairs = [
        (rc.enrich_payments(hot_txns, hot_settlements, skew=skew), rc.enrich_payments(txns, settlements)),
        (rc.overdue(hot_txns, hot_settlements, as_of=AS_OF, skew=skew), rc.overdue(txns, settlements, as_of=AS_OF)),
        (rc.orphans(hot_txns, hot_settlements, skew=skew), rc.orphans(txns, settlements).select(*settlements.columns)),
        (rc.amount_mismatch(hot_txns, hot_settlements, skew=skew), rc.amount_mismatch(txns, settlements)),
        (rc.mismatch_log(hot_txns, hot_settlements, as_of=AS_OF, skew=skew), rc.mismatch_log(txns, settlements, as_of=AS_OF)),
        (mart_recon(hot_txns, hot_settlements, skew=skew), mart_recon(txns, settlements)),
    ]
    for got, expected in pairs:
        assert rows(got.select(*expected.columns)) == rows(expected)


def test_no_positions_are_read_without_hot_keys(spark, folder):
    txns, settlements, skew = rc.read_for_join(skewed(spark, folder))
    assert "row_position" not in txns.columns + settlements.columns
    assert not skew.txn_hot and not skew.settlement_hot


@pytest.mark.parametrize("how", ["inner", "left", "full", "left_semi", "left_anti"])
def test_stale_hot_list_loses_no_rows(spark, how):
    """A list found in other rows: keys that one side, or both, no longer hold."""
    left = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "id string, x int")
    right = spark.createDataFrame([("b", 5), ("c", 6), ("c", 7), (None, 8)], "id string, y int")
    hot = [HotKey(k, 100) for k in ("a", "b", "c", "gone", None)]
    for left_hot, right_hot in ((hot, []), ([], hot), (hot, hot)):
        got = skew_join(left, right, "id", how, left_hot=left_hot, right_hot=right_hot, cfg=SMALL)
        assert rows(got) == rows(left.join(right, "id", how))


def test_log_is_the_union_of_its_branches_with_null_ids(spark):
    txns = txn(spark, dict(transaction_id="t"), dict(transaction_id="u"))
    settlements = settlement(
        spark,
        dict(transaction_id="t", settlement_id="s1"),
        dict(transaction_id="t"),
        dict(transaction_id="t"),
        dict(transaction_id="nobody", settlement_id="o"),
    )
    log = rc.mismatch_log(txns, settlements, as_of=AS_OF)
    counts = {r.mismatch_type: r.mismatches for r in rc.mismatch_counts(log).collect()}
    assert counts[rc.DELAYED] == rc.overdue(txns, settlements, as_of=AS_OF).count() == 3
    assert counts[rc.ORPHAN] == rc.orphans(txns, settlements).count() == 1


def test_amounts_are_told_exactly(spark):
    from railwatch.functions import number_text

    values = [0.1 + 0.2, 0.3, 1.0, 1e-11, 12345678.5, 0.00025, 123456789012345.6, None, -0.5, 2e16]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").select(number_text("v")).collect()]
    assert [None if g == "None" else float(g) for g in got] == values
    assert got[:5] == ["0.30000000000000004", "0.3", "1.0", "1.0E-11", "12345678.5"] and got[5] == "0.00025"
