from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from railwatch.operators.attribution import alert_feed, attribute_failures, bank_history, with_severity
from railwatch.functions import band
from tests.helpers import SILVER, at

AS_OF = "2024-01-01 10:10:00"
TEXT = "2024-01-01T10:10:00.000000+00:00"


def snapshot(spark, *banks):
    data = [((at("10:00:00"), at("10:05:00")), m, 10, rate, latency, 0.0) for m, rate, latency in banks]
    return spark.createDataFrame(data, SILVER)


CASES = {
    "all healthy": ([("upi_hdfc", 99.0, 500.0), ("upi_axis", 95.0, 9000.0)], ("HEALTHY", "")),
    "just below 20 %": ([("upi_hdfc", 80.1, 500.0)], ("HEALTHY", "")),
    "exactly 20 %": ([("upi_hdfc", 80.0, 500.0)], ("BANK_SIDE_ISSUE", "upi_hdfc")),
    "one, just not slow": ([("upi_hdfc", 10.0, 2999.0)], ("BANK_SIDE_ISSUE", "upi_hdfc")),
    "one, slow": ([("upi_hdfc", 10.0, 3000.0), ("upi_axis", 90.0, 100.0)], ("PLATFORM_SIDE_ISSUE", "upi_hdfc")),
    "two, slow": ([("upi_sbi", 10.0, 3000.0), ("upi_axis", 70.0, 100.0)], ("NPCI_SIDE_ISSUE", "upi_axis,upi_sbi")),
    "one, no latency": ([("upi_hdfc", 10.0, None)], ("BANK_SIDE_ISSUE", "upi_hdfc")),
}


@pytest.mark.parametrize("case", CASES)
def test_rules(spark, case):
    banks, expected = CASES[case]
    assert [tuple(r) for r in attribute_failures(snapshot(spark, *banks), as_of=AS_OF).collect()] == [(*expected, TEXT)]


def test_no_snapshot_gives_no_row(spark):
    empty = spark.createDataFrame([], SILVER)
    assert attribute_failures(empty).count() == 0
    assert attribute_failures(empty, by="window").count() == 0


def test_history_classifies_each_window_and_ignores_other_methods(spark):
    data = [
        ((at("10:00:00"), at("10:05:00")), "upi_hdfc", 10, 10.0, 500.0, 0.0),
        ((at("10:00:00"), at("10:05:00")), "gpay", 10, 0.0, 500.0, 0.0),
        ((at("10:05:00"), at("10:10:00")), "upi_hdfc", 10, 99.0, 500.0, 0.0),
        ((at("10:10:00"), at("10:15:00")), "gpay", 10, 0.0, 500.0, 0.0),
    ]
    got = {r.window.end: (r.classification, r.detected_at) for r in bank_history(spark.createDataFrame(data, SILVER)).collect()}
    assert got == {
        at("10:05:00"): ("BANK_SIDE_ISSUE", "2024-01-01T10:05:00.000000+00:00"),
        at("10:10:00"): ("HEALTHY", TEXT),
    }


def test_alerts_and_display(spark):
    events = spark.createDataFrame(
        [("HEALTHY", "", "t1"), ("NPCI_SIDE_ISSUE", "a,b", "t2"), ("NEW_KIND", None, "t3")],
        "classification string, affected_banks string, detected_at string",
    )
    alerts = alert_feed(events.filter("affected_banks is not null")).collect()
    assert [a.message for a in alerts] == [":rotating_light: *NPCI_SIDE_ISSUE* detected\nAffected: a, b\nTime: t2"]
    shown = {r.classification: (r.severity, r.affected_display) for r in with_severity(events).collect()}
    assert shown == {"HEALTHY": ("ok", "none"), "NPCI_SIDE_ISSUE": ("critical", "a,b"), "NEW_KIND": ("unknown", "none")}


def test_bands(spark):
    rates = spark.createDataFrame([(95.0,), (94.99,), (90.0,), (89.99,), (None,)], "r double")
    assert [r[0] for r in rates.select(band("r")).collect()] == ["green", "yellow", "yellow", "red", "red"]
    assert rates.select(band(F.col("r"), ((50.0, "up"),), "down")).first()[0] == "up"
