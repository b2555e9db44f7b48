"""Thresholds and sizes; every operator takes them as an argument."""

from __future__ import annotations

from dataclasses import dataclass

# Payment methods that are banks on the shared rail.
BANK_METHODS = ("upi_hdfc", "upi_axis", "upi_sbi", "upi_icici")

# Classifications and the severity shown for each.
SEVERITY = {
    "NPCI_SIDE_ISSUE": "critical",
    "PLATFORM_SIDE_ISSUE": "high",
    "BANK_SIDE_ISSUE": "medium",
    "HEALTHY": "ok",
}
UNKNOWN_SEVERITY = "unknown"

# Lower bounds of the success-rate bands, highest first.
SUCCESS_BANDS = ((95.0, "green"), (90.0, "yellow"))
LOWEST_BAND = "red"


# The defaults of the thresholds below.


@dataclass(frozen=True)
class AttributionConfig:
    failure_rate_pct: float = 20.0
    shared_rail_banks: int = 2
    slow_response_ms: float = 3000.0
    banks: tuple[str, ...] = BANK_METHODS


@dataclass(frozen=True)
class ReconConfig:
    settlement_delay_seconds: int = 180
    amount_tolerance: float = 0.0


@dataclass(frozen=True)
class WindowConfig:
    length: str = "5 minutes"
    slide: str = "1 minute"
    watermark: str = "60 seconds"


@dataclass(frozen=True)
class MonitorConfig:
    lag_alert: int = 5000
    lag_critical: int = 20000
    stale_minutes: float = 8.0


@dataclass(frozen=True)
class ForestConfig:
    trees: int = 200
    sample_size: int = 256
    contamination: float = 0.03
    seed: int = 42


@dataclass(frozen=True)
class SkewConfig:
    """A key with more than ``rows_per_task`` rows is spread over several tasks of a join.

    Keys are counted on so many rows that such a key shows up about ``seen_rows`` times. The count only chooses the
    plan; the joins use every row. The list that reaches the driver has at most a key per ``rows_per_task`` rows.
    """

    rows_per_task: int = 5_000_000
    seen_rows: int = 1_000
    seed: int = 42
