"""Column expressions shared by the operators."""

from railwatch.functions.expressions import (
    age_minutes,
    as_of_time,
    band,
    complement_pct,
    count_where,
    csv_list,
    display_or_none,
    iso_text,
    number_text,
    rate_pct,
    safe_rate_pct,
    severity,
    to_event_time,
)

__all__ = [
    "age_minutes",
    "as_of_time",
    "band",
    "complement_pct",
    "count_where",
    "csv_list",
    "display_or_none",
    "iso_text",
    "number_text",
    "rate_pct",
    "safe_rate_pct",
    "severity",
    "to_event_time",
]
