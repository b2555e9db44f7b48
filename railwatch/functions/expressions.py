from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from railwatch.config import LOWEST_BAND, SEVERITY, SUCCESS_BANDS, UNKNOWN_SEVERITY


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_of_time(as_of: Column | datetime | str | None) -> Column:
    """The reference time of a run; Spark fixes the default once per query."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("timestamp")


def to_event_time(c: Column | str) -> Column:
    """ISO-8601 text to timestamp; text that is no time gives null, also in ANSI mode."""
    return _col(c).try_cast("timestamp")


def iso_text(c: Column | str) -> Column:
    return F.date_format(_col(c), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")


def count_where(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0))


def rate_pct(part: Column | str, total: Column | str) -> Column:
    """The rate in percent, null where the total is 0."""
    return F.try_divide(_col(part), _col(total)) * 100


def safe_rate_pct(part: Column | str, total: Column | str) -> Column:
    """The rate in percent, 0 where the total is 0."""
    return F.when(_col(total) != 0, rate_pct(part, total)).otherwise(F.lit(0.0))


def complement_pct(rate: Column | str) -> Column:
    return F.lit(100.0) - _col(rate)


def age_minutes(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))) / F.lit(60e6)


def csv_list(items: Column) -> Column:
    """Array to comma-separated text in sorted order; empty gives ''."""
    return F.concat_ws(",", F.array_sort(items))


def display_or_none(c: Column | str) -> Column:
    return F.coalesce(F.nullif(_col(c), F.lit("")), F.lit("none"))


def number_text(c: Column | str) -> Column:
    """A double as its shortest exact text, plain from 0.0001 up to 10^16 (``1.0``, ``12345678.5``); null as ``None``."""
    c = _col(c)
    text = c.cast("string")
    # Spark writes an exponent outside of 0.001 to 10^7.
    plain = F.regexp_replace(text.try_cast("decimal(38,21)").cast("string"), r"(\.\d+?)0+$", "$1")
    in_range = (F.abs(c) >= 1e-4) & (F.abs(c) < 1e16)
    return F.coalesce(F.when(in_range & text.contains("E"), plain), text, F.lit("None"))


def band(rate: Column | str, bands=SUCCESS_BANDS, lowest: str = LOWEST_BAND) -> Column:
    """The first band whose lower bound the rate reaches."""
    rate = _col(rate)
    chain = F
    for lower, name in bands:
        chain = chain.when(rate >= lower, name)
    return chain.otherwise(lowest)


def severity(classification: Column | str, levels=SEVERITY, default: str = UNKNOWN_SEVERITY) -> Column:
    pairs = [F.lit(x) for pair in levels.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), _col(classification)), F.lit(default))
