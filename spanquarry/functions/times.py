"""Time parsing and durations."""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}([.,]\d{1,6})?)?)?([+-]\d{2}:?\d{2})?)?$"
MS_FROM = 1e11  # numbers above this are epoch milliseconds, below it seconds


def iso_time(text: Column) -> Column:
    """ISO-8601 text to an instant: ``Z`` allowed, no zone means UTC, anything else is null."""
    t = F.replace(F.trim(text), F.lit("Z"), F.lit("+00:00"))
    return F.when(t.rlike(ISO), t.try_cast("timestamp"))


def epoch_time(value: Column) -> Column:
    seconds = F.when(value > MS_FROM, value / 1000.0).otherwise(value.cast("double"))
    return F.timestamp_micros(F.round(seconds * 1_000_000).cast("bigint"))


def parse_mixed_time(value: Column) -> Column:
    """JSON value (as text) that is an ISO string or an epoch number."""
    v = F.try_parse_json(value)
    number = F.schema_of_variant(v).rlike("^(BIGINT|DOUBLE|DECIMAL|FLOAT|INT|SMALLINT|TINYINT)")
    return F.when(F.coalesce(number, F.lit(False)), epoch_time(F.try_variant_get(v, "$", "double"))).otherwise(
        iso_time(F.coalesce(F.try_variant_get(v, "$", "string"), value))
    )


def parse_relative(text: Column, now: Column) -> Column:
    """``7d`` / ``24h`` / ``30m`` before ``now``, else an ISO time."""
    t = F.lower(F.trim(text))
    amount = F.regexp_extract(t, "^([0-9]+)[dhm]$", 1)
    n = F.nullif(amount, F.lit("")).try_cast("int")
    unit = F.right(t, F.lit(1))
    delta = (
        F.when(unit == "d", F.make_dt_interval(days=n))
        .when(unit == "h", F.make_dt_interval(hours=n))
        .otherwise(F.make_dt_interval(mins=n))
    )
    return F.when(n.isNotNull(), now - delta).otherwise(iso_time(text))


def window_seconds(text: str) -> int:
    """Seconds of a window label such as ``24h`` or ``7d``."""
    match = re.fullmatch(r"(\d+)([dhm])", text.strip().lower())
    if not match:
        raise ValueError(f"not a window: {text!r}")
    return int(match[1]) * {"d": 86400, "h": 3600, "m": 60}[match[2]]


def latency_ms(start: Column, end: Column, guard: str = "not_before") -> Column:
    """Whole milliseconds between two instants.

    ``not_before``: null if end < start; ``after``: null unless end > start; ``clamp``: at least 0.
    """
    span = F.floor((F.unix_micros(end) - F.unix_micros(start)) / 1000).cast("long")
    if guard == "not_before":
        return F.when(end >= start, span)
    if guard == "after":
        return F.when(end > start, span)
    return F.when(start.isNotNull() & end.isNotNull(), F.greatest(F.lit(0).cast("long"), span))
