"""Deterministic sampling and monitoring eligibility."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def sampled(row_id: Column, rule_id: str, rate: float | Column) -> Column:
    """True for a stable share ``rate`` of ids; each rule draws its own sample.

    The first eight hexadecimal digits of md5(id:rule) are compared with the rate, so any engine draws the same sample.
    """
    rate = F.lit(rate) if isinstance(rate, (int, float)) else rate
    drawn = F.substring(F.md5(F.concat(row_id.cast("string"), F.lit(f":{rule_id}")).cast("binary")), 1, 8)
    edge = F.lpad(F.lower(F.hex((rate * F.lit(float(1 << 32))).cast("long"))), 8, "0")
    return F.when(rate >= 1, row_id.isNotNull()).otherwise(drawn < edge)


def monitor_eligible(
    monitor: Column, row_id: Column, enabled: Column, coverage: Column, rate: Column, rule_id: str = "monitor"
) -> Column:
    """An explicit flag decides; a null flag follows the agent's profile."""
    by_profile = F.coalesce(enabled, F.lit(False)) & (
        (coverage == "all") | ((coverage == "sampled") & sampled(row_id, rule_id, rate))
    )
    return F.coalesce(monitor, by_profile, F.lit(False))
