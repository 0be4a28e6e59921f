"""Window functions that survive a hot key.

A plain ``Window.partitionBy(session)`` sorts a whole session in one task. Here every key is cut into
slices of its ordering axis (an hour, a day, 10,000 positions). Each (key, slice) is windowed on
its own; one small row per slice carries the running state across slices; the two are joined back.
Results equal those of the plain window: nothing is capped, and the only per-key work left is one
row per slice.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Spec:
    """One output column of :func:`sliced_window`."""

    kind: str
    out: str
    value: Column
    inclusive: bool = True


def row_number(out: str) -> Spec:
    return Spec("sum", out, F.lit(1).cast("long"))


def running_sum(out: str, value: Column) -> Spec:
    return Spec("sum", out, value)


def running_max(out: str, value: Column, inclusive: bool = True) -> Spec:
    """Largest value up to this row (or strictly before it)."""
    return Spec("max", out, value, inclusive)


def previous(out: str, value: Column) -> Spec:
    return Spec("previous", out, value)


def following(out: str, value: Column) -> Spec:
    return Spec("following", out, value)


def last_known(out: str, value: Column, inclusive: bool = True) -> Spec:
    """Latest non-null value up to this row (or strictly before it)."""
    return Spec("last_known", out, value, inclusive)


def next_known(out: str, value: Column, inclusive: bool = True) -> Spec:
    """Nearest non-null value from this row on (or strictly after it)."""
    return Spec("next_known", out, value, inclusive)


def time_slice(ts: Column, seconds: int = 86400) -> Column:
    return F.floor(F.unix_seconds(ts.cast("timestamp")) / F.lit(seconds)).cast("long")


def position_slice(pos: Column, size: int = 10000) -> Column:
    return F.floor(pos / F.lit(size)).cast("long")


def _local(spec: Spec, window) -> Column:
    before = window.rowsBetween(Window.unboundedPreceding, 0 if spec.inclusive else -1)
    after = window.rowsBetween(0 if spec.inclusive else 1, Window.unboundedFollowing)
    if spec.kind == "sum":
        return F.sum(spec.value).over(before)
    if spec.kind == "max":
        return F.max(spec.value).over(before)
    if spec.kind == "previous":
        return F.lag(F.struct(spec.value.alias("v"))).over(window)
    if spec.kind == "following":
        return F.lead(F.struct(spec.value.alias("v"))).over(window)
    if spec.kind == "last_known":
        return F.last(spec.value, ignorenulls=True).over(before)
    return F.first(spec.value, ignorenulls=True).over(after)


def _summary(spec: Spec, rank: Column) -> Column:
    known = F.when(spec.value.isNotNull(), rank)
    return {
        "sum": lambda: F.sum(spec.value),
        "max": lambda: F.max(spec.value),
        "previous": lambda: F.max_by(F.struct(spec.value.alias("v")), rank),
        "following": lambda: F.min_by(F.struct(spec.value.alias("v")), rank),
        "last_known": lambda: F.max_by(spec.value, known),
        "next_known": lambda: F.min_by(spec.value, known),
    }[spec.kind]()


def _carry(spec: Spec, column: str, window) -> Column:
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    after = window.rowsBetween(1, Window.unboundedFollowing)
    if spec.kind == "sum":
        return F.sum(column).over(before)
    if spec.kind == "max":
        return F.max(column).over(before)
    if spec.kind == "previous":
        return F.lag(column).over(window)
    if spec.kind == "following":
        return F.lead(column).over(window)
    if spec.kind == "last_known":
        return F.last(column, ignorenulls=True).over(before)
    return F.first(column, ignorenulls=True).over(after)


def _combine(spec: Spec) -> Column:
    local, carry = F.col(f"__l_{spec.out}"), F.col(f"__c_{spec.out}")
    if spec.kind == "sum":
        return F.coalesce(local + carry, local, carry)
    if spec.kind == "max":
        return F.greatest(local, carry)
    if spec.kind in ("previous", "following"):
        return F.coalesce(local, carry)["v"]
    return F.coalesce(local, carry)


def sliced_window(
    df: DataFrame, keys: Sequence[str], slice_by: Column, order: Sequence[str], specs: Sequence[Spec]
) -> DataFrame:
    """Add ``specs`` over ``keys`` ordered ascending by ``order``.

    ``slice_by`` must not decrease along ``order``; ``order`` must be a total order per key.
    """
    sliced = df.withColumn("__slice", slice_by)
    inner = Window.partitionBy(*keys, "__slice").orderBy(*order)
    rank = F.struct(*[F.col(c) for c in order])
    outer = Window.partitionBy(*keys).orderBy("__slice")

    carried = sliced.groupBy(*keys, "__slice").agg(*[_summary(s, rank).alias(f"__s_{s.out}") for s in specs])
    carried = carried.select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
        F.col("__slice").alias("__k_slice"),
        *[_carry(s, f"__s_{s.out}", outer).alias(f"__c_{s.out}") for s in specs],
    )
    local = sliced.select("*", *[_local(s, inner).alias(f"__l_{s.out}") for s in specs])
    match = F.col("__slice").eqNullSafe(F.col("__k_slice"))
    for i, k in enumerate(keys):
        match = match & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    kept = [c for c in df.columns if c not in {s.out for s in specs}]
    return local.join(carried, match, "left").select(*kept, *[_combine(s).alias(s.out) for s in specs])
