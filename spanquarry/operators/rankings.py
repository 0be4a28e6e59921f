"""Sorted and limited reads. ``orderBy().limit(n)`` keeps n rows per task and merges them; sorts
without a limit are range-partitioned."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def newest_first(df: DataFrame, ts: str, row_id: str, limit: int | None = None) -> DataFrame:
    out = df.orderBy(F.desc(ts), F.desc(row_id))
    return out if limit is None else out.limit(limit)


def oldest_first(df: DataFrame, ts: str, row_id: str) -> DataFrame:
    return df.orderBy(ts, row_id)


def worst_first(verdicts: DataFrame, k: int, row_id: str = "trace_id") -> DataFrame:
    """Scored rows, lowest rating first."""
    return verdicts.where("rating IS NOT NULL").orderBy("rating", row_id).limit(k)


def low_scoring(results: DataFrame, order: str, threshold: float, k: int) -> DataFrame:
    """The first ``k`` rows in list order rated at or below the threshold."""
    return results.where(F.col("rating") <= threshold).orderBy(order).limit(k)


def recs_by_priority(recommendations: DataFrame) -> DataFrame:
    """High, medium, low; an unset priority counts as low; list order within each."""
    rank = F.when(F.col("priority") == "high", 0).when(F.col("priority") == "medium", 1).otherwise(2)
    return recommendations.withColumn("rank", rank.cast("long")).orderBy("rank", "pos")


def traces_page(roots: DataFrame, limit: int, cursor: tuple | None = None) -> DataFrame:
    """Newest first after a keyset cursor ``(started_at, span_id)``.

    The time part of the cursor is a plain comparison, which prunes partitions and row groups. The
    next cursor is the last row of the page.
    """
    out = roots
    if cursor is not None:
        ts, span_id = F.lit(cursor[0]).cast("timestamp"), cursor[1]
        out = out.where((F.col("started_at") <= ts) & ((F.col("started_at") < ts) | (F.col("span_id") < span_id)))
    return newest_first(out, "started_at", "span_id", limit)


def get_by_id(df: DataFrame, column: str, value) -> DataFrame:
    return df.where(F.col(column) == value)


def pairwise_recent(batches: DataFrame, run_a=None, run_b=None) -> DataFrame:
    out = batches
    if run_a is not None:
        out = out.where(F.col("run_a_id") == run_a)
    if run_b is not None:
        out = out.where(F.col("run_b_id") == run_b)
    return newest_first(out, "created_at", "batch_id")
