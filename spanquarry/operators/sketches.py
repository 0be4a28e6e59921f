"""Mergeable sketches per agent and day: distinct counts and percentiles of any span of time without its rows.

HyperLogLog and KLL sketches are a few kilobytes each and combine on the map side, so a hot agent is one small row per task.
Days are summed up once, as they arrive, and every report merges the days and agents it asks for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanquarry.streaming import epochs

#: log2 of the HyperLogLog buckets and its relative standard error; size of the KLL sketch and its rank error at 99 %.
BUCKETS, COUNT_ERROR = 12, 1.04 / 2**6
LEVEL, RANK_ERROR = 200, 0.0133
#: Standard errors within which a count is expected.
SIGMAS = 3


def sketch(spans: DataFrame, keys: Sequence[str] = ("agent",), users: str = "user_id", value: str = "latency_ms") -> DataFrame:
    """keys, day, n, users (sketch), latency (sketch): one row per key and day."""
    return spans.groupBy(*keys, F.to_date("started_at").alias("day")).agg(
        F.count("*").alias("n"),
        F.hll_sketch_agg(users, BUCKETS).alias("users"),
        F.kll_sketch_agg_bigint(F.col(value).cast("bigint"), LEVEL).alias("latency"),
    )


def merged(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sketches of coarser keys (none: of everything)."""
    return sketches.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.hll_union_agg("users").alias("users"), F.kll_merge_agg_bigint("latency").alias("latency")
    )


def estimates(sketches: DataFrame, keys: Sequence[str], probs: Sequence[float] = (0.5, 0.95)) -> DataFrame:
    """keys, n, users and a percentile per probability, named p50 and so on."""
    at = {f"p{int(p * 100)}": F.kll_sketch_get_quantile_bigint("latency", F.lit(float(p))) for p in probs}
    return merged(sketches, keys).select(*keys, "n", F.hll_sketch_estimate("users").alias("users"), *[c.alias(n) for n, c in at.items()])


def within_count(estimate: Column, exact: Column) -> Column:
    """Whether a distinct count is as near as the sketch promises; counts below a few hundred are exact but for collisions."""
    return F.abs(estimate - exact) <= F.greatest(F.ceil(exact * COUNT_ERROR * SIGMAS), F.lit(1))


def within_rank(below: Column, upto: Column, n: Column, prob: float) -> Column:
    """Whether a percentile's rank is right: ``below`` values are smaller, ``upto`` at most as large as it."""
    return (below / n <= prob + RANK_ERROR) & (upto / n >= prob - RANK_ERROR)


def sketch_sink(folder: str, keys: Sequence[str] = ("agent",), **columns: str):
    """``foreachBatch`` writer: what a micro-batch brings, as sketches; late spans are one more row of their day."""

    def write(spans: DataFrame, epoch: int) -> None:
        sketch(spans, keys, **columns).write.mode("overwrite").parquet(f"{folder}/epoch={epoch}")

    return write


def read_sketches(spark: SparkSession, folder: str) -> DataFrame:
    return epochs.read(spark, folder, epochs.epochs(spark, folder)).drop("epoch")


def compact_sketches(spark: SparkSession, folder: str, keys: Sequence[str] = ("agent",), keep: int = 2) -> int | None:
    """Merge the days of old epochs; estimates stay what they are within the sketches' error."""
    return epochs.compact(spark, folder, lambda old: merged(old, [*keys, "day"]), keep)
