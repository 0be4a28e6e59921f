"""User callables over tables: agents, code scorers, scorers that want a whole trace.

The callable is shipped to the Python workers and sees Arrow batches; how many run at once is the
number of partitions, and the result is a column, so nothing passes through the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby, islice
from typing import Any, Protocol

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

CALL_FIELDS = "raw STRING, error_type STRING, error_message STRING, latency_ms BIGINT"
SCORE_FIELDS = "score DOUBLE, skipped BOOLEAN, label STRING, score_error STRING"


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def batch_infer(cases: DataFrame, fn: Callable[[dict], Any]) -> DataFrame:
    """Run ``fn`` on every case; adds the raw answer as JSON, or the error, and the latency.

    Prune finished cases (``resume_pending``, ``reuse_outputs``) before: the optimizer does not move
    filters across a Python stage.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import json
        import time

        for batch in batches:
            out = []
            for case in batch.to_dict("records"):
                began = time.monotonic()
                try:
                    answer, kind, message = json.dumps(fn(case), default=str), None, None
                except Exception as exc:
                    answer, kind, message = None, type(exc).__name__, str(exc)
                out.append((answer, kind, message, int((time.monotonic() - began) * 1000)))
            added = pd.DataFrame(out, columns=["raw", "error_type", "error_message", "latency_ms"], index=batch.index)
            yield pd.concat([batch, added], axis=1)

    return cases.mapInPandas(run, f"{_ddl(cases)}, {CALL_FIELDS}")


def code_scorer(rows: DataFrame, handler: Callable[..., Any], alert_below: float | None = None) -> DataFrame:
    """``handler(input, output, expected, metadata, trace)`` per row.

    It returns a score of 0..1, or ``{"score", "name"?, "metadata"?}``, or None to skip. ``alert`` says
    that the score is below ``alert_below``.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ("input", "output", "expected", "metadata", "trace")
        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                try:
                    value = handler(*[row.get(n) for n in names])
                    label = value.get("name") if isinstance(value, dict) else None
                    value = value.get("score") if isinstance(value, dict) else value
                    out.append((None if value is None else float(value), value is None, label, None))
                except Exception as exc:
                    out.append((None, False, None, f"{type(exc).__name__}: {exc}"))
            added = pd.DataFrame(out, columns=["score", "skipped", "label", "score_error"], index=batch.index)
            added["score"] = added["score"].astype("float64")
            yield pd.concat([batch, added], axis=1)

    scored = rows.mapInPandas(run, f"{_ddl(rows)}, {SCORE_FIELDS}")
    below = F.lit(False) if alert_below is None else F.coalesce(F.col("score") < alert_below, F.lit(False))
    return scored.withColumn("alert", below)


def _records(batches: Iterator[pd.DataFrame]) -> Iterator[dict]:
    return (row for batch in batches for row in batch.to_dict("records"))


def _frames(rows: Iterator[tuple], columns: list[str]) -> Iterator[pd.DataFrame]:
    while some := list(islice(rows, 5000)):
        yield pd.DataFrame(some, columns=columns)


def _span_order(spans: DataFrame) -> list[Column]:
    """Roots first, then by start and id, as far as the columns are there."""
    order = [F.col("parent_span_id").isNotNull()] if "parent_span_id" in spans.columns else []
    return order + [F.col(c) for c in ("started_at", "span_id") if c in spans.columns]


def external_scorer(spans: DataFrame, handler: Callable[[Iterator[dict]], Any], invert_match: bool = False) -> DataFrame:
    """Score whole traces: ``handler`` reads the spans of one trace as an iterator and returns
    ``{"score", "matched"}``.

    Spans stream to the handler in Arrow batches, sorted by Spark with roots first, so a long trace is never held in
    memory as a whole unless the handler does so. A trace is still one stream in one task; :func:`reduce_traces` splits it.
    """

    def scored(rows: Iterator[dict]):
        for trace, own in groupby(rows, key=lambda row: row["trace_id"]):
            value = handler(own) or {}
            for _ in own:  # the rest of a trace the handler stopped reading
                pass
            matched, score = value.get("matched"), value.get("score")
            yield trace, None if score is None else float(score), None if matched is None else bool(matched) != invert_match

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _frames(scored(_records(batches)), ["trace_id", "score", "matched"])

    kind = spans.schema["trace_id"].dataType.simpleString()
    known = spans.where("trace_id IS NOT NULL")
    ordered = known.repartition(F.xxhash64("trace_id")).sortWithinPartitions("trace_id", *_span_order(spans))
    return ordered.mapInPandas(run, f"trace_id {kind}, score DOUBLE, matched BOOLEAN")


class TraceReducer(Protocol):
    """A fold over the spans of a trace that can be cut anywhere: merging the states of two neighbouring parts gives the state of both."""

    def start(self) -> Any: ...

    def step(self, state: Any, span: dict) -> Any: ...

    def merge(self, left: Any, right: Any) -> Any: ...

    def finish(self, state: Any) -> dict: ...


def reduce_traces(spans: DataFrame, reducer: TraceReducer, fields: str, slice_seconds: int = 3600) -> DataFrame:
    """trace_id and ``fields`` (DDL; keys of what ``finish`` returns) of every trace.

    A trace is cut into slices of time, the roots being a slice before all others. Slices are folded where Spark puts them, in order (start, then id),
    and only their pickled states meet, again in order. A trace of a million spans is thus work for as many tasks as it has slices.
    """
    kind = spans.schema["trace_id"].dataType.simpleString()
    names = [f.name for f in StructType.fromDDL(fields)]
    is_root = F.col("parent_span_id").isNull()
    part = F.when(is_root, F.lit(-(2**62))).otherwise(F.floor(F.unix_micros("started_at") / (slice_seconds * 1_000_000)))
    cut = spans.where("trace_id IS NOT NULL").withColumn("__part", part)

    def folded(rows: Iterator[dict]):
        for (trace, number), own in groupby(rows, key=lambda row: (row["trace_id"], row["__part"])):
            state = reducer.start()
            for row in own:
                state = reducer.step(state, row)
            yield trace, number, cloudpickle.dumps(state)

    def joined(rows: Iterator[dict]):
        for trace, own in groupby(rows, key=lambda row: row["trace_id"]):
            states = (cloudpickle.loads(row["state"]) for row in own)
            state = next(states)
            for other in states:
                state = reducer.merge(state, other)
            value = reducer.finish(state)
            yield trace, *(value.get(n) for n in names)

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _frames(folded(_records(batches)), ["trace_id", "part", "state"])

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _frames(joined(_records(batches)), ["trace_id", *names])

    sliced = cut.repartition("trace_id", "__part").sortWithinPartitions("trace_id", "__part", "started_at", "span_id")
    states = sliced.mapInPandas(fold, f"trace_id {kind}, part BIGINT, state BINARY")
    ordered = states.repartition(F.xxhash64("trace_id")).sortWithinPartitions("trace_id", "part")
    return ordered.mapInPandas(join, f"trace_id {kind}, {fields}")


def dry_run(rows: DataFrame, handler: Callable[..., Any], n: int, alert_below: float | None = None) -> DataFrame:
    """Score a small sample; the caller writes nothing."""
    return code_scorer(rows.limit(n), handler, alert_below)


def sampled_scoring(roots: DataFrame, scorer_id: str, rate: float, handler: Callable[..., Any], alert_threshold: float | None) -> DataFrame:
    """Score a stable sample of roots; a score below the threshold alerts, a null threshold never."""
    from spanquarry.functions.sampling import sampled

    return code_scorer(roots.where(sampled(F.col("span_id"), scorer_id, rate)), handler, alert_threshold)
