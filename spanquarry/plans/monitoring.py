"""The monitoring job: from spans to hits, signals and KPIs with one definition of failure."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame

from spanquarry.functions.matching import Pattern
from spanquarry.operators import monitoring as M


def monitor(
    spans: DataFrame, texts: DataFrame, feedback: DataFrame, patterns: Sequence[Pattern], sources: dict[str, str], now: str, window_seconds: int
) -> dict[str, DataFrame]:
    """Tables ``hits``, ``signals`` and ``kpis`` of the window; each is lazy, the caller writes them.

    A root fails when it carries an error or a failure pattern hit it.
    """
    since = str(datetime.fromisoformat(now) - timedelta(seconds=window_seconds))
    recent = M.production_roots(spans).where(M.in_window("started_at", now, window_seconds))
    hits = M.span_pattern(recent.join(texts, "span_id"), patterns, sources)
    facts = M.run_facts(spans, hits, since)
    return {"hits": hits, "signals": M.signal_rollup(hits), "kpis": M.kpis(facts, feedback, now, window_seconds, M.production_roots(spans))}
