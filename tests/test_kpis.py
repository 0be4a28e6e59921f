"""KPIs: agents that only have votes, outcomes, the project's row; prices of tools over time."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from spanquarry.operators import monitoring as M

NOW, DAY = "2024-01-31 00:00:00", 86400


def test_agent_with_late_votes_only_keeps_its_row(spark):
    facts = spark.createDataFrame(
        [("t1", "a", "2024-01-30 00:00:00", 10, False, 1, 0, "ok"), ("t2", "b", "2024-01-02 00:00:00", 20, True, 0, 1, "error")],
        "trace_id string, agent string, started_at string, latency_ms bigint, failed boolean, tool_ok bigint, tool_failed bigint, outcome string",
    ).withColumn("started_at", F.to_timestamp("started_at"))
    votes = [("t2", "down", "2024-01-29 00:00:00"), ("t2", "up", "2024-01-30 00:00:00")]
    feedback = spark.createDataFrame(votes, "trace_id string, rating string, created_at string").withColumn("created_at", F.to_timestamp("created_at"))
    rows = M.kpis(facts, feedback, NOW, 7 * DAY).collect()
    got = {r.agent: r for r in rows if r.scope == "agent"}
    (whole,) = [r for r in rows if r.scope == "project"]
    assert (whole.agent, whole.total_runs, whole.ok_runs, whole.error_runs, whole.downvote_rate, whole.p95_latency_ms) == (None, 1, 1, 0, 0.5, 10.0)
    assert set(got) == {"a", "b"} and got["a"].downvote_rate is None and got["a"].total_runs == 1
    assert (got["b"].total_runs, got["b"].failed_runs, got["b"].failure_rate, got["b"].p95_latency_ms) == (0, 0, None, None)
    assert got["b"].downvote_rate == 0.5
    delta = {r.agent: r for r in M.kpi_delta(facts, NOW, 7 * DAY, feedback).collect()}
    assert set(delta) == {"a", "b"} and (delta["b"].current_runs, delta["b"].prior_runs) == (0, 0)
    assert delta["b"].current_downvote_rate == 0.5 and delta["b"].current_failure_rate is None


def test_outcomes_and_project_percentile(spark):
    span = "span_id bigint, trace_id bigint, parent_span_id bigint, source string, agent string, started_at timestamp, latency_ms bigint, error string, span_kind string"
    rows = []
    for i in range(8):
        at = datetime(2024, 1, 29, i)
        rows.append((10 * i, 10 * i, None, None, "ab"[i % 2], at, 100 * i, "boom" if i in (0, 1) else None, "agent"))
        rows.append((10 * i + 1, 10 * i, 10 * i, None, "ab"[i % 2], at, 5, "bad" if i in (1, 2, 3) else None, "tool"))
    hits = spark.createDataFrame([(30, "failure"), (40, "failure"), (50, "proper")], "span_id bigint, polarity string")
    facts = M.run_facts(spark.createDataFrame(rows, span), hits)
    assert {r.span_id // 10: r.outcome for r in facts.collect()} == {0: "error", 1: "error", 2: "tool_failure", 3: "flagged", 4: "flagged", 5: "ok", 6: "ok", 7: "ok"}
    votes = spark.createDataFrame([], "trace_id bigint, rating string, created_at timestamp")
    got = {(r.scope, r.agent): r for r in M.kpis(facts, votes, NOW, 7 * DAY).collect()}
    whole, a = got["project", None], got["agent", "a"]
    assert (whole.total_runs, whole.failed_runs, whole.ok_runs, whole.error_runs, whole.flagged_runs, whole.tool_failure_runs) == (8, 4, 3, 2, 2, 1)
    assert (a.total_runs, a.ok_runs, a.error_runs, a.flagged_runs, a.tool_failure_runs) == (4, 1, 1, 1, 1)
    assert whole.p95_latency_ms == 665.0 and whole.downvote_rate is None  # 95 % of the way from 0 to 700, interpolated


def test_calls_cost_what_their_tool_cost_then(spark):
    spans = spark.createDataFrame(
        [
            (1, "tool", "search", "2024-01-01 00:00:00"), (2, "tool", "search", "2024-01-10 00:00:00"), (3, "tool", "search", "2024-01-09 23:59:59"),
            (4, "tool", "free", "2024-01-10 00:00:00"), (5, "llm", "search", "2024-01-10 00:00:00"), (6, "tool", "late", "2024-01-10 00:00:00"),
            (7, "tool", None, "2024-01-10 00:00:00"), (8, "tool", "search", "2024-01-30 12:00:00"), (9, "tool", "search", "2024-01-30 13:00:00"),
        ],
        "span_id bigint, span_kind string, tool string, at string",
    ).select("*", F.to_timestamp("at").alias("started_at"), F.lit("m").alias("model"), *[F.lit(None).cast("bigint").alias(f"{k}_tokens") for k in ("input", "output", "cache_read")])
    models = spark.createDataFrame([], "model string, input_usd double, output_usd double, cache_read_usd double, cache_write_usd double")
    prices = spark.createDataFrame(
        [("search", 0.001, None), ("search", 0.002, "2024-01-10 00:00:00"), ("search", 0.0015, "2024-01-10 00:00:00"), ("search", 0.005, "2024-01-30 13:00:00"), ("late", 1.0, "2024-02-01 00:00:00")],
        "tool string, price_usd double, valid_from string",
    ).withColumn("valid_from", F.to_timestamp("valid_from"))
    priced = M.price_join(spans, models, prices)
    assert {r.span_id: int(r.cost_micro_usd) for r in priced.collect()} == {1: 1000, 2: 2000, 3: 1000, 4: 0, 5: 0, 6: 0, 7: 0, 8: 2000, 9: 5000}
    trend = M.cost_trend(priced.withColumn("is_eval", F.col("span_id") == 8), NOW, 30 * DAY).collect()
    tools = {r.tool: r.cost_usd for r in trend if r.tool}
    assert tools == {"search": 0.009, "free": 0.0, "late": 0.0}  # the evaluation's call is not one of them
    (total,) = [r.cost_usd for r in trend if not r.ts and not r.tool]
    assert total == sum(r.cost_usd for r in trend if r.ts and not r.segment) == pytest.approx(0.011)
