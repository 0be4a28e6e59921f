"""Production monitoring: checks, pattern hits, signals, KPIs, metrics and cost."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanquarry.functions import matching
from spanquarry.functions.sampling import sampled

DEFAULT_LATENCY_MS = 20_000


def at(ts: str | Column) -> Column:
    return F.lit(ts).cast("timestamp") if isinstance(ts, str) else ts


def in_window(column: str, now: str, seconds: int) -> Column:
    """``[now - seconds, now)`` as plain comparisons, which reach the Parquet scan."""
    end = at(now)
    return (F.col(column) >= end - F.make_dt_interval(secs=F.lit(seconds))) & (F.col(column) < end)


def production_roots(spans: DataFrame) -> DataFrame:
    """Roots that are not evaluation traffic; the one view every KPI reads."""
    return spans.where(F.col("parent_span_id").isNull() & ~F.col("source").eqNullSafe(F.lit("eval-run")))


def production_spans(spans: DataFrame) -> DataFrame:
    """All spans of production traces; children follow their root's source."""
    return spans.join(production_roots(spans).select("trace_id"), "trace_id", "left_semi")


# -- built-in checks ---------------------------------------------------------------------------


def empty_response(output: Column) -> Column:
    return F.trim(F.coalesce(output, F.lit(""))) == ""


def trace_error(error: Column) -> Column:
    return error.isNotNull()


def tool_failure(tool_calls: Column) -> Column:
    """Any call with success = false; an unset flag is unknown, not a failure."""
    return F.coalesce(F.exists(tool_calls, lambda t: F.coalesce(~t["success"], F.lit(False))), F.lit(False))


def traces_with_tool_failure(spans: DataFrame) -> DataFrame:
    failed = spans.where((F.col("span_kind") == "tool") & F.col("error").isNotNull()).select("trace_id")
    return production_roots(spans).join(failed, "trace_id", "left_semi")


def slow_roots(spans: DataFrame, profiles: DataFrame, default_ms: int = DEFAULT_LATENCY_MS) -> DataFrame:
    """Roots over their agent's latency limit, or the default where the agent sets none."""
    limits = profiles.select(F.col("agent").alias("p_agent"), F.col("latency_threshold_ms").alias("p_limit"))
    return (
        production_roots(spans)
        .join(limits, F.col("agent") == F.col("p_agent"), "left")
        .withColumn("limit_ms", F.coalesce("p_limit", F.lit(default_ms)).cast("long"))
        .where(F.col("latency_ms") > F.col("limit_ms"))
        .select("span_id", "agent", "latency_ms", "limit_ms")
    )


# -- pattern hits and signals ------------------------------------------------------------------


def span_pattern(
    roots: DataFrame, patterns: Sequence[matching.Pattern], sources: dict[str, str], pattern_ids: str | None = None
) -> DataFrame:
    """Hits ``(span_id, agent, started_at, pattern_key, polarity, severity)``.

    All patterns become one array expression, so the texts are scanned once however many patterns
    there are, and nothing is shuffled.
    """
    # texts are lower-cased once, in their own projection, and read by every pattern
    roots = roots.select("*", *[F.lower(F.coalesce(F.col(c), F.lit(""))).alias(f"__lower_{name}") for name, c in sources.items()])
    columns = {name: F.col(c) for name, c in sources.items()}
    columns |= {f"{name}.lower": F.col(f"__lower_{name}") for name in sources}
    hits = []
    for p in patterns:
        ids = F.col(pattern_ids) if pattern_ids else F.lit(None).cast("array<string>")
        applies = matching.restrict_ids(ids, p.key, p.enabled or p.source == "builtin")
        verdict = applies & matching.scope_agents(F.col("agent"), p.agent_ids)
        if p.sample_rate < 1.0:
            verdict = verdict & sampled(F.col("span_id"), p.key, p.sample_rate)
        verdict = verdict & matching.match_conditions(p.conditions, columns)
        hit = F.struct(
            F.lit(p.key).alias("pattern_key"), F.lit(p.polarity).alias("polarity"), F.lit(p.severity).alias("severity")
        )
        hits.append(F.when(verdict, hit))
    return roots.select(
        "span_id", "agent", "started_at", F.explode(F.array_compact(F.array(*hits))).alias("hit")
    ).select("span_id", "agent", "started_at", "hit.*")


def trace_term_match(spans: DataFrame, text: str, terms: Sequence[str]) -> DataFrame:
    """Traces whose tree holds every term in some span.

    A trace's text is the text of all its spans; each term is searched span by span and the flags
    are or-ed per trace, so the texts of a large trace are never joined into one string.
    """
    flags = [F.bool_or(matching.contains_phrase(F.coalesce(F.col(text), F.lit("")), t)).alias(f"f{i}") for i, t in enumerate(terms)]
    found = spans.groupBy("trace_id").agg(*flags)
    for i in range(len(terms)):
        found = found.where(F.col(f"f{i}"))
    return found.select("trace_id")


def signal_rollup(hits: DataFrame) -> DataFrame:
    """Hits to signals keyed by (pattern, agent): first and last seen, count, latest trace, status.

    Polarity and severity are those of the latest hit, as in the stream that keeps signals up to date.
    """
    last = F.struct("started_at", "span_id")
    return hits.groupBy("pattern_key", "agent").agg(
        F.min("started_at").alias("first_seen"),
        F.max("started_at").alias("last_seen"),
        F.count("*").alias("n"),
        F.max_by("span_id", last).alias("representative"),
        F.max_by("polarity", last).alias("polarity"),
        F.max_by("severity", last).alias("severity"),
        F.when(F.max_by("polarity", last) == "proper", "healthy").otherwise("open").alias("status"),
    )


def recent_occurrences(hits: DataFrame, n: int) -> DataFrame:
    """The last ``n`` hits of each signal. The row-number filter is applied before the shuffle too
    (window group limit), so a hot signal sends at most ``n`` rows per task."""
    from pyspark.sql import Window

    newest = Window.partitionBy("pattern_key", "agent").orderBy(F.desc("started_at"), F.desc("span_id"))
    return hits.withColumn("pos", F.row_number().over(newest).cast("long")).where(F.col("pos") <= n)


def signals_filter(
    signals: DataFrame,
    polarity: str = "failure",
    status: str | None = None,
    severity: str | None = None,
    agent: str | None = None,
    occurrences: DataFrame | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Most recent signals first (all, or the first ``limit``); an agent matches as representative or through any occurrence."""
    out = signals
    if polarity not in ("all", "both"):
        out = out.where(F.col("polarity") == polarity)
    if status is not None:
        out = out.where(F.col("status") == status)
    if severity is not None:
        out = out.where(F.col("severity") == severity)
    if agent is not None:
        own = F.col("agent") == agent
        if occurrences is not None:
            seen = occurrences.where(F.col("agent") == agent).select(F.col("pattern_key").alias("o_key")).distinct()
            out = out.join(seen, F.col("pattern_key") == F.col("o_key"), "left").where(own | F.col("o_key").isNotNull()).drop("o_key")
        else:
            out = out.where(own)
    newest = out.orderBy(F.desc("last_seen"), "pattern_key", "agent")
    return newest if limit is None else newest.limit(limit)


# -- KPIs and metrics --------------------------------------------------------------------------


def ratio(part: Column, whole: Column) -> Column:
    """Null on an empty denominator: a rate without data is unknown, not 0."""
    return F.when(whole > 0, part.cast("double") / whole.cast("double"))


def run_facts(spans: DataFrame, failure_hits: DataFrame | None = None, since: str | None = None) -> DataFrame:
    """One row per production root: failed flag, its outcome and the outcome counts of its tool calls.

    The outcome is the first that holds of ``error`` (the root carries one), ``flagged`` (a failure pattern hit), ``tool_failure`` (a
    call failed) and ``ok``.

    ``since`` limits the scan to spans that started at or after it. A call starts inside its root, so
    no call of a root in the window is lost, and old partitions are not read.
    """
    if since is not None:
        spans = spans.where(F.col("started_at") >= at(since))
    roots = production_roots(spans).select("span_id", "trace_id", "agent", "started_at", "latency_ms", "error")
    tools = (
        spans.where(F.col("span_kind") == "tool")
        .groupBy("trace_id")
        .agg(F.count_if(F.col("error").isNull()).alias("tool_ok"), F.count_if(F.col("error").isNotNull()).alias("tool_failed"))
    )
    facts = roots.join(tools, "trace_id", "left")
    error = F.col("error").isNotNull()
    failed = error
    if failure_hits is not None:
        hit = failure_hits.where("polarity = 'failure'").select(F.col("span_id").alias("h_id")).distinct()
        facts = facts.join(hit, F.col("span_id") == F.col("h_id"), "left")
        failed = failed | F.col("h_id").isNotNull()
    return facts.select(
        "span_id",
        "trace_id",
        "agent",
        "started_at",
        "latency_ms",
        failed.alias("failed"),
        F.when(error, "error").when(failed, "flagged").when(F.col("tool_failed") > 0, "tool_failure").otherwise("ok").alias("outcome"),
        F.coalesce("tool_ok", F.lit(0)).alias("tool_ok"),
        F.coalesce("tool_failed", F.lit(0)).alias("tool_failed"),
    )


OUTCOMES = ("ok", "error", "flagged", "tool_failure")


def kpis(facts: DataFrame, feedback: DataFrame, now: str, window_seconds: int, roots: DataFrame | None = None) -> DataFrame:
    """KPIs over the window before ``now``: one row per agent (scope ``agent``) and one of all (scope ``project``, agent null).

    A vote counts in the window it was cast in, however old its trace: where ``facts`` are pruned to the window, ``roots``
    (trace_id, agent) are the roots of all time. An agent that only has votes in the window has 0 runs and null rates.
    Runs are broken down by outcome (``ok_runs`` and so on; see :func:`run_facts`).

    The first aggregation is per (agent, latency value): it combines on the map side and leaves one
    row per distinct millisecond, so the exact percentile of a hot agent is a weighted one over few
    rows instead of a buffer of all its latencies. Grouping sets over these rows give the project's row, its percentile included,
    without a second scan.
    """
    recent = facts.where(in_window("started_at", now, window_seconds))
    per_value = recent.groupBy("agent", "latency_ms").agg(
        F.count("*").alias("n"),
        F.count_if("failed").alias("failed"),
        F.sum("tool_ok").alias("tool_ok"),
        F.sum("tool_failed").alias("tool_failed"),
        *[F.count_if(F.col("outcome") == o).alias(o) for o in OUTCOMES],
    )
    sets, whole = [["agent"], []], F.grouping("agent").alias("whole")
    runs = per_value.groupingSets(sets, "agent").agg(
        whole,
        F.sum("n").alias("total_runs"),
        F.sum("failed").alias("failed_runs"),
        F.sum("tool_ok").alias("ok_calls"),
        F.sum("tool_failed").alias("failed_calls"),
        F.percentile("latency_ms", F.lit(0.95), F.col("n")).alias("p95"),
        *[F.sum(o).alias(f"{o}_runs") for o in OUTCOMES],
    )
    votes = (
        feedback.where(in_window("created_at", now, window_seconds))
        .select("trace_id", "rating")
        .join((facts if roots is None else roots).select("trace_id", F.col("agent").alias("voted")), "trace_id")
        .groupingSets([["voted"], []], "voted")
        .agg(F.grouping("voted").alias("v_whole"), F.count_if(F.col("rating") == "down").alias("downs"), F.count("*").alias("votes"))
        .where("v_whole = 1 OR voted IS NOT NULL")
    )
    failure = ratio(F.col("failed_runs"), F.col("total_runs"))
    both = runs.join(votes, F.col("agent").eqNullSafe(F.col("voted")) & (F.col("whole") == F.col("v_whole")), "full")
    counts = ["total_runs", "failed_runs", *[f"{o}_runs" for o in OUTCOMES]]
    return both.select(
        F.when(F.coalesce("whole", "v_whole") == 1, "project").otherwise("agent").alias("scope"),
        F.coalesce("agent", "voted").alias("agent"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in counts],
        F.round(failure, 6).alias("failure_rate"),
        F.round(1 - failure, 6).alias("health_rate"),
        F.round(ratio(F.col("failed_calls"), F.col("ok_calls") + F.col("failed_calls")), 6).alias("tool_failure_rate"),
        F.round(ratio(F.col("downs"), F.col("votes")), 6).alias("downvote_rate"),
        F.round("p95", 6).alias("p95_latency_ms"),
    )


def kpi_delta(facts: DataFrame, now: str, window_seconds: int, feedback: DataFrame | None = None, roots: DataFrame | None = None) -> DataFrame:
    """Each KPI beside its value in the equal window before; both windows in one pass.

    Votes count in the window they were cast in; without ``feedback`` the downvote rates are null. An agent that only has votes
    has 0 runs.
    """
    mid = at(now) - F.make_dt_interval(secs=F.lit(window_seconds))

    def part(ts: str) -> Column:
        return F.when(F.col(ts) >= mid, "current").otherwise("prior").alias("part")

    value_counts = facts.where(in_window("started_at", now, 2 * window_seconds)).groupBy("agent", part("started_at"), "latency_ms").agg(
        F.count("*").alias("n"), F.count_if("failed").alias("failed"), F.sum("tool_ok").alias("ok"), F.sum("tool_failed").alias("bad")
    )
    cols = []
    for p in ("current", "prior"):
        only = F.col("part") == p
        n, failed, ok, bad = (F.sum(F.when(only, F.col(c))) for c in ("n", "failed", "ok", "bad"))
        cols += [
            F.coalesce(n, F.lit(0)).alias(f"{p}_runs"),
            F.round(ratio(failed, n), 6).alias(f"{p}_failure_rate"),
            F.round(1 - ratio(failed, n), 6).alias(f"{p}_health_rate"),
            F.round(ratio(bad, ok + bad), 6).alias(f"{p}_tool_failure_rate"),
            F.round(F.percentile(F.when(only, F.col("latency_ms")), F.lit(0.95), F.col("n")), 6).alias(f"{p}_p95"),
        ]
    wide = value_counts.groupBy("agent").agg(*cols)
    if feedback is None:
        wide = wide.withColumns({f"{p}_downvote_rate": F.lit(None).cast("double") for p in ("current", "prior")})
    else:
        cast = feedback.where(in_window("created_at", now, 2 * window_seconds)).select("trace_id", "rating", part("created_at"))
        votes = cast.join((facts if roots is None else roots).select("trace_id", "agent"), "trace_id").groupBy("agent").agg(
            *[
                F.round(ratio(F.count_if((F.col("part") == p) & (F.col("rating") == "down")), F.count_if(F.col("part") == p)), 6).alias(f"{p}_downvote_rate")
                for p in ("current", "prior")
            ]
        )
        wide = wide.join(votes.where("agent IS NOT NULL"), "agent", "full").fillna(0, ["current_runs", "prior_runs"])
    kpis_ = ("failure_rate", "health_rate", "tool_failure_rate", "downvote_rate", "p95")
    return wide.select("*", *[F.round(F.col(f"current_{k}") - F.col(f"prior_{k}"), 6).alias(f"{k}_delta") for k in kpis_])


def bucket_seconds(window_seconds: int) -> int:
    """Bucket width by window: up to 1 h minutes, up to 24 h hours, beyond that days."""
    if window_seconds <= 3600:
        return 60
    return 3600 if window_seconds <= 86400 else 86400


def bucket_ms(ts: str, seconds: int) -> Column:
    """UTC-aligned bucket start in epoch milliseconds."""
    return (F.floor(F.unix_seconds(F.col(ts)) / seconds) * (seconds * 1000)).cast("long")


def framework_label(framework: Column) -> Column:
    return F.lower(F.coalesce(framework, F.lit("other")))


def metrics_filter(
    spans: DataFrame,
    agent: str | None = None,
    model: str | None = None,
    kind: str | None = None,
    framework: str | None = None,
    status: str | None = None,
) -> DataFrame:
    """Conjunction of the given filters; framework ``other`` means unlabelled."""
    out = spans
    if agent is not None:
        out = out.where(F.col("agent") == agent)
    if model is not None:
        out = out.where(F.col("model") == model)
    if kind is not None:
        out = out.where(F.col("span_kind") == kind)
    if framework is not None:
        out = out.where(framework_label(F.col("framework")) == framework.lower())
    if status is not None:
        out = out.where(F.col("error").isNotNull() if status == "error" else F.col("error").isNull())
    return out


MONEY = "decimal(38,6)"


def cost_micro_usd(input_tokens: Column, output_tokens: Column, read: Column, write: Column, prices: dict[str, Column]) -> Column:
    """Cost in millionths of a dollar as an exact decimal, so sums do not depend on their order.

    Prices are per million tokens. Cache tokens are part of the input and priced apart if a rate is
    set; a missing price counts 0.
    """
    zero = F.lit(0)

    def rate(name: str, *fallback: Column) -> Column:
        return F.coalesce(prices[name].cast("decimal(14,6)"), *fallback, F.lit(0).cast("decimal(14,6)"))

    def n(tokens: Column) -> Column:
        return F.coalesce(tokens, zero).cast("decimal(18,0)")

    plain = F.greatest(n(input_tokens) - n(read) - n(write), zero.cast("decimal(18,0)")).cast("decimal(18,0)")
    rate_in = rate("input")
    total = plain * rate_in + n(read) * rate("cache_read", rate_in) + n(write) * rate("cache_write", rate_in) + n(output_tokens) * rate("output")
    return F.greatest(total, zero).cast(MONEY)


def usd(micro: Column) -> Column:
    """Dollars of a sum of millionths."""
    return F.round(micro.cast("double") / 1_000_000.0, 6)


def price_periods(tool_prices: DataFrame) -> DataFrame:
    """Tool prices (tool, price_usd, valid_from) with the moment the next one takes over; a null ``valid_from`` holds from the beginning.

    Of several prices from one moment on the highest holds. The table is configuration, a few rows per tool.
    """
    one = tool_prices.groupBy("tool", "valid_from").agg(F.max("price_usd").alias("price_usd"))
    until = F.lead("valid_from").over(Window.partitionBy("tool").orderBy(F.col("valid_from").asc_nulls_first()))
    return one.select("tool", "valid_from", until.alias("valid_until"), F.round(F.col("price_usd") * 1_000_000).cast("long").alias("call_micro_usd"))


def price_join(spans: DataFrame, prices: DataFrame, tool_prices: DataFrame | None = None) -> DataFrame:
    """Add ``cost_micro_usd``: tokens by the model's price, and each tool call, failed ones included, by the price its ``tool`` had
    when it started. Models and tools without a price cost nothing.

    Both lists join from the left on equality (a call and its tool's period by one more comparison), so the
    spans are not dealt anew where Catalyst measures the list as small, and sorted and split by skew otherwise.
    """
    p = prices.select(
        F.col("model").alias("p_model"), "input_usd", "output_usd", "cache_read_usd", "cache_write_usd"
    )
    rates = {
        "input": F.col("input_usd"),
        "output": F.col("output_usd"),
        "cache_read": F.col("cache_read_usd"),
        "cache_write": F.col("cache_write_usd"),
    }
    write = F.col("cache_write_tokens") if "cache_write_tokens" in spans.columns else F.lit(None).cast("long")
    tokens = cost_micro_usd(F.col("input_tokens"), F.col("output_tokens"), F.col("cache_read_tokens"), write, rates)
    priced, call = spans.join(p, F.col("model") == F.col("p_model"), "left"), F.lit(0)
    if tool_prices is not None:
        periods = price_periods(tool_prices).withColumnRenamed("tool", "p_tool")
        holds = (
            (F.when(F.col("span_kind") == "tool", F.col("tool")) == F.col("p_tool"))
            & (F.col("valid_from").isNull() | (F.col("started_at") >= F.col("valid_from")))
            & (F.col("valid_until").isNull() | (F.col("started_at") < F.col("valid_until")))
        )
        priced, call = priced.join(periods, holds, "left"), F.coalesce("call_micro_usd", F.lit(0))
    return priced.select(*spans.columns, (tokens + call).cast(MONEY).alias("cost_micro_usd"))


def metrics_grid(priced: DataFrame, now: str, window_seconds: int) -> DataFrame:
    """Bucket × framework grid: spans by kind, failures, tokens, cost, exact latency percentiles."""
    width = bucket_seconds(window_seconds)
    kinds = ["agent", "llm", "tool", "retrieval", "memory"]
    fine = (
        priced.where(in_window("started_at", now, window_seconds))
        .groupBy(bucket_ms("started_at", width).alias("ts"), framework_label(F.col("framework")).alias("framework"), "latency_ms")
        .agg(
            F.count("*").alias("n"),
            *[F.count_if(F.col("span_kind") == k).alias(f"{k}_spans") for k in kinds],
            F.count_if((F.col("span_kind") == "tool") & F.col("error").isNotNull()).alias("tool_failures"),
            F.sum("input_tokens").alias("input_tokens"),
            F.sum("output_tokens").alias("output_tokens"),
            F.sum("cost_micro_usd").alias("cost"),
        )
    )
    sums = ["n", *[f"{k}_spans" for k in kinds], "tool_failures", "input_tokens", "output_tokens"]
    p50_p95 = F.percentile("latency_ms", F.array(F.lit(0.5), F.lit(0.95)), F.col("n"))
    return (
        fine.groupBy("ts", "framework")
        .agg(p50_p95.alias("p"), *[F.sum(c).alias(f"{c}_") for c in sums], F.sum("cost").alias("cost"))
        .select(
            "ts",
            "framework",
            *[F.col(f"{c}_").alias("spans" if c == "n" else c) for c in sums],
            usd(F.col("cost")).alias("cost_usd"),
            F.round(F.col("p")[0], 6).alias("p50_latency_ms"),
            F.round(F.col("p")[1], 6).alias("p95_latency_ms"),
        )
    )


def cost_trend(priced: DataFrame, now: str, window_seconds: int) -> DataFrame:
    """Spend per bucket and segment, per bucket, in total, and per tool (ts, segment, tool; null where summed over).

    Segments are models and the reserved ``eval runs`` and ``tool calls``; only the latter are split by tool. ``priced``
    carries ``is_eval`` per span. All levels come from one scan by grouping sets.
    """
    width = bucket_seconds(window_seconds)
    segment = (
        F.when(F.col("is_eval"), "eval runs")
        .when(F.col("span_kind") == "tool", "tool calls")
        .otherwise(F.coalesce("model", F.lit("unpriced")))
    )
    spent = (
        priced.where(in_window("started_at", now, window_seconds))
        .select(bucket_ms("started_at", width).alias("ts"), segment.alias("segment"), "tool", "cost_micro_usd")
        .withColumn("tool", F.when(F.col("segment") == "tool calls", F.col("tool")))
    )
    return (
        spent.groupingSets([["ts", "segment"], ["ts"], [], ["tool"]], "ts", "segment", "tool")
        .agg(usd(F.sum("cost_micro_usd")).alias("cost_usd"), F.grouping("tool").alias("over_tools"))
        .where("over_tools = 1 OR tool IS NOT NULL")
        .drop("over_tools")
    )


def latency_percentiles(spans: DataFrame, keys: Sequence[str], probs: Sequence[float] = (0.5, 0.9, 0.95, 0.99)) -> DataFrame:
    """Exact percentiles from (group, value) counts; see :func:`kpis` for why."""
    counts = spans.groupBy(*keys, "latency_ms").agg(F.count("*").alias("n"))
    out = counts.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.percentile("latency_ms", F.array(*[F.lit(p) for p in probs]), F.col("n")).alias("p")
    )
    return out.select(*keys, "n", *[F.round(F.col("p")[i], 6).alias(f"p{int(p * 100)}") for i, p in enumerate(probs)])


def tool_quality(calls: DataFrame) -> DataFrame:
    """Per tool: calls, failures, failure rate (unknown outcomes excluded) and mean latency."""
    failed, ok = F.count_if(F.col("success") == F.lit(False)), F.count_if("success")
    return calls.groupBy("name").agg(
        F.count("*").alias("calls"),
        failed.alias("failures"),
        F.round(ratio(failed, failed + ok), 6).alias("failure_rate"),
        F.round(F.avg("latency_ms"), 6).alias("avg_latency_ms"),
    )


def framework_totals(spans: DataFrame, bucket: int = 86400) -> DataFrame:
    return spans.groupBy(bucket_ms("started_at", bucket).alias("ts"), framework_label(F.col("framework")).alias("framework")).agg(
        F.count("*").alias("n")
    )


def alert_metrics(facts: DataFrame, feedback: DataFrame, costs: DataFrame, now: str, minutes: int, roots: DataFrame | None = None) -> DataFrame:
    """Current value per agent and metric over the last minutes; a rate without data is null. ``roots``: see :func:`kpis`."""
    seconds = minutes * 60
    base = kpis(facts, feedback, now, seconds, roots).where("scope = 'agent'")
    spend = costs.where(in_window("started_at", now, seconds)).groupBy("agent").agg(F.sum("cost_micro_usd").alias("cost"))
    wide = base.join(spend, "agent", "left").select(
        "agent",
        F.col("failure_rate").alias("failureRate"),
        F.col("tool_failure_rate").alias("toolFailureRate"),
        F.col("downvote_rate").alias("downvoteRate"),
        F.col("p95_latency_ms").alias("p95LatencyMs"),
        F.col("total_runs").cast("double").alias("traceCount"),
        usd(F.col("cost")).alias("estimatedCostUsd"),
    )
    names = ["failureRate", "toolFailureRate", "downvoteRate", "p95LatencyMs", "traceCount", "estimatedCostUsd"]
    return wide.unpivot("agent", names, "metric", "value")


def session_summary(turns: DataFrame, scores: DataFrame) -> DataFrame:
    """Per session: turns, first and last activity, latest score."""
    s = turns.groupBy("session_id").agg(
        F.count("*").alias("turns"), F.min("started_at").alias("first_at"), F.max("started_at").alias("last_at")
    )
    latest = scores.groupBy("session_id").agg(F.max_by("rating", F.struct("scored_at", "verdict_id")).alias("latest_score"))
    return s.join(latest, "session_id", "left")


def multi_turn_sessions(turns: DataFrame, minimum: int = 2) -> DataFrame:
    return turns.groupBy("session_id").agg(F.count("*").alias("turns")).where(F.col("turns") >= minimum)


def distinct_sessions(spans: DataFrame) -> DataFrame:
    """Sessions touched, in order of first appearance."""
    return spans.groupBy("session_id").agg(F.min("started_at").alias("first_at")).orderBy("first_at", "session_id")


def topic_counts(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy("topic").agg(F.count("*").alias("n"), F.round(F.avg("sentiment"), 6).alias("sentiment"))


def rating_series(verdicts: DataFrame, width_seconds: int) -> DataFrame:
    return verdicts.groupBy(bucket_ms("scored_at", width_seconds).alias("ts")).agg(
        F.round(F.avg("rating"), 6).alias("average_rating"), F.count("rating").alias("n")
    )


def idle_points(turns: DataFrame, idle_seconds: int = 120, now: str | None = None, slice_seconds: int = 86400) -> DataFrame:
    """Moments when a session had been quiet for ``idle_seconds`` with at least two turns so far.

    Cumulative: a resumed session is scored again as a whole. Sliced by time, so a session that
    owns a third of all turns is not sorted in one task.
    """
    from spanquarry.operators import sliced

    stepped = sliced.sliced_window(
        turns.select("session_id", "started_at", "span_id"),
        ["session_id"],
        sliced.time_slice(F.col("started_at"), slice_seconds),
        ["started_at", "span_id"],
        [sliced.row_number("turns"), sliced.following("next_at", F.col("started_at"))],
    )
    horizon = at(now) if now else F.lit(None).cast("timestamp")
    until = F.coalesce("next_at", horizon)
    idle = F.make_dt_interval(secs=F.lit(idle_seconds))
    return stepped.where((F.col("turns") >= 2) & (until >= F.col("started_at") + idle)).select(
        "session_id", (F.col("started_at") + idle).alias("idle_at"), "turns"
    )
