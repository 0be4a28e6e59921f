"""Filters, checks, patterns, KPIs and metrics over spans and long texts."""

from pyspark.sql import functions as F

from catalog.base import query, view
from catalog.sources import scratch
from catalog.views import NOW
from spanquarry.functions import matching, sampling
from spanquarry.functions.matching import Condition, Pattern
from spanquarry.operators import monitoring as M
from spanquarry.operators import sketches, trees

DAY = 86400
MONTH = 30 * DAY

# Long texts as production roots: the response is the whole document.
view("doc_roots", """
SELECT doc_id AS span_id, concat('agent-', CAST(doc_id % 7 AS STRING)) AS agent,
       CAST(TIMESTAMP '2024-01-01 00:00:00' AS TIMESTAMP) AS started_at, text AS response,
       lang AS user_message, source, doc_id % 50 AS trace_id
FROM {documents}
""")

# Turns of a conversation: an assistant reply with the user message before it.
view("turns", """
SELECT a.conv_id * 100 + a.turn AS span_id, a.conv_id AS session_id, a.turn AS turn,
       b.text AS user_message, a.text AS response
FROM {conversations} a LEFT JOIN {conversations} b ON b.conv_id = a.conv_id AND b.turn = a.turn - 1
WHERE a.role = 'assistant'
""")

view("prices", """
SELECT 'm-small' AS model, CAST(0.15 AS DOUBLE) AS input_usd, CAST(0.60 AS DOUBLE) AS output_usd,
       CAST(NULL AS DOUBLE) AS cache_read_usd, CAST(NULL AS DOUBLE) AS cache_write_usd
UNION ALL SELECT 'm-large', CAST(2.50 AS DOUBLE), CAST(10.00 AS DOUBLE), CAST(1.25 AS DOUBLE), CAST(NULL AS DOUBLE)
""")

# Prices of tools change over the month; the last of nine tools has none, and the others none before their first.
view("tool_prices", """
SELECT concat('tool-', CAST(n_nationkey % 8 AS STRING)) AS tool, CAST(n_nationkey + 1 AS DOUBLE) / 1000 AS price_usd,
       CASE WHEN n_nationkey > 1 THEN TIMESTAMP '2024-01-02 00:00:00' + n_nationkey * INTERVAL 1 DAY END AS valid_from
FROM {nation}
""")

# Per-agent limits: three agents set their own, the others use the default.
view("profiles", """
SELECT DISTINCT concat('agent-', CAST(user_id % 7 AS STRING)) AS agent,
       CASE WHEN user_id % 7 < 3 THEN 5000 + user_id % 7 * 5000 END AS latency_threshold_ms,
       user_id % 7 <> 6 AS enabled, CASE WHEN user_id % 7 = 5 THEN 'none' ELSE 'all' END AS coverage
FROM {events}
""")

PROD = "parent_span_id IS NULL AND source IS DISTINCT FROM 'eval-run'"
WEEK = f"started_at >= TIMESTAMP '{NOW}' - INTERVAL 7 DAY AND started_at < TIMESTAMP '{NOW}'"
WEEK_FB = WEEK.replace("started_at", "created_at")

PATTERNS = (
    Pattern("ssn", (Condition(r"\d{3}-\d{2}-\d{4}", "regex", case_sensitive=True),), severity="high"),
    Pattern("email", (Condition(r"[a-z0-9.]+@[a-z0-9]+\.[a-z]+", "regex", case_sensitive=True),)),
    Pattern(
        "license",
        (Condition("license"), Condition("copyright", connector="or"), Condition("fr", sources=("userMessage",), negate=True)),
        severity="low",
    ),
    Pattern("polite", (Condition("thank", sources=("response", "userMessage")),), polarity="proper"),
    Pattern("digits", (Condition("[0-9]{8}", "regex"),), agent_ids=("agent-1", "agent-2")),
    Pattern("off", (Condition("a"),), enabled=False),
)
SOURCES = {"response": "response", "userMessage": "user_message"}

HITS_SQL = """
SELECT span_id, agent, started_at, 'ssn' AS pattern_key, 'failure' AS polarity, 'high' AS severity FROM {doc_roots}
WHERE regexp_matches(response, '[0-9][0-9][0-9]-[0-9][0-9]-[0-9][0-9][0-9][0-9]')
UNION ALL SELECT span_id, agent, started_at, 'email', 'failure', 'medium' FROM {doc_roots}
WHERE regexp_matches(response, '[a-z0-9.]+@[a-z0-9]+[.][a-z]+')
UNION ALL SELECT span_id, agent, started_at, 'license', 'failure', 'low' FROM {doc_roots}
WHERE (contains(lower(response), 'license') OR contains(lower(response), 'copyright')) AND NOT contains(lower(user_message), 'fr')
UNION ALL SELECT span_id, agent, started_at, 'polite', 'proper', 'medium' FROM {doc_roots}
WHERE contains(lower(response), 'thank') OR contains(lower(user_message), 'thank')
UNION ALL SELECT span_id, agent, started_at, 'digits', 'failure', 'medium' FROM {doc_roots}
WHERE agent IN ('agent-1', 'agent-2') AND regexp_matches(response, '[0-9][0-9][0-9][0-9][0-9][0-9][0-9][0-9]')
"""


def doc_hits(t):
    return M.span_pattern(t.doc_roots, PATTERNS, SOURCES)


def facts(t, since=None):
    return M.run_facts(t.spans, since=since)


def with_tool(spans):
    return spans.withColumn("tool", F.when(F.col("span_kind") == "tool", F.concat(F.lit("tool-"), (F.col("span_id") % 9).cast("string"))))


def priced(t):
    evals = t.spans.where("source = 'eval-run'").select(F.col("trace_id").alias("e"))
    p = M.price_join(with_tool(t.spans), t.prices, t.tool_prices)
    return p.join(evals, F.col("trace_id") == F.col("e"), "left").withColumn("is_eval", F.col("e").isNotNull()).drop("e")


PRICED_SQL = """
SELECT s.*, e.trace_id IS NOT NULL AS is_eval,
  greatest(greatest(input_tokens - cache_read_tokens, 0) * CAST(coalesce(p.input_usd, 0) AS DECIMAL(14, 6))
    + cache_read_tokens * CAST(coalesce(p.cache_read_usd, p.input_usd, 0) AS DECIMAL(14, 6)) + output_tokens * CAST(coalesce(p.output_usd, 0) AS DECIMAL(14, 6)), 0)
  + coalesce(q.call_micro, 0) AS micro, CASE WHEN span_kind = 'tool' THEN concat('tool-', CAST(span_id % 9 AS STRING)) END AS tool
FROM {spans} s LEFT JOIN (SELECT tool AS q_tool, valid_from, lead(valid_from) OVER (PARTITION BY tool ORDER BY valid_from NULLS FIRST) AS valid_until, CAST(round(price_usd * 1000000) AS BIGINT) AS call_micro FROM {tool_prices}) q
  ON s.span_kind = 'tool' AND q.q_tool = concat('tool-', CAST(span_id % 9 AS STRING)) AND (valid_from IS NULL OR started_at >= valid_from) AND (valid_until IS NULL OR started_at < valid_until) LEFT JOIN {prices} p ON s.model = p.model
LEFT JOIN (SELECT trace_id FROM {spans} WHERE source = 'eval-run') e ON s.trace_id = e.trace_id
"""

FACTS_SQL = f"""
SELECT r.span_id, r.trace_id, r.agent, r.started_at, r.latency_ms, r.error IS NOT NULL AS failed,
       coalesce(k.ok, 0) AS tool_ok, coalesce(k.bad, 0) AS tool_failed
FROM {{spans}} r LEFT JOIN (SELECT trace_id, count(*) FILTER (error IS NULL) AS ok, count(*) FILTER (error IS NOT NULL) AS bad
  FROM {{spans}} WHERE span_kind = 'tool' GROUP BY trace_id) k ON r.trace_id = k.trace_id
WHERE {PROD}
"""


def kpis_sql(condition, votes):
    return f"""
SELECT CASE WHEN coalesce(f.whole, v.whole) = 1 THEN 'project' ELSE 'agent' END AS scope, coalesce(f.agent, v.agent) AS agent,
  {", ".join(f"coalesce({c}, 0) AS {c}" for c in ("total_runs", "failed_runs", "ok_runs", "error_runs", "flagged_runs", "tool_failure_runs"))},
  failure_rate, health_rate, tool_failure_rate, downvote_rate, p95_latency_ms FROM (
  SELECT grouping(agent) AS whole, agent, count(*) AS total_runs, CAST(count(*) FILTER (failed) AS BIGINT) AS failed_runs,
    count(*) FILTER (NOT failed AND tool_failed = 0) AS ok_runs, count(*) FILTER (failed) AS error_runs, 0::BIGINT AS flagged_runs,
    count(*) FILTER (NOT failed AND tool_failed > 0) AS tool_failure_runs,
    round(count(*) FILTER (failed) / count(*), 6) AS failure_rate,
    round(1 - count(*) FILTER (failed) / count(*), 6) AS health_rate,
    round(sum(tool_failed) / nullif(sum(tool_ok) + sum(tool_failed), 0), 6) AS tool_failure_rate,
    round(quantile_cont(latency_ms, 0.95), 6) AS p95_latency_ms
  FROM ({FACTS_SQL}) WHERE {condition} GROUP BY GROUPING SETS ((agent), ())) f
FULL JOIN (SELECT grouping(agent) AS whole, agent, round(count(*) FILTER (rating = 'down') / count(*), 6) AS downvote_rate
  FROM {{feedback}} v JOIN ({FACTS_SQL}) x ON v.trace_id = x.trace_id WHERE {votes} GROUP BY GROUPING SETS ((agent), ())) v
ON f.whole = v.whole AND f.agent IS NOT DISTINCT FROM v.agent
"""


@query("kpis", kpis_sql(WEEK, WEEK_FB))
def kpis(t):
    return M.kpis(facts(t, "2024-01-24 00:00:00"), t.feedback, NOW, 7 * DAY, M.production_roots(t.spans))


@query("production_roots", f"SELECT span_id, agent FROM {{spans}} WHERE {PROD}")
def production_roots(t):
    return M.production_roots(t.spans).select("span_id", "agent")


@query("match_contains", """
SELECT span_id FROM {doc_roots} WHERE (contains(lower(response), 'the') OR contains(lower(response), 'der'))
  AND contains(lower(response), 'in') AND NOT contains(lower(response), 'que')""")
def match_contains(t):
    return t.doc_roots.where(
        matching.match_contains(F.col("response"), ["the", "Der"], ["in"], ["QUE"])
    ).select("span_id")


@query("match_regex", "SELECT span_id FROM {doc_roots} WHERE regexp_matches(response, '[A-Z][a-z]+ [0-9]+')")
def match_regex(t):
    return t.doc_roots.where(matching.match_regex(F.col("response"), "[A-Z][a-z]+ [0-9]+")).select("span_id")


@query("match_conditions", """
SELECT span_id FROM {turns} WHERE (contains(lower(response), 'tion') OR contains(user_message, 'In'))
  AND NOT regexp_matches(coalesce(user_message, ''), '(?i)que.*la') AND NOT contains(lower(response), 'zz')""")
def match_conditions(t):
    conditions = [
        Condition("TION"),
        Condition("In", connector="or", sources=("userMessage",), case_sensitive=True),
        Condition("que.*la", "regex", negate=True, sources=("userMessage",)),
        Condition("zz", negate=True),
    ]
    sources = {"response": F.col("response"), "userMessage": F.col("user_message")}
    return t.turns.where(matching.match_conditions(conditions, sources)).select("span_id")


@query("match_targets", """
SELECT trace_id FROM {doc_roots} GROUP BY trace_id
HAVING bool_or(contains(lower(response), 'license')) AND bool_or(contains(lower(response), 'que')) AND bool_or(contains(lower(response), 'the'))""")
def match_targets(t):
    return M.trace_term_match(t.doc_roots, "response", ["LICENSE", "que", "the"])


@query("match_semantic", """
SELECT d.span_id, d.agent FROM {doc_roots} d JOIN {labels} l ON d.span_id = l.doc_id WHERE l.toxic = 1""")
def match_semantic(t):
    """A rubric judged by a model: its verdict column is an input table."""
    verdicts = t.labels.where("toxic = 1").select(F.col("doc_id").alias("span_id"))
    return t.doc_roots.join(verdicts, "span_id", "left_semi").select("span_id", "agent")


@query("scope_agents", f"SELECT span_id FROM {{spans}} WHERE {PROD} AND agent IN ('agent-2', 'agent-4')")
def scope_agents(t):
    return M.production_roots(t.spans).where(matching.scope_agents(F.col("agent"), ["agent-2", "agent-4"])).select("span_id")


@query("check_empty_response", """
SELECT span_id FROM {turns} WHERE trim(coalesce(CASE WHEN turn % 3 = 0 THEN '  ' ELSE response END, '')) = ''""")
def check_empty_response(t):
    output = F.when(F.col("turn") % 3 == 0, "  ").otherwise(F.col("response"))
    return t.turns.where(M.empty_response(output)).select("span_id")


@query("check_trace_error", f"SELECT span_id FROM {{spans}} WHERE {PROD} AND error IS NOT NULL")
def check_trace_error(t):
    return M.production_roots(t.spans).where(M.trace_error(F.col("error"))).select("span_id")


@query("check_tool_failure", f"""
SELECT span_id FROM {{spans}} WHERE {PROD} AND trace_id IN
  (SELECT trace_id FROM {{spans}} WHERE span_kind = 'tool' AND error IS NOT NULL)""")
def check_tool_failure(t):
    return M.traces_with_tool_failure(t.spans).select("span_id")


@query("check_latency", f"""
SELECT span_id, s.agent, latency_ms, CAST(coalesce(latency_threshold_ms, 20000) AS BIGINT) AS limit_ms
FROM {{spans}} s LEFT JOIN {{profiles}} p ON s.agent = p.agent
WHERE {PROD} AND latency_ms > coalesce(latency_threshold_ms, 20000)""")
def check_latency(t):
    return M.slow_roots(t.spans, t.profiles)


@query("check_downvote", """
SELECT f.trace_id, s.agent FROM {feedback} f JOIN {spans} s ON f.trace_id = s.span_id
WHERE f.rating = 'down' AND s.parent_span_id IS NULL""")
def check_downvote(t):
    downs = t.feedback.where("rating = 'down'").select("trace_id")
    return downs.join(trees.roots(t.spans).select("trace_id", "agent"), "trace_id")


@query("monitor_eligible", f"""
SELECT span_id, CASE WHEN s.span_id % 10 = 0 THEN true WHEN s.span_id % 7 = 0 THEN false
  ELSE coalesce(p.enabled AND p.coverage = 'all', false) END AS eligible
FROM {{spans}} s LEFT JOIN {{profiles}} p ON s.agent = p.agent WHERE {PROD}""")
def monitor_eligible(t):
    flag = F.when(F.col("span_id") % 10 == 0, True).when(F.col("span_id") % 7 == 0, False)
    verdict = sampling.monitor_eligible(flag, F.col("span_id"), F.col("enabled"), F.col("coverage"), F.lit(0.0))
    return M.production_roots(t.spans).join(t.profiles, "agent", "left").select("span_id", verdict.alias("eligible"))


@query("pattern_ids_restrict", """
SELECT span_id, 'email' AS pattern_key FROM {doc_roots}
WHERE regexp_matches(response, '[a-z0-9.]+@[a-z0-9]+[.][a-z]+') AND span_id % 3 <> 0
UNION ALL SELECT span_id, 'off' FROM {doc_roots} WHERE span_id % 3 = 0 AND contains(lower(response), 'a')""")
def pattern_ids_restrict(t):
    named = t.doc_roots.withColumn("pattern_ids", F.when(F.col("span_id") % 3 == 0, F.array(F.lit("off"))))
    chosen = [p for p in PATTERNS if p.key in ("email", "off")]
    return M.span_pattern(named, chosen, SOURCES, "pattern_ids").select("span_id", "pattern_key")


@query("metrics_filter", """
SELECT span_id FROM {spans} WHERE agent = 'agent-3' AND span_kind = 'tool' AND framework IS NULL AND error IS NOT NULL
UNION ALL SELECT span_id FROM {spans} WHERE model = 'm-large' AND lower(framework) = 'langchain' AND error IS NULL""")
def metrics_filter(t):
    a = M.metrics_filter(t.spans, agent="agent-3", kind="tool", framework="other", status="error")
    b = M.metrics_filter(t.spans, model="m-large", framework="LangChain", status="ok")
    return a.unionByName(b).select("span_id")


@query("span_pattern", HITS_SQL)
def span_pattern(t):
    return doc_hits(t)


SIGNALS_SQL = f"""
SELECT pattern_key, agent, min(started_at) AS first_seen, max(started_at) AS last_seen, count(*) AS n,
  max(span_id) AS representative, arg_max(polarity, struct_pack(a := started_at, b := span_id)) AS polarity, arg_max(severity, struct_pack(a := started_at, b := span_id)) AS severity,
  CASE WHEN arg_max(polarity, struct_pack(a := started_at, b := span_id)) = 'proper' THEN 'healthy' ELSE 'open' END AS status
FROM ({HITS_SQL}) GROUP BY pattern_key, agent
"""


@query("signal_rollup", SIGNALS_SQL)
def signal_rollup(t):
    return M.signal_rollup(doc_hits(t))


@query("signals_filter", f"""
SELECT pattern_key, agent, n FROM ({SIGNALS_SQL}) s WHERE polarity = 'failure' AND status = 'open' AND severity = 'medium'
  AND (agent = 'agent-1' OR pattern_key IN (SELECT pattern_key FROM ({HITS_SQL}) WHERE agent = 'agent-1'))
ORDER BY last_seen DESC, pattern_key, agent""")
def signals_filter(t):
    hits = doc_hits(t)
    out = M.signals_filter(M.signal_rollup(hits), status="open", severity="medium", agent="agent-1", occurrences=hits)
    return out.select("pattern_key", "agent", "n")


@query("signals_recent", f"SELECT pattern_key, agent, n FROM ({SIGNALS_SQL}) ORDER BY last_seen DESC, pattern_key, agent LIMIT 20")
def signals_recent(t):
    return M.signals_filter(M.signal_rollup(doc_hits(t)), polarity="all", limit=20).select("pattern_key", "agent", "n")


@query("recent_occurrences", f"""
SELECT pattern_key, agent, span_id, pos FROM (SELECT *, row_number() OVER (PARTITION BY pattern_key, agent
  ORDER BY started_at DESC, span_id DESC) AS pos FROM ({HITS_SQL})) WHERE pos <= 5""")
def recent_occurrences(t):
    return M.recent_occurrences(doc_hits(t), 5).select("pattern_key", "agent", "span_id", "pos")


@query("rule_filter", """
SELECT span_id FROM {spans} s JOIN {documents} d ON d.doc_id = s.span_id
WHERE s.parent_span_id IS NULL AND s.model = 'm-small' AND s.error IS NOT NULL AND contains(lower(d.text), 'an')
  AND s.agent IN ('agent-0', 'agent-1', 'agent-2')""")
def rule_filter(t):
    from spanquarry.operators.routing import Rule, rule_filter as filter_rule

    rule = Rule("r1", model="m-small", status="error", contains="AN", agent_ids=("agent-0", "agent-1", "agent-2"))
    texts = t.documents.select(F.col("doc_id").alias("span_id"), F.col("text").alias("output"))
    return filter_rule(trees.roots(t.spans).join(texts, "span_id"), rule).select("span_id")


def _both(sql):
    return ", ".join(sql.format(p=p, c=c) for p, c in (("current", 1), ("prior", 0)))


DELTAS = ("failure_rate", "health_rate", "tool_failure_rate", "downvote_rate", "p95")


@query("kpi_delta", f"""
WITH f AS (SELECT *, CASE WHEN started_at >= TIMESTAMP '{NOW}' - INTERVAL 7 DAY THEN 1 ELSE 0 END AS cur FROM ({FACTS_SQL})
  WHERE started_at >= TIMESTAMP '{NOW}' - INTERVAL 14 DAY AND started_at < TIMESTAMP '{NOW}'),
g AS (SELECT agent, {_both("CAST(count(*) FILTER (cur = {c}) AS BIGINT) AS {p}_runs, round(count(*) FILTER (failed AND cur = {c}) / nullif(count(*) FILTER (cur = {c}), 0), 6) AS {p}_failure_rate, round(1 - count(*) FILTER (failed AND cur = {c}) / nullif(count(*) FILTER (cur = {c}), 0), 6) AS {p}_health_rate, round(sum(tool_failed) FILTER (cur = {c}) / nullif(sum(tool_ok + tool_failed) FILTER (cur = {c}), 0), 6) AS {p}_tool_failure_rate, round(quantile_cont(latency_ms, 0.95) FILTER (cur = {c}), 6) AS {p}_p95")} FROM f GROUP BY agent),
v AS (SELECT agent, {_both("round(count(*) FILTER (rating = 'down' AND cur = {c}) / nullif(count(*) FILTER (cur = {c}), 0), 6) AS {p}_downvote_rate")} FROM (
  SELECT r.agent, b.rating, CASE WHEN b.created_at >= TIMESTAMP '{NOW}' - INTERVAL 7 DAY THEN 1 ELSE 0 END AS cur FROM {{feedback}} b JOIN ({FACTS_SQL}) r ON b.trace_id = r.trace_id
  WHERE b.created_at >= TIMESTAMP '{NOW}' - INTERVAL 14 DAY AND b.created_at < TIMESTAMP '{NOW}') GROUP BY agent)
SELECT g.* REPLACE (coalesce(g.agent, v.agent) AS agent, coalesce(g.current_runs, 0) AS current_runs, coalesce(g.prior_runs, 0) AS prior_runs), v.current_downvote_rate, v.prior_downvote_rate, {", ".join(f"round(current_{k} - prior_{k}, 6) AS {k}_delta" for k in DELTAS)} FROM g FULL JOIN v ON g.agent = v.agent""")
def kpi_delta(t):
    return M.kpi_delta(facts(t, "2024-01-17 00:00:00"), NOW, 7 * DAY, t.feedback, M.production_roots(t.spans))


@query("price_join", f"SELECT span_id, CAST(micro AS DOUBLE) AS cost_micro FROM ({PRICED_SQL})")
def price_join(t):
    return priced(t).select("span_id", F.col("cost_micro_usd").cast("double").alias("cost_micro"))


@query("metrics_grid", f"""
SELECT CAST(floor(epoch(started_at) / 86400) AS BIGINT) * 86400000 AS ts, lower(coalesce(framework, 'other')) AS framework,
  count(*) AS spans, CAST(count(*) FILTER (span_kind = 'agent') AS BIGINT) AS agent_spans,
  count(*) FILTER (span_kind = 'llm') AS llm_spans, count(*) FILTER (span_kind = 'tool') AS tool_spans,
  count(*) FILTER (span_kind = 'retrieval') AS retrieval_spans, count(*) FILTER (span_kind = 'memory') AS memory_spans,
  count(*) FILTER (span_kind = 'tool' AND error IS NOT NULL) AS tool_failures,
  CAST(sum(input_tokens) AS BIGINT) AS input_tokens, CAST(sum(output_tokens) AS BIGINT) AS output_tokens,
  round(CAST(sum(micro) AS DOUBLE) / 1000000, 6) AS cost_usd, round(quantile_cont(latency_ms, 0.5), 6) AS p50_latency_ms,
  round(quantile_cont(latency_ms, 0.95), 6) AS p95_latency_ms
FROM ({PRICED_SQL}) WHERE {WEEK} AND trace_id IN (SELECT trace_id FROM {{spans}} WHERE {PROD}) GROUP BY 1, 2""")
def metrics_grid(t):
    return M.metrics_grid(M.price_join(with_tool(M.production_spans(t.spans)), t.prices, t.tool_prices), NOW, 7 * DAY)


@query("cost_trend", f"""
SELECT ts, segment, tool, round(CAST(sum(micro) AS DOUBLE) / 1000000, 6) AS cost_usd FROM (
  SELECT CAST(floor(epoch(started_at) / 86400) AS BIGINT) * 86400000 AS ts, micro, CASE WHEN NOT is_eval THEN tool END AS tool,
    CASE WHEN is_eval THEN 'eval runs' WHEN span_kind = 'tool' THEN 'tool calls' ELSE coalesce(model, 'unpriced') END AS segment
  FROM ({PRICED_SQL}) WHERE {WEEK}) GROUP BY GROUPING SETS ((ts, segment), (ts), (), (tool)) HAVING grouping(tool) = 1 OR tool IS NOT NULL""")
def cost_trend(t):
    return M.cost_trend(priced(t), NOW, 7 * DAY)


@query("alert_metric", f"""
WITH k AS ({kpis_sql(WEEK.replace('7 DAY', '1440 MINUTE'), WEEK_FB.replace('7 DAY', '1440 MINUTE'))}),
c AS (SELECT agent, sum(micro) AS cost FROM ({PRICED_SQL}) WHERE {WEEK.replace('7 DAY', '1440 MINUTE')} AND NOT is_eval GROUP BY agent),
w AS (SELECT k.agent, failure_rate, tool_failure_rate, downvote_rate, p95_latency_ms, CAST(total_runs AS DOUBLE) AS n, round(CAST(cost AS DOUBLE) / 1000000, 6) AS cost
  FROM k LEFT JOIN c ON k.agent = c.agent WHERE k.scope = 'agent')
SELECT agent, 'failureRate' AS metric, failure_rate AS value FROM w UNION ALL SELECT agent, 'toolFailureRate', tool_failure_rate FROM w
UNION ALL SELECT agent, 'downvoteRate', downvote_rate FROM w UNION ALL SELECT agent, 'p95LatencyMs', p95_latency_ms FROM w
UNION ALL SELECT agent, 'traceCount', n FROM w UNION ALL SELECT agent, 'estimatedCostUsd', cost FROM w""")
def alert_metric(t):
    recent = facts(t, "2024-01-30 00:00:00")
    return M.alert_metrics(recent, t.feedback, priced(t).where(~F.col("is_eval")), NOW, 1440, M.production_roots(t.spans))


@query("latency_percentiles", """
SELECT agent, span_kind, count(*) AS n, round(quantile_cont(latency_ms, 0.5), 6) AS p50, round(quantile_cont(latency_ms, 0.9), 6) AS p90,
  round(quantile_cont(latency_ms, 0.95), 6) AS p95, round(quantile_cont(latency_ms, 0.99), 6) AS p99
FROM {spans} GROUP BY agent, span_kind""")
def latency_percentiles(t):
    return M.latency_percentiles(t.spans, ["agent", "span_kind"])


def day_sketches(t):
    """Sketches per agent and day, stored by two jobs of which the second brings late rows of the same days."""
    folder = scratch(t.spark, "sketches")
    write = sketches.sketch_sink(folder)
    for epoch in (0, 1):
        write(t.spans.where(F.col("span_id") % 2 == epoch), epoch)
    return sketches.read_sketches(t.spark, folder)


@query("latency_percentiles_approx", """
SELECT agent, count(*) AS n, true AS p50_within, true AS p95_within FROM {spans} WHERE latency_ms IS NOT NULL GROUP BY agent""")
def latency_percentiles_approx(t):
    """Percentiles from merged sketches, each with whether its exact rank is within the stated error."""
    found = sketches.estimates(day_sketches(t), ["agent"]).select(F.col("agent").alias("a"), "p50", "p95")
    values = t.spans.where("latency_ms IS NOT NULL").join(found, F.col("agent") == F.col("a"))
    counts = [F.count_if(F.col("latency_ms") < F.col(p)).alias(f"{p}_below") for p in ("p50", "p95")]
    counts += [F.count_if(F.col("latency_ms") <= F.col(p)).alias(f"{p}_upto") for p in ("p50", "p95")]
    ranks = values.groupBy("agent").agg(F.count("*").alias("n"), *counts)
    within = [sketches.within_rank(F.col(f"{p}_below"), F.col(f"{p}_upto"), F.col("n"), q).alias(f"{p}_within") for p, q in (("p50", 0.5), ("p95", 0.95))]
    return ranks.select("agent", "n", *within)


@query("tool_quality", """
SELECT concat('tool-', CAST(span_id % 9 AS STRING)) AS name, count(*) AS calls, CAST(count(*) FILTER (error IS NOT NULL) AS BIGINT) AS failures,
  round(count(*) FILTER (error IS NOT NULL) / nullif(count(*) FILTER (span_id % 11 <> 0 OR error IS NOT NULL), 0), 6) AS failure_rate,
  round(avg(latency_ms), 6) AS avg_latency_ms
FROM {spans} WHERE span_kind = 'tool' GROUP BY 1""")
def tool_quality(t):
    unknown = (F.col("span_id") % 11 == 0) & F.col("error").isNull()
    calls = t.spans.where("span_kind = 'tool'").select(
        F.concat(F.lit("tool-"), (F.col("span_id") % 9).cast("string")).alias("name"),
        F.when(~unknown, F.col("error").isNull()).alias("success"),
        "latency_ms",
    )
    return M.tool_quality(calls)


@query("framework_totals", """
SELECT CAST(floor(epoch(started_at) / 86400) AS BIGINT) * 86400000 AS ts, lower(coalesce(framework, 'other')) AS framework, count(*) AS n
FROM {spans} GROUP BY 1, 2""")
def framework_totals(t):
    return M.framework_totals(t.spans)


@query("downvote_rate", "SELECT round(avg(CASE WHEN rating = 'down' THEN 1.0 ELSE 0.0 END), 6) AS downvote_rate, count(*) AS votes FROM {feedback}")
def downvote_rate(t):
    down = F.count_if(F.col("rating") == "down")
    return t.feedback.agg(F.round(M.ratio(down, F.count("*")), 6).alias("downvote_rate"), F.count("*").alias("votes"))


SESSIONS = "(SELECT user_id AS session_id, started_at, span_id FROM {spans} WHERE parent_span_id IS NULL)"


def session_turns(t):
    return trees.roots(t.spans).select(F.col("user_id").alias("session_id"), "started_at", "span_id")


@query("session_summary", f"""
SELECT s.session_id, turns, first_at, last_at, latest_score FROM
  (SELECT session_id, count(*) AS turns, min(started_at) AS first_at, max(started_at) AS last_at FROM {SESSIONS} GROUP BY session_id) s
LEFT JOIN (SELECT r.session_id, arg_max(v.rating, struct_pack(a := r.started_at, b := v.trace_id)) AS latest_score
  FROM {{verdicts}} v JOIN {SESSIONS} r ON v.trace_id = r.span_id GROUP BY r.session_id) l ON s.session_id = l.session_id""")
def session_summary(t):
    turns = session_turns(t)
    scores = t.verdicts.join(turns, F.col("trace_id") == F.col("span_id")).select(
        "session_id", "rating", F.col("started_at").alias("scored_at"), F.col("trace_id").alias("verdict_id")
    )
    return M.session_summary(turns, scores)


@query("session_multi_turn", f"SELECT session_id, count(*) AS turns FROM {SESSIONS} GROUP BY session_id HAVING count(*) >= 2")
def session_multi_turn(t):
    return M.multi_turn_sessions(session_turns(t))


@query("distinct_sessions", f"SELECT session_id, min(started_at) AS first_at FROM {SESSIONS} GROUP BY session_id")
def distinct_sessions(t):
    return M.distinct_sessions(session_turns(t))


@query("approx_users", """
SELECT coalesce(agent, 'all') AS agent, count(*) AS n, count(DISTINCT user_id) AS users, true AS within FROM {spans} GROUP BY GROUPING SETS ((agent), ())""")
def approx_users(t):
    """Distinct users per agent and in all from merged sketches, beside the exact number and whether the estimate is within its error."""
    days = day_sketches(t)
    each = sketches.estimates(days, ["agent"]).unionByName(sketches.estimates(days.withColumn("agent", F.lit("all")), ["agent"]))
    exact = t.spans.groupingSets([["agent"], []], "agent").agg(F.count_distinct("user_id").alias("exact")).select(F.coalesce("agent", F.lit("all")).alias("agent"), "exact")
    within = sketches.within_count(F.col("users"), F.col("exact")).alias("within")
    return each.join(exact, "agent").select("agent", "n", F.col("exact").alias("users"), within)


@query("topic_counts", """
SELECT d.lang AS topic, count(*) AS n, round(avg(CASE WHEN l.toxic = 1 THEN -1 ELSE l.quality END), 6) AS sentiment
FROM {documents} d JOIN {labels} l ON d.doc_id = l.doc_id GROUP BY d.lang""")
def topic_counts(t):
    sentiment = F.when(F.col("toxic") == 1, -1).otherwise(F.col("quality"))
    return M.topic_counts(t.documents.join(t.labels, "doc_id").select(F.col("lang").alias("topic"), sentiment.alias("sentiment")))


@query("rating_series", """
SELECT CAST(floor(epoch(s.started_at) / 3600) AS BIGINT) * 3600000 AS ts, round(avg(v.rating), 6) AS average_rating, count(v.rating) AS n
FROM {verdicts} v JOIN {spans} s ON v.trace_id = s.span_id GROUP BY 1""")
def rating_series(t):
    timed = t.verdicts.join(t.spans.select("span_id", F.col("started_at").alias("scored_at")), F.col("trace_id") == F.col("span_id"))
    return M.rating_series(timed, 3600)


IDLE = 12 * 3600


@query("idle_points", f"""
SELECT session_id, started_at + INTERVAL 12 HOUR AS idle_at, turns FROM (SELECT session_id, started_at,
  row_number() OVER w AS turns, coalesce(lead(started_at) OVER w, TIMESTAMP '{NOW}') AS next_at
  FROM {SESSIONS} WINDOW w AS (PARTITION BY session_id ORDER BY started_at, span_id))
WHERE turns >= 2 AND next_at >= started_at + INTERVAL 12 HOUR""")
def idle_points(t):
    return M.idle_points(session_turns(t), IDLE, NOW)


@query("retention", f"SELECT span_id FROM {{spans}} WHERE started_at >= TIMESTAMP '{NOW}' - INTERVAL 20 DAY")
def retention(t):
    from spanquarry.sources.tables import retention as keep

    return keep(t.spans, "started_at", NOW, 20).select("span_id")
