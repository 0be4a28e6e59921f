"""Callback logs, message lists, streams of chunks, alert ticks."""

from pyspark.sql import functions as F

from catalog.base import query, view
from catalog.monitoring import FACTS_SQL, facts
from catalog.views import NOW
from spanquarry.operators import logs as L

# A team run per conversation: some messages without a time, tool requests and executions.
view("team", """
SELECT conv_id AS run_id, turn AS pos, TIMESTAMP '2024-01-01 00:00:00' + conv_id * INTERVAL 1 HOUR AS run_start,
       CASE WHEN turn % 3 <> 1 THEN TIMESTAMP '2024-01-01 00:00:00' + conv_id * INTERVAL 1 HOUR + (turn + 1) * INTERVAL 7 SECOND END AS created_at,
       CASE turn % 4 WHEN 1 THEN 'request' WHEN 2 THEN 'execution' ELSE 'text' END AS kind,
       CASE WHEN turn % 4 = 3 THEN role END AS source, text,
       CASE WHEN turn % 4 = 1 THEN concat('c', CAST(turn + 1 AS STRING)) WHEN turn % 4 = 2 AND conv_id % 3 <> 0 THEN concat('c', CAST(turn AS STRING)) WHEN turn % 4 = 2 THEN 'zz' END AS call_id,
       concat('tool', CAST(turn % 4 AS STRING)) AS call_name, CASE WHEN turn % 4 = 1 THEN 'args' END AS call_args, turn % 8 = 2 AS is_error,
       CASE WHEN turn % 4 IN (1, 3) THEN turn * 10 END AS input_tokens, CASE WHEN turn % 4 = 3 OR turn % 8 = 0 THEN turn + 1 END AS output_tokens
FROM {conversations}
""")
TIMED = """
SELECT *, coalesce(last_value(created_at IGNORE NULLS) OVER (PARTITION BY run_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), run_start) AS start_at,
  coalesce(last_value(created_at IGNORE NULLS) OVER (PARTITION BY run_id ORDER BY pos ROWS UNBOUNDED PRECEDING), run_start) AS end_at FROM {team}"""


@query("chain_timing", f"SELECT run_id, pos, start_at, end_at FROM ({TIMED})")
def chain_timing(t):
    return L.chain_timing(t.team, slice_size=2).select("run_id", "pos", "start_at", "end_at")


PAIRED = f"""
SELECT e.run_id, e.pos, coalesce(r.call_name, e.call_name) AS name, r.call_args AS input, CASE WHEN e.is_error THEN 'ERROR: ' || e.text ELSE e.text END AS output, NOT e.is_error AS success, coalesce(r.start_at, e.start_at) AS start_at, e.end_at
FROM ({TIMED}) e LEFT JOIN ({TIMED}) r ON r.kind = 'request' AND e.run_id = r.run_id AND e.call_id = r.call_id WHERE e.kind = 'execution'"""


@query("pair_tool_calls", f"SELECT run_id, pos, name, input, output, success, start_at, end_at FROM ({PAIRED})")
def pair_tool_calls(t):
    out = L.norm_team_log(t.team).where("span_kind = 'tool'")
    return out.select("run_id", "pos", "name", "input", "output", "success", "start_at", "end_at")


@query("norm_team_log", f"""
SELECT run_id, pos, 'tool' AS span_kind, name, input, output, success, start_at, end_at, NULL::BIGINT AS input_tokens, NULL::BIGINT AS output_tokens FROM ({PAIRED})
UNION ALL SELECT run_id, pos, CASE WHEN source <> '' THEN 'agent' ELSE 'llm' END, CASE WHEN source <> '' THEN source ELSE 'LLM Call ' || row_number() OVER (PARTITION BY run_id ORDER BY pos) END, NULL, text, NULL, start_at, end_at, input_tokens, output_tokens
FROM ({TIMED}) WHERE kind = 'text' AND (input_tokens IS NOT NULL OR output_tokens IS NOT NULL)""")
def norm_team_log(t):
    return L.norm_team_log(t.team)


@query("team_totals", """
SELECT run_id, arg_max(text, pos) FILTER (kind = 'text' AND text <> '') AS output, CAST(coalesce(sum(input_tokens) FILTER (kind = 'text'), 0) AS BIGINT) AS input_tokens, CAST(coalesce(sum(output_tokens) FILTER (kind = 'text'), 0) AS BIGINT) AS output_tokens
FROM {team} GROUP BY run_id""")
def team_totals(t):
    return L.team_totals(t.team)


# Model and tool callbacks of an agent: starts and ends.
PLUGIN = """
SELECT user_id AS run_id, event_id, ts AS happened, CASE event_type WHEN 'view' THEN 'model_start' WHEN 'purchase' THEN 'model_end' WHEN 'click' THEN 'tool_start' WHEN 'error' THEN 'tool_end' END AS event,
  concat('tool-', CAST(event_id % 2 AS STRING)) AS tool, concat('p', CAST(event_id AS STRING)) AS payload, CASE WHEN event_id % 6 = 1 THEN 'boom' END AS error FROM {events}"""


def fifo_sql(start, end, keys):
    return f"""
WITH u AS (SELECT *, coalesce(max(greatest(ne - ns, 0)) OVER (PARTITION BY {keys} ORDER BY happened, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lost FROM (
  SELECT *, CAST(count(*) FILTER (event = '{end}') OVER w AS BIGINT) AS ne, CAST(count(*) FILTER (event = '{start}') OVER w AS BIGINT) AS ns FROM ({PLUGIN}) WHERE event IN ('{start}', '{end}') WINDOW w AS (PARTITION BY {keys} ORDER BY happened, event_id)))
SELECT e.run_id, e.tool, e.ne AS n, e.happened AS end_at, e.payload AS end_payload, e.error AS end_error, s.happened, s.event_id, s.payload
FROM (SELECT *, CASE WHEN ne - ns <= lost THEN ne - lost END AS k FROM u WHERE event = '{end}') e
LEFT JOIN (SELECT {keys}, ns AS k, happened, event_id, payload FROM u WHERE event = '{start}') s USING ({keys}, k)"""


@query("pair_fifo", f"SELECT run_id, tool, n, event_id AS start_event_id, end_payload FROM ({fifo_sql('tool_start', 'tool_end', 'run_id, tool')})")
def pair_fifo(t):
    log = t.sql(PLUGIN).withColumnRenamed("happened", "at")
    starts = log.where("event = 'tool_start'").select("run_id", "tool", "at", "event_id", "payload")
    ends = log.where("event = 'tool_end'").select("run_id", "tool", "at", "event_id", "payload")
    return L.pair_fifo(starts, ends, ["run_id", "tool"]).select("run_id", "tool", "n", "start_event_id", "end_payload")


@query("norm_plugin_log", f"""
SELECT run_id, 'llm' AS span_kind, 'LLM Call ' || n AS name, payload AS input, end_payload AS output, end_error AS error, happened AS start_at, CAST(floor((epoch_us(end_at) - epoch_us(happened)) / 1000) AS BIGINT) AS latency_ms, NULL::BOOLEAN AS success FROM ({fifo_sql('model_start', 'model_end', 'run_id')})
UNION ALL SELECT run_id, 'tool', tool, payload, end_payload, end_error, happened, CAST(floor((epoch_us(end_at) - epoch_us(happened)) / 1000) AS BIGINT), end_error IS NULL FROM ({fifo_sql('tool_start', 'tool_end', 'run_id, tool')})""")
def norm_plugin_log(t):
    return L.norm_plugin_log(t.sql(PLUGIN).withColumnRenamed("happened", "at"))


# Crew tasks: the spans of a trace as tasks, in reverse insertion order, with outputs for most.
TASKS = """
SELECT trace_id AS run_id, 8 - span_id % 8 AS pos, CASE WHEN span_id % 3 = 0 THEN concat('task ', CAST(span_id AS STRING)) END AS name, started_at AS start_at,
  CASE WHEN span_id % 4 <> 1 THEN started_at + latency_ms * INTERVAL 1 MILLISECOND END AS end_at, error FROM {spans}"""
TASK_OUT = "SELECT trace_id AS run_id, span_id % 8 AS pos, CASE WHEN span_id % 2 = 0 THEN concat('about ', CAST(span_id AS STRING)) END AS description, concat('out ', CAST(span_id AS STRING)) AS raw FROM {spans} WHERE span_id % 8 <> 7"
ORDERED = f"SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY start_at, pos) AS step, greatest((epoch_us(coalesce(end_at, start_at)) - epoch_us(start_at)) / 1000, 0.0) AS duration_ms FROM ({TASKS})"
NUMBERED_OUT = f"SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY pos) AS step FROM ({TASK_OUT})"


@query("task_order", f"SELECT run_id, step, start_at, coalesce(end_at, start_at) AS end_at, duration_ms FROM ({ORDERED})")
def task_order(t):
    return L.task_order(t.sql(TASKS)).select("run_id", "step", "start_at", "end_at", "duration_ms")


@query("pair_positional", f"SELECT o.run_id, o.step, n.raw FROM ({ORDERED}) o LEFT JOIN ({NUMBERED_OUT}) n ON o.run_id = n.run_id AND o.step = n.step")
def pair_positional(t):
    return L.pair_positional(L.task_order(t.sql(TASKS)), t.sql(TASK_OUT)).select("run_id", "step", "raw")


@query("norm_crew_log", f"""
SELECT o.run_id, o.step, coalesce(o.name, n.description, 'Task ' || o.step) AS name, 'agent' AS span_kind, n.description AS input, CASE WHEN o.error IS NOT NULL THEN 'ERROR: ' || o.error ELSE n.raw END AS output, o.start_at, coalesce(o.end_at, o.start_at) AS end_at, o.duration_ms
FROM ({ORDERED}) o LEFT JOIN ({NUMBERED_OUT}) n ON o.run_id = n.run_id AND o.step = n.step""")
def norm_crew_log(t):
    return L.norm_crew_log(t.sql(TASKS), t.sql(TASK_OUT), 100)


RUN_TIMES = "SELECT span_id AS run_id, span_id * 1000 AS start_ms, latency_ms FROM {spans} WHERE parent_span_id IS NULL"


@query("even_split", f"""
SELECT s.run_id, s.pos, round(latency_ms / n, 6) AS duration_ms, round(start_ms + (i - 1) * latency_ms / n, 6) AS start_ms, round(start_ms + i * latency_ms / n, 6) AS end_ms
FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY pos) AS i, count(*) OVER (PARTITION BY run_id) AS n FROM ({TASK_OUT})) s JOIN ({RUN_TIMES}) r ON s.run_id = r.run_id""")
def even_split(t):
    out = L.even_split(t.sql(TASK_OUT), t.sql(RUN_TIMES))
    return out.select("run_id", "pos", *[F.round(c, 6).alias(c) for c in ("duration_ms", "start_ms", "end_ms")])


CHUNK_TIMES = "SELECT trace_id AS call_id, started_at AS happened FROM {spans} WHERE parent_span_id IS NOT NULL AND trace_id % 3 <> 0"
CALL_STARTS = "SELECT span_id AS call_id, started_at FROM {spans} WHERE parent_span_id IS NULL"


@query("ttft", f"""
SELECT s.call_id, CAST(floor((epoch_us(f) - epoch_us(started_at)) / 1000) AS BIGINT) AS ttft_ms, e AS end_at FROM ({CALL_STARTS}) s LEFT JOIN (SELECT call_id, min(happened) AS f, max(happened) AS e FROM ({CHUNK_TIMES}) GROUP BY call_id) c ON s.call_id = c.call_id""")
def ttft(t):
    return L.ttft(t.sql(CHUNK_TIMES).withColumnRenamed("happened", "at"), t.sql(CALL_STARTS))


CHUNK_LOG = """
SELECT call_id, seq, CASE WHEN seq % 3 = 2 THEN 1 ELSE 0 END AS choice, CASE WHEN call_id % 4 <> 1 THEN delta ELSE '' END AS delta, CASE WHEN seq % 2 = 1 THEN seq % 4 END AS tool_index,
  CASE WHEN seq < 4 AND seq % 4 <> 3 THEN concat('fn', CAST(seq AS STRING)) END AS tool_name, concat('a', CAST(seq AS STRING)) AS tool_args, CASE WHEN seq > 0 THEN concat('m', CAST(seq AS STRING)) END AS model,
  CAST(NULL AS BIGINT) AS input_tokens, usage_output AS output_tokens, usage_output IS NOT NULL AS has_usage, CASE WHEN call_id % 5 = 0 AND seq = 1 THEN 'cut' END AS error FROM {chunks}"""


ASSEMBLED = f"""
WITH l AS ({CHUNK_LOG}),
x AS (SELECT call_id, string_agg(c, chr(10) ORDER BY choice) AS txt FROM (SELECT call_id, choice, string_agg(delta, '' ORDER BY seq) AS c FROM l WHERE delta <> '' GROUP BY call_id, choice) GROUP BY call_id),
y AS (SELECT call_id, '[tool call] ' || string_agg(coalesce(nm, 'unknown') || '(' || a || ')', ', ' ORDER BY tool_index) AS tl FROM (SELECT call_id, tool_index, arg_max(tool_name, seq) FILTER (tool_name IS NOT NULL) AS nm, string_agg(tool_args, '' ORDER BY seq) AS a FROM l WHERE tool_index IS NOT NULL GROUP BY call_id, tool_index) GROUP BY call_id),
f AS (SELECT call_id, arg_min(model, seq) FILTER (model IS NOT NULL) AS model, NULL::BIGINT AS input_tokens, arg_max(output_tokens, seq) FILTER (has_usage) AS output_tokens, max(error) AS error FROM l GROUP BY call_id)
SELECT f.call_id, coalesce(x.txt, y.tl) AS output, f.model, f.input_tokens, f.output_tokens, f.error FROM f LEFT JOIN x ON f.call_id = x.call_id LEFT JOIN y ON f.call_id = y.call_id"""


@query("assemble_chunks", ASSEMBLED)
def assemble_chunks(t):
    log = t.sql(CHUNK_LOG).withColumn("output_tokens", F.col("output_tokens").cast("long"))
    return L.assemble_chunks(log, slice_size=2)


@query("ttl_sweep", f"""
SELECT span_id AS run_id FROM {{spans}} WHERE started_at < TIMESTAMP '{NOW}' - INTERVAL 3600 SECOND AND span_kind = 'tool' AND span_id NOT IN (SELECT parent_span_id FROM {{spans}} WHERE parent_span_id IS NOT NULL)""")
def ttl_sweep(t):
    starts = t.spans.where("span_kind = 'tool'").select(F.col("span_id").alias("run_id"), "started_at")
    ends = t.spans.select(F.col("parent_span_id").alias("run_id"))
    return L.ttl_sweep(starts, ends, NOW).select("run_id")


# -- alerts ------------------------------------------------------------------------------------

TICKS = f"""
SELECT f.agent AS subject, make_timestamp(t * 3600000000) AS tick, count(*) AS runs, round(count(*) FILTER (failed) / count(*), 6) AS value
FROM ({FACTS_SQL}) f, LATERAL (SELECT unnest(range(CAST(floor(epoch(f.started_at) / 3600) AS BIGINT) + 1, CAST(floor(epoch(f.started_at) / 3600) AS BIGINT) + 7)) AS t) GROUP BY f.agent, t"""


@query("sliding_kpi", TICKS)
def sliding_kpi(t):
    return L.sliding_kpi(facts(t), 360, 60)


ISLANDS = f"""
WITH b AS (SELECT *, coalesce(last_value(CASE WHEN runs >= 2 THEN value > 0.4 END IGNORE NULLS) OVER (PARTITION BY subject ORDER BY tick ROWS UNBOUNDED PRECEDING), false) AS st FROM ({TICKS})),
c AS (SELECT *, sum(CASE WHEN st AND NOT coalesce(was, false) THEN 1 ELSE 0 END) OVER (PARTITION BY subject ORDER BY tick ROWS UNBOUNDED PRECEDING) AS incident FROM (SELECT *, lag(st) OVER (PARTITION BY subject ORDER BY tick) AS was FROM b)),
i AS (SELECT subject, CAST(incident AS BIGINT) AS incident, min(tick) FILTER (st) AS started_at, max(tick) FILTER (st) AS last_firing_at, count(*) FILTER (st) AS firing_ticks, min(tick) FILTER (NOT st) AS resolved_at FROM c WHERE incident > 0 GROUP BY subject, incident),
e AS (SELECT subject, incident, CASE WHEN k = 0 THEN 'triggered' ELSE 'repeat' END AS kind, min(tick) AS due FROM (SELECT c.subject, i.incident, c.tick, CAST(epoch(c.tick) - epoch(i.started_at) AS BIGINT) // 7200 AS k
    FROM c JOIN i ON c.subject = i.subject AND c.incident = i.incident WHERE st) GROUP BY subject, incident, k UNION ALL SELECT subject, incident, 'resolved', resolved_at FROM i WHERE resolved_at IS NOT NULL)"""


def states(t):
    enough = F.when(F.col("runs") >= 2, F.col("value"))
    return L.alert_states(L.sliding_kpi(facts(t), 360, 60).withColumn("value", enough), "gt", 0.4)


@query("breach_islands", f"{ISLANDS} SELECT * FROM i")
def breach_islands(t):
    return L.breach_islands(states(t))


@query("alert_events", f"""{ISLANDS} SELECT subject, incident, kind, due AS "at" FROM e""")
def alert_events(t):
    return L.alert_events(states(t), 120)


@query("alert_events_newest", f"""{ISLANDS} SELECT subject, kind, due AS "at" FROM e ORDER BY due DESC, concat(subject, kind) DESC LIMIT 50""")
def alert_events_newest(t):
    from spanquarry.operators.rankings import newest_first

    events = L.alert_events(states(t), 120).withColumn("k", F.concat("subject", "kind"))
    return newest_first(events, "at", "k", 50).select("subject", "kind", "at")
