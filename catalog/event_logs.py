"""Framework event logs and model calls."""

from pyspark.sql import functions as F

from catalog.base import query, view
from spanquarry.operators import event_logs as E

# Callback runs: chains, model calls, tools and retrievals; some chains are plumbing, some parents are lost, some never end.
view("runs_log", """
SELECT c.span_id AS run_id, CASE WHEN c.parent_span_id > 0 OR c.parent_span_id = c.trace_id THEN c.parent_span_id WHEN c.parent_span_id IS NOT NULL THEN -1 END AS parent_id,
       CASE WHEN s.parent_span_id IS NULL OR s.span_kind = 'memory' OR c.span_id % 8 < 4 THEN 'chain' ELSE s.span_kind END AS kind,
       CASE WHEN c.span_id % 3 <> 0 OR s.parent_span_id IS NULL THEN c.name END AS name, s.started_at AS start_at, CASE WHEN c.span_id % 11 <> 5 THEN s.started_at + s.latency_ms * INTERVAL 1 MILLISECOND END AS end_at,
       s.model, CASE WHEN c.span_id % 11 <> 5 THEN s.input_tokens END AS input_tokens, CASE WHEN c.span_id % 11 <> 5 THEN s.output_tokens END AS output_tokens, CASE WHEN c.span_id % 11 <> 5 THEN s.error END AS error
FROM {chains} c JOIN {spans} s ON c.span_id = s.span_id
""")


def events(t, runs, docs=False):
    start = runs.select(
        "run_id", "parent_id", "kind", F.lit("start").alias("event"), F.col("start_at").alias("at"), "name",
        F.concat(F.lit("in "), F.col("run_id").cast("string")).alias("payload"), "model", F.lit(None).cast("long").alias("input_tokens"),
        F.lit(None).cast("long").alias("output_tokens"), F.lit(None).cast("string").alias("error"),
    )
    none = F.lit(None)
    failed = F.col("error").isNotNull()
    end = runs.select(
        "run_id", none.cast("bigint").alias("parent_id"), none.cast("string").alias("kind"), F.when(failed, "error").otherwise("end").alias("event"),
        F.col("end_at").alias("at"), none.cast("string").alias("name"), F.when(~failed, F.concat(F.lit("out "), F.col("run_id").cast("string"))).alias("payload"),
        none.cast("string").alias("model"), "input_tokens", "output_tokens", "error",
    )
    if docs:
        # none to three texts, the second one empty; every fifth retrieval says nothing of its documents
        text = lambda i: F.when(i == 2, "").otherwise(F.concat(F.lit("doc "), F.col("run_id").cast("string"), F.lit("-"), i.cast("string")))
        some = F.transform(F.sequence(F.lit(1), F.lit(3)), text)
        given = (F.col("event") == "end") & (F.col("k") == "retrieval") & (F.col("run_id") % 5 != 0)
        end = end.join(runs.select(F.col("run_id").alias("r"), F.col("kind").alias("k")), F.col("run_id") == F.col("r"))
        end = end.withColumn("docs", F.when(given, F.slice(some, F.lit(1), (F.col("run_id") % 4).cast("int")))).drop("r", "k")
        start = start.withColumn("docs", F.lit(None).cast("array<string>"))
    return start.unionByName(end.where("at IS NOT NULL"))


NOISE = "(coalesce(name, '') = 'RunnableSequence' OR starts_with(coalesce(name, ''), 'ChannelWrite'))"
TREE = f"""
WITH RECURSIVE r AS (SELECT *, kind = 'chain' AND (parent_id IS NULL OR NOT {NOISE}) AS kept FROM {{runs_log}}),
w AS (SELECT r.*, CASE WHEN kind = 'chain' AND parent_id IS NULL THEN run_id END AS root_id, CAST(NULL AS BIGINT) AS kept_parent FROM r WHERE parent_id IS NULL
  UNION ALL SELECT r.*, w.root_id, CASE WHEN w.kept THEN w.run_id ELSE w.kept_parent END FROM r JOIN w ON r.parent_id = w.run_id)
SELECT run_id, root_id, CASE WHEN parent_id IS NOT NULL THEN coalesce(kept_parent, root_id) END AS parent_span_id, CASE WHEN parent_id IS NULL THEN 'agent' ELSE kind END AS span_kind,
  CASE WHEN name IS NOT NULL OR kind = 'chain' THEN name WHEN kind = 'tool' THEN 'Tool call' ELSE CASE kind WHEN 'llm' THEN 'LLM Call ' ELSE 'Retrieval ' END || n END AS name, error, model, latency_ms,
  'in ' || run_id AS input, CASE WHEN docs IS NOT NULL THEN CASE docs WHEN 0 THEN NULL WHEN 3 THEN 'doc ' || run_id || '-1' || chr(10) || chr(10) || '---' || chr(10) || chr(10) || 'doc ' || run_id || '-3' ELSE 'doc ' || run_id || '-1' END
    WHEN error IS NULL AND end_at IS NOT NULL THEN 'out ' || run_id END AS output, input_tokens, output_tokens, docs AS doc_count, end_at
FROM (SELECT *, CASE WHEN kind = 'retrieval' AND error IS NULL AND end_at IS NOT NULL AND run_id % 5 <> 0 THEN run_id % 4 END AS docs, row_number() OVER (PARTITION BY root_id, kind ORDER BY end_at, run_id) AS n, CAST(floor((epoch_us(coalesce(end_at, start_at)) - epoch_us(start_at)) / 1000) AS BIGINT) AS latency_ms FROM w WHERE root_id IS NOT NULL AND CASE WHEN kind = 'chain' THEN kept ELSE end_at IS NOT NULL END)"""


@query("norm_chain_log", f"SELECT * EXCLUDE (end_at) FROM ({TREE})")
def norm_chain_log(t):
    return E.norm_chain_log(events(t, t.runs_log, docs=True)).drop("start_at", "end_at")


@query("chain_tool_calls", f"""
SELECT root_id, run_id, name, input, coalesce(error, output) AS output, error IS NULL AS success, latency_ms, row_number() OVER (PARTITION BY root_id ORDER BY end_at, run_id) AS pos
FROM ({TREE}) WHERE span_kind = 'tool'""")
def chain_tool_calls(t):
    return E.chain_tool_calls(E.norm_chain_log(events(t, t.runs_log))).drop("end_at")


view("query_log", """
SELECT span_id AS run_id, parent_span_id AS parent_id, CASE WHEN parent_span_id IS NULL AND span_id % 24 = 0 THEN 'synthesize' WHEN parent_span_id IS NULL THEN 'query'
         WHEN span_kind = 'tool' THEN 'function' WHEN span_kind = 'memory' THEN 'chunking' ELSE span_kind END AS kind,
       CASE WHEN span_kind = 'tool' AND span_id % 3 <> 0 THEN 'search' END AS name, started_at AS start_at, CASE WHEN span_id % 9 <> 4 THEN started_at + latency_ms * INTERVAL 1 MILLISECOND END AS end_at, model,
       CASE WHEN span_id % 9 <> 4 THEN input_tokens END AS input_tokens, CASE WHEN span_id % 9 <> 4 THEN output_tokens END AS output_tokens, CASE WHEN span_id % 9 <> 4 THEN error END AS error
FROM {spans}
""")

QUERY_TREE = """
WITH RECURSIVE w AS (SELECT q.*, CASE WHEN kind IN ('query', 'llm', 'retrieval') THEN run_id END AS root_id FROM {query_log} q WHERE parent_id IS NULL
  UNION ALL SELECT q.*, coalesce(w.root_id, CASE WHEN q.kind IN ('query', 'llm', 'retrieval') THEN q.run_id END) FROM {query_log} q JOIN w ON q.parent_id = w.run_id),
k AS (SELECT *, row_number() OVER (PARTITION BY root_id, kind ORDER BY end_at NULLS LAST, CAST(run_id AS STRING)) AS n FROM w WHERE root_id IS NOT NULL)
SELECT CASE WHEN run_id = root_id THEN concat(CAST(run_id AS STRING), ':step') ELSE CAST(run_id AS STRING) END AS run_id, CAST(root_id AS STRING) AS parent_span_id, CASE kind WHEN 'function' THEN 'tool' ELSE kind END AS span_kind,
  CASE WHEN kind = 'llm' THEN 'LLM Call ' || n WHEN kind = 'retrieval' THEN 'Retrieval ' || n ELSE coalesce(name, 'unknown') END AS name, CASE WHEN error IS NOT NULL THEN 'ERROR: ' || error ELSE 'out ' || run_id END AS output,
  input_tokens::BIGINT AS input_tokens FROM k WHERE end_at IS NOT NULL AND kind IN ('llm', 'retrieval', 'function')
UNION ALL SELECT CAST(root_id AS STRING), NULL, 'agent', 'query', arg_max(CASE WHEN error IS NULL THEN 'out ' || run_id END, struct_pack(a := end_at, b := CAST(run_id AS STRING))) FILTER (kind IN ('query', 'llm') AND error IS NULL AND end_at IS NOT NULL),
  nullif(CAST(sum(input_tokens) FILTER (kind = 'llm') AS BIGINT), 0) FROM k GROUP BY root_id"""


@query("norm_query_log", QUERY_TREE)
def norm_query_log(t):
    log = events(t, t.query_log)
    named = log.withColumn("run_id", F.col("run_id").cast("string")).withColumn("parent_id", F.col("parent_id").cast("string"))
    return E.norm_query_log(named).select("run_id", "parent_span_id", "span_kind", "name", "output", "input_tokens")


view("agent_log", """
SELECT trace_id, span_id, CASE WHEN span_kind = 'tool' THEN 'function' WHEN span_kind = 'llm' THEN 'generation' WHEN span_kind = 'retrieval' THEN 'response' ELSE 'handoff' END AS kind,
       concat('f', CAST(span_id % 4 AS STRING)) AS name, CASE WHEN span_id % 3 <> 0 THEN concat('in ', CAST(span_id AS STRING)) END AS input, CASE WHEN span_id % 4 <> 0 THEN concat('out ', CAST(span_id AS STRING)) END AS output,
       model, input_tokens, output_tokens, error AS error_message, CASE WHEN span_id % 2 = 0 THEN 'data' END AS error_data, started_at AS start_at, started_at + latency_ms * INTERVAL 1 MILLISECOND AS end_at
FROM {spans}
""")


@query("norm_agents_log", """
WITH r AS (SELECT *, kind IN ('generation', 'response') AS c, struct_pack(a := end_at, b := span_id) AS k, error_message || CASE WHEN error_data <> '' THEN ' (' || error_data || ')' ELSE '' END AS err FROM {agent_log})
SELECT trace_id, 'root' AS span_id, 'agent' AS span_kind, 'agent' AS name, arg_min(input, k) FILTER (c AND input <> '') AS input, arg_max(output, k) FILTER (c AND output <> '') AS output, arg_min(model, k) FILTER (c AND model <> '') AS model, arg_min(err, k) FILTER (err IS NOT NULL) AS error,
  CAST(coalesce(sum(input_tokens) FILTER (c), 0) AS BIGINT) AS input_tokens, CAST(coalesce(sum(output_tokens) FILTER (c), 0) AS BIGINT) AS output_tokens, min(start_at) AS start_at, CAST(floor((epoch_us(max(end_at)) - epoch_us(min(start_at))) / 1000) AS BIGINT) AS latency_ms FROM r GROUP BY trace_id
UNION ALL SELECT trace_id, CAST(span_id AS STRING), 'llm', 'LLM Call ' || row_number() OVER (PARTITION BY trace_id ORDER BY end_at, span_id), input, output, model, NULL, input_tokens, output_tokens, start_at, CAST(floor((epoch_us(end_at) - epoch_us(start_at)) / 1000) AS BIGINT) FROM r WHERE c
UNION ALL SELECT trace_id, CAST(span_id AS STRING), 'tool', name, input, output, NULL, err, NULL, NULL, start_at, CAST(floor((epoch_us(end_at) - epoch_us(start_at)) / 1000) AS BIGINT) FROM r WHERE kind = 'function'""")
def norm_agents_log(t):
    return E.norm_agents_log(t.agent_log)


CALLS = "SELECT concat('mw:', CAST(span_id AS STRING)) AS call_id, agent AS scope, started_at AS happened FROM {spans} WHERE span_kind = 'llm'"
SCOPES = "SELECT concat('dbx:', CAST(span_id AS STRING)) AS span_id, agent AS scope, started_at AS start_at, CASE WHEN span_id % 5 = 0 THEN started_at + latency_ms * 40 * INTERVAL 1 SECOND ELSE started_at + latency_ms * 40 * INTERVAL 1 MILLISECOND END AS end_at FROM {spans} WHERE span_kind = 'agent'"


@query("norm_call_log", f"""
SELECT call_id, parent_span_id, parent_span_id IS NULL AS is_root FROM (SELECT c.call_id, arg_max(s.span_id, struct_pack(a := s.start_at, b := s.span_id)) AS parent_span_id
  FROM ({CALLS}) c LEFT JOIN ({SCOPES}) s ON c.scope = s.scope AND s.start_at <= c.happened AND c.happened < s.end_at GROUP BY c.call_id)""")
def norm_call_log(t):
    calls = t.sql(CALLS).withColumnRenamed("happened", "at")
    return E.norm_call_log(calls, t.sql(SCOPES)).select("call_id", "parent_span_id", "is_root")
