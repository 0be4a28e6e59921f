"""Span tree queries."""

from pyspark.sql import functions as F

from catalog.base import query, view
from spanquarry.functions.normalize import is_noise_chain
from spanquarry.operators import trees

# Spans with chain names: some of them plumbing, and a few parents that are not in the trace.
view("chains", """
SELECT span_id, trace_id, CASE WHEN span_id % 31 = 5 THEN -span_id ELSE parent_span_id END AS parent_span_id,
       CASE WHEN span_id % 5 = 1 THEN 'RunnableSequence' WHEN span_id % 5 = 2 THEN 'ChannelWrite<x>' ELSE 'planner' END AS name
FROM {spans}
""")

view("session_spans", """
SELECT span_id, trace_id, parent_span_id, CASE WHEN parent_span_id IS NULL AND span_id % 3 <> 0 THEN concat('s', CAST(user_id AS STRING))
       WHEN span_id % 13 = 6 THEN 'own' END AS session_id
FROM {spans}
""")


@query("root_of", """
WITH RECURSIVE up AS (SELECT span_id, span_id AS root_id, CAST(0 AS BIGINT) AS depth FROM {chains} WHERE parent_span_id IS NULL
  UNION ALL SELECT c.span_id, up.root_id, up.depth + 1 FROM {chains} c JOIN up ON c.parent_span_id = up.span_id)
SELECT c.span_id, up.root_id, up.depth FROM {chains} c LEFT JOIN up ON c.span_id = up.span_id""")
def root_of(t):
    return trees.root_of(t.chains)


NOISE = "(name IN ('RunnableSequence') OR starts_with(name, 'ChannelWrite'))"


@query("nearest_kept_ancestor", f"""
WITH RECURSIVE walk AS (SELECT span_id, trace_id, parent_span_id AS cur, CAST(NULL AS BIGINT) AS found FROM {{chains}} WHERE parent_span_id IS NOT NULL
  UNION ALL SELECT w.span_id, w.trace_id, CASE WHEN {NOISE} THEN c.parent_span_id END, CASE WHEN NOT {NOISE} THEN c.span_id END
  FROM walk w JOIN {{chains}} c ON w.cur = c.span_id),
f AS (SELECT span_id, max(found) AS found FROM walk GROUP BY span_id)
SELECT c.span_id, CASE WHEN c.parent_span_id IS NOT NULL THEN coalesce(f.found, c.trace_id) END AS parent_span_id
FROM {{chains}} c LEFT JOIN f ON c.span_id = f.span_id WHERE NOT {NOISE}""")
def nearest_kept_ancestor(t):
    return trees.nearest_kept_ancestor(t.chains, is_noise_chain(F.col("name")))


@query("parent_child", """
SELECT a.span_id, a.trace_id, CASE WHEN a.parent_span_id IS NOT NULL THEN coalesce(b.span_id, a.trace_id) END AS parent_span_id
FROM {chains} a LEFT JOIN {chains} b ON a.parent_span_id = b.span_id AND a.trace_id = b.trace_id""")
def parent_child(t):
    return trees.parent_child(t.chains)


@query("inherit_session", """
SELECT a.span_id, a.trace_id, a.parent_span_id, coalesce(a.session_id, r.session_id) AS session_id
FROM {session_spans} a LEFT JOIN {session_spans} r ON a.trace_id = r.span_id""")
def inherit_session(t):
    return trees.inherit_session(t.session_spans)


@query("session_id_derive", """
SELECT a.span_id, coalesce(a.session_id, r.session_id, concat('auto_', CAST(a.trace_id AS STRING))) AS session_id
FROM {session_spans} a LEFT JOIN {session_spans} r ON a.trace_id = r.span_id""")
def session_id_derive(t):
    return trees.session_id_derive(t.session_spans).select("span_id", "session_id")


@query("span_offset", """
SELECT a.span_id, a.trace_id, coalesce(CAST(floor((epoch_us(CASE WHEN a.span_id % 29 <> 3 THEN a.started_at END) - epoch_us(r.started_at)) / 1000) AS BIGINT), 0) AS offset_ms
FROM {spans} a LEFT JOIN {spans} r ON a.trace_id = r.span_id AND r.span_id % 29 <> 3""")
def span_offset(t):
    known = F.when(F.col("span_id") % 29 != 3, F.col("started_at"))
    return trees.span_offset(t.spans.withColumn("started_at", known))


@query("eval_stamp", """
SELECT s.span_id, s.trace_id, CASE WHEN r.trace_id IS NOT NULL THEN 'eval-run' ELSE s.source END AS source,
  CASE WHEN r.trace_id IS NOT NULL THEN coalesce(CASE WHEN s.span_id % 6 = 1 THEN true END, false) ELSE CASE WHEN s.span_id % 6 = 1 THEN true END END AS monitor,
  r.run_id AS eval_run_id
FROM {spans} s LEFT JOIN (SELECT doc_id AS trace_id, concat('run-', CAST(doc_id % 4 AS STRING)) AS run_id FROM {labels} WHERE doc_id % 8 = 0) r ON s.trace_id = r.trace_id""")
def eval_stamp(t):
    made = t.labels.where("doc_id % 8 = 0").select(
        F.col("doc_id").alias("trace_id"), F.concat(F.lit("run-"), (F.col("doc_id") % 4).cast("string")).alias("run_id")
    )
    return trees.eval_stamp(t.spans.withColumn("monitor", F.when(F.col("span_id") % 6 == 1, True)), made)


@query("root_token_sum", """
SELECT trace_id, CAST(sum(nullif(input_tokens, 0)) AS BIGINT) AS input_tokens, CAST(sum(nullif(output_tokens, 0)) AS BIGINT) AS output_tokens
FROM {spans} WHERE parent_span_id IS NOT NULL GROUP BY trace_id""")
def root_token_sum(t):
    return trees.root_token_sum(t.spans)


@query("tool_call_mirror", """
SELECT trace_id, span_id, started_at, latency_ms, error IS NULL AS success,
  row_number() OVER (PARTITION BY trace_id ORDER BY started_at, span_id) AS pos
FROM {spans} WHERE span_kind = 'tool' AND parent_span_id IS NOT NULL""")
def tool_call_mirror(t):
    return trees.tool_call_mirror(t.spans)


@query("tool_call_nested", """
SELECT trace_id, CAST(floor((pos - 1) / 2) AS BIGINT) AS block, count(*) AS n_calls, string_agg(CAST(span_id AS STRING), ',' ORDER BY pos) AS calls FROM (
  SELECT *, row_number() OVER (PARTITION BY trace_id ORDER BY started_at, span_id) AS pos FROM {spans} WHERE span_kind = 'tool' AND parent_span_id IS NOT NULL)
GROUP BY trace_id, floor((pos - 1) / 2)""")
def tool_call_nested(t):
    nested = trees.nest_calls(trees.tool_call_mirror(t.spans), "trace_id", 2)
    ids = F.array_join(F.transform("tool_calls", lambda c: c["span_id"].cast("string")), ",")
    return nested.select("trace_id", "block", "n_calls", ids.alias("calls"))


@query("root_summary", """
SELECT trace_id, arg_min(i, k) FILTER (i IS NOT NULL) AS input, arg_max(o, k) FILTER (o IS NOT NULL) AS output,
  arg_min(model, k) FILTER (model IS NOT NULL) AS model, arg_min(error, k) FILTER (error IS NOT NULL) AS error
FROM (SELECT *, struct_pack(a := started_at, b := span_id) AS k, CASE WHEN span_kind = 'llm' THEN concat('in', CAST(span_id AS STRING)) END AS i,
  CASE WHEN span_kind = 'llm' THEN concat('out', CAST(span_id AS STRING)) END AS o FROM {spans}) GROUP BY trace_id""")
def root_summary(t):
    llm = F.col("span_kind") == "llm"
    sid = F.col("span_id").cast("string")
    with_text = t.spans.withColumn("input", F.when(llm, F.concat(F.lit("in"), sid))).withColumn(
        "output", F.when(llm, F.concat(F.lit("out"), sid))
    )
    return trees.root_summary(with_text)


PENDING = "span_id % 8 = 5 AND span_kind IN ('tool', 'retrieval')"


@query("attach_pending", f"""
WITH p AS (SELECT span_id, agent, started_at FROM {{spans}} WHERE {PENDING}),
r AS (SELECT span_id, agent, started_at + latency_ms * INTERVAL 1 MILLISECOND AS sent FROM {{spans}} WHERE parent_span_id IS NULL)
SELECT p.span_id AS record_id, r.span_id AS root_id FROM p ASOF LEFT JOIN
  (SELECT agent, sent, min(span_id) AS span_id FROM r GROUP BY agent, sent) r ON p.agent = r.agent AND p.started_at <= r.sent""")
def attach_pending(t):
    pending = t.spans.where("span_id % 8 = 5").select(
        F.col("span_id").alias("record_id"), F.col("agent").alias("scope"), F.col("span_kind").alias("kind"), F.col("started_at").alias("at")
    )
    sent = F.timestamp_micros(F.unix_micros("started_at") + F.col("latency_ms") * 1000)
    ends = trees.roots(t.spans).select(F.col("span_id").alias("root_id"), F.col("agent").alias("scope"), sent.alias("at"))
    return trees.attach_pending(pending, ends)


@query("pre_run_retrievals", """
WITH p AS (SELECT span_id, agent, started_at FROM {spans} WHERE span_id % 8 = 3 AND span_kind = 'retrieval'),
r AS (SELECT agent, started_at, min(span_id) AS span_id FROM {spans} WHERE parent_span_id IS NULL GROUP BY agent, started_at)
SELECT p.span_id AS record_id, r.span_id AS root_id FROM p ASOF LEFT JOIN r ON p.agent = r.agent AND p.started_at <= r.started_at""")
def pre_run_retrievals(t):
    """Retrievals before a chain start join the next top-level chain of their scope."""
    pending = t.spans.where("span_id % 8 = 3 AND span_kind = 'retrieval'").select(
        F.col("span_id").alias("record_id"), F.col("agent").alias("scope"), F.col("span_kind").alias("kind"), F.col("started_at").alias("at")
    )
    starts = trees.roots(t.spans).select(F.col("span_id").alias("root_id"), F.col("agent").alias("scope"), F.col("started_at").alias("at"))
    return trees.attach_pending(pending, starts)


def numbered(keys):
    return f"""
SELECT span_id, trace_id, concat(CASE WHEN span_kind = 'llm' THEN 'LLM Call ' ELSE 'Retrieval ' END,
  CAST(row_number() OVER (PARTITION BY {keys} ORDER BY started_at, span_id) AS STRING)) AS name
FROM {{spans}} WHERE span_kind IN ('llm', 'retrieval') AND span_id % 7 <> 2"""


@query("auto_number", numbered("trace_id"))
def auto_number(t):
    return trees.auto_number(t.spans.withColumn("name", F.when(F.col("span_id") % 7 == 2, "named")))


@query("auto_number_by_kind", numbered("trace_id, span_kind"))
def auto_number_by_kind(t):
    return trees.auto_number(t.spans.withColumn("name", F.when(F.col("span_id") % 7 == 2, "named")), shared_counter=False)


@query("trace_tree", "SELECT span_id, trace_id, started_at FROM {spans} WHERE user_id = 7")
def trace_tree(t):
    return t.spans.where("user_id = 7").select("span_id", "trace_id", "started_at").orderBy("started_at", "span_id")


@query("root_first", "SELECT span_id, parent_span_id IS NOT NULL AS is_child FROM {spans}")
def root_first(t):
    child = F.col("parent_span_id").isNotNull()
    return t.spans.select("span_id", child.alias("is_child")).orderBy("is_child", "span_id")
