"""Normalising column expressions, on JSON and text derived from the event and document tables."""

from pyspark.sql import functions as F

from catalog.base import query, view
from catalog.views import NOW
from spanquarry.functions import messages as MS
from spanquarry.functions import normalize as N
from spanquarry.functions import times as T
from spanquarry.functions.python_scoring import payload_bound
from spanquarry.functions.sampling import sampled

# What agents returned, as JSON text: strings, objects of several shapes, numbers, nulls.
view("raw_outputs", """
SELECT event_id, user_id, CASE event_id % 10
  WHEN 0 THEN concat('"plain ', CAST(event_id AS STRING), '"')
  WHEN 1 THEN concat('{{"output": "answer ', CAST(event_id AS STRING), '", "input_tokens": ', CAST(user_id AS STRING), '}}')
  WHEN 2 THEN concat('{{"output": "", "text": "alt ', event_type, '", "metadata": {{"prompt_tokens": ', CAST(user_id AS STRING), ', "completion_tokens": "', CAST(event_id AS STRING), '"}}}}')
  WHEN 3 THEN '{{"response": "resp", "error": {{"type": "Timeout", "message": "slow"}}}}'
  WHEN 4 THEN '{{"output": {{"text": "obj", "extra": 1}}}}'
  WHEN 5 THEN concat('{{"error": "failed ', event_type, '"}}')
  WHEN 6 THEN CAST(event_id AS STRING)
  WHEN 7 THEN 'null'
  WHEN 8 THEN '{{"output": {{"text": "  "}}, "output_tokens": "bad", "metadata": {{"output_tokens": 0, "completion_tokens": 12}}}}'
  ELSE '{{"output": false, "text": [], "response": 7, "error": {{}}}}' END AS raw
FROM {events}
""")


@query("normalize_result", """
SELECT event_id, CASE k WHEN 0 THEN 'plain ' || event_id WHEN 1 THEN 'answer ' || event_id WHEN 2 THEN json_extract_string(raw, '$.text')
    WHEN 3 THEN 'resp' WHEN 4 THEN 'obj' WHEN 5 THEN '' WHEN 6 THEN CAST(event_id AS VARCHAR) WHEN 7 THEN '' WHEN 8 THEN '  ' ELSE '7' END AS text,
  k = 4 AS extra_keys,
  CASE WHEN k = 3 THEN 'Timeout' WHEN k = 5 THEN 'Exception' WHEN k IN (7, 8) THEN 'EmptyOutput' END AS error_type,
  CASE WHEN k = 3 THEN 'slow' WHEN k = 5 THEN json_extract_string(raw, '$.error') WHEN k IN (7, 8) THEN 'Agent returned no output' END AS error_message,
  CASE WHEN k = 1 THEN user_id WHEN k = 2 THEN nullif(user_id, 0) END AS input_tokens,
  CASE WHEN k = 2 THEN event_id WHEN k = 8 THEN 12 END AS output_tokens
FROM (SELECT *, event_id % 10 AS k FROM {raw_outputs})""")
def normalize_result(t):
    return N.normalize_result(t.raw_outputs).select("event_id", "r.*")


@query("empty_output_fail", """
SELECT event_id FROM {raw_outputs} WHERE event_id % 10 IN (7, 8)""")
def empty_output_fail(t):
    r = N.normalize_result(t.raw_outputs).select("event_id", "r")
    keys = F.when(F.col("r.extra_keys"), F.array(F.lit("text"), F.lit("other"))).otherwise(F.array(F.lit("text")))
    given = F.when(F.col("r.error_type") != "EmptyOutput", F.col("r.error_type"))
    return r.where(N.empty_output_fail(F.col("r.text"), given, keys)).select("event_id")


@query("normalize_error", """
SELECT event_id, '' AS text, 'ValueError' AS error_type, 'boom ' || event_id AS error_message, false AS retryable
FROM {events} WHERE event_type = 'error'""")
def normalize_error(t):
    message = F.concat(F.lit("boom "), F.col("event_id").cast("string"))
    failed = t.events.where("event_type = 'error'")
    return failed.select("event_id", N.normalize_error(F.lit("ValueError"), message).alias("r")).select("event_id", "r.*")


@query("error_coerce", """
SELECT event_id, CASE event_id % 10 WHEN 3 THEN 'Timeout' WHEN 5 THEN 'Exception' END AS type,
  CASE event_id % 10 WHEN 3 THEN 'slow' WHEN 5 THEN json_extract_string(raw, '$.error') END AS message FROM {raw_outputs}""")
def error_coerce(t):
    scalar = F.try_variant_get(F.try_parse_json("raw"), "$.error", "variant")
    return t.raw_outputs.select("event_id", N.error_coerce(F.to_json(scalar)).alias("e")).select("event_id", "e.type", "e.message")


@query("token_ladder", """
SELECT event_id, CASE WHEN event_id % 10 = 1 THEN user_id WHEN event_id % 10 = 2 THEN nullif(user_id, 0) END AS input_tokens,
  CASE WHEN event_id % 10 = 2 THEN event_id WHEN event_id % 10 = 8 THEN 12 END AS output_tokens FROM {raw_outputs}""")
def token_ladder(t):
    return N.normalize_result(t.raw_outputs).select("event_id", "r.input_tokens", "r.output_tokens")


@query("response_lift", """
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN event_type WHEN event_id % 10 = 4 THEN 'obj' WHEN event_id % 10 = 8 THEN '  ' END AS response
FROM (SELECT r.*, e.event_type FROM {raw_outputs} r JOIN {events} e USING (event_id))""")
def response_lift(t):
    own = F.when(F.col("event_id") % 3 == 0, F.col("event_type"))
    both = t.raw_outputs.join(t.events.select("event_id", "event_type"), "event_id")
    return both.select("event_id", N.response_lift(own, F.get_json_object("raw", "$.output")).alias("response"))


@query("stats_hoist", """
SELECT doc_id, CAST(coalesce(CASE WHEN doc_id % 2 = 0 THEN quality END, toxic) AS BIGINT) AS jaccard FROM {labels}""")
def stats_hoist(t):
    nested = F.when(F.col("doc_id") % 2 == 0, F.col("quality"))
    return t.labels.select("doc_id", N.hoist(nested, F.col("toxic")).cast("long").alias("jaccard"))


@query("trace_event_coerce", """
SELECT event_id, 'unknown' AS type, NULL::VARCHAR AS name, 'note ' || event_type AS summary, NULL::BIGINT AS latency_ms FROM {events}
UNION ALL SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'tool' ELSE 'unknown' END, event_type, NULL, event_id + 1 FROM {events}""")
def trace_event_coerce(t):
    kind = F.when(F.col("event_id") % 2 == 0, '"type": "tool", ').otherwise("")
    latency = F.when(F.col("event_id") % 3 == 0, '"latency_ms"').otherwise('"latency_ms": 0, "latencyMs"')
    item = F.concat(F.lit("{"), kind, F.lit('"name": "'), F.col("event_type"), F.lit('", '), latency, F.lit(": "), (F.col("event_id") + 1).cast("string"), F.lit("}"))
    listed = F.concat(F.lit('["note '), F.col("event_type"), F.lit('", null, '), item, F.lit("]"))
    payload = F.when(F.col("event_id") % 4 == 0, F.concat(F.lit('{"events": '), listed, F.lit("}"))).otherwise(listed)
    return t.events.select("event_id", F.explode(N.trace_event_coerce(payload)).alias("e")).select("event_id", "e.*")


@query("trace_budget_prefix", """
WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS pos FROM {documents}),
s AS (SELECT *, 2 + sum(strlen(line) + 1) OVER (PARTITION BY doc_id ORDER BY pos) AS used,
  14 + sum(strlen(line)) OVER (PARTITION BY doc_id) + 2 * (count(*) OVER (PARTITION BY doc_id) - 1) AS whole FROM lines)
SELECT doc_id, count(*) FILTER (whole <= 2000 OR used <= 2000) AS kept FROM s GROUP BY doc_id""")
def trace_budget_prefix(t):
    kept = N.trace_budget_prefix(F.split("text", "\n"), 2000)
    return t.documents.select("doc_id", F.size(kept).cast("long").alias("kept"))


@query("payload_bound", """
SELECT doc_id, text AS words_kept_text, array_to_string(string_split(text, ' ')[1:30], ' ') AS words, len(string_split(text, ' ')) > 30 AS truncated FROM {documents}""")
def payload_bound_query(t):
    payload = F.to_json(F.struct(F.col("text"), F.split("text", " ").alias("words")))
    out = t.documents.select("doc_id", payload_bound(payload, 3, 200, 30).alias("p"))
    kept = F.from_json("p.bounded", "text string, words array<string>")
    return out.select("doc_id", kept["text"].alias("words_kept_text"), F.array_join(kept["words"], " ").alias("words"), "p.truncated")


@query("split_semi", """
SELECT doc_id, CASE WHEN len(items) > 0 AND trim(raw) NOT IN ('', 'nan') THEN array_to_string(items, '|') END AS items FROM (
  SELECT doc_id, raw, list_filter(list_transform(string_split(raw, ';'), lambda x: trim(x)), lambda x: x <> '') AS items FROM (
    SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'nan' WHEN 1 THEN concat(lang, ' ; ;', source, ';') WHEN 2 THEN ' ; ' ELSE lang END AS raw FROM {documents}))""")
def split_semi(t):
    k = F.col("doc_id") % 4
    raw = F.when(k == 0, "nan").when(k == 1, F.concat("lang", F.lit(" ; ;"), "source", F.lit(";"))).when(k == 2, " ; ").otherwise(F.col("lang"))
    return t.documents.select("doc_id", F.array_join(N.split_semi(raw), "|").alias("items"))


@query("nullish_text", "SELECT doc_id, nullif(nullif(trim(CASE doc_id % 3 WHEN 0 THEN ' nan ' WHEN 1 THEN '  ' ELSE concat(' ', lang) END), ''), 'nan') AS value FROM {documents}")
def nullish_text(t):
    k = F.col("doc_id") % 3
    raw = F.when(k == 0, " nan ").when(k == 1, "  ").otherwise(F.concat(F.lit(" "), "lang"))
    return t.documents.select("doc_id", N.nullish_text(raw).alias("value"))


@query("first_field", "SELECT o_orderkey, coalesce(nullif(CASE WHEN o_orderstatus = 'F' THEN '' ELSE o_orderstatus END, ''), o_orderpriority) AS value FROM {orders}")
def first_field(t):
    df = t.orders.withColumn("status", F.when(F.col("o_orderstatus") == "F", "").otherwise(F.col("o_orderstatus")))
    return df.select("o_orderkey", N.first_field(df.columns, "state", "status", "o_orderpriority").alias("value"))


@query("parse_mixed_time", """
SELECT event_id, CASE event_id % 6 WHEN 0 THEN epoch_us(ts) // 1000 WHEN 1 THEN CAST(floor(epoch(ts)) AS BIGINT) * 1000 WHEN 2 THEN epoch_us(ts) // 1000
  WHEN 3 THEN CAST(floor(epoch(ts)) AS BIGINT) * 1000 - 7200000 ELSE NULL END AS ms FROM {events}""")
def parse_mixed_time(t):
    k, ts = F.col("event_id") % 6, F.col("ts")
    iso = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    value = (
        F.when(k == 0, F.unix_millis(ts).cast("string"))
        .when(k == 1, F.concat(F.lit('"'), iso, F.lit('Z"')))
        .when(k == 2, F.concat(F.lit('"'), F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit('"')))
        .when(k == 3, F.concat(F.lit('"'), iso, F.lit('+02:00"')))
        .when(k == 4, F.lit('"soon"'))
    )
    parsed = T.parse_mixed_time(value)
    return t.events.select("event_id", F.unix_millis(parsed).alias("ms"))


@query("parse_relative", f"""
SELECT event_id, CASE event_id % 4 WHEN 0 THEN epoch_ms(TIMESTAMP '{NOW}') - (event_id % 9) * 86400000 WHEN 1 THEN epoch_ms(TIMESTAMP '{NOW}') - (event_id % 9) * 3600000
  WHEN 2 THEN epoch_ms(TIMESTAMP '{NOW}') - (event_id % 9) * 60000 ELSE CAST(floor(epoch(ts)) AS BIGINT) * 1000 END AS ms FROM {{events}}""")
def parse_relative(t):
    k, n = F.col("event_id") % 4, (F.col("event_id") % 9).cast("string")
    text = F.when(k == 0, F.concat(n, F.lit("d"))).when(k == 1, F.concat(n, F.lit("H "))).when(k == 2, F.concat(n, F.lit("m"))).otherwise(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    )
    return t.events.select("event_id", F.unix_millis(T.parse_relative(text, F.lit(NOW).cast("timestamp"))).alias("ms"))


@query("latency_ms", """
SELECT event_id, CASE WHEN d >= 0 THEN CAST(floor(d / 1000) AS BIGINT) END AS not_before, CASE WHEN d > 0 THEN CAST(floor(d / 1000) AS BIGINT) END AS after_start,
  greatest(0, CAST(floor(d / 1000) AS BIGINT)) AS clamped
FROM (SELECT event_id, CAST(CASE WHEN event_id % 5 = 0 THEN 0 ELSE (event_id % 7 - 3) * 1234567 END AS BIGINT) AS d FROM {events})""")
def latency_ms(t):
    d = F.when(F.col("event_id") % 5 == 0, 0).otherwise((F.col("event_id") % 7 - 3) * 1234567)
    end = F.timestamp_micros(F.unix_micros("ts") + d)
    start = F.col("ts")
    return t.events.select(
        "event_id",
        T.latency_ms(start, end).alias("not_before"),
        T.latency_ms(start, end, "after").alias("after_start"),
        T.latency_ms(start, end, "clamp").alias("clamped"),
    )


@query("stable_span_id", """
SELECT span_id, CASE WHEN parent_span_id IS NULL THEN concat('dbx:', CAST(trace_id AS STRING)) ELSE concat('dbx:', CAST(trace_id AS STRING), ':', CAST(span_id AS STRING)) END AS wire_id,
  CASE WHEN parent_span_id IS NULL THEN NULL WHEN parent_span_id = trace_id THEN concat('dbx:', CAST(trace_id AS STRING)) ELSE concat('dbx:', CAST(trace_id AS STRING), ':', CAST(parent_span_id AS STRING)) END AS wire_parent
FROM {spans}""")
def stable_span_id(t):
    from spanquarry.sources.trace_docs import wire_span_id

    trace, span, parent = (F.col(c).cast("string") for c in ("trace_id", "span_id", "parent_span_id"))
    return t.spans.select(
        "span_id",
        wire_span_id(trace, span, F.col("parent_span_id").isNull()).alias("wire_id"),
        F.when(parent.isNotNull(), wire_span_id(trace, parent, parent == trace)).alias("wire_parent"),
    )


@query("agent_name_derive", "SELECT interaction_id, CASE WHEN domain <> '' THEN concat('moveworks-', domain) ELSE 'moveworks-assistant' END AS name FROM {interactions}")
def agent_name_derive(t):
    from spanquarry.sources.conversations import DEFAULT_NAME, NAME_PREFIX

    return t.interactions.select("interaction_id", N.agent_name(None, F.col("domain"), NAME_PREFIX, DEFAULT_NAME).alias("name"))


@query("idempotency_key", "SELECT doc_id, concat(run_id, ':case-', CAST(question_index AS STRING), ':run-1') AS k FROM {results}")
def idempotency_key(t):
    case = F.concat(F.lit("case-"), F.col("question_index").cast("string"))
    return t.results.select("doc_id", N.idempotency_key(F.col("run_id"), case, F.lit(1)).alias("k"))


# Chat payloads: message objects, key ladders, content lists.
view("payloads", """
SELECT conv_id, turn, role, text, turn % 5 AS k, CASE turn % 5
  WHEN 0 THEN concat('{{"messages": [{{"type": "system", "content": "be brief"}}, {{"type": "human", "content": ', concat(chr(34), text, chr(34)), '}}, {{"type": "human", "content": "later"}}, {{"type": "ai", "content": "first"}}, {{"type": "ai", "content": ', concat(chr(34), text, chr(34)), '}}]}}')
  WHEN 1 THEN concat('{{"messages": [{{"role": "assistant", "content": [{{"type": "text", "text": "part"}}, {{"type": "image"}}, {{"type": "text", "text": ', concat(chr(34), role, chr(34)), '}}]}}]}}')
  WHEN 2 THEN concat('{{"query": ', concat(chr(34), text, chr(34)), ', "answer": ', concat(chr(34), role, chr(34)), '}}')
  WHEN 3 THEN concat('{{"input": "", "question": ', concat(chr(34), role, chr(34)), ', "output": 5, "result": ', concat(chr(34), text, chr(34)), '}}')
  ELSE '{{"other": 1}}' END AS payload
FROM {quoted}
""")
# Texts without quotes, backslashes and line breaks, so that quoting them makes valid JSON on both engines.
view("quoted", """
SELECT conv_id, turn, role, replace(replace(replace(text, chr(92), ' '), chr(34), ' '), chr(10), ' ') AS text FROM {conversations}
""")


@query("extract_input_text", """
SELECT conv_id, turn, CASE k WHEN 0 THEN text WHEN 1 THEN payload WHEN 2 THEN text WHEN 3 THEN role ELSE payload END AS value FROM {payloads}""")
def extract_input_text(t):
    return t.payloads.select("conv_id", "turn", MS.chain_input_text(F.col("payload")).alias("value"))


@query("extract_output_text", """
SELECT conv_id, turn, CASE k WHEN 0 THEN text WHEN 1 THEN 'part ' || role WHEN 2 THEN role WHEN 3 THEN text ELSE payload END AS value FROM {payloads}""")
def extract_output_text(t):
    return t.payloads.select("conv_id", "turn", MS.chain_output_text(F.col("payload")).alias("value"))


view("agent_messages", """
SELECT conv_id, turn, role, text, turn % 4 AS k, CASE turn % 4
  WHEN 0 THEN concat('[{{"role": "user", "content": "early"}}, {{"role": "user", "content": "', text, '"}}, {{"role": "assistant", "content": "', role, '"}}]')
  WHEN 1 THEN concat('[{{"role": "user", "content": [{{"type": "input_text", "text": "x"}}, {{"type": "text", "text": "', text, '"}}]}}, {{"role": "assistant", "content": "no"}}, {{"type": "message", "content": [{{"type": "output_text", "text": "', role, '"}}]}}]')
  WHEN 2 THEN '[{{"role": "system", "content": "s"}}]' ELSE '[]' END AS payload
FROM {quoted}
""")


@query("agent_log_texts", """
SELECT conv_id, turn, CASE WHEN k IN (0, 1) THEN text ELSE payload END AS input, CASE WHEN k IN (0, 1) THEN role ELSE payload END AS output FROM {agent_messages}""")
def agent_log_texts(t):
    p = F.col("payload")
    return t.agent_messages.select("conv_id", "turn", MS.agent_input_text(p).alias("input"), MS.agent_output_text(p).alias("output"))


view("responses", """
SELECT event_id, event_type, CASE event_id % 5 WHEN 0 THEN 'openai' WHEN 1 THEN 'anthropic' WHEN 2 THEN 'genai' WHEN 3 THEN 'adk' ELSE 'litellm' END AS provider,
 CASE event_id % 5
  WHEN 0 THEN CASE WHEN event_id % 2 = 0 THEN concat('{{"choices": [{{"message": {{"content": "a ', event_type, '"}}}}, {{"message": {{"content": "b"}}}}]}}')
     ELSE concat('{{"choices": [{{"message": {{"content": null, "tool_calls": [{{"function": {{"name": "f", "arguments": "', event_type, '"}}}}, {{"function": {{"name": "g", "arguments": "1"}}}}]}}}}]}}') END
  WHEN 1 THEN CASE WHEN event_id % 2 = 0 THEN concat('{{"content": [{{"type": "text", "text": "', event_type, '"}}, {{"type": "tool_use", "name": "f", "input": "1"}}]}}')
     ELSE concat('{{"content": [{{"type": "tool_use", "name": "', event_type, '", "input": "1"}}]}}') END
  WHEN 2 THEN CASE WHEN event_id % 2 = 0 THEN concat('{{"candidates": [{{"content": {{"parts": [{{"function_call": {{"name": "f", "args": "1"}}}}, {{"text": "', event_type, '"}}, {{"text": "second"}}]}}}}]}}')
     ELSE concat('{{"text": "', event_type, '"}}') END
  WHEN 3 THEN CASE WHEN event_id % 2 = 0 THEN concat('{{"parts": [{{"text": "', event_type, '"}}, {{"text": "second"}}]}}')
     ELSE concat('{{"parts": [{{"function_call": {{"name": "', event_type, '", "args": "1"}}}}]}}') END
  ELSE '{{"choices": []}}' END AS response,
 CASE event_id % 5
  WHEN 0 THEN concat('{{"prompt_tokens": ', CAST(user_id AS STRING), ', "completion_tokens": 5, "prompt_tokens_details": {{"cached_tokens": 2}}}}')
  WHEN 1 THEN concat('{{"input_tokens": ', CAST(user_id AS STRING), ', "output_tokens": 6, "cache_creation_input_tokens": 3, "cache_read_input_tokens": 4}}')
  WHEN 2 THEN concat('{{"prompt_token_count": ', CAST(user_id AS STRING), ', "candidates_token_count": 7, "cached_content_token_count": 1}}')
  WHEN 3 THEN concat('{{"prompt_tokens": 0, "input_tokens": ', CAST(user_id AS STRING), ', "output_tokens": 8}}') END AS usage_block,
 user_id
FROM {events}
""")


@query("provider_output", """
SELECT event_id, CASE WHEN event_id % 5 = 0 AND event_id % 2 = 0 THEN 'a ' || event_type || chr(10) || 'b' WHEN event_id % 5 = 0 THEN '[tool call] f(' || event_type || '), g(1)'
  WHEN event_id % 5 = 1 AND event_id % 2 = 0 THEN event_type WHEN event_id % 5 = 1 THEN '[tool call] ' || event_type || '(1)'
  WHEN event_id % 5 = 2 THEN event_type WHEN event_id % 5 = 3 AND event_id % 2 = 0 THEN event_type || ' second'
  WHEN event_id % 5 = 3 THEN '[tool call] ' || event_type || '(1)' END AS value FROM {responses}""")
def provider_output(t):
    return t.responses.select("event_id", MS.provider_output(F.col("provider"), F.col("response")).alias("value"))


@query("provider_usage", """
SELECT event_id, CASE event_id % 5 WHEN 1 THEN user_id + 7 WHEN 3 THEN user_id WHEN 4 THEN NULL ELSE user_id END AS input,
  CASE event_id % 5 WHEN 0 THEN 5 WHEN 1 THEN 6 WHEN 2 THEN 7 WHEN 3 THEN 8 END::BIGINT AS output,
  CASE event_id % 5 WHEN 0 THEN 2 WHEN 1 THEN 4 WHEN 2 THEN 1 END::BIGINT AS cache_read, CASE event_id % 5 WHEN 1 THEN 3 END::BIGINT AS cache_write FROM {responses}""")
def provider_usage(t):
    provider = F.when(F.col("provider") == "adk", "llamaindex").otherwise(F.col("provider"))
    return t.responses.select("event_id", MS.provider_usage(provider, F.col("usage_block")).alias("u")).select("event_id", "u.*")


@query("fold_system", """
SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN 'system:be brief|' ELSE '' END || role || ':' || text AS messages FROM {conversations}""")
def fold_system(t):
    system = F.when(F.col("turn") % 2 == 0, "be brief").otherwise("")
    one = F.array(F.struct(F.col("role").alias("role"), F.col("text").alias("content")))
    folded = MS.fold_system(system, one)
    flat = F.array_join(F.transform(folded, lambda m: F.concat_ws(":", m["role"], m["content"])), "|")
    return t.conversations.select("conv_id", "turn", flat.alias("messages"))


@query("tool_defs_cap", """
SELECT doc_id, CASE WHEN n > 0 AND total <= 12000 THEN least(n, 20) END AS kept FROM (SELECT doc_id, len(w) AS n,
  1 + list_sum(list_transform(w[1:20], lambda x: length(x) + 3)) AS total FROM (SELECT doc_id, string_split(regexp_replace(text, '["\\\\\\n\\t\\r]', '', 'g'), ' ') AS w FROM {documents}))""")
def tool_defs_cap(t):
    words = F.split(F.regexp_replace("text", r'["\\\n\t\r]', ""), " ", -1)
    return t.documents.select("doc_id", F.size(MS.tool_defs_cap(F.array(words), 20, 12_000)).cast("long").alias("n")).select(
        "doc_id", F.when(F.col("n") > 0, F.col("n")).alias("kept")
    )


@query("framework_label", "SELECT span_id, lower(coalesce(CASE WHEN span_id % 4 = 0 THEN 'NIM' END, framework, CASE WHEN span_id % 3 = 0 THEN 'Detected' END, 'other')) AS framework FROM {spans}")
def framework_label(t):
    explicit, detected = F.when(F.col("span_id") % 4 == 0, "NIM"), F.when(F.col("span_id") % 3 == 0, "Detected")
    return t.spans.select("span_id", N.framework_label(explicit, F.col("framework"), detected).alias("framework"))


@query("span_kind", """
SELECT span_id, CASE WHEN span_id % 4 = 0 THEN span_kind WHEN span_id % 4 = 1 THEN 'chain' WHEN span_id % 12 = 2 THEN 'llm' WHEN span_id % 12 = 6 THEN 'retrieval'
  WHEN model IS NOT NULL THEN 'llm' ELSE 'other' END AS kind FROM {spans}""")
def span_kind(t):
    sid = F.col("span_id")
    name = F.when(sid % 12 == 2, F.concat(F.lit("LLM Call "), sid.cast("string"))).when(sid % 12 == 6, "Retrieval 3").otherwise("step")
    kind = N.span_kind(F.when(sid % 4 == 0, F.col("span_kind")), F.when(sid % 4 == 1, "chain"), name, F.col("model"))
    return t.spans.select("span_id", kind.alias("kind"))


@query("noise_flag", "SELECT span_id, (name = 'RunnableSequence' AND span_id % 4 <> 1) OR starts_with(name, 'ChannelWrite') AS noise FROM {chains}")
def noise_flag(t):
    node = F.when(F.col("span_id") % 4 == 1, "RunnableSequence")
    return t.chains.select("span_id", N.is_noise_chain(F.col("name"), node).alias("noise"))


@query("wire_rename", "SELECT span_id AS spanId, latency_ms AS latencyMs, model FROM {spans}")
def wire_rename(t):
    df = t.spans.select("span_id", "latency_ms", "model")
    return N.wire_rename(df, {"span_id": "spanId", "latency_ms": "latencyMs"}, {"model"})


@query("ref_unwrap", "SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'a' || doc_id ELSE CAST(doc_id AS VARCHAR) END AS ref FROM {labels}")
def ref_unwrap(t):
    d = F.col("doc_id").cast("string")
    k = F.col("doc_id") % 3
    ref = F.when(k == 0, F.concat(F.lit("a"), d)).when(k == 1, F.concat(F.lit('{"_id": "'), d, F.lit('", "name": "x"}'))).otherwise(
        F.concat(F.lit('{"id": '), d, F.lit("}"))
    )
    return t.labels.select("doc_id", N.ref_unwrap(ref).alias("ref"))


@query("rating_band", "SELECT trace_id, CASE WHEN rating >= 7 THEN 'high' WHEN rating >= 4 THEN 'medium' WHEN rating IS NOT NULL THEN 'low' END AS band, CASE WHEN rating / 10 >= 0.85 THEN 'high' WHEN rating / 10 >= 0.6 THEN 'medium' ELSE 'low' END AS cosine_band FROM {verdicts}")
def rating_band(t):
    r = F.col("rating")
    return t.verdicts.select("trace_id", N.rating_band(r, "rating").alias("band"), N.rating_band(r / 10, "cosine").alias("cosine_band"))


@query("sampled", "SELECT span_id FROM {spans} WHERE substr(md5(concat(CAST(span_id AS STRING), ':rule-1')), 1, 8) < '40000000'")
def sampled_query(t):
    return t.spans.where(sampled(F.col("span_id"), "rule-1", 0.25)).select("span_id")


@query("retrieval_join_text", """
SELECT conv_id, text, CAST(2 AS BIGINT) AS doc_count FROM {conversations} WHERE turn = 0 AND conv_id % 2 = 0
UNION ALL SELECT conv_id, text || chr(10) || chr(10) || '---' || chr(10) || chr(10) || role, CAST(2 AS BIGINT) FROM {conversations} WHERE turn = 0 AND conv_id % 2 = 1""")
def retrieval_join_text(t):
    """Two chunks of which every other second one is blank: both are counted, blanks are not joined."""
    second = F.when(F.col("conv_id") % 2 == 0, "").otherwise(F.col("role"))
    text, n = N.retrieval_join_text(F.array(F.col("text"), second))
    return t.conversations.where("turn = 0").select("conv_id", text.alias("text"), n.alias("doc_count"))


@query("price_valid", """
SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN false WHEN 1 THEN false WHEN 2 THEN false ELSE true END AS valid FROM {part}""")
def price_valid(t):
    k = F.col("p_partkey") % 5
    price = F.when(k == 0, "-1").when(k == 1, "cheap").when(k == 2, "Infinity").otherwise(F.col("p_retailprice").cast("string"))
    return t.part.select("p_partkey", N.price_valid(price).alias("valid"))


@query("read_messages", "SELECT conv_id, turn, CASE WHEN role = 'assistant' THEN 'bot' ELSE 'user' END AS who FROM {conversations}")
def read_messages(t):
    bot = F.when(F.col("role") == "assistant", "b1").when(F.col("role") == "user", "")
    return t.conversations.select("conv_id", "turn", N.message_role(bot).alias("who"))
