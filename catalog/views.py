"""Agent telemetry derived from the given tables, in SQL that reads the same on both engines."""

from catalog.base import view

NOW = "2024-01-31 00:00:00"  # reference time of every windowed query; the wall clock is never read

view("spans", """
SELECT event_id AS span_id,
       CASE WHEN event_id % 8 = 0 THEN NULL
            ELSE event_id - event_id % 8 + CAST(floor((event_id % 8) / 2) AS BIGINT) END AS parent_span_id,
       event_id - event_id % 8 AS trace_id,
       user_id,
       CASE WHEN user_id % 11 = 0 AND ts < TIMESTAMP '2024-01-17 00:00:00' THEN 'agent-retired' ELSE concat('agent-', CAST(user_id % 7 AS STRING)) END AS agent,
       ts AS started_at,
       CASE WHEN event_id % 8 = 0 THEN 'agent' WHEN event_type = 'view' THEN 'retrieval'
            WHEN event_type = 'purchase' THEN 'llm' WHEN event_type = 'signup' THEN 'memory' ELSE 'tool' END AS span_kind,
       CASE WHEN event_type = 'error' THEN 'boom' END AS error,
       CAST(round(value * 200) AS BIGINT) AS latency_ms,
       CASE event_id % 3 WHEN 0 THEN 'm-small' WHEN 1 THEN 'm-large' END AS model,
       CASE event_id % 5 WHEN 1 THEN 'LangChain' WHEN 2 THEN 'langchain' WHEN 3 THEN 'crewai' WHEN 4 THEN 'openai' END AS framework,
       CASE WHEN event_id % 16 = 8 THEN 'eval-run' END AS source,
       CAST(regexp_extract(props, '[0-9]+', 0) AS BIGINT) * 10 AS input_tokens,
       CAST(regexp_extract(props, '[0-9]+', 0) AS BIGINT) * 3 AS output_tokens,
       CAST(regexp_extract(props, '[0-9]+', 0) AS BIGINT) AS cache_read_tokens
FROM {events}
""")

view("verdicts", """
SELECT doc_id AS trace_id,
       CASE WHEN quality = 1 THEN 6 + doc_id % 5 ELSE doc_id % 6 END AS rating,
       (CASE WHEN doc_id % 9 = 0 THEN 1 - quality ELSE quality END) = 0 AS truth_bad,
       CASE WHEN doc_id % 4 = 0 THEN doc_id % 11 END AS corrected_score
FROM {labels}
""")

view("results", """
SELECT concat('run-', CAST(doc_id % 4 AS STRING)) AS run_id,
       CAST(floor(doc_id / 4) AS BIGINT) AS question_index,
       CASE WHEN CAST(floor(doc_id / 4) AS BIGINT) % 2 = 0 THEN 'm-small' ELSE 'm-large' END AS model,
       CASE WHEN doc_id % 17 = 0 THEN 'failed' WHEN doc_id % 13 = 0 THEN 'skipped' ELSE 'scored' END AS status,
       CASE WHEN doc_id % 17 = 0 OR doc_id % 13 = 0 THEN NULL
            WHEN quality = 1 THEN 6 + doc_id % 5 ELSE doc_id % 6 END AS rating,
       doc_id % 10 = 3 AS is_smoke_test_variant,
       doc_id
FROM {labels}
""")

view("cases", """
SELECT item_id AS question_index, concat('q', CAST(item_id AS STRING)) AS query, text AS expected_results,
       CASE item_id % 3 WHEN 0 THEN split('smoke', ',') WHEN 1 THEN split('smoke,full', ',') END AS splits
FROM {benchmark}
""")

view("text_pairs", """
SELECT a.conv_id, a.turn, a.text AS reference, b.text AS candidate
FROM {conversations} a JOIN {conversations} b ON a.conv_id = b.conv_id AND b.turn = a.turn + 2
WHERE a.role = 'assistant' AND b.role = 'assistant'
""")

view("chunks", """
SELECT conv_id AS call_id, turn AS seq, text AS delta,
       CASE WHEN role = 'assistant' THEN length(text) END AS usage_output
FROM {conversations}
""")

view("feedback", """
SELECT event_id AS trace_id, CASE WHEN event_id % 5 = 0 THEN 'down' ELSE 'up' END AS rating, ts + (event_id % 97) * INTERVAL 3 HOUR AS created_at
FROM {events} WHERE event_id % 24 = 0
""")

view("interactions", """
SELECT o_orderkey AS interaction_id, o_custkey AS conversation_id, o_orderdate AS created_time,
       CASE WHEN o_orderstatus = 'F' THEN '' ELSE o_orderstatus END AS domain
FROM {orders}
""")

view("plugin_calls", """
SELECT CASE WHEN l_orderkey % 10 = 0 THEN NULL ELSE l_orderkey END AS interaction_id,
       l_partkey AS conversation_id, concat('tool-', CAST(l_suppkey % 9 AS STRING)) AS plugin_name,
       l_linenumber AS pos, l_orderkey AS call_ref
FROM {lineitem}
""")

view("vec_pairs", """
SELECT a.vec_id, a.embedding AS va, b.embedding AS vb
FROM {embeddings} a JOIN {embeddings} b ON b.vec_id = a.vec_id + 1
""")
