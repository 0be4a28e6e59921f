"""Scans, imports and append-once rules."""

import uuid

from pyspark.sql import functions as F

from catalog.base import query, view
from spanquarry.lineage import shared_base
from spanquarry.sources import conversations as CV
from spanquarry.sources import csv_cases, ndjson, store, tables, trace_docs

EVENT_ROW = "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE"


def scratch(spark, name):
    """A fresh folder on the shared storage the session names, or a local one in tests."""
    return f"{shared_base(spark)}/{name}-{uuid.uuid4().hex}"


@query("scan_ndjson", "SELECT event_id, user_id, event_type, value, NULL::VARCHAR AS _corrupt_record FROM {events}")
def scan_ndjson(t):
    folder = scratch(t.spark, "ndjson")
    t.events.select("event_id", "user_id", "event_type", "value").write.json(folder)
    return ndjson.scan_ndjson(t.spark, folder, EVENT_ROW)


@query("dump_ndjson", "SELECT 'events' AS entity, count(*) AS n_rows FROM {events} UNION ALL SELECT 'labels', count(*) FROM {labels}")
def dump_ndjson(t):
    folder = scratch(t.spark, "dump")
    ndjson.dump_ndjson({"events": t.events, "labels": t.labels}, folder)
    manifest = t.spark.read.schema("entity STRING, rows BIGINT, path STRING").json(f"{folder}/manifest")
    return manifest.select("entity", F.col("rows").alias("n_rows"))


@query("export_manifest", """
SELECT 'events' AS entity, count(*) AS n_rows, 'events.ndjson' AS path FROM {events} UNION ALL SELECT 'labels', count(*), 'labels.ndjson' FROM {labels}
UNION ALL SELECT 'orders', count(*), 'orders.ndjson' FROM {orders}""")
def export_manifest(t):
    return tables.export_manifest({"events": t.events, "labels": t.labels, "orders": t.orders})


@query("incremental_since", "SELECT event_id FROM {events} WHERE ts >= TIMESTAMP '2024-01-20 00:00:00'")
def incremental_since(t):
    return tables.incremental_since(t.events, "ts", "2024-01-20 00:00:00").select("event_id")


@query("half_open_window", "SELECT event_id FROM {events} WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-12 00:00:00'")
def half_open_window(t):
    return tables.half_open_window(t.events, "ts", "2024-01-10", "2024-01-12").select("event_id")


@query("half_open_window_null_time", """
SELECT event_id FROM (SELECT event_id, CASE WHEN event_id % 9 <> 0 THEN ts END AS ts FROM {events}) WHERE ts IS NULL OR (ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-12 00:00:00')""")
def half_open_window_null_time(t):
    df = t.events.select("event_id", F.when(F.col("event_id") % 9 != 0, F.col("ts")).alias("ts"))
    return tables.half_open_window(df, "ts", "2024-01-10", "2024-01-12", keep_null=True).select("event_id")


CASES = "SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN ' ' WHEN 1 THEN ' nan' ELSE concat(' ', source, ' ') END AS query, CASE WHEN doc_id % 4 = 0 THEN ' ' ELSE lang END AS expected_results, concat(lang, '; ;', source) AS expected_capabilities FROM {documents}"


@query("import_cases_df", f"""
SELECT doc_id, trim(query) AS query, nullif(trim(expected_results), '') AS expected_results, concat(split_part(expected_capabilities, ';', 1), '|', split_part(expected_capabilities, ';', 3)) AS caps, trim(query) IN ('', 'nan') AS rejected FROM ({CASES})""")
def import_cases_df(t):
    out = csv_cases.import_cases_df(t.sql(CASES))
    return out.select("doc_id", "query", "expected_results", F.array_join("expected_capabilities", "|").alias("caps"), "rejected")


@query("import_cases_csv", f"SELECT trim(query) AS query, nullif(trim(expected_results), '') AS expected_results, trim(query) = '' AS rejected, row_number() OVER (ORDER BY doc_id) + 1 AS line FROM ({CASES})")
def import_cases_csv(t):
    """The cases are written as one quoted CSV file first; a file keeps its record order."""
    folder = scratch(t.spark, "cases")
    keep = t.sql(CASES).orderBy("doc_id").select("query", "expected_results", "expected_capabilities")
    keep.coalesce(1).write.option("header", True).option("quoteAll", True).option("escape", '"').csv(folder)
    return csv_cases.import_cases_csv(t.spark, folder).select("query", "expected_results", "rejected", "line")


WIRE = """
SELECT event_id, concat('{{"name": "', event_type, '", "span_id": "', CAST(event_id AS STRING), '", "input_tokens": ', CAST(event_id % 3 AS STRING), ', "latency_ms": ', CAST(user_id AS STRING),
  ', "monitor": true, "metadata": {{"a": 1}}, "unknown": [1], "started_at_unix_nano": "', CAST(event_id * 1000000000 AS STRING), '"}}') AS value FROM {events}"""


@query("wire_project", "SELECT CAST(event_id AS STRING) AS span_id, event_type AS name, nullif(event_id % 3, 0) AS input_tokens, CAST(NULL AS BIGINT) AS output_tokens, user_id AS latency_ms, true AS monitor, NULL::VARCHAR AS error, event_id * 1000 AS started_ms FROM {events}")
def wire_project(t):
    spans = ndjson.wire_spans(t.sql(WIRE))
    started = F.unix_millis("started_at").alias("started_ms")
    return spans.select("span_id", "name", "input_tokens", "output_tokens", "latency_ms", "monitor", "error", started)


@query("dataset_copy", "SELECT concat('copy-', CAST(c_custkey AS STRING)) AS dataset_id, 'renamed' AS name, c_mktsegment AS judge_model, CAST(c_nationkey AS BIGINT) AS number_of_requests FROM {customer}")
def dataset_copy(t):
    source = t.customer.select(
        "c_custkey", F.col("c_name").alias("name"), F.col("c_mktsegment").alias("judge_model"), F.col("c_nationkey").cast("long").alias("number_of_requests"), F.lit(1).alias("private")
    )
    return ndjson.dataset_copy(source, F.concat(F.lit("copy-"), F.col("c_custkey").cast("string")), "renamed")


ARRIVALS = "SELECT event_id % 7 AS project_id, event_id - event_id % 2 AS span_id, event_id AS arrival FROM {events}"
EXISTING = "SELECT event_id % 7 AS project_id, event_id AS span_id FROM {events} WHERE event_id % 10 = 4"


@query("ingest_dedupe", f"""
SELECT a.project_id, a.span_id, a.arrival, x.span_id IS NOT NULL OR a.arrival > min(a.arrival) OVER (PARTITION BY a.project_id, a.span_id) AS deduped FROM ({ARRIVALS.replace('event_id % 7', '(event_id - event_id % 2) % 7')}) a
LEFT JOIN ({EXISTING}) x ON a.project_id = x.project_id AND a.span_id = x.span_id""")
def ingest_dedupe(t):
    arrivals = t.sql(ARRIVALS.replace("event_id % 7", "(event_id - event_id % 2) % 7"))
    return tables.ingest_dedupe(t.sql(EXISTING), arrivals, ["project_id", "span_id"])


@query("tenant_scope", "SELECT o_orderkey FROM {orders} WHERE o_orderpriority = '1-URGENT'")
def tenant_scope(t):
    return tables.tenant_scope(t.orders.withColumnRenamed("o_orderpriority", "project_id"), "1-URGENT").select("o_orderkey")


# -- conversation export -----------------------------------------------------------------------

INTER = """
SELECT interaction_id, conversation_id, CASE WHEN interaction_id % 50 = 7 THEN NULL ELSE created_time END AS created_time, domain, CASE WHEN interaction_id % 3 = 0 THEN 'r1' END AS route,
  CASE WHEN interaction_id % 4 <> 0 THEN concat('ask ', CAST(interaction_id AS STRING)) ELSE '' END AS utterance, CASE WHEN interaction_id % 5 <> 0 THEN 'done' END AS reply,
  created_time + (interaction_id % 9 - 2) * INTERVAL 1 SECOND AS resolved_time FROM {interactions}"""
CONV = "SELECT c_custkey AS conversation_id, lower(c_mktsegment) AS domain, CASE WHEN c_custkey % 2 = 0 THEN 'route-c' END AS route FROM {customer} WHERE c_custkey % 3 <> 0 UNION ALL SELECT c_custkey, 'zz-last', 'zz-route' FROM {customer} WHERE c_custkey % 12 = 1"


# of two export rows of a conversation the larger values count
CONV_LAST = f"SELECT conversation_id, max(domain) AS domain, CASE WHEN max(domain) = 'zz-last' THEN 'zz-route' ELSE max(route) END AS route FROM ({CONV}) GROUP BY conversation_id"


@query("enrich_conversation", f"""
SELECT interaction_id, coalesce(nullif(i.domain, ''), c.domain) AS domain, coalesce(i.route, c.route) AS route FROM ({INTER}) i LEFT JOIN ({CONV_LAST}) c ON i.conversation_id = c.conversation_id""")
def enrich_conversation(t):
    return CV.enrich_conversation(t.sql(INTER), t.sql(CONV)).select("interaction_id", "domain", "route")


SIZES = "SELECT CAST(coalesce(interaction_id, conversation_id) AS STRING) AS k, count(*) AS n FROM {plugin_calls} GROUP BY 1"
ATTACHED = f"""
SELECT interaction_id, CASE WHEN o.k IS NOT NULL THEN o.k ELSE c.k END AS calls_key, coalesce(o.n, c.n, 0) AS n_calls FROM {{interactions}} i
LEFT JOIN ({SIZES}) o ON CAST(i.interaction_id AS STRING) = o.k LEFT JOIN ({SIZES}) c ON CAST(i.conversation_id AS STRING) = c.k"""


@query("attach_calls", f"""
SELECT a.interaction_id, a.calls_key, a.n_calls, c.pos, c.plugin_name AS called FROM ({ATTACHED}) a
LEFT JOIN (SELECT *, CAST(coalesce(interaction_id, conversation_id) AS STRING) AS k FROM {{plugin_calls}}) c ON a.calls_key = c.k""")
def attach_calls(t):
    out = CV.attach_calls(t.interactions, t.plugin_calls)
    calls = CV.named_calls(t.plugin_calls).select("calls_key", F.col("pos").cast("int").alias("pos"), F.col("name").alias("called"))
    return out.select("interaction_id", "calls_key", "n_calls").join(calls, "calls_key", "left")


@query("import_conversations", f"""
SELECT 'moveworks-' || coalesce(nullif(i.domain, ''), c.domain) AS named, concat('mw:', CAST(i.interaction_id AS STRING)) AS span_id, concat('mw_', CAST(i.conversation_id AS STRING)) AS session_id, epoch_us(created_time) * 1000 AS started_at_ns,
  CASE WHEN resolved_time >= created_time THEN (i.interaction_id % 9 - 2) * 1000 END AS latency_ms, CASE WHEN utterance <> '' THEN utterance ELSE '{{{{"interaction_type":"unknown"}}}}' END AS input, reply AS output, a.n_calls
FROM ({INTER}) i LEFT JOIN ({CONV_LAST}) c ON i.conversation_id = c.conversation_id JOIN ({ATTACHED}) a ON i.interaction_id = a.interaction_id WHERE created_time IS NOT NULL""")
def import_conversations(t):
    out = CV.import_conversations(t.sql(INTER), t.sql(CONV), t.plugin_calls)
    named = F.when(F.col("name") != CV.DEFAULT_NAME, F.col("name"))
    return out.select(named.alias("named"), "span_id", "session_id", "started_at_ns", "latency_ms", "input", "output", "n_calls")


@query("import_metadata", f"""
SELECT concat('mw:', CAST(i.interaction_id AS STRING)) AS span_id, epoch_us(created_time) // 1000000 AS started_s, CASE WHEN resolved_time >= created_time THEN (i.interaction_id % 9 - 2) * 1000 END AS latency_ms,
  concat('{{{{"source":"moveworks","conversationId":', CAST(i.conversation_id AS STRING), ',"interactionId":"', CAST(i.interaction_id AS STRING), '"', CASE WHEN i.interaction_id % 2 = 0 THEN ',"interactionType":"form"' ELSE '' END,
    coalesce(',"domain":"' || coalesce(nullif(i.domain, ''), c.domain) || '"', ''), coalesce(',"route":"' || coalesce(i.route, c.route) || '"', ''), CASE WHEN i.interaction_id % 7 <> 0 THEN concat(',"userId":"u', CAST(i.interaction_id % 7 AS STRING), '"') ELSE '' END, '}}}}') AS metadata
FROM ({INTER}) i LEFT JOIN ({CONV_LAST}) c ON i.conversation_id = c.conversation_id WHERE created_time IS NOT NULL""")
def import_metadata(t):
    """Times come as ISO text with and without a zone, as seconds and as milliseconds, under either of two names."""
    at, ended, k = F.col("created_time"), F.col("resolved_time"), F.col("interaction_id") % 4
    iso = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss")
    mixed = F.when(k == 0, F.unix_seconds(at).cast("string")).when(k == 1, F.unix_millis(at).cast("string")).when(k == 2, F.concat(iso, F.lit("Z"))).otherwise(iso)
    raw = t.sql(INTER).select(
        "interaction_id", "conversation_id", "domain", "route",
        F.when(k % 2 == 0, mixed).otherwise("").alias("created_time"), F.when(k % 2 == 1, mixed).alias("created_at"), F.unix_millis(ended).alias("completed_time"),
        F.when(F.col("interaction_id") % 2 == 0, "form").alias("type"),
        F.when(F.col("interaction_id") % 7 != 0, F.concat(F.lit("u"), (F.col("interaction_id") % 7).cast("string"))).alias("user_id"),
    )
    out = CV.import_conversations(raw, t.sql(CONV), t.plugin_calls)
    return out.select("span_id", F.expr("started_at_ns div 1000000000").alias("started_s"), "latency_ms", "metadata")


@query("skip_untimed", f"SELECT interaction_id FROM ({INTER}) WHERE created_time IS NULL")
def skip_untimed(t):
    return tables.valid_split(t.sql(INTER), F.col("created_time").isNotNull())[1].select("interaction_id")


@query("sync_report", f"""
SELECT count(*) AS interactions, CAST(count(*) FILTER (created_time IS NULL) AS BIGINT) AS skipped_no_time, count(*) FILTER (created_time IS NOT NULL AND i.interaction_id % 8 <> 0) AS ingested, count(*) FILTER (created_time IS NOT NULL AND i.interaction_id % 8 = 0) AS deduped,
  CAST(sum(a.n_calls) FILTER (created_time IS NOT NULL) AS BIGINT) AS calls_attached, count(DISTINCT conversation_id) FILTER (created_time IS NOT NULL) AS sessions FROM ({INTER}) i JOIN ({ATTACHED}) a ON i.interaction_id = a.interaction_id""")
def sync_report(t):
    raw = t.sql(INTER)
    existing = t.interactions.where("interaction_id % 8 = 0").select(F.concat(F.lit("mw:"), F.col("interaction_id").cast("string")).alias("span_id"))
    return CV.sync_report(raw, CV.import_conversations(raw, t.sql(CONV), t.plugin_calls), existing)


# -- nested trace documents --------------------------------------------------------------------


def docs(t):
    """A document per event: a root, a tool under it, and a step whose parent is unknown."""
    e, tid = F.col("event_id"), F.col("event_id").cast("string")
    base = (e + 1) * 1_000_000_000

    def span(sid, parent, name, kind, start, end, code):
        return F.struct(
            F.lit(sid).alias("span_id"), parent.alias("parent_id"), F.lit(name).alias("name"), F.lit(kind).alias("span_type"),
            start.alias("start_time_ns"), end.alias("end_time_ns"), F.col("event_type").alias("inputs"), F.lit(None).cast("string").alias("outputs"),
            F.struct(code.alias("status_code"), F.lit(None).cast("string").alias("description")).alias("status"),
        )

    none = F.lit(None).cast("string")
    code = F.when(F.col("event_type") == "error", "STATUS_CODE_ERROR").otherwise("OK")
    spans = F.array(
        span("t", F.lit("r"), "search", "tool", base + 1_000_000, base + 1_000_000 + F.col("user_id") * 1_000_000, code),
        span("r", none, "agent", "AGENT", base, base + 9_999_999, F.lit("OK")),
        span("x", F.lit("lost"), "step", "CHAIN", base, base, F.lit("OK")),
    )
    state = F.when(e % 10 == 3, "TraceState.IN_PROGRESS").otherwise("OK")
    meta = F.when(e % 2 == 0, F.create_map(F.lit("mlflow.trace.session"), F.col("user_id").cast("string")))
    tags = F.create_map(F.lit("session_id"), F.lit("tagged"))
    info = F.struct(
        tid.alias("trace_id"), F.lit("e1").alias("experiment_id"), state.alias("state"), F.unix_millis("ts").alias("request_time"),
        meta.alias("trace_metadata"), F.when(e % 3 == 0, tags).alias("tags"),
    )
    return t.events.select(info.alias("info"), F.struct(spans.alias("spans")).alias("data"))


DOC_BASE = "SELECT *, concat('dbx:', CAST(event_id AS STRING)) AS w, 'dbx_' || CASE WHEN event_id % 2 = 0 THEN CAST(user_id AS VARCHAR) WHEN event_id % 3 = 0 THEN 'tagged' END AS sess FROM {events} WHERE event_id % 10 <> 3"


@query("import_mlflow_traces", f"""
SELECT w || ':t' AS span_id, w AS parent_span_id, sess AS session_id, 'search' AS name, nullif(user_id, 0) AS latency_ms, CASE WHEN event_type = 'error' THEN 'error' END AS error, NULL::BIGINT AS n_tools, NULL::BOOLEAN AS tool_ok FROM ({DOC_BASE})
UNION ALL SELECT w, NULL, sess, 'agent', 9, NULL, 1, event_type <> 'error' FROM ({DOC_BASE}) UNION ALL SELECT w || ':x', w, sess, 'step', NULL, NULL, NULL, NULL FROM ({DOC_BASE})""")
def import_mlflow_traces(t):
    out = trace_docs.import_traces(trace_docs.skip_in_progress(docs(t)))
    return out.select(
        "span_id", "parent_span_id", "session_id", "name", "latency_ms", "error",
        F.when(F.col("tool_calls").isNotNull(), F.size("tool_calls")).cast("long").alias("n_tools"),
        F.element_at("tool_calls", 1)["success"].alias("tool_ok"),
    )


@query("explode_mlflow", "SELECT CAST(count(*) * 3 AS BIGINT) AS spans, count(*) AS roots FROM {events}")
def explode_mlflow(t):
    out = trace_docs.import_traces(docs(t), "my agent")
    return out.agg(F.count("*").alias("spans"), F.count_if(F.col("name") == "my agent").alias("roots"))


@query("skip_in_progress", "SELECT event_id FROM {events} WHERE event_id % 10 <> 3")
def skip_in_progress(t):
    return trace_docs.skip_in_progress(docs(t)).select(F.col("info.trace_id").cast("long").alias("event_id"))


# -- table by day ------------------------------------------------------------------------------

KEEP_UNTIL = "2024-01-30 12:00:00"


@query("retention_store", f"""
SELECT event_id, CASE WHEN day(ts) % 4 = 0 THEN upper(event_type) ELSE event_type END AS event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM {{events}}
WHERE ts >= TIMESTAMP '{KEEP_UNTIL}' - INTERVAL 20 DAY AND (day(ts) % 4 <> 0 OR event_id % 3 <> 0)""")
def retention_store(t):
    """All days are written, every fourth is replaced by corrected rows, the old ones are dropped."""
    folder = scratch(t.spark, "days")
    rows = t.events.select("event_id", "event_type", "ts")
    store.replace_days(rows, folder, "ts")
    fourth = rows.where((F.dayofmonth("ts") % 4 == 0) & (F.col("event_id") % 3 != 0))
    store.replace_days(fourth.withColumn("event_type", F.upper("event_type")), folder, "ts")
    store.expire(t.spark, folder, KEEP_UNTIL, 20)
    return store.retained(t.spark, folder, "ts", KEEP_UNTIL, 20).select("event_id", "event_type", F.col("day").cast("string").alias("day"))


@query("append_store", """
SELECT event_id AS idempotency_key, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, CAST(1 AS BIGINT) AS copies, (SELECT count(*) FROM {events} WHERE event_id % 3 <> 0 AND event_type <> 'error') AS duplicate,
  (SELECT count(*) FROM {events} WHERE event_type = 'error') AS invalid FROM {events} WHERE event_type <> 'error'""")
def append_store(t):
    """Two thirds of the results are appended, then all of them are delivered; blank outputs without an error are refused."""
    folder = scratch(t.spark, "results")
    output = F.when(F.col("event_type") == "error", "").otherwise(F.col("event_type"))
    batch = t.events.select(F.col("event_id").alias("idempotency_key"), F.col("event_id").alias("arrival"), output.alias("output"), F.lit(None).cast("string").alias("error"), "ts")
    store.append_batch(t.spark, batch.where("idempotency_key % 3 <> 0"), folder, "ts")
    said = store.append_batch(t.spark, batch, folder, "ts")
    found = store.read_days(t.spark, folder, "ts").groupBy("idempotency_key", F.col("day").cast("string").alias("day")).agg(F.count("*").alias("copies"))
    return found.select("*", F.lit(said["duplicate"]).cast("bigint").alias("duplicate"), F.lit(said["invalid"]).cast("bigint").alias("invalid"))
