"""Streaming jobs over the given files, run to completion, and user callables."""

from pyspark.sql import functions as F

from catalog.base import Tables, query, view
from catalog.logs import ASSEMBLED, CHUNK_LOG, ISLANDS, states
from catalog.monitoring import FACTS_SQL, HITS_SQL, PATTERNS, SIGNALS_SQL, SOURCES, facts
from catalog.sources import scratch
from catalog.views import NOW
from spanquarry.functions import callables as K
from spanquarry.operators import logs as L
from spanquarry.operators import monitoring as M
from spanquarry.operators import trees
from spanquarry.operators.routing import Rule
from spanquarry.session import SETTINGS
from spanquarry.streaming import jobs as J
from spanquarry.streaming import processors as P


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"


class Streamed(Tables):
    """The same tables and views, read as file streams."""

    def __init__(self, t: Tables):
        super().__init__(t.spark, t.folder)
        self._batch = t

    def __getattr__(self, name):
        from catalog.base import TABLES

        if name in TABLES and name not in self._made:
            schema = getattr(self._batch, name).schema
            # a file or a folder of files; a stream takes a single file by a pattern only
            self._made[name] = self.spark.readStream.schema(schema).parquet(f"{self.folder}/{name}.parque[t]")
        return super().__getattr__(name)


def finish(t, stream, mode="append", sink=None):
    """Run a stream over everything available and return what it stored."""
    folder = scratch(t.spark, "stream")
    t.spark.conf.set(STATE_STORE, SETTINGS[STATE_STORE])
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True)
    out = f"{folder}/out"
    if sink is not None:
        writer = writer.foreachBatch(sink(out))
    elif mode == "append":
        writer = writer.format("parquet").option("path", out)
    else:
        writer = writer.foreachBatch(lambda df, epoch: df.write.mode("overwrite").parquet(out))
    writer.start().awaitTermination()
    return t.spark.read.parquet(out)


def streamed_copy(t, df):
    """A derived table written once and read back as a stream."""
    folder = scratch(t.spark, "source")
    df.write.parquet(folder)
    return t.spark.readStream.schema(df.schema).parquet(folder)


def ended_copy(t, df, event_time):
    """The same with the row that ends the input."""
    return streamed_copy(t, df.unionByName(P.end_marker(t.spark, df.schema, event_time)))


@query("monitor_stream", HITS_SQL)
def monitor_stream(t):
    roots = Streamed(t).doc_roots.withColumn("parent_span_id", F.lit(None).cast("long"))
    return finish(t, J.monitor_stream(roots, PATTERNS, SOURCES))


@query("dedupe_stream", "SELECT span_id, agent FROM {spans}")
def dedupe_stream(t):
    twice = t.spans.select("span_id", "agent", "started_at")
    stream = streamed_copy(t, twice.unionByName(twice))
    return finish(t, J.dedupe_stream(stream).select("span_id", "agent"))


@query("late_data", f"SELECT span_id FROM {{spans}} WHERE span_id % 5 <> 0 AND started_at < TIMESTAMP '{NOW}' - INTERVAL 480 HOUR")
def late_data(t):
    spans = t.spans.select("span_id", "started_at")
    return J.late_data(spans, spans.where("span_id % 5 = 0"), NOW, 480).select("span_id")


RATED = "SELECT v.rating, s.started_at AS scored_at FROM {verdicts} v JOIN {spans} s ON v.trace_id = s.span_id"


@query("rating_tumble", f"""
SELECT CAST(floor(epoch(scored_at) / 3600) AS BIGINT) * 3600000 AS ts, round(avg(rating), 6) AS average_rating, count(rating) AS n FROM ({RATED}) GROUP BY 1""")
def rating_tumble(t):
    return finish(t, J.rating_tumble(streamed_copy(t, t.sql(RATED)), "1 hour"), "complete")


@query("sliding_kpi_stream", f"""
SELECT f.agent AS subject, make_timestamp(t * 3600000000) AS tick, count(*) AS runs, round(count(*) FILTER (failed) / count(*), 6) AS value
FROM ({FACTS_SQL}) f, LATERAL (SELECT unnest(range(CAST(floor(epoch(f.started_at) / 3600) AS BIGINT) + 1, CAST(floor(epoch(f.started_at) / 3600) AS BIGINT) + 7)) AS t) GROUP BY f.agent, t""")
def sliding_kpi_stream(t):
    return finish(t, J.sliding_kpi_stream(streamed_copy(t, facts(t)), 360, 60), "complete")


@query("idle_sessions", """
SELECT session_id, started_at + INTERVAL 12 HOUR AS idle_at, turns FROM (SELECT user_id AS session_id, started_at, row_number() OVER w AS turns, lead(started_at) OVER w AS next_at
  FROM {spans} WHERE parent_span_id IS NULL WINDOW w AS (PARTITION BY user_id ORDER BY started_at, span_id))
WHERE turns >= 2 AND (next_at IS NULL OR next_at >= started_at + INTERVAL 12 HOUR)""")
def idle_sessions(t):
    turns = trees.roots(t.spans).select(F.col("user_id").alias("session_id"), "started_at")
    return finish(t, P.idle_sessions(ended_copy(t, turns, "started_at"), 12 * 3600))


@query("alert_stream", f'{ISLANDS} SELECT subject, kind, due AS "at" FROM e')
def alert_stream(t):
    value = F.when(F.col("runs") >= 2, F.col("value"))
    ticks = L.sliding_kpi(facts(t), 360, 60).select(
        F.lit("r1").alias("rule_id"), "subject", F.lit("tick").alias("kind"), F.col("tick").alias("at"), value.alias("value"),
        F.lit("gt").alias("operator"), F.lit(0.4).alias("threshold"), F.lit(120).alias("cooldown_minutes"),
    )
    return finish(t, J.alert_stream(streamed_copy(t, ticks))).select("subject", "kind", "at")


@query("assemble_chunks_stream", ASSEMBLED)
def assemble_chunks_stream(t):
    """Every second chunk is delivered twice; of two thirds of the calls no chunk says that it is the last."""
    final = t.chunks.groupBy("call_id").agg(F.max("seq").alias("final"))
    log = t.sql(CHUNK_LOG).join(final, "call_id").withColumns({
        "at": F.timestamp_seconds(F.lit(1704067200) + F.col("call_id") * 3600 + F.col("seq") * 400),
        "last": F.when(F.col("call_id") % 3 == 0, F.col("seq") == F.col("final")),
        "output_tokens": F.col("output_tokens").cast("long"),
    }).drop("final")
    out = finish(t, P.assemble_chunks_stream(ended_copy(t, log.unionByName(log.where("seq % 2 = 0")), "at"), slice_size=2))
    return out.select("call_id", "output", "model", "input_tokens", "output_tokens", "error")


SWEPT = """
SELECT s.span_id AS run_id, s.started_at FROM {spans} s WHERE s.span_kind = 'tool' AND NOT EXISTS (
  SELECT 1 FROM {spans} c WHERE c.parent_span_id = s.span_id AND c.started_at BETWEEN s.started_at AND s.started_at + INTERVAL 3600 SECOND)"""


def swept(t):
    starts = t.spans.where("span_kind = 'tool'").select(F.col("span_id").alias("run_id"), "started_at")
    ends = t.spans.where("parent_span_id IS NOT NULL").select(F.col("parent_span_id").alias("run_id"), F.col("started_at").alias("ended_at"))
    return P.ttl_sweep_stream(ended_copy(t, starts, "started_at"), ended_copy(t, ends, "ended_at"))


@query("ttl_sweep_stream", SWEPT)
def ttl_sweep_stream(t):
    return finish(t, swept(t)).select("run_id", "started_at")


@query("ttl_sweep_counts", f"""
SELECT CAST(floor(epoch(started_at + INTERVAL 3600 SECOND) / 86400) AS BIGINT) * 86400000 AS ts, count(*) AS n FROM ({SWEPT}) GROUP BY 1""")
def ttl_sweep_counts(t):
    """Dropped runs counted per day of their drop, in one stream behind the sweep."""
    return finish(t, P.dropped_counts(swept(t)))


RULES = [
    Rule("review-errors", "review", status="error", agent_ids=("agent-1", "agent-2")),
    Rule("keep-small", "dataset", model="m-small"),
    Rule("notify-large", "webhook", model="m-large", status="error"),
]
ROUTED = """
SELECT 'review-errors' AS rule_id, 'review' AS action, span_id FROM {spans} WHERE parent_span_id IS NULL AND error IS NOT NULL AND agent IN ('agent-1', 'agent-2')
UNION ALL SELECT 'keep-small', 'dataset', span_id FROM {spans} WHERE parent_span_id IS NULL AND model = 'm-small'
UNION ALL SELECT 'notify-large', 'webhook', span_id FROM {spans} WHERE parent_span_id IS NULL AND model = 'm-large' AND error IS NOT NULL"""


@query("route_rules", ROUTED)
def route_rules(t):
    roots = trees.roots(Streamed(t).spans).withColumn("output", F.lit(None).cast("string"))
    out = finish(t, roots, sink=lambda folder: J.route_sink(folder, RULES))
    return out.select("rule_id", "action", "span_id")


@query("signal_upsert", SIGNALS_SQL)
def signal_upsert(t):
    roots = Streamed(t).doc_roots.withColumn("parent_span_id", F.lit(None).cast("long"))
    return finish(t, J.monitor_stream(roots, PATTERNS, SOURCES), sink=J.signal_upsert).drop("epoch")


@query("downvote_stream", """
SELECT f.trace_id, s.agent, 'downvote' AS pattern_key, 'too slow' AS summary, f.created_at FROM {feedback} f JOIN {spans} s ON f.trace_id = s.span_id WHERE f.rating = 'down'""")
def downvote_stream(t):
    votes = Streamed(t).feedback.withColumn("comment", F.lit("too slow"))
    return finish(t, J.downvote_stream(votes, trees.roots(t.spans)))


@query("cursor_sync", "SELECT event_id, event_type FROM {events}")
def cursor_sync(t):
    """Two runs over the same source: the second finds nothing new."""
    folder = scratch(t.spark, "sync")
    source = Streamed(t).events.select("event_id", "event_type")
    for _ in range(2):
        J.cursor_sync(source, f"{folder}/out", f"{folder}/checkpoint")
    return t.spark.read.parquet(f"{folder}/out")


# -- callables ---------------------------------------------------------------------------------


def shout(case):
    if case["question_index"] % 7 == 3:
        raise ValueError("no answer")
    return {"output": case["query"].upper()}


@query("batch_infer", """
SELECT question_index, CASE WHEN question_index % 7 <> 3 THEN '{{"output": "' || upper(query) || '"}}' END AS raw, CASE WHEN question_index % 7 = 3 THEN 'ValueError' END AS error_type, CASE WHEN question_index % 7 = 3 THEN 'no answer' END AS error_message FROM {cases}""")
def batch_infer(t):
    return K.batch_infer(t.cases.select("question_index", "query"), shout).select("question_index", "raw", "error_type", "error_message")


def share_of_letter(input, output, expected, metadata, trace):
    if not output:
        return None
    return {"score": round(output.count("e") / len(output), 6), "name": "e-share"}


SHARE = "SELECT doc_id, CASE WHEN n_chars % 3 <> 0 THEN text END AS output FROM {documents}"


@query("code_scorer", f"""
SELECT doc_id, round((length(output) - length(replace(output, 'e', ''))) / nullif(length(output), 0), 6) AS score, coalesce(output, '') = '' AS skipped, CASE WHEN output <> '' THEN 'e-share' END AS label,
  coalesce(round((length(output) - length(replace(output, 'e', ''))) / nullif(length(output), 0), 6) < 0.1, false) AS alert FROM ({SHARE})""")
def code_scorer(t):
    return K.code_scorer(t.sql(SHARE), share_of_letter, 0.1).select("doc_id", "score", "skipped", "label", "alert")


def failing_share(spans):
    n = bad = 0
    for s in spans:
        n += 1
        bad += s["error"] is not None
    return {"score": bad / n, "matched": bad > 0}


@query("external_scorer", "SELECT trace_id, count(error) / count(*) AS score, count(error) = 0 AS matched FROM {spans} GROUP BY trace_id")
def external_scorer(t):
    return K.external_scorer(t.spans.select("trace_id", "span_id", "error"), failing_share, invert_match=True)


@query("dry_run", f"""
SELECT doc_id, round((length(output) - length(replace(output, 'e', ''))) / nullif(length(output), 0), 6) AS score, coalesce(round((length(output) - length(replace(output, 'e', ''))) / nullif(length(output), 0), 6) < 0.1, false) AS alert
FROM (SELECT * FROM ({SHARE}) ORDER BY doc_id LIMIT 10)""")
def dry_run(t):
    return K.dry_run(t.sql(SHARE).orderBy("doc_id"), share_of_letter, 10, 0.1).select("doc_id", "score", "alert")


@query("sampled_scoring", """
SELECT span_id, round((length(response) - length(replace(response, 'e', ''))) / nullif(length(response), 0), 6) AS score, coalesce(round((length(response) - length(replace(response, 'e', ''))) / nullif(length(response), 0), 6) < 0.1, false) AS alert
FROM {doc_roots} WHERE substr(md5(concat(CAST(span_id AS STRING), ':scorer-1')), 1, 8) < '4ccccccc'""")
def sampled_scoring(t):
    roots = t.doc_roots.select("span_id", F.col("response").alias("output"))
    return K.sampled_scoring(roots, "scorer-1", 0.3, share_of_letter, 0.1).select("span_id", "score", "alert")


class Failures:
    """Share of failing spans, the first failing one, and whether every span came in order."""

    def start(self):
        return {"n": 0, "bad": 0, "first": None, "root": None, "low": None, "high": None, "ordered": True}

    def step(self, state, span):
        root, at = span["parent_span_id"] != span["parent_span_id"], (span["started_at"], span["span_id"])
        if state["n"] == 0:
            state["root"] = root
        if not root:
            state["ordered"] &= state["high"] is None or state["high"] <= at
            state["low"], state["high"] = state["low"] or at, at
        state["n"] += 1
        if span["error"] is not None:
            state["bad"] += 1
            state["first"] = span["span_id"] if state["first"] is None else state["first"]
        return state

    def merge(self, left, right):
        apart = left["high"] is None or right["low"] is None or left["high"] <= right["low"]
        return {
            "n": left["n"] + right["n"], "bad": left["bad"] + right["bad"], "first": right["first"] if left["first"] is None else left["first"], "root": left["root"],
            "low": left["low"] or right["low"], "high": right["high"] or left["high"], "ordered": left["ordered"] and right["ordered"] and apart,
        }

    def finish(self, state):
        return {"score": state["bad"] / state["n"], "first_failed": state["first"], "roots_first": bool(state["root"]), "in_order": bool(state["ordered"])}


@query("reduce_traces", """
SELECT trace_id, count(error) / count(*) AS score, arg_min(span_id, struct_pack(a := parent_span_id IS NOT NULL, b := started_at, c := span_id)) FILTER (error IS NOT NULL) AS first_failed,
  bool_or(parent_span_id IS NULL) AS roots_first, true AS in_order FROM {spans} GROUP BY trace_id""")
def reduce_traces(t):
    """Traces are cut into slices of an hour, whose states are merged in order."""
    spans = t.spans.select("trace_id", "span_id", "parent_span_id", "started_at", "error")
    return K.reduce_traces(spans, Failures(), "score DOUBLE, first_failed BIGINT, roots_first BOOLEAN, in_order BOOLEAN", 3600)


@query("external_scorer_hits", "SELECT trace_id FROM {spans} GROUP BY trace_id HAVING count(error) > 2")
def external_scorer_hits(t):
    """Only traces that can match reach the Python stage."""
    bad = t.spans.where("error IS NOT NULL").groupBy("trace_id").count().where("count > 2")
    some = t.spans.join(bad, "trace_id", "left_semi").select("trace_id", "span_id", "error")
    return K.external_scorer(some, failing_share).where("matched").select("trace_id")
