"""Calibration, evidence, registries, rankings and set operations."""

from pyspark.sql import functions as F

from catalog.base import query, view
from catalog.monitoring import SESSIONS, session_turns
from catalog.views import NOW
from spanquarry.operators import quality as Q
from spanquarry.operators import rankings as R
from spanquarry.operators import registry as G
from spanquarry.operators import trees

OUTCOMES = "SELECT trace_id AS subject_id, truth_bad FROM {verdicts} WHERE trace_id % 3 <> 1"
REVIEWS = """
SELECT trace_id AS subject_id, CASE WHEN trace_id % 5 = 0 THEN CASE WHEN corrected_score < 5 THEN 'bad' ELSE 'good' END END AS label FROM {verdicts} WHERE corrected_score IS NOT NULL"""
SCORES = "SELECT trace_id AS subject_id, rating FROM {verdicts} WHERE trace_id % 7 <> 2"
TRUTH = f"""
SELECT subject_id, arg_min(origin, k) AS origin, arg_min(truth_bad, k) AS truth_bad FROM (SELECT *, r * 2 + CASE WHEN truth_bad THEN 0 ELSE 1 END AS k FROM (
  SELECT subject_id, 'outcome' AS origin, 2 AS r, truth_bad FROM ({OUTCOMES}) UNION ALL SELECT trace_id, 'vote', 3, rating = 'down' FROM {{feedback}}
  UNION ALL SELECT subject_id, 'review', 1, label = 'bad' FROM ({REVIEWS}) WHERE label IS NOT NULL)) GROUP BY subject_id"""
PAIRS = f"SELECT t.*, v.rating < 5 AS judge_bad FROM ({TRUTH}) t LEFT JOIN ({SCORES}) v ON t.subject_id = v.subject_id"


def pairs(t):
    truths = Q.truth(t.sql(OUTCOMES), t.feedback, t.sql(REVIEWS))
    return Q.verdict_truth(t.sql(SCORES), truths)


@query("verdict_truth", PAIRS)
def verdict_truth(t):
    return pairs(t)


ALPHA = "CASE WHEN n >= 10 AND (2 * tp + fp + fn) * (2 * n - (2 * tp + fp + fn)) > 0 THEN 1 - (fp + fn) * (2 * n - 1) / ((2 * tp + fp + fn) * (2 * n - (2 * tp + fp + fn))) END"


@query("calibration", f"""
WITH c AS (SELECT count(judge_bad) AS n, count(*) FILTER (judge_bad AND truth_bad) AS tp, count(*) FILTER (judge_bad AND NOT truth_bad) AS fp, count(*) FILTER (NOT judge_bad AND truth_bad) AS fn,
  count(*) FILTER (NOT judge_bad AND NOT truth_bad) AS tn, count(*) FILTER (origin <> 'review') AS reported, count(*) FILTER (origin = 'review') AS review_labels, count(*) FILTER (judge_bad IS NULL) AS no_verdict FROM ({PAIRS})),
a AS (SELECT *, {ALPHA} AS al FROM c)
SELECT n AS compared, round((tp + tn) / nullif(n, 0), 6) AS agreement, round(fp / nullif(fp + tn, 0), 6) AS false_positive_rate, round(fn / nullif(fn + tp, 0), 6) AS false_negative_rate, round(al, 6) AS alpha,
  CASE WHEN al < 0 THEN 'poor' WHEN al <= 0.2 THEN 'slight' WHEN al <= 0.4 THEN 'fair' WHEN al <= 0.6 THEN 'moderate' WHEN al <= 0.8 THEN 'substantial' WHEN al IS NOT NULL THEN 'near-perfect' END AS alpha_band,
  CAST(reported AS BIGINT) AS reported, review_labels, no_verdict FROM a""")
def calibration(t):
    return Q.calibration(pairs(t))


@query("alpha_agg", f"""
WITH c AS (SELECT origin, count(judge_bad) AS n, count(*) FILTER (judge_bad AND truth_bad) AS tp, count(*) FILTER (judge_bad AND NOT truth_bad) AS fp, count(*) FILTER (NOT judge_bad AND truth_bad) AS fn FROM ({PAIRS}) GROUP BY origin)
SELECT origin, n AS compared, round({ALPHA}, 6) AS alpha FROM c""")
def alpha_agg(t):
    return Q.calibration(pairs(t), keys=("origin",)).select("origin", "compared", "alpha")


@query("rating_mae", "SELECT round(avg(abs(rating - corrected_score)), 6) AS mae, count(abs(rating - corrected_score)) AS n FROM {verdicts}")
def rating_mae(t):
    return Q.rating_mae(t.verdicts)


@query("tuning_delta", f"""
SELECT count(*) AS compared, CAST(count(*) FILTER (o <> b AND w = b) AS BIGINT) AS fixed, count(*) FILTER (o = b AND w <> b) AS broken, count(*) FILTER (o <> b AND w = b) - count(*) FILTER (o = b AND w <> b) AS net,
  count(*) FILTER (o <> b AND w = b) - count(*) FILTER (o = b AND w <> b) < 0 AS regressed
FROM (SELECT t.truth_bad AS b, v.rating < 5 AS o, v.rating < 7 AS w FROM ({TRUTH}) t JOIN {{verdicts}} v ON t.subject_id = v.trace_id)""")
def tuning_delta(t):
    truths = Q.truth(t.sql(OUTCOMES), t.feedback, t.sql(REVIEWS))
    old = t.verdicts.select(F.col("trace_id").alias("subject_id"), (F.col("rating") < 5).alias("judge_bad"))
    new = t.verdicts.select(F.col("trace_id").alias("subject_id"), (F.col("rating") < 7).alias("judge_bad"))
    return Q.tuning_delta(old, new, truths)


EVIDENCE = "SELECT doc_id AS row_id, concat('p', CAST(doc_id % 6 AS STRING)) AS prompt_id, CASE WHEN doc_id % 6 < 3 THEN doc_id % 4 ELSE doc_id % 97 END AS version, rating FROM {results}"
CURRENT = "SELECT prompt_id, max(version) AS current_version FROM (" + EVIDENCE + ") GROUP BY prompt_id"


@query("prompt_evidence", f"""
SELECT prompt_id, row_id, version, rating, pos FROM (SELECT *, row_number() OVER (PARTITION BY prompt_id ORDER BY rating, row_id) AS pos FROM (
  SELECT e.*, e.version = c.current_version AS cur, count(*) FILTER (e.version = c.current_version) OVER (PARTITION BY e.prompt_id) AS n FROM ({EVIDENCE}) e JOIN ({CURRENT}) c ON e.prompt_id = c.prompt_id)
  WHERE (cur OR n < 10) AND rating IS NOT NULL) WHERE pos <= 5""")
def prompt_evidence(t):
    return Q.prompt_evidence(t.sql(EVIDENCE), t.sql(CURRENT), 10, 5)


CALLS = "SELECT trace_id, concat('tool-', CAST(span_id % 9 AS STRING)) AS tool, error IS NULL AS success FROM {spans} WHERE span_kind = 'tool'"


@query("tool_evidence", f"""
SELECT DISTINCT tool, trace_id AS subject_id, 'failure' AS why FROM ({CALLS}) WHERE NOT success
UNION ALL SELECT DISTINCT c.tool, c.trace_id, 'low rating' FROM ({CALLS}) c JOIN {{verdicts}} v ON c.trace_id = v.trace_id WHERE v.rating <= 5""")
def tool_evidence(t):
    return Q.tool_evidence(t.sql(CALLS), t.verdicts)


CONFIRMED = "SELECT agent, started_at AS happened, span_id AS failure_id FROM {spans} WHERE error IS NOT NULL"
REPORTS = "SELECT agent, started_at AS sealed_at, span_id AS report_id FROM {spans} WHERE span_id % 100 = 56"


@query("confirmed_batches", f"""
SELECT agent, batch, count(*) AS failures, min(happened) AS first_at, batch = max(n) AS is_open FROM (SELECT c.agent, c.happened, CAST(count(r.report_id) AS BIGINT) AS batch,
  (SELECT count(*) FROM ({REPORTS}) x WHERE x.agent = c.agent) AS n FROM ({CONFIRMED}) c LEFT JOIN ({REPORTS}) r ON r.agent = c.agent AND r.sealed_at <= c.happened GROUP BY c.agent, c.happened, c.failure_id) GROUP BY agent, batch""")
def confirmed_batches(t):
    return Q.confirmed_batches(t.sql(CONFIRMED).withColumnRenamed("happened", "at"), t.sql(REPORTS))


SESSION_VERDICTS = f"""
SELECT r.session_id, CASE WHEN v.trace_id % 3 = 0 THEN 'policy' ELSE 'quality' END AS kind, v.rating, r.started_at AS scored_at, v.trace_id AS verdict_id
FROM {{verdicts}} v JOIN {SESSIONS} r ON v.trace_id = r.span_id"""


@query("latest_verdict", f"""
SELECT v.*, s.last_at, coalesce(s.last_at > v.scored_at, false) AS stale FROM (SELECT session_id, kind, arg_max(rating, struct_pack(a := scored_at, b := verdict_id)) AS rating, max(scored_at) AS scored_at FROM ({SESSION_VERDICTS}) GROUP BY session_id, kind) v
LEFT JOIN (SELECT session_id, max(started_at) AS last_at FROM {SESSIONS} GROUP BY session_id) s ON v.session_id = s.session_id""")
def latest_verdict(t):
    sessions = session_turns(t).groupBy("session_id").agg(F.max("started_at").alias("last_at"))
    return Q.latest_verdict(t.sql(SESSION_VERDICTS), sessions)


REVIEW_ITEMS = """
SELECT event_id AS item_id, event_id AS trace_id, ts AS queued_at, CASE event_id % 4 WHEN 0 THEN 'labeled' WHEN 1 THEN 'skipped' ELSE 'pending' END AS status, CASE WHEN event_id % 3 = 0 THEN 'manual' ELSE 'rule' END AS source
FROM {events} WHERE event_type = 'error'"""


@query("review_filter", f"SELECT item_id FROM ({REVIEW_ITEMS}) WHERE status = 'pending' AND source = 'rule'")
def review_filter(t):
    return Q.review_filter(t.sql(REVIEW_ITEMS), source="rule").select("item_id")


@query("review_counts", f"SELECT source, status, count(*) AS n FROM ({REVIEW_ITEMS}) GROUP BY source, status")
def review_counts(t):
    return Q.review_counts(t.sql(REVIEW_ITEMS))


@query("queue_newest", f"SELECT item_id, status FROM ({REVIEW_ITEMS}) ORDER BY queued_at DESC, item_id DESC LIMIT 100")
def queue_newest(t):
    return R.newest_first(t.sql(REVIEW_ITEMS), "queued_at", "item_id", 100).select("item_id", "status")


SCORER_LOG = "SELECT s.started_at AS scored_at, concat('scorer-', CAST(v.trace_id % 3 AS STRING)) AS scorer, v.trace_id, v.rating FROM {verdicts} v JOIN {spans} s ON v.trace_id = s.span_id"


@query("scorer_events", f"SELECT scored_at, scorer, trace_id, rating FROM ({SCORER_LOG}) WHERE scorer = 'scorer-1' AND scored_at >= TIMESTAMP '2024-01-01 00:00:00' AND scored_at < TIMESTAMP '2024-01-10 00:00:00'")
def scorer_events(t):
    return Q.scorer_events(t.sql(SCORER_LOG), "scorer-1", "2024-01-01", "2024-01-10")


@query("validate_enum", """
SELECT event_id, event_type IN ('click', 'view', 'purchase') AND event_type IS NOT NULL AS valid FROM {events}""")
def validate_enum(t):
    from spanquarry.sources.tables import valid_split

    good, bad = valid_split(t.events, F.col("event_type").isin("click", "view", "purchase"))
    return good.select("event_id", F.lit(True).alias("valid")).unionByName(bad.select("event_id", F.lit(False).alias("valid")))


@query("vote_trace", "SELECT f.trace_id, f.rating, f.created_at, s.agent FROM {feedback} f JOIN {spans} s ON f.trace_id = s.span_id")
def vote_trace(t):
    return t.feedback.join(t.spans.select(F.col("span_id").alias("trace_id"), "agent"), "trace_id")


# -- registries --------------------------------------------------------------------------------

AGENTS = "SELECT c_custkey AS agent_id, concat('agent-', CAST(c_custkey % 9 AS STRING)) AS name, TIMESTAMP '2024-01-01 00:00:00' + c_custkey % 50 * INTERVAL 1 DAY AS created_at FROM {customer} WHERE c_custkey % 9 < 5"


@query("oldest_by_name", f"SELECT name, arg_min(agent_id, struct_pack(a := created_at, b := agent_id)) AS agent_id, min(created_at) AS created_at FROM ({AGENTS}) GROUP BY name")
def oldest_by_name(t):
    return G.oldest_by_name(t.sql(AGENTS))


@query("resolve_agent", f"""
SELECT s.span_id, s.agent, a.agent_id FROM {{spans}} s LEFT JOIN (SELECT name, arg_min(agent_id, struct_pack(a := created_at, b := agent_id)) AS agent_id FROM ({AGENTS}) GROUP BY name) a ON s.agent = a.name""")
def resolve_agent(t):
    return G.resolve_agent(t.spans.select("span_id", "agent"), t.sql(AGENTS))


SEEN = "SELECT concat('tool-', CAST(l_partkey % 40 AS STRING)) AS name, CASE WHEN l_linenumber = 1 THEN concat('def ', CAST(l_partkey % 40 AS STRING)) END AS definition FROM {lineitem}"
KNOWN = "SELECT concat('tool-', CAST(n_nationkey AS STRING)) AS name, n_name AS definition, CAST(0.25E0 AS DOUBLE) AS price FROM {nation}"


@query("unregistered_tools", f"SELECT name, count(*) AS calls, max(definition) AS definition FROM ({SEEN}) WHERE name NOT IN (SELECT name FROM ({KNOWN})) GROUP BY name")
def unregistered_tools(t):
    return G.unregistered_tools(t.sql(SEEN), t.sql(KNOWN))


INCOMING = "SELECT concat('tool-', CAST(p_partkey % 60 AS STRING)) AS name, p_name AS definition, p_retailprice AS price, p_partkey AS arrival FROM {part}"


@query("register_if_absent", f"""
SELECT name, definition, price FROM ({KNOWN}) UNION ALL SELECT name, arg_min(definition, arrival), arg_min(price, arrival) FROM ({INCOMING}) WHERE name NOT IN (SELECT name FROM ({KNOWN})) GROUP BY name""")
def register_if_absent(t):
    return G.register_if_absent(t.sql(KNOWN), t.sql(INCOMING))


VERSIONS = "SELECT concat('id-', CAST(o_custkey AS STRING)) AS prompt_id, CASE WHEN o_custkey % 10 = 3 THEN 'id-7' ELSE concat('name-', CAST(o_custkey AS STRING)) END AS name, o_orderkey AS version, o_orderpriority AS text FROM {orders}"
WANTED = """
SELECT c_custkey AS request_id, CASE WHEN c_custkey % 2 = 0 THEN concat('id-', CAST(c_custkey AS STRING)) WHEN c_custkey % 7 = 0 THEN 'id-7' ELSE concat('name-', CAST(c_custkey AS STRING)) END AS key,
  CASE WHEN c_custkey % 5 = 0 THEN c_custkey * 10 END AS version FROM {customer}"""


@query("version_lookup", f"""
SELECT request_id, max(version) AS version, arg_max(text, version) AS text FROM (SELECT w.request_id, w.version AS asked, v.version, v.text, CASE WHEN w.key = v.name THEN 0 ELSE 1 END AS p,
  min(CASE WHEN w.key = v.name THEN 0 ELSE 1 END) OVER (PARTITION BY w.request_id) AS best FROM ({WANTED}) w JOIN ({VERSIONS}) v ON w.key = v.name OR w.key = v.prompt_id)
WHERE p = best AND (asked IS NULL OR asked = version) GROUP BY request_id""")
def version_lookup(t):
    return G.version_lookup(t.sql(VERSIONS), t.sql(WANTED))


LOG = "SELECT o_orderkey AS entry_id, concat('prompt-', CAST(o_custkey AS STRING)) AS name, o_orderdate AS published_at, o_orderpriority AS text FROM {orders}"


@query("version_number", f"SELECT entry_id, name, row_number() OVER w AS version, lag(text) OVER w AS prev_text FROM ({LOG}) WINDOW w AS (PARTITION BY name ORDER BY published_at, entry_id)")
def version_number(t):
    return G.version_number(t.sql(LOG)).select("entry_id", "name", "version", "prev_text")


ENABLED = "SELECT concat('k', CAST(p_partkey % 300 AS STRING)) AS key FROM {part} WHERE p_partkey % 2 = 0"
GIVEN = "SELECT concat('k', CAST(p_partkey % 300 AS STRING)) AS key FROM {part} WHERE p_partkey % 3 = 0"


@query("enable_keys", f"SELECT key FROM ({ENABLED}) UNION SELECT key FROM ({GIVEN})")
def enable_keys(t):
    return G.enable_keys(t.sql(ENABLED), t.sql(GIVEN))


@query("disable_keys", f"SELECT key FROM ({ENABLED}) EXCEPT SELECT key FROM ({GIVEN})")
def disable_keys(t):
    return G.disable_keys(t.sql(ENABLED), t.sql(GIVEN))


@query("missing_columns", "SELECT count(*) AS n_rows, 'expected_results,query' AS missing FROM {documents}")
def missing_columns(t):
    missing = G.missing_columns(t.documents, {"query", "expected_results", "text"})
    return t.documents.agg(F.count("*").alias("n_rows")).withColumn("missing", F.lit(",".join(missing)))


@query("template_split", "SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'template' ELSE 'custom' END AS kind FROM {part}")
def template_split(t):
    patterns = t.part.withColumn("source", F.when(F.col("p_size") % 2 == 0, "builtin").otherwise("user"))
    return G.template_split(patterns).select("p_partkey", "kind")


@query("union_sources", """
SELECT CAST(span_id AS STRING) AS span_id, agent AS name, error, NULL AS session_id FROM {spans} UNION ALL SELECT concat('mw:', CAST(interaction_id AS STRING)), domain, NULL, concat('mw_', CAST(conversation_id AS STRING)) FROM {interactions}""")
def union_sources(t):
    a = t.spans.select(F.col("span_id").cast("string").alias("span_id"), F.col("agent").alias("name"), "error")
    b = t.interactions.select(
        F.concat(F.lit("mw:"), F.col("interaction_id").cast("string")).alias("span_id"),
        F.col("domain").alias("name"),
        F.concat(F.lit("mw_"), F.col("conversation_id").cast("string")).alias("session_id"),
    )
    return G.union_sources(a, b)


# -- rankings ----------------------------------------------------------------------------------


@query("worst_first", "SELECT trace_id, rating FROM {verdicts} WHERE rating IS NOT NULL ORDER BY rating, trace_id LIMIT 25")
def worst_first(t):
    return R.worst_first(t.verdicts, 25).select("trace_id", "rating")


@query("low_scoring", "SELECT doc_id, rating FROM {results} WHERE rating <= 5 ORDER BY doc_id LIMIT 5")
def low_scoring(t):
    return R.low_scoring(t.results, "doc_id", 5.0, 5).select("doc_id", "rating")


@query("recs_by_priority", """
SELECT doc_id, CAST(CASE source WHEN 'src1' THEN 0 WHEN 'src2' THEN 1 ELSE 2 END AS BIGINT) AS rank FROM {documents}""")
def recs_by_priority(t):
    priority = F.when(F.col("source") == "src1", "high").when(F.col("source") == "src2", "medium").when(F.col("source") == "src3", "low")
    recs = t.documents.select("doc_id", priority.alias("priority"), F.col("doc_id").alias("pos"))
    return R.recs_by_priority(recs).select("doc_id", "rank")


@query("traces_page", """
SELECT span_id, started_at FROM {spans} WHERE parent_span_id IS NULL AND framework IS NULL AND (started_at, span_id) < (TIMESTAMP '2024-01-20 00:00:00', 100000) ORDER BY started_at DESC, span_id DESC LIMIT 50""")
def traces_page(t):
    unlabelled = trees.roots(t.spans).where("framework IS NULL")
    return R.traces_page(unlabelled, 50, ("2024-01-20 00:00:00", 100000)).select("span_id", "started_at")


@query("session_spans", "SELECT span_id, started_at FROM {spans} WHERE user_id = 5")
def session_spans(t):
    return R.oldest_first(t.spans.where("user_id = 5"), "started_at", "span_id").select("span_id", "started_at")


@query("scores_newest", f"SELECT verdict_id, rating, scored_at FROM ({SESSION_VERDICTS}) WHERE session_id IN (1, 2, 3, 4, 5, 6, 7, 8)")
def scores_newest(t):
    mine = t.sql(SESSION_VERDICTS).where("session_id BETWEEN 1 AND 8")
    return R.newest_first(mine, "scored_at", "verdict_id").select("verdict_id", "rating", "scored_at")


@query("votes_oldest", "SELECT trace_id, rating, created_at FROM {feedback}")
def votes_oldest(t):
    return R.oldest_first(t.feedback, "created_at", "trace_id")


@query("gates_newest", "SELECT run_id, finished_at FROM {runs}")
def gates_newest(t):
    return R.newest_first(t.runs, "finished_at", "run_id").select("run_id", "finished_at")


@query("get_by_id", "SELECT span_id, agent, latency_ms FROM {spans} WHERE span_id = 64")
def get_by_id(t):
    return R.get_by_id(t.spans, "span_id", 64).select("span_id", "agent", "latency_ms")


BATCHES = "SELECT o_orderkey AS batch_id, o_custkey AS run_a_id, o_orderkey % 7 AS run_b_id, o_orderdate AS created_at FROM {orders}"


@query("pairwise_recent", f"SELECT batch_id, run_a_id FROM ({BATCHES}) WHERE run_b_id = 3")
def pairwise_recent(t):
    return R.pairwise_recent(t.sql(BATCHES), run_b=3).select("batch_id", "run_a_id")
