"""Whole jobs."""

from pyspark.sql import functions as F

from catalog.base import query
from catalog.evaluation import jac
from catalog.monitoring import PATTERNS, WEEK
from catalog.streams import shout
from catalog.views import NOW
from spanquarry.plans import evaluation, monitoring


@query("evaluation_job", f"""
SELECT 'run-x' AS run_id, count(*) AS number_of_runs, round(avg(rating), 6) AS average_rating, min(rating) AS min_rating, max(rating) AS max_rating, round(avg(j), 6) AS average_jaccard
FROM (SELECT question_index % 11 AS rating, CASE WHEN question_index % 7 <> 3 AND expected_results <> '' THEN round({jac('upper(query)', 'expected_results')}, 6) END AS j FROM {{cases}}, (SELECT unnest([1, 2]) AS n) WHERE question_index % 4 <> 1 OR n <> 1)""")
def evaluation_job(t):
    cases = evaluation.run_cases(t.cases, 2, None, None, None)
    accepted = cases.where("question_index % 4 = 1 AND run_number = 1").select(
        F.concat(F.lit("run-x:"), "case_id", F.lit(":run-"), F.col("run_number").cast("string")).alias("idempotency_key")
    )
    results = evaluation.execute(cases, "run-x", shout, accepted)
    verdicts = results.select("idempotency_key", (F.col("question_index") % 11).alias("rating"))
    return evaluation.report(results, verdicts, {"jaccard": True}).select(
        "run_id", "number_of_runs", "average_rating", "min_rating", "max_rating", "average_jaccard"
    )


@query("monitoring_job", f"""
SELECT agent, count(*) AS total_runs, CAST(count(*) FILTER (error IS NOT NULL OR hit) AS BIGINT) AS failed_runs FROM (SELECT s.agent, s.error, d.text IS NOT NULL AND (regexp_matches(d.text, '[0-9][0-9][0-9]-[0-9][0-9]-[0-9][0-9][0-9][0-9]')
  OR regexp_matches(d.text, '[a-z0-9.]+@[a-z0-9]+[.][a-z]+')) AS hit FROM {{spans}} s LEFT JOIN {{documents}} d ON d.doc_id = s.span_id WHERE parent_span_id IS NULL AND s.source IS DISTINCT FROM 'eval-run' AND {WEEK}) GROUP BY agent""")
def monitoring_job(t):
    texts = t.documents.select(F.col("doc_id").alias("span_id"), F.col("text").alias("response"))
    out = monitoring.monitor(t.spans, texts, t.feedback, PATTERNS[:2], {"response": "response"}, NOW, 7 * 86400)
    return out["kpis"].where("scope = 'agent'").select("agent", "total_runs", "failed_runs")
