"""Evaluation runs, statistics, gates and scores."""

from pyspark.sql import functions as F

from catalog.base import query, view
from spanquarry.functions import python_scoring, text
from spanquarry.operators import evaluation as EV
from spanquarry.operators import scoring as SC

# A nested dataset per source: its documents are the questions.
view("datasets", """
SELECT c_nationkey AS dataset_id, 1 + c_nationkey % 3 AS number_of_requests, c_nationkey % 2 = 0 AS models_enabled,
       c_custkey, c_name, c_mktsegment
FROM {customer}
""")

# Results of every run with texts: the answer is a document, the expectation the next one of its run.
view("answers", """
SELECT r.run_id, r.question_index, r.doc_id, r.model, r.status, r.rating, r.is_smoke_test_variant, d.text AS output,
       CASE WHEN r.doc_id % 6 = 1 THEN '' ELSE e.text END AS expected,
       CASE WHEN r.status = 'failed' THEN 'boom' END AS error, d.n_chars AS latency_ms, r.doc_id * 3 AS input_tokens, r.doc_id AS output_tokens
FROM {results} r JOIN {documents} d ON r.doc_id = d.doc_id LEFT JOIN {documents} e ON e.doc_id = r.doc_id + 4
""")

CASE_COLS = "case_id, question_index, run_number, model, query, expected_results, is_smoke_test_variant"
EXPANDED = """
SELECT concat('case-', CAST(question_index AS STRING), CASE WHEN m IS NOT NULL THEN '::' || m ELSE '' END) AS case_id, question_index,
  CAST(n AS BIGINT) AS run_number, m AS model, query, expected_results, false AS is_smoke_test_variant
FROM {cases}, (SELECT unnest([1, 2, 3]) AS n), (SELECT unnest(['m1', 'm2']) AS m)"""
SMOKE = """
SELECT concat('case-', CAST(question_index AS STRING)) AS case_id, question_index, CAST(3 + i + 1 AS BIGINT) AS run_number, CAST(NULL AS STRING) AS model,
  concat(query, ' v', CAST(i AS STRING)) AS query, expected_results, true AS is_smoke_test_variant
FROM {cases}, (SELECT unnest([0, 1]) AS i) WHERE question_index % 3 = 0"""


def smoke_variants(t):
    pair = F.array(F.concat("query", F.lit(" v0")), F.concat("query", F.lit(" v1")))
    return t.cases.where("question_index % 3 = 0").select("question_index", pair.alias("variants"))


def run_cases(t):
    return EV.expand_cases(t.cases, 3, ["m1", "m2"]).unionByName(EV.expand_smoke(t.cases, smoke_variants(t), 3))


@query("case_flatten", """
SELECT dataset_id, greatest(number_of_requests, 1) AS n_runs, CASE WHEN models_enabled THEN 'm1,m2' END AS models, CAST(1 AS BIGINT) AS question_index, c_mktsegment AS query
FROM {datasets} UNION ALL SELECT dataset_id, greatest(number_of_requests, 1), CASE WHEN models_enabled THEN 'm1,m2' END, CAST(0 AS BIGINT), c_name FROM {datasets}""")
def case_flatten(t):
    questions = F.array(F.struct(F.col("c_name").alias("query")), F.struct(F.col("c_mktsegment").alias("query")))
    nested = t.datasets.withColumn("models", F.array(F.lit("m1"), F.lit("m2"))).withColumn("questions", questions)
    return EV.case_flatten(nested).withColumn("models", F.array_join("models", ","))


@query("split_filter", "SELECT question_index, query FROM {cases} WHERE list_contains(splits, 'smoke')")
def split_filter(t):
    return EV.split_filter(t.cases, "smoke").select("question_index", "query")


@query("expand_cases", EXPANDED)
def expand_cases(t):
    return EV.expand_cases(t.cases, 3, ["m1", "m2"])


@query("expand_smoke", SMOKE)
def expand_smoke(t):
    return EV.expand_smoke(t.cases, smoke_variants(t), 3)


@query("run_counts", f"""
SELECT count(DISTINCT question_index) AS questions, max(run_number) FILTER (NOT is_smoke_test_variant) AS repeats,
  CAST(count(*) FILTER (is_smoke_test_variant) AS BIGINT) AS smoke_variants, count(*) AS cases FROM ({EXPANDED} UNION ALL {SMOKE})""")
def run_counts(t):
    return EV.run_counts(run_cases(t))


ACCEPTED = "question_index % 2 = 0"


@query("resume_pending", f"SELECT concat('r:', case_id, ':run-', CAST(run_number AS STRING)) AS k FROM ({EXPANDED} UNION ALL {SMOKE}) WHERE NOT ({ACCEPTED})")
def resume_pending(t):
    cases = run_cases(t)
    accepted = cases.where(ACCEPTED).select(EV.idempotency_key(F.lit("r"), F.col("case_id"), F.col("run_number")).alias("idempotency_key"))
    return EV.resume_pending(cases, "r", accepted).select(F.col("idempotency_key").alias("k"))


@query("pending_cases", f"SELECT concat('r:', case_id, ':run-', CAST(run_number AS STRING)) AS k FROM ({EXPANDED} UNION ALL {SMOKE}) WHERE NOT ({ACCEPTED})")
def pending_cases(t):
    keys = run_cases(t).select("question_index", EV.idempotency_key(F.lit("r"), F.col("case_id"), F.col("run_number")).alias("k"))
    return keys.select("k").exceptAll(keys.where(ACCEPTED).select("k"))


PRIOR = """
SELECT concat('q', CAST(question_index AS STRING)) AS query, CASE WHEN doc_id % 3 = 0 THEN 0 ELSE 1 + doc_id % 2 END AS run_number, is_smoke_test_variant,
  CASE WHEN doc_id % 7 = 0 THEN '' ELSE concat('out', CAST(doc_id AS STRING)) END AS output, CAST(CASE WHEN doc_id % 5 = 0 THEN 'boom' END AS STRING) AS error, status, doc_id AS pos FROM {results}"""
FIT = "error IS NULL AND status <> 'failed' AND output <> '' AND query <> ''"


@query("reusable_rows", f"SELECT query, output FROM ({PRIOR}) WHERE {FIT}")
def reusable_rows(t):
    return EV.reusable_rows(t.sql(PRIOR)).select("query", "output")


@query("reuse_outputs", f"""
SELECT e.*, c.cached_output FROM ({EXPANDED}) e LEFT JOIN (SELECT query, coalesce(nullif(run_number, 0), 1) AS rn, is_smoke_test_variant AS s, arg_max(output, pos) AS cached_output
  FROM ({PRIOR}) WHERE {FIT} GROUP BY ALL) c ON e.query = c.query AND e.run_number = c.rn AND e.is_smoke_test_variant = c.s""")
def reuse_outputs(t):
    return EV.reuse_outputs(EV.expand_cases(t.cases, 3, ["m1", "m2"]), t.sql(PRIOR))


OUTPUTS = """
SELECT concat('case-', CAST(item_id AS STRING)) AS key, CASE WHEN item_id % 2 = 0 THEN '' ELSE concat('by id ', text) END AS value FROM {benchmark} WHERE item_id % 4 <> 3
UNION ALL SELECT CAST(item_id AS STRING), concat('by index ', text) FROM {benchmark} WHERE item_id % 3 <> 2"""


@query("precomputed_match", f"""
SELECT e.*, coalesce(nullif(a.value, ''), b.value, '') AS raw_output FROM ({EXPANDED} UNION ALL {SMOKE}) e
LEFT JOIN ({OUTPUTS}) a ON e.case_id = a.key LEFT JOIN ({OUTPUTS}) b ON CAST(e.question_index AS STRING) = b.key""")
def precomputed_match(t):
    return EV.precomputed_match(run_cases(t), t.sql(OUTPUTS))


@query("precomputed_source", f"""
SELECT case_id, run_number, raw_output AS text, CASE WHEN trim(raw_output) = '' THEN 'EmptyOutput' END AS error_type FROM (SELECT e.case_id, e.run_number, coalesce(nullif(a.value, ''), b.value, '') AS raw_output FROM ({EXPANDED} UNION ALL {SMOKE}) e
LEFT JOIN ({OUTPUTS}) a ON e.case_id = a.key LEFT JOIN ({OUTPUTS}) b ON CAST(e.question_index AS STRING) = b.key)""")
def precomputed_source(t):
    """Stored answers as a source of results: a case without one is a failed row."""
    from spanquarry.functions.normalize import normalize_result

    found = EV.precomputed_match(run_cases(t), t.sql(OUTPUTS))
    raw = found.select("case_id", "run_number", F.to_json(F.struct(F.col("raw_output").alias("output"))).alias("raw"))
    return normalize_result(raw).select("case_id", "run_number", "r.text", "r.error_type")


@query("batch_no", "SELECT doc_id, (row_number() OVER (PARTITION BY run_id ORDER BY question_index, doc_id) - 1) // 10 AS batch_no FROM {results}")
def batch_no(t):
    return EV.batch_no(t.results, "run_id", ["question_index", "doc_id"], slice_size=100).select("doc_id", "batch_no")


BATCH = """
SELECT concat(run_id, ':', CAST(question_index AS STRING)) AS idempotency_key, doc_id AS arrival, CASE WHEN doc_id % 11 = 4 THEN ' ' ELSE 'x' END AS output,
  CAST(CASE WHEN doc_id % 22 = 4 THEN 'boom' END AS STRING) AS error FROM {results}
UNION ALL SELECT concat(run_id, ':', CAST(question_index AS STRING)), doc_id + 1000000000, 'again', CAST(NULL AS STRING) FROM {results} WHERE doc_id % 3 = 0"""
STORED = "SELECT concat(run_id, ':', CAST(question_index AS STRING)) AS idempotency_key FROM {results} WHERE doc_id % 5 = 0"


@query("append_results", f"""
WITH b AS ({BATCH}), s AS ({STORED}), v AS (SELECT *, trim(output) = '' AND error IS NULL AS invalid, idempotency_key IN (SELECT idempotency_key FROM s) AS known FROM b)
SELECT idempotency_key, arrival, CASE WHEN known THEN 'duplicate' WHEN invalid THEN 'invalid'
  WHEN arrival > min(arrival) FILTER (NOT invalid) OVER (PARTITION BY idempotency_key) THEN 'duplicate' ELSE 'accepted' END AS outcome FROM v""")
def append_results(t):
    from spanquarry.sources.tables import append_results as append

    return append(t.sql(STORED), t.sql(BATCH)).select("idempotency_key", "arrival", "outcome")


@query("live_stats", """
SELECT run_id, round(avg(rating), 6) AS average_rating, min(rating) AS min_rating, max(rating) AS max_rating, CAST(count(*) FILTER (status = 'scored') AS BIGINT) AS rated,
  count(*) FILTER (status = 'skipped') AS skipped, count(*) FILTER (status = 'failed') AS failed FROM {results} GROUP BY run_id""")
def live_stats(t):
    return EV.live_stats(t.results)


TOK = "list_distinct(regexp_extract_all(lower({0}), '[\\p{{{{L}}}}\\p{{{{N}}}}]+'))"


def jac(a, b):
    ta, tb = TOK.format(a), TOK.format(b)
    return f"(CASE WHEN len(list_distinct(list_concat({ta}, {tb}))) > 0 THEN len(list_intersect({ta}, {tb})) / len(list_distinct(list_concat({ta}, {tb}))) END)"


SCORED = f"""
SELECT *, CASE WHEN coalesce(expected, '') <> '' AND error IS NULL THEN round({jac('output', 'expected')}, 6) END AS jaccard FROM {{answers}}"""


def scored(t):
    return SC.similarity_enabled(t.answers, {"jaccard": True}, ("jaccard",))


@query("report_stats", f"""
SELECT run_id, count(*) AS number_of_runs, round(avg(rating), 6) AS average_rating, min(rating) AS min_rating, max(rating) AS max_rating, round(avg(jaccard), 6) AS average_jaccard
FROM ({SCORED}) WHERE NOT is_smoke_test_variant GROUP BY run_id""")
def report_stats(t):
    return EV.report_stats(scored(t).where(~F.col("is_smoke_test_variant")))


# vectors of an answer and of what was expected, as the answers' documents and those four further on
VECTORED = f"""
SELECT s.*, CASE WHEN s.jaccard IS NOT NULL THEN list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda z: z[1]::DOUBLE * z[2]::DOUBLE))
  / (sqrt(list_sum(list_transform(a.embedding, lambda x: x::DOUBLE * x::DOUBLE))) * sqrt(list_sum(list_transform(b.embedding, lambda x: x::DOUBLE * x::DOUBLE)))) END AS cosine
FROM ({SCORED}) s LEFT JOIN {{embeddings}} a ON a.vec_id = s.doc_id LEFT JOIN {{embeddings}} b ON b.vec_id = s.doc_id + 4"""


def vectored(t):
    a = t.embeddings.select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("va"))
    b = t.embeddings.select((F.col("vec_id") - 4).alias("doc_id"), F.col("embedding").alias("vb"))
    both = scored(t).join(a, "doc_id", "left").join(b, "doc_id", "left")
    return both.withColumn("cosine", F.when(F.col("jaccard").isNotNull(), text.cosine(F.col("va"), F.col("vb")))).drop("va", "vb")


@query("report_metrics", f"""
SELECT run_id, count(*) AS number_of_runs, round(avg(rating), 6) AS average_rating, min(rating) AS min_rating, max(rating) AS max_rating, round(avg(cosine), 6) AS average_cosine, round(avg(jaccard), 6) AS average_jaccard
FROM ({VECTORED}) WHERE NOT is_smoke_test_variant GROUP BY run_id""")
def report_metrics(t):
    return EV.report_stats(vectored(t).where(~F.col("is_smoke_test_variant")))


@query("model_matrix", f"""
SELECT model, count(*) AS runs, round(avg(rating), 6) AS average_rating, min(rating) AS min_rating, max(rating) AS max_rating, round(var_pop(rating), 6) AS rating_variance,
  round(avg(jaccard), 6) AS average_jaccard, round(avg(latency_ms), 6) AS average_latency_ms, CAST(sum(input_tokens) AS BIGINT) AS input_tokens, CAST(sum(output_tokens) AS BIGINT) AS output_tokens,
  model = 'm-small' AS is_baseline FROM ({SCORED}) GROUP BY model""")
def model_matrix(t):
    return EV.model_matrix(scored(t), "m-small")


JUDGED = """
SELECT run_id, concat('judge-', CAST(doc_id % 3 AS STRING)) AS scorer, rating AS score FROM {results}
UNION ALL SELECT run_id, 'safety', CASE WHEN doc_id % 2 = 0 THEN rating / 2 END FROM {results}"""


@query("scorer_breakdown", f"SELECT run_id, scorer, round(avg(score), 6) AS average_score, count(score) AS n FROM ({JUDGED}) GROUP BY run_id, scorer")
def scorer_breakdown(t):
    return EV.scorer_breakdown(t.sql(JUDGED))


# Runs of datasets: every order is a run of its customer's dataset, its average from its total price.
view("runs", """
SELECT o_orderkey AS run_id, o_custkey AS dataset_id, o_orderdate AS finished_at, CASE WHEN o_orderstatus = 'O' THEN 'running' ELSE 'completed' END AS status,
       CASE WHEN o_orderkey % 9 <> 0 THEN CAST(floor(o_totalprice) AS BIGINT) % 100 / 10.0E0 END AS average_rating, concat('v', CAST(o_orderkey % 3 AS STRING)) AS version
FROM {orders}
""")
PREV = """
SELECT *, last_value(CASE WHEN status = 'completed' THEN struct_pack(r := run_id, a := average_rating) END IGNORE NULLS) OVER (PARTITION BY dataset_id ORDER BY finished_at, run_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM {runs}"""


@query("baseline_run", f"SELECT run_id, p.r AS baseline_run_id, p.a AS baseline_average FROM ({PREV})")
def baseline_run(t):
    return EV.previous_runs(t.runs).select("run_id", "baseline_run_id", "baseline_average")


@query("prev_run", f"SELECT run_id, dataset_id, p.r AS prev_run_id FROM ({PREV}) WHERE status = 'completed'")
def prev_run(t):
    return EV.previous_runs(t.runs).where("status = 'completed'").select("run_id", "dataset_id", F.col("baseline_run_id").alias("prev_run_id"))


GATE = f"""
SELECT run_id, 'fail-under' AS check_name, coalesce(average_rating >= 4, false) AS passed, CASE WHEN average_rating IS NULL THEN 'no rating' WHEN average_rating >= 4 THEN 'at or above the floor' ELSE 'below the floor' END AS detail FROM {{runs}}
UNION ALL SELECT run_id, 'no-regression', CASE WHEN p.a IS NULL THEN true ELSE coalesce(average_rating >= p.a - 0.5, false) END,
  CASE WHEN p.a IS NULL THEN 'no baseline' WHEN average_rating >= p.a - 0.5 THEN 'within tolerance' ELSE 'regressed' END FROM ({PREV})"""


@query("run_gate", GATE)
def run_gate(t):
    return EV.run_gate(EV.previous_runs(t.runs), fail_under=4.0, no_regression=True)


@query("gate_verdict", f"SELECT run_id, bool_and(passed) AS passed, CAST(CASE WHEN bool_and(passed) THEN 0 ELSE 1 END AS BIGINT) AS exit_code FROM ({GATE}) GROUP BY run_id")
def gate_verdict(t):
    return EV.gate_verdict(EV.run_gate(EV.previous_runs(t.runs), fail_under=4.0, no_regression=True))


@query("version_compare", """
SELECT dataset_id, version, round(sum(rating_sum) / nullif(sum(rating_n), 0), 6) AS average_rating, CAST(sum(rating_n) AS BIGINT) AS n FROM
  (SELECT dataset_id, version, average_rating AS rating_sum, CASE WHEN average_rating IS NULL THEN 0 ELSE 1 END AS rating_n FROM {runs}) GROUP BY dataset_id, version""")
def version_compare(t):
    stats = t.runs.groupBy("run_id").agg(F.sum("average_rating").alias("rating_sum"), F.count("average_rating").alias("rating_n"))
    return EV.version_compare(stats, t.runs.select("run_id", "dataset_id", "version"))


LIMITS = {"rating": 5.0, "jaccard": 0.05}


@query("threshold_violations", f"""
SELECT doc_id, 'rating' AS metric, CAST(rating AS DOUBLE) AS value, 5.0::DOUBLE AS limit_value FROM ({SCORED}) WHERE rating < 5
UNION ALL SELECT doc_id, 'jaccard', jaccard, 0.05::DOUBLE FROM ({SCORED}) WHERE jaccard < 0.05""")
def threshold_violations(t):
    return EV.threshold_violations(scored(t), LIMITS, ["doc_id"])


@query("ci_gate", f"""
SELECT run_id, count(*) AS scored, CAST(count(*) FILTER (bad) AS BIGINT) AS violating, round(count(*) FILTER (NOT bad) / count(*), 6) AS pass_rate, count(*) FILTER (NOT bad) / count(*) >= 0.6 AS passed,
  min(question_index) FILTER (bad) AS first_failing_question FROM (SELECT *, coalesce(rating < 5, false) OR coalesce(jaccard < 0.05, false) AS bad FROM ({SCORED})) GROUP BY run_id""")
def ci_gate(t):
    return EV.ci_gate(scored(t), LIMITS, 0.6)


@query("pair_runs", """
SELECT coalesce(a.question_index, b.question_index) AS question_index, CAST(1 AS BIGINT) AS run_number, a.output AS output_a, b.output AS output_b,
  CASE WHEN a.question_index IS NULL THEN 'missing in A' WHEN b.question_index IS NULL THEN 'missing in B' END AS skipped
FROM (SELECT question_index, output FROM {answers} WHERE run_id = 'run-0') a FULL JOIN (SELECT question_index, output FROM {answers} WHERE run_id = 'run-1') b ON a.question_index = b.question_index""")
def pair_runs(t):
    a = t.answers.withColumn("run_number", F.lit(1).cast("long"))
    return EV.pair_runs(a.where("run_id = 'run-0'"), a.where("run_id = 'run-1'"))


@query("presentation_order", """
SELECT doc_id, CASE WHEN row_number() OVER (PARTITION BY run_id ORDER BY question_index, doc_id) % 2 = 1 THEN 'A' ELSE 'B' END AS presented_first FROM {results}""")
def presentation_order(t):
    pairs = t.results.withColumn("run_number", F.col("doc_id"))
    return EV.presentation_order(pairs, "run_id", slice_size=100).select("doc_id", "presented_first")


PAIRWISE = """
SELECT doc_id % 12 AS batch_id, CASE doc_id % 5 WHEN 0 THEN 'tie' WHEN 1 THEN 'A' WHEN 2 THEN 'B' ELSE CASE WHEN quality = 1 THEN 'A' ELSE 'B' END END AS winner,
  CASE WHEN doc_id % 12 < 8 THEN CASE doc_id % 7 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE CASE doc_id % 5 WHEN 0 THEN 'tie' WHEN 1 THEN 'A' ELSE 'B' END END END AS winner_swapped
FROM {labels}"""
SUMMARY = f"""
SELECT *, CASE WHEN a_wins > b_wins THEN 'A' WHEN b_wins > a_wins THEN 'B' ELSE 'tie' END AS winner FROM (SELECT batch_id, count(*) AS total, CAST(count(*) FILTER (f = 'A') AS BIGINT) AS a_wins,
  count(*) FILTER (f = 'B') AS b_wins, count(*) FILTER (f = 'tie') AS ties, round(count(*) FILTER (winner <> winner_swapped) / nullif(count(winner_swapped), 0), 6) AS flip_rate
  FROM (SELECT *, CASE WHEN winner_swapped IS NULL OR winner = winner_swapped THEN winner ELSE 'tie' END AS f FROM ({PAIRWISE})) GROUP BY batch_id)"""


@query("pairwise_summary", SUMMARY)
def pairwise_summary(t):
    return EV.pairwise_summary(t.sql(PAIRWISE))


@query("pairwise_assert", f"""
SELECT batch_id, 'must_win' AS failed_check FROM ({SUMMARY}) WHERE winner <> 'A' UNION ALL SELECT batch_id, 'max_losses' FROM ({SUMMARY}) WHERE b_wins > 8
UNION ALL SELECT batch_id, 'max_flip_rate' FROM ({SUMMARY}) WHERE flip_rate > 0.2""")
def pairwise_assert(t):
    return EV.pairwise_assert(EV.pairwise_summary(t.sql(PAIRWISE)), must_win="A", max_losses=8, max_flip_rate=0.2)


# -- scores ------------------------------------------------------------------------------------


@query("jaccard", f"SELECT conv_id, turn, round({jac('candidate', 'reference')}, 6) AS score FROM {{text_pairs}}")
def jaccard(t):
    return t.text_pairs.select("conv_id", "turn", F.round(text.jaccard(F.col("candidate"), F.col("reference")), 6).alias("score"))


@query("token_overlap", f"SELECT doc_id, len(list_intersect({TOK.format('output')}, {TOK.format('expected')})) AS both_n, len(list_distinct(list_concat({TOK.format('output')}, {TOK.format('expected')}))) AS either_n FROM {{answers}} WHERE expected IS NOT NULL")
def token_overlap(t):
    both, either = text.token_overlap(text.tokens(F.col("output")), text.tokens(F.col("expected")))
    return t.answers.where("expected IS NOT NULL").select("doc_id", both.alias("both_n"), either.alias("either_n"))


PAIR_TOKENS = "SELECT conv_id, turn, regexp_extract_all(lower(candidate), '[\\p{{L}}\\p{{N}}]+') AS c, regexp_extract_all(lower(reference), '[\\p{{L}}\\p{{N}}]+') AS r FROM {text_pairs}"


@query("bleu4", f"""
WITH p AS ({PAIR_TOKENS}), n AS (SELECT unnest([1, 2, 3, 4]) AS n),
cg AS (SELECT conv_id, turn, n, array_to_string(c[i:i + n - 1], ' ') AS g, count(*) AS k FROM (SELECT *, unnest(range(1, greatest(len(c) - n + 2, 1))) AS i FROM p, n) GROUP BY ALL),
rg AS (SELECT conv_id, turn, n, array_to_string(r[i:i + n - 1], ' ') AS g, count(*) AS k FROM (SELECT *, unnest(range(1, greatest(len(r) - n + 2, 1))) AS i FROM p, n) GROUP BY ALL),
m AS (SELECT cg.conv_id, cg.turn, cg.n, sum(least(cg.k, coalesce(rg.k, 0))) AS matched, sum(cg.k) AS total FROM cg LEFT JOIN rg USING (conv_id, turn, n, g) GROUP BY ALL),
s AS (SELECT conv_id, turn, count(*) AS orders, min(matched) AS worst, sum(ln(greatest(matched, 0.5) / total)) / 4 AS l FROM m GROUP BY ALL)
SELECT conv_id, turn, round(CASE WHEN coalesce(orders, 0) < 4 OR worst = 0 THEN 0.0 ELSE exp(l) * CASE WHEN len(c) >= len(r) THEN 1 ELSE exp(1 - len(r) / len(c)) END END, 6) AS score
FROM p LEFT JOIN s USING (conv_id, turn)""")
def bleu4(t):
    score = python_scoring.bleu4(text.tokens(F.col("candidate")), text.tokens(F.col("reference")))
    return t.text_pairs.select("conv_id", "turn", F.round(score, 6).alias("score"))


@query("rouge_l", f"""
WITH p AS ({PAIR_TOKENS}), l AS (SELECT *, list_reduce(list_prepend(list_transform(range(0, len(c) + 1), lambda z: 0), list_transform(r, lambda w: [CASE WHEN x = w THEN 1 ELSE 0 END for x in c])),
  lambda row, hit: list_reduce(list_prepend([0], list_transform(range(1, len(hit) + 1), lambda j: [CASE WHEN hit[j] = 1 THEN row[j] + 1 ELSE row[j + 1] END])),
  lambda acc, v: list_append(acc, greatest(acc[-1], v[1]))))[-1] AS lcs FROM p)
SELECT conv_id, turn, round(CASE WHEN lcs = 0 OR len(c) = 0 OR len(r) = 0 THEN 0.0 ELSE 2 * (lcs / len(c)) * (lcs / len(r)) / (lcs / len(c) + lcs / len(r)) END, 6) AS score FROM l""")
def rouge_l(t):
    score = python_scoring.rouge_l(text.tokens(F.col("candidate")), text.tokens(F.col("reference")))
    return t.text_pairs.select("conv_id", "turn", F.round(score, 6).alias("score"))


@query("rouge_l_documents")
def rouge_l_documents(t):
    score = python_scoring.rouge_l(text.tokens(F.col("output")), text.tokens(F.col("expected")))
    return t.answers.where("expected IS NOT NULL").select("doc_id", F.round(score, 6).alias("score"))


@query("cosine", """
SELECT vec_id, round(list_sum(list_transform(list_zip(va, vb), lambda z: z[1]::DOUBLE * z[2]::DOUBLE)) / (sqrt(list_sum(list_transform(va, lambda x: x::DOUBLE * x::DOUBLE))) * sqrt(list_sum(list_transform(vb, lambda x: x::DOUBLE * x::DOUBLE)))), 6) AS score
FROM {vec_pairs}""")
def cosine(t):
    return t.vec_pairs.select("vec_id", F.round(text.cosine(F.col("va"), F.col("vb")), 6).alias("score"))


@query("similarity_enabled", f"""
SELECT doc_id, CASE WHEN coalesce(expected, '') <> '' AND error IS NULL AND model = 'm-small' THEN round({jac('output', 'expected')}, 6) END AS jaccard,
  CASE WHEN coalesce(expected, '') <> '' AND error IS NULL AND model = 'm-large' THEN round(list_cosine_similarity(CAST(va AS DOUBLE[]), CAST(vb AS DOUBLE[])), 6) END AS cosine FROM {{answers}} LEFT JOIN {{vec_pairs}} ON vec_id = doc_id""")
def similarity_enabled(t):
    vectors = t.vec_pairs.select(F.col("vec_id").alias("doc_id"), F.col("va").alias("output_vector"), F.col("vb").alias("expected_vector"))
    switches = {"jaccard": F.col("model") == "m-small", "cosine": F.col("model") == "m-large"}
    return SC.similarity_enabled(t.answers.join(vectors, "doc_id", "left"), switches, ("jaccard", "cosine")).select("doc_id", "jaccard", "cosine")


@query("requires_expected", "SELECT doc_id FROM {answers} WHERE trim(coalesce(expected, '')) <> ''")
def requires_expected(t):
    return SC.requires_expected(t.answers).select("doc_id")


CONTEXT = """
SELECT r.doc_id, r.question_index, r.doc_id AS trace_id, CASE WHEN r.doc_id % 4 = 0 THEN r.output END AS retrieval_context FROM {answers} r"""
TRACE_CTX = "SELECT doc_id AS trace_id, text AS retrieved FROM {documents} WHERE doc_id % 4 = 1"
PINNED = "SELECT question_index, expected_results AS pinned FROM {cases}"


@query("retrieval_context", f"""
SELECT r.doc_id, coalesce(r.retrieval_context, t.retrieved, c.pinned) AS context FROM ({CONTEXT}) r LEFT JOIN ({TRACE_CTX}) t ON r.trace_id = t.trace_id LEFT JOIN ({PINNED}) c ON r.question_index = c.question_index""")
def retrieval_context(t):
    return SC.retrieval_context(t.sql(CONTEXT), t.sql(TRACE_CTX), t.sql(PINNED)).select("doc_id", F.col("retrieval_context").alias("context"))


@query("context_jaccard", f"""
SELECT doc_id, round({jac('context', 'pinned')}, 6) AS score FROM (SELECT r.doc_id, coalesce(r.retrieval_context, t.retrieved, c.pinned) AS context, c.pinned
  FROM ({CONTEXT}) r LEFT JOIN ({TRACE_CTX}) t ON r.trace_id = t.trace_id JOIN ({PINNED}) c ON r.question_index = c.question_index)""")
def context_jaccard(t):
    ctx = SC.retrieval_context(t.sql(CONTEXT), t.sql(TRACE_CTX), t.sql(PINNED)).join(t.sql(PINNED), "question_index")
    return ctx.select("doc_id", F.round(text.jaccard(F.col("retrieval_context"), F.col("pinned")), 6).alias("score"))


@query("result_trace", """
SELECT r.doc_id, k.tool_calls, k.failed_calls, k.retrievals FROM {results} r LEFT JOIN (SELECT trace_id, CAST(count(*) FILTER (span_kind = 'tool') AS BIGINT) AS tool_calls,
  count(*) FILTER (span_kind = 'tool' AND error IS NOT NULL) AS failed_calls, count(*) FILTER (span_kind = 'retrieval') AS retrievals FROM {spans} GROUP BY trace_id) k ON r.doc_id = k.trace_id""")
def result_trace(t):
    return SC.result_trace(t.results.withColumn("trace_id", F.col("doc_id")), t.spans).select("doc_id", "tool_calls", "failed_calls", "retrievals")


TOOLS = """
SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'a,b' WHEN 1 THEN 'b,a' WHEN 2 THEN 'a,b,b' ELSE 'a' END AS actual, CASE event_id % 3 WHEN 0 THEN 'a,b' WHEN 1 THEN 'b,a,b' ELSE 'a' END AS expected FROM {events}"""


@query("trajectory", f"""
SELECT event_id, actual = expected AS strict, (actual, expected) IN (('a,b','a,b'), ('b,a','a,b'), ('a,b,b','b,a,b'), ('a','a')) AS unordered,
  (actual, expected) IN (('a,b','a,b'), ('b,a','a,b'), ('a,b,b','a,b'), ('a,b,b','b,a,b'), ('a,b','a'), ('b,a','a'), ('a,b,b','a'), ('a','a')) AS superset,
  (actual, expected) IN (('a,b','a,b'), ('b,a','a,b'), ('a','a,b'), ('a,b','b,a,b'), ('b,a','b,a,b'), ('a,b,b','b,a,b'), ('a','b,a,b'), ('a','a')) AS subset FROM ({TOOLS})""")
def trajectory(t):
    df = t.sql(TOOLS)
    a, e = F.split("actual", ","), F.split("expected", ",")
    return df.select("event_id", *[text.trajectory(a, e, m).alias(m) for m in text.MODES])


@query("multi_judge_merge", """
SELECT trace_id, round(CASE WHEN j2 IS NULL THEN j1 WHEN ((j1 >= 5) = (j2 >= 5) AND abs(j1 - j2) <= 1) OR j3 IS NULL THEN (j1 + j2) / 2 ELSE list_sort([j1, j2, j3])[2] END, 6) AS score
FROM (SELECT trace_id, rating::DOUBLE AS j1, (CASE WHEN trace_id % 5 <> 0 THEN (rating + trace_id % 4) % 11 END)::DOUBLE AS j2, (CASE WHEN trace_id % 3 <> 0 THEN trace_id % 11 END)::DOUBLE AS j3 FROM {verdicts})""")
def multi_judge_merge(t):
    tid, r = F.col("trace_id"), F.col("rating").cast("double")
    j2 = F.when(tid % 5 != 0, ((F.col("rating") + tid % 4) % 11).cast("double"))
    j3 = F.when(tid % 3 != 0, (tid % 11).cast("double"))
    return t.verdicts.select("trace_id", F.round(text.merge_judges(r, j2, j3), 6).alias("score"))


@query("judge_prompt", """
SELECT conv_id, turn, 'Q: ' || reference || ' A: ' || candidate || CASE WHEN turn % 2 = 0 THEN chr(10) || chr(10) || 'Be strict.' ELSE '' END AS prompt FROM {text_pairs}""")
def judge_prompt(t):
    criteria = F.when(F.col("turn") % 2 == 0, "Be strict.").otherwise("")
    values = {"input": F.col("reference"), "output": F.col("candidate")}
    return t.text_pairs.select("conv_id", "turn", text.judge_prompt(F.lit("Q: {input} A: {output}"), values, criteria).alias("prompt"))


GROUP = """
SELECT trace_id AS subject_id, 'judge' AS member, CAST(rating AS DOUBLE) AS raw_score FROM {verdicts}
UNION ALL SELECT trace_id, 'pattern', CAST(trace_id % 2 AS DOUBLE) FROM {verdicts} UNION ALL SELECT trace_id, 'custom', CASE WHEN trace_id % 3 <> 0 THEN trace_id % 10 / 10.0E0 END FROM {verdicts}"""
MEMBERS = """
SELECT member, kind, 'g1' AS group_id, CAST(weight AS DOUBLE) AS weight, gate, CAST(5 AS DOUBLE) AS pass_mark FROM (SELECT 'judge' AS member, 'judge' AS kind, 3 AS weight, false AS gate UNION ALL SELECT 'pattern', 'pattern', 1, r_regionkey < 0 FROM {region} WHERE r_regionkey = 0
UNION ALL SELECT 'custom', 'custom', 2, true)"""


@query("group_score", f"""
SELECT group_id, subject_id, round(CASE WHEN gated THEN 0 ELSE s / w END, 6) AS score, gated FROM (SELECT group_id, subject_id, coalesce(bool_or(gate AND score < pass_mark), false) AS gated,
  sum(weight * score) AS s, sum(weight) FILTER (score IS NOT NULL) AS w FROM (SELECT m.*, subject_id, CASE kind WHEN 'judge' THEN raw_score WHEN 'pattern' THEN CASE WHEN raw_score > 0 THEN 10.0 ELSE 0.0 END ELSE raw_score * 10 END AS score
  FROM ({GROUP}) v JOIN ({MEMBERS}) m ON v.member = m.member) GROUP BY group_id, subject_id)""")
def group_score(t):
    return SC.group_score(t.sql(GROUP), t.sql(MEMBERS))
