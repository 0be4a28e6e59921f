"""Specified behaviours, quirks included."""

import math
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from spanquarry.functions import matching, messages, normalize, python_scoring, sampling, text, times
from spanquarry.functions.matching import Condition
from spanquarry.operators import evaluation, logs, quality, registry, trees
from spanquarry.operators.monitoring import ratio
from spanquarry.sources import csv_cases, tables


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return df.select(column.alias("x")).first()["x"]


RAW = [
    ('"hello"', "hello", None),
    ('{"output": "", "text": 0, "response": "r"}', "r", None),
    ('{"output": {"text": " "}}', " ", "EmptyOutput"),
    ('{"output": {"text": "", "rows": 1}}', "", None),
    ('{"error": {"message": "late"}}', "", "Exception"),
    ('{"output": "x", "error": false}', "x", None),
    ("true", "True", None),
    ("null", "", "EmptyOutput"),
    ("7", "7", None),
    ("[]", "[]", None),
]


@pytest.mark.parametrize("raw,answer,error", RAW)
def test_normalize_result(spark, raw, answer, error):
    row = normalize.normalize_result(spark.createDataFrame([(raw,)], ["raw"])).first()["r"]
    assert (row["text"], row["error_type"]) == (answer, error)


def test_tokens_zero_is_absent_in_the_fallback_only(spark):
    df = spark.createDataFrame([('{"output": "x", "input_tokens": 0, "metadata": {"output_tokens": 0, "completion_tokens": "5"}}',)], ["raw"])
    row = normalize.normalize_result(df).first()["r"]
    assert (row["input_tokens"], row["output_tokens"]) == (0, 5)


def test_conditions_fold_left_to_right(spark):
    conditions = [Condition("a"), Condition("b", connector="or"), Condition("c", connector="and")]
    verdict = lambda t: one(spark, matching.match_conditions(conditions, {"response": F.col("t")}), t=t)
    assert [verdict("a"), verdict("ac"), verdict("bc"), verdict("c")] == [False, True, True, False]


def test_reference_shapes_of_patterns(spark):
    ssn = [Condition(r"\d{3}-\d{2}-\d{4}", "regex")]
    money = [Condition("guaranteed refund"), Condition("money back", connector="or")]
    src = {"response": F.col("t")}
    assert one(spark, matching.match_conditions(ssn, src), t="it is 123-45-6789")
    assert one(spark, matching.match_conditions(money, src), t="Your MONEY BACK")
    assert not one(spark, matching.match_conditions(money, src), t="refund")


def test_stream_assembly(spark):
    schema = "call_id STRING, seq BIGINT, choice INT, delta STRING, tool_index INT, tool_name STRING, tool_args STRING, model STRING, input_tokens BIGINT, output_tokens BIGINT, has_usage BOOLEAN, error STRING"
    rows = [
        ("a", 0, 0, "Hel", None, None, None, "m", None, None, False, None),
        ("a", 1, 0, "lo", None, None, None, "n", None, None, False, None),
        ("a", 2, 0, " there", None, None, None, None, 9, 4, True, None),
        ("b", 0, 0, None, 0, "lookup_order", None, None, None, None, False, None),
        ("b", 1, 0, None, 0, None, '{"order_id": ', None, None, None, False, None),
        ("b", 2, 0, None, 0, None, '"A1"}', None, None, None, False, "cut"),
    ]
    for size in (1, 2, 1000):
        out = {r["call_id"]: r for r in logs.assemble_chunks(spark.createDataFrame(rows, schema), size).collect()}
        assert (out["a"]["output"], out["a"]["model"], out["a"]["input_tokens"], out["a"]["output_tokens"]) == ("Hello there", "m", 9, 4)
        assert (out["b"]["output"], out["b"]["output_tokens"], out["b"]["error"]) == ('[tool call] lookup_order({"order_id": "A1"})', None, "cut")


def test_usage_adds_split_cache_counts(spark):
    usage = '{"input_tokens": 10, "output_tokens": 2, "cache_read_input_tokens": 5}'
    row = one(spark, messages.provider_usage(F.lit("anthropic"), F.col("u")), u=usage)
    assert (row["input"], row["cache_read"], row["cache_write"]) == (15, 5, None)
    row = one(spark, messages.provider_usage(F.lit("openai"), F.lit(None).cast("string")))
    assert row["input"] is None and row["output"] is None


def test_split_keeps_indexes(spark):
    cases = spark.createDataFrame([(0, ["smoke"]), (1, None), (2, ["smoke", "full"])], "question_index BIGINT, splits ARRAY<STRING>")
    assert sorted(r[0] for r in evaluation.split_filter(cases, "smoke").select("question_index").collect()) == [0, 2]


def test_reuse_skips_failed_and_lets_the_last_win(spark):
    cases = spark.createDataFrame([("q0", 1, False), ("q1", 1, False), ("q2", 1, False)], "query STRING, run_number BIGINT, is_smoke_test_variant BOOLEAN")
    prior = spark.createDataFrame(
        [("q0", None, None, "old", None, "scored", 1), ("q0", 1, False, "new", None, "scored", 2), ("q1", 1, False, "bad", None, "failed", 3)],
        "query STRING, run_number BIGINT, is_smoke_test_variant BOOLEAN, output STRING, error STRING, status STRING, pos BIGINT",
    )
    got = {r["query"]: r["cached_output"] for r in evaluation.reuse_outputs(cases, prior).collect()}
    assert got == {"q0": "new", "q1": None, "q2": None}


GATES = [(8.2, None, True, True), (5.1, None, False, True), (7.0, 7.6, True, False), (None, 5.0, False, False)]


@pytest.mark.parametrize("average,baseline,floor_ok,regression_ok", GATES)
def test_gate(spark, average, baseline, floor_ok, regression_ok):
    runs = spark.createDataFrame([("r", average, baseline)], "run_id STRING, average_rating DOUBLE, baseline_average DOUBLE")
    checks = {r["check_name"]: (r["passed"], r["detail"]) for r in evaluation.run_gate(runs, 7.0, True).collect()}
    assert (checks["fail-under"][0], checks["no-regression"][0]) == (floor_ok, regression_ok)
    if baseline is None:
        assert checks["no-regression"][1] == "no baseline"
    with pytest.raises(ValueError):
        evaluation.run_gate(runs)


def test_pairwise(spark):
    def summary(cases):
        df = spark.createDataFrame([("b", w, s) for w, s in cases], "batch_id STRING, winner STRING, winner_swapped STRING")
        return evaluation.pairwise_summary(df)

    s = summary([("A", None), ("A", None), ("B", None)]).first()
    assert (s["winner"], s["flip_rate"]) == ("A", None)
    tie = summary([("A", "A"), ("B", "B")])
    assert [r["failed_check"] for r in evaluation.pairwise_assert(tie, must_win="A", max_flip_rate=0.2).collect()] == ["must_win"]
    flip = summary([("A", "B"), ("A", "A")])
    assert flip.first()["ties"] == 1 and flip.first()["flip_rate"] == 0.5
    assert [r["failed_check"] for r in evaluation.pairwise_assert(flip, max_flip_rate=0.2).collect()] == ["max_flip_rate"]


def test_price_and_tool_registry(spark):
    assert [one(spark, normalize.price_valid(F.lit(p))) for p in ("0.25", "-1", "cheap", "NaN", "Infinity")] == [True, False, False, False, False]
    stored = spark.createDataFrame([("search", 0.25)], "name STRING, price DOUBLE")
    new = spark.createDataFrame([("search", 9.0, 1), ("fetch", 1.0, 2), ("fetch", 2.0, 3)], "name STRING, price DOUBLE, arrival INT")
    assert dict(map(tuple, registry.register_if_absent(stored, new).collect())) == {"search": 0.25, "fetch": 1.0}


def test_review_error_and_alpha(spark):
    v = spark.createDataFrame([(8.0, 2.0), (5.0, None)], "rating DOUBLE, corrected_score DOUBLE")
    assert tuple(quality.rating_mae(v).first()) == (6.0, 1)
    assert one(spark, quality.alpha(F.lit(10), F.lit(0), F.lit(0))) is None
    assert one(spark, quality.alpha(F.lit(10), F.lit(0), F.lit(10))) == 1.0
    assert one(spark, ratio(F.lit(0), F.lit(0))) is None


def test_lcs_and_rouge_against_brute_force():
    def brute(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
            row = new
        return row[-1]

    rng = random.Random(3)
    for _ in range(200):
        a = [rng.choice("abcd") for _ in range(rng.randrange(40))]
        b = [rng.choice("abcd") for _ in range(rng.randrange(90))]
        assert python_scoring.lcs_length(a, b) == brute(a, b)


def test_scores(spark):
    a, b = text.tokens(F.lit("The cat sat on the mat")), text.tokens(F.lit("the cat sat on a mat"))
    assert one(spark, python_scoring.bleu4(a, a)) == 1.0
    assert one(spark, python_scoring.bleu4(a, text.tokens(F.lit("nothing alike")))) == 0.0
    assert one(spark, python_scoring.rouge_l(a, b)) == one(spark, python_scoring.rouge_l(b, a)) == pytest.approx(5 / 6)
    assert one(spark, text.jaccard(F.lit(""), F.lit("!"))) is None
    assert one(spark, text.jaccard(F.lit("Été à"), F.lit("été"))) == 0.5
    zero = F.array(F.lit(0.0), F.lit(0.0))
    assert one(spark, text.cosine(zero, zero)) is None


def test_trajectory_counts_repeats(spark):
    arr = lambda *x: F.array(*[F.lit(i) for i in x]) if x else F.array().cast("array<string>")
    assert not one(spark, text.trajectory(arr("a"), arr("a", "a"), "superset"))
    assert one(spark, text.trajectory(arr("a", "a"), arr("a"), "superset"))
    assert one(spark, text.trajectory(arr(), arr(), "strict"))
    assert not one(spark, text.trajectory(arr("a"), arr(), "strict"))


def test_climb_handles_cycles_orphans_and_depth(spark):
    chain = [(i, i - 1 if i else None) for i in range(40)]
    rows = chain + [(100, 101), (101, 100), (102, 101), (200, 999)]
    spans = spark.createDataFrame(rows, "span_id BIGINT, parent_span_id BIGINT").repartition(3)
    out = {r["span_id"]: (r["root_id"], r["depth"]) for r in trees.root_of(spans).collect()}
    assert all(out[i] == (0, i) for i in range(40))
    assert all(out[i] == (None, None) for i in (100, 101, 102, 200))


def test_sampling_rate_and_stability(spark):
    n, rate = 20_000, 0.2
    ids = spark.range(n)
    hit = ids.where(sampling.sampled(F.col("id"), "r", rate))
    assert abs(hit.count() - n * rate) < 3 * math.sqrt(n * rate * (1 - rate))
    assert hit.exceptAll(ids.repartition(7).where(sampling.sampled(F.col("id"), "r", rate))).count() == 0
    assert ids.where(sampling.sampled(F.col("id"), "r", 1.0)).count() == n
    assert ids.where(sampling.sampled(F.col("id"), "r", 0.0)).count() == 0


def test_times(spark):
    ms = lambda t: one(spark, F.unix_millis(times.parse_mixed_time(F.col("t"))), t=t)
    assert ms("1700000000") == ms("1700000000000") == 1700000000000
    assert ms('"2024-01-01T00:00:00Z"') == ms("2024-01-01") == 1704067200000
    assert ms('"1700000000"') is None and ms('"2024"') is None
    assert times.window_seconds("7d") == 604800


def test_csv_import_rejects_blank_queries_by_line(spark, tmp_path):
    file = tmp_path / "cases.csv"
    file.write_text('query,expected_results,expected_capabilities\nfirst,yes,"a; b;"\n" ",x,\n"two\nlines",,nan\nnan,n,\n')
    out = {r["line"]: r for r in csv_cases.import_cases_csv(spark, str(file)).collect()}
    assert sorted(out) == [2, 3, 4, 5]
    assert out[2]["expected_capabilities"] == ["a", "b"] and out[3]["rejected"] and not out[5]["rejected"]
    assert out[4]["query"] == "two\nlines" and out[4]["expected_capabilities"] is None
    (tmp_path / "bad.csv").write_text("question\nx\n")
    with pytest.raises(ValueError):
        csv_cases.import_cases_csv(spark, str(tmp_path / "bad.csv"))


def test_dedupe_is_idempotent(spark):
    rows = spark.createDataFrame([(1, 0), (1, 1), (2, 2)], "span_id BIGINT, arrival BIGINT")
    empty = rows.where("false")
    first = tables.ingest_dedupe(empty, rows, ["span_id"]).where("NOT deduped")
    assert first.count() == 2
    assert tables.ingest_dedupe(first, rows, ["span_id"]).where("NOT deduped").count() == 0


def test_resume_after_append_is_empty(spark):
    cases = spark.createDataFrame([("case-0", 1), ("case-1", 1)], "case_id STRING, run_number BIGINT")
    keys = cases.select(normalize.idempotency_key(F.lit("r"), F.col("case_id"), F.col("run_number")).alias("idempotency_key"))
    assert evaluation.resume_pending(cases, "r", keys).count() == 0
    assert keys.first()[0] == "r:case-0:run-1"


def test_wire_rename_refuses_unknown_fields(spark):
    with pytest.raises(ValueError):
        normalize.wire_rename(spark.range(1).withColumn("typo", F.lit(1)), {"id": "ID"}, set())


def test_task_order_and_chain_timing(spark):
    at = lambda s: datetime(2024, 1, 1, 0, 0, s)
    messages_df = spark.createDataFrame([("r", 0, at(5), at(1)), ("r", 1, None, at(1)), ("r", 2, at(9), at(1))], "run_id STRING, pos BIGINT, created_at TIMESTAMP, run_start TIMESTAMP")
    got = {r["pos"]: (r["start_at"].second, r["end_at"].second) for r in logs.chain_timing(messages_df, 1).collect()}
    assert got == {0: (1, 5), 1: (5, 5), 2: (5, 9)}
