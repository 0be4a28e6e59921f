"""Evaluation runs: case expansion, resume and reuse, statistics, gates, head-to-head comparisons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanquarry.functions.normalize import idempotency_key
from spanquarry.operators import sliced
from spanquarry.operators.monitoring import ratio

CASE_FIELDS = ("query", "expected_results")


def case_flatten(datasets: DataFrame) -> DataFrame:
    """One row per question of a nested dataset; the array position is the question index and the
    comparison models are hoisted only where they are enabled."""
    return datasets.select(
        "dataset_id",
        F.greatest(F.coalesce("number_of_requests", F.lit(1)), F.lit(1)).alias("n_runs"),
        F.when(F.col("models_enabled"), F.col("models")).alias("models"),
        F.posexplode("questions").alias("question_index", "q"),
    ).select("dataset_id", "n_runs", "models", F.col("question_index").cast("long").alias("question_index"), "q.*")


def split_filter(cases: DataFrame, split: str | None) -> DataFrame:
    """Cases tagged with a split, keeping their indexes; untagged cases are in no split."""
    return cases if not split else cases.where(F.array_contains("splits", split))


def expand_cases(cases: DataFrame, n_runs: int | Column, models: list[str] | None = None) -> DataFrame:
    """question × run 1..N × comparison models (or a single unset model).

    Expansion happens inside each row, so nothing is shuffled and a hot dataset stays spread.
    """
    n = F.greatest(F.lit(n_runs) if isinstance(n_runs, int) else n_runs, F.lit(1))
    listed = F.array(*[F.lit(m) for m in models]) if models else F.array(F.lit(None).cast("string"))
    runs = cases.withColumn("run_number", F.explode(F.sequence(F.lit(1), n)))
    full = runs.withColumn("model", F.explode(listed))
    suffix = F.when(F.col("model").isNotNull(), F.concat(F.lit("::"), F.col("model"))).otherwise("")
    return full.select(
        F.concat(F.lit("case-"), F.col("question_index").cast("string"), suffix).alias("case_id"),
        "question_index",
        F.col("run_number").cast("long").alias("run_number"),
        "model",
        *CASE_FIELDS,
        F.lit(False).alias("is_smoke_test_variant"),
    )


def expand_smoke(cases: DataFrame, variants: DataFrame, n_runs: int) -> DataFrame:
    """Rows of the smoke variants ``(question_index, variants array)``: run number N + i + 1, the
    variant as query, the question's expectations, no comparison models."""
    exploded = variants.select("question_index", F.posexplode("variants").alias("i", "variant"))
    return exploded.join(cases, "question_index").select(
        F.concat(F.lit("case-"), F.col("question_index").cast("string")).alias("case_id"),
        "question_index",
        (F.lit(max(n_runs, 1)) + F.col("i") + 1).cast("long").alias("run_number"),
        F.lit(None).cast("string").alias("model"),
        F.col("variant").alias("query"),
        *[c for c in CASE_FIELDS if c != "query"],
        F.lit(True).alias("is_smoke_test_variant"),
    )


def resume_pending(run_cases: DataFrame, run_id: str, accepted_keys: DataFrame) -> DataFrame:
    """Cases whose idempotency key was not accepted yet."""
    keyed = run_cases.withColumn("idempotency_key", idempotency_key(F.lit(run_id), F.col("case_id"), F.col("run_number")))
    return keyed.join(accepted_keys.select("idempotency_key"), "idempotency_key", "left_anti")


def reusable_rows(prior: DataFrame) -> DataFrame:
    """Earlier results fit for reuse: no error, not failed, non-empty output and query."""
    return prior.where(
        (F.coalesce("error", F.lit("")) == "")
        & ~F.col("status").eqNullSafe("failed")
        & (F.coalesce("output", F.lit("")) != "")
        & (F.coalesce("query", F.lit("")) != "")
    )


def reuse_outputs(run_cases: DataFrame, prior: DataFrame) -> DataFrame:
    """Attach the earlier answer to the same query text, run number and smoke flag.

    The last of several earlier rows (by ``pos``) wins. The key leaves the model out, so every model
    of a case reuses one answer, as specified.
    """
    cached = (
        reusable_rows(prior)
        .groupBy(
            "query",
            F.coalesce(F.nullif("run_number", F.lit(0)), F.lit(1)).alias("run_number"),
            F.coalesce("is_smoke_test_variant", F.lit(False)).alias("is_smoke_test_variant"),
        )
        .agg(F.max_by("output", "pos").alias("cached_output"))
    )
    return run_cases.join(cached, ["query", "run_number", "is_smoke_test_variant"], "left")


def precomputed_match(run_cases: DataFrame, outputs: DataFrame) -> DataFrame:
    """Stored answers ``(key, value)`` by case id, else by question index; an empty first hit falls
    through; nothing found gives an empty answer."""
    by_id = outputs.select(F.col("key").alias("case_id"), F.col("value").alias("by_id"))
    by_index = outputs.select(F.col("key").alias("index_key"), F.col("value").alias("by_index"))
    return (
        run_cases.join(by_id, "case_id", "left")
        .join(by_index, F.col("question_index").cast("string") == F.col("index_key"), "left")
        .select(*run_cases.columns, F.coalesce(F.nullif("by_id", F.lit("")), "by_index", F.lit("")).alias("raw_output"))
    )


def run_counts(run_cases: DataFrame) -> DataFrame:
    """Distinct questions, repeats and smoke variants of a run."""
    return run_cases.agg(
        F.countDistinct("question_index").alias("questions"),
        F.max(F.when(~F.col("is_smoke_test_variant"), F.col("run_number"))).alias("repeats"),
        F.count_if("is_smoke_test_variant").alias("smoke_variants"),
        F.count("*").alias("cases"),
    )


def batch_no(rows: DataFrame, run_key: str, order: list[str], size: int = 10, slice_size: int = 10_000) -> DataFrame:
    """Batches of ``size`` in case order within each run."""
    numbered = sliced.sliced_window(
        rows, [run_key], sliced.position_slice(F.col(order[0]), slice_size), order, [sliced.row_number("__rn")]
    )
    return numbered.withColumn("batch_no", F.floor((F.col("__rn") - 1) / size).cast("long")).drop("__rn")


# -- statistics --------------------------------------------------------------------------------


def live_stats(results: DataFrame, keys: list[str] = ["run_id"]) -> DataFrame:  # noqa: B006
    return results.groupBy(*keys).agg(
        F.round(F.avg("rating"), 6).alias("average_rating"),
        F.min("rating").alias("min_rating"),
        F.max("rating").alias("max_rating"),
        F.count_if(F.col("status") == "scored").alias("rated"),
        F.count_if(F.col("status") == "skipped").alias("skipped"),
        F.count_if(F.col("status") == "failed").alias("failed"),
    )


METRICS = ("cosine", "jaccard", "bleu", "rouge")


def report_stats(scored: DataFrame) -> DataFrame:
    """Runs counted, ratings and similarity means per run; null metrics are left out of a mean."""
    return scored.groupBy("run_id").agg(
        F.count("*").alias("number_of_runs"),
        F.round(F.avg("rating"), 6).alias("average_rating"),
        F.min("rating").alias("min_rating"),
        F.max("rating").alias("max_rating"),
        *[F.round(F.avg(m), 6).alias(f"average_{m}") for m in METRICS if m in scored.columns],
    )


def report_view(stats: DataFrame) -> DataFrame:
    """Presentation of a report: an analysed run without ratings shows 0.0."""
    return stats.withColumn("average_rating", F.coalesce("average_rating", F.lit(0.0)))


def model_matrix(scored: DataFrame, baseline: str) -> DataFrame:
    """Per model: runs, rating spread, similarity means, latency, token sums, baseline flag."""
    return scored.groupBy("model").agg(
        F.count("*").alias("runs"),
        F.round(F.avg("rating"), 6).alias("average_rating"),
        F.min("rating").alias("min_rating"),
        F.max("rating").alias("max_rating"),
        F.round(F.var_pop("rating"), 6).alias("rating_variance"),
        *[F.round(F.avg(m), 6).alias(f"average_{m}") for m in METRICS if m in scored.columns],
        F.round(F.avg("latency_ms"), 6).alias("average_latency_ms"),
        F.sum("input_tokens").alias("input_tokens"),
        F.sum("output_tokens").alias("output_tokens"),
    ).withColumn("is_baseline", F.col("model") == baseline)


def scorer_breakdown(judgements: DataFrame) -> DataFrame:
    return judgements.groupBy("run_id", "scorer").agg(
        F.round(F.avg("score"), 6).alias("average_score"), F.count("score").alias("n")
    )


def version_compare(run_stats: DataFrame, runs: DataFrame) -> DataFrame:
    """Average rating over all rated rows per ``version`` of a dataset's runs."""
    return (
        runs.join(run_stats, "run_id")
        .groupBy("dataset_id", "version")
        .agg(F.sum("rating_sum").alias("s"), F.sum("rating_n").alias("n"))
        .select("dataset_id", "version", F.round(ratio(F.col("s"), F.col("n")), 6).alias("average_rating"), "n")
    )


def previous_runs(runs: DataFrame, slice_seconds: int = 30 * 86400) -> DataFrame:
    """For every run the dataset's previous *completed* run and its average.

    ``runs(run_id, dataset_id, finished_at, status, average_rating)``.
    """
    done = F.col("status") == "completed"
    prior = F.struct(F.col("run_id").alias("run_id"), F.col("average_rating").alias("avg"))
    out = sliced.sliced_window(
        runs,
        ["dataset_id"],
        sliced.time_slice(F.col("finished_at"), slice_seconds),
        ["finished_at", "run_id"],
        [sliced.last_known("__prev", F.when(done, prior), inclusive=False)],
    )
    return out.select(
        *runs.columns, F.col("__prev.run_id").alias("baseline_run_id"), F.col("__prev.avg").alias("baseline_average")
    )


def run_gate(
    runs_with_baseline: DataFrame,
    fail_under: float | None = None,
    no_regression: bool = False,
    tolerance: float = 0.5,
    average: str = "average_rating",
    baseline: str = "baseline_average",
) -> DataFrame:
    """One row per run and check: ``check_name, passed, detail``.

    No average fails ``fail-under``; no baseline passes ``no-regression`` with a note. Pass another
    pair of columns to gate one additional scorer's own average.
    """
    if fail_under is None and not no_regression:
        raise ValueError("a gate needs fail_under or no_regression")
    avg, base = F.col(average), F.col(baseline)
    checks = []
    if fail_under is not None:
        ok = F.coalesce(avg >= fail_under, F.lit(False))
        detail = F.when(avg.isNull(), "no rating").when(ok, "at or above the floor").otherwise("below the floor")
        checks.append(F.struct(F.lit("fail-under").alias("check_name"), ok.alias("passed"), detail.alias("detail")))
    if no_regression:
        ok = F.when(base.isNull(), True).otherwise(F.coalesce(avg >= base - tolerance, F.lit(False)))
        detail = F.when(base.isNull(), "no baseline").when(ok, "within tolerance").otherwise("regressed")
        checks.append(F.struct(F.lit("no-regression").alias("check_name"), ok.alias("passed"), detail.alias("detail")))
    return runs_with_baseline.select("run_id", F.explode(F.array(*checks)).alias("c")).select("run_id", "c.*")


def gate_verdict(checks: DataFrame) -> DataFrame:
    """A run passes when every check does; the exit code follows."""
    return checks.groupBy("run_id").agg(F.every("passed").alias("passed")).withColumn(
        "exit_code", F.when(F.col("passed"), 0).otherwise(1).cast("long")
    )


# -- continuous integration --------------------------------------------------------------------


def threshold_violations(scored: DataFrame, limits: dict[str, float], keys: list[str]) -> DataFrame:
    """One row per result and metric below its limit; missing metrics do not violate."""
    checks = [
        F.when(F.col(m) < limit, F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"), F.lit(float(limit)).alias("limit_value")))
        for m, limit in limits.items()
    ]
    return scored.select(*keys, F.explode(F.array_compact(F.array(*checks))).alias("v")).select(*keys, "v.*")


def ci_gate(scores: DataFrame, limits: dict[str, float], pass_rate_threshold: float) -> DataFrame:
    """Pass rate of each run against the threshold, and the first failing question for fail-fast."""
    bad = F.lit(False)
    for metric, limit in limits.items():
        bad = bad | F.coalesce(F.col(metric) < limit, F.lit(False))
    rate = ratio(F.count_if(~bad), F.count("*"))
    return scores.groupBy("run_id").agg(
        F.count("*").alias("scored"),
        F.count_if(bad).alias("violating"),
        F.round(rate, 6).alias("pass_rate"),
        (rate >= pass_rate_threshold).alias("passed"),
        F.min(F.when(bad, F.col("question_index"))).alias("first_failing_question"),
    )


# -- head to head ------------------------------------------------------------------------------


def pair_runs(a: DataFrame, b: DataFrame) -> DataFrame:
    """Results of two runs side by side per question and repeat; one side missing is ``skipped``."""
    keys = ["question_index", "run_number"]
    left = a.select(*keys, F.col("output").alias("output_a"), F.lit(True).alias("has_a"))
    right = b.select(*keys, F.col("output").alias("output_b"), F.lit(True).alias("has_b"))
    reason = F.when(F.col("has_a").isNull(), "missing in A").when(F.col("has_b").isNull(), "missing in B")
    return left.join(right, keys, "full").select(*keys, "output_a", "output_b", reason.alias("skipped"))


def presentation_order(pairs: DataFrame, batch_key: str, slice_size: int = 10_000) -> DataFrame:
    """Which answer is shown first alternates case by case within a comparison."""
    order = ["question_index", "run_number"]
    numbered = sliced.sliced_window(
        pairs, [batch_key], sliced.position_slice(F.col("question_index"), slice_size), order, [sliced.row_number("__rn")]
    )
    first = F.when(F.col("__rn") % 2 == 1, "A").otherwise("B")
    return numbered.withColumn("presented_first", first).drop("__rn")


def both_order_winner(first: Column, swapped: Column) -> Column:
    """Verdict of a case judged in both orders: a verdict that flips with the order is a tie."""
    return F.when(swapped.isNull() | (first == swapped), first).otherwise("tie")


def pairwise_summary(cases: DataFrame) -> DataFrame:
    """Per comparison: totals, wins, ties, overall winner, flip rate.

    ``winner`` and, where the swapped order was judged too, ``winner_swapped`` hold A, B or tie. No
    flip rate unless both orders were judged.
    """
    final = both_order_winner(F.col("winner"), F.col("winner_swapped"))
    flipped = F.col("winner_swapped").isNotNull() & (F.col("winner") != F.col("winner_swapped"))
    s = cases.groupBy("batch_id").agg(
        F.count("*").alias("total"),
        F.count_if(final == "A").alias("a_wins"),
        F.count_if(final == "B").alias("b_wins"),
        F.count_if(final == "tie").alias("ties"),
        F.round(ratio(F.count_if(flipped), F.count("winner_swapped")), 6).alias("flip_rate"),
    )
    winner = F.when(F.col("a_wins") > F.col("b_wins"), "A").when(F.col("b_wins") > F.col("a_wins"), "B").otherwise("tie")
    return s.withColumn("winner", winner)


def pairwise_assert(
    summary: DataFrame, must_win: str | None = None, max_losses: int | None = None, max_flip_rate: float | None = None
) -> DataFrame:
    """Failed checks of a comparison, seen from ``must_win`` (default A) as the candidate."""
    losses = F.col("a_wins") if must_win == "B" else F.col("b_wins")
    checks = []
    if must_win is not None:
        checks.append(F.when(F.col("winner") != must_win, "must_win"))
    if max_losses is not None:
        checks.append(F.when(losses > max_losses, "max_losses"))
    if max_flip_rate is not None:
        checks.append(F.when(F.col("flip_rate") > max_flip_rate, "max_flip_rate"))
    return summary.select("batch_id", F.explode(F.array_compact(F.array(*checks))).alias("failed_check"))
