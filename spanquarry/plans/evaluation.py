"""The evaluation job: which cases still run, what they answered, how they scored."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanquarry.functions.callables import batch_infer
from spanquarry.functions.normalize import idempotency_key, normalize_result
from spanquarry.operators import evaluation, scoring


def run_cases(cases: DataFrame, n_runs: int, models: list[str] | None, variants: DataFrame | None, split: str | None) -> DataFrame:
    chosen = evaluation.split_filter(cases, split)
    expanded = evaluation.expand_cases(chosen, n_runs, models)
    return expanded if variants is None else expanded.unionByName(evaluation.expand_smoke(chosen, variants, n_runs))


def execute(
    pending: DataFrame, run_id: str, fn: Callable[[dict], Any], accepted: DataFrame | None = None, prior: DataFrame | None = None
) -> DataFrame:
    """Answers of a run.

    Accepted cases are removed and cached answers taken before the Python stage, because the
    optimizer cannot move either past it; only the remaining cases reach ``fn``.
    """
    if accepted is not None:
        pending = evaluation.resume_pending(pending, run_id, accepted).drop("idempotency_key")
    if prior is not None:
        pending = evaluation.reuse_outputs(pending, prior)
        cached = pending.where("cached_output IS NOT NULL").select(
            *[c for c in pending.columns if c != "cached_output"],
            F.to_json(F.struct(F.col("cached_output").alias("output"))).alias("raw"),
            F.lit(None).cast("string").alias("error_type"), F.lit(None).cast("string").alias("error_message"), F.lit(0).cast("long").alias("latency_ms"),
        )
        fresh = batch_infer(pending.where("cached_output IS NULL").drop("cached_output"), fn)
        answered = cached.unionByName(fresh)
    else:
        answered = batch_infer(pending, fn)
    rows = normalize_result(answered)
    raised = F.col("error_type").isNotNull()
    return rows.select(
        idempotency_key(F.lit(run_id), F.col("case_id"), F.col("run_number")).alias("idempotency_key"),
        F.lit(run_id).alias("run_id"), "case_id", "question_index", "run_number", "model", "query", "is_smoke_test_variant",
        F.col("expected_results").alias("expected"),
        F.when(raised, "").otherwise(F.col("r.text")).alias("output"),
        F.when(raised, F.col("error_type")).otherwise(F.col("r.error_type")).alias("error"),
        F.when(raised, F.col("error_message")).otherwise(F.col("r.error_message")).alias("error_message"),
        F.col("r.input_tokens").alias("input_tokens"), F.col("r.output_tokens").alias("output_tokens"), "latency_ms",
    )


def report(results: DataFrame, verdicts: DataFrame, metrics: dict[str, bool]) -> DataFrame:
    """Scored results with the judge's rating, summarised per run; smoke variants are left out."""
    scored = scoring.similarity_enabled(results.where(~F.col("is_smoke_test_variant")), metrics)
    return evaluation.report_stats(scored.join(verdicts, "idempotency_key", "left"))
