"""Scored result tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanquarry.functions import python_scoring, text


def similarity_enabled(results: DataFrame, settings: dict[str, bool | Column], wanted=("jaccard", "bleu", "rouge")) -> DataFrame:
    """Add each metric where it is switched on, for rows with an expected answer and no error.

    The tokens are extracted once per text and feed all metrics; the expensive ones see only the
    rows they are switched on for. ``cosine`` compares the columns output_vector and expected_vector.
    """
    gradable = (F.coalesce("expected", F.lit("")) != "") & F.col("error").isNull()
    out = results.withColumn("__c", F.when(gradable, text.tokens(F.col("output")))).withColumn(
        "__r", F.when(gradable, text.tokens(F.col("expected")))
    )
    for metric in wanted:
        switch = settings.get(metric, False)
        on = F.lit(switch) if isinstance(switch, bool) else F.coalesce(switch, F.lit(False))
        cand, ref = F.when(on, F.col("__c")), F.when(on, F.col("__r"))
        if metric == "jaccard":
            both, either = text.token_overlap(cand, ref)
            value = F.when(either > 0, both / either)
        elif metric == "cosine":
            value = F.when(gradable & on, text.cosine(F.col("output_vector"), F.col("expected_vector")))
        else:
            value = {"bleu": python_scoring.bleu4, "rouge": python_scoring.rouge_l}[metric](cand, ref)
        out = out.withColumn(metric, F.round(value, 6))
    return out.drop("__c", "__r")


def retrieval_context(results: DataFrame, traces: DataFrame, cases: DataFrame) -> DataFrame:
    """Context of a result: its own, else its trace's retrieval texts, else the case's pinned one."""
    t = traces.select(F.col("trace_id").alias("t_id"), F.col("retrieved").alias("t_ctx"))
    c = cases.select(F.col("question_index").alias("c_id"), F.col("pinned").alias("c_ctx"))
    return (
        results.join(t, F.col("trace_id") == F.col("t_id"), "left")
        .join(c, F.col("question_index") == F.col("c_id"), "left")
        .select(*[c for c in results.columns if c != "retrieval_context"], F.coalesce("retrieval_context", "t_ctx", "c_ctx").alias("retrieval_context"))
    )


def result_trace(results: DataFrame, spans: DataFrame) -> DataFrame:
    """Results with the tool and retrieval counts of their linked trace.

    The counts are combined on the map side before the join; the calls themselves stay in long form
    (see ``trees.tool_call_mirror``).
    """
    facts = spans.groupBy("trace_id").agg(
        F.count_if(F.col("span_kind") == "tool").alias("tool_calls"),
        F.count_if((F.col("span_kind") == "tool") & F.col("error").isNotNull()).alias("failed_calls"),
        F.count_if(F.col("span_kind") == "retrieval").alias("retrievals"),
    )
    return results.join(facts, "trace_id", "left")


def requires_expected(results: DataFrame) -> DataFrame:
    """Rows a scorer that needs an expected answer looks at."""
    return results.where(F.trim(F.coalesce("expected", F.lit(""))) != "")


def group_score(verdicts: DataFrame, members: DataFrame) -> DataFrame:
    """Weighted 0-10 score of a scorer group per subject, zeroed by a failed gate.

    Judge scores count as they are, a pattern gives 10 or 0, a custom score of 0..1 is scaled by 10.
    Members without a score are left out and the weights renormalised.
    """
    score = (
        F.when(F.col("kind") == "judge", F.col("raw_score"))
        .when(F.col("kind") == "pattern", F.when(F.col("raw_score") > 0, 10.0).otherwise(0.0))
        .otherwise(F.col("raw_score") * 10)
    )
    joined = verdicts.join(members, "member").select(
        "subject_id", "group_id", "weight", F.when(F.col("raw_score").isNotNull(), score).alias("score"), "gate", "pass_mark"
    )
    scored = F.col("score").isNotNull()
    failed_gate = F.bool_or(F.col("gate") & scored & (F.col("score") < F.col("pass_mark")))
    total = F.sum(F.when(scored, F.col("weight")))
    mean = F.when(total > 0, F.sum(F.col("weight") * F.col("score")) / total)
    gated = F.coalesce(failed_gate, F.lit(False))
    return joined.groupBy("group_id", "subject_id").agg(
        F.round(F.when(gated, 0.0).otherwise(mean), 6).alias("score"), gated.alias("gated")
    )
