"""Automation rules: filter, sample, and the table each match goes to."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanquarry.functions.matching import match_contains, scope_agents
from spanquarry.functions.sampling import sampled


@dataclass(frozen=True)
class Rule:
    rule_id: str
    action: str = "review"  # review | dataset | webhook
    model: str | None = None
    status: str = "any"  # any | error
    contains: str | None = None
    agent_ids: tuple[str, ...] | None = None
    sample_rate: float = 1.0


def rule_condition(rule: Rule) -> Column:
    keep = scope_agents(F.col("agent"), rule.agent_ids)
    if rule.model is not None:
        keep = keep & F.col("model").eqNullSafe(rule.model)
    if rule.status == "error":
        keep = keep & F.col("error").isNotNull()
    if rule.contains is not None:
        keep = keep & match_contains(F.col("output"), [rule.contains])
    if rule.sample_rate < 1.0:
        keep = keep & sampled(F.col("span_id"), rule.rule_id, rule.sample_rate)
    return keep


def rule_filter(roots: DataFrame, rule: Rule) -> DataFrame:
    return roots.where(rule_condition(rule))


def route_rules(roots: DataFrame, rules: list[Rule], pending_reviews: DataFrame | None = None) -> DataFrame:
    """``(rule_id, action, span_id)`` for every match, in one scan for all rules.

    A trace already waiting for review is not queued again.
    """
    targets = [
        F.when(rule_condition(r), F.struct(F.lit(r.rule_id).alias("rule_id"), F.lit(r.action).alias("action"))) for r in rules
    ]
    routed = roots.select("span_id", F.explode(F.array_compact(F.array(*targets))).alias("t")).select("t.*", "span_id")
    if pending_reviews is None:
        return routed
    waiting = pending_reviews.where("status = 'pending'").select("span_id").distinct()
    reviews = routed.where("action = 'review'").join(waiting, "span_id", "left_anti").select(*routed.columns)
    return routed.where("action <> 'review'").unionByName(reviews)
