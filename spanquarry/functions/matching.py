"""Failure patterns compiled to boolean Columns, so that all of them are checked in one scan."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Condition:
    value: str
    detector: str = "phrase"  # phrase | regex
    connector: str = "and"  # joins this condition to everything on its left
    negate: bool = False
    sources: tuple[str, ...] = ("response",)
    case_sensitive: bool = False


@dataclass(frozen=True)
class Pattern:
    """A pattern is configuration: it is written by people and arrives as a Python object."""

    key: str
    conditions: tuple[Condition, ...]
    polarity: str = "failure"
    severity: str = "medium"
    enabled: bool = True
    sample_rate: float = 1.0
    agent_ids: tuple[str, ...] | None = None  # None = every agent
    source: str = "custom"


def contains_phrase(text: Column, phrase: str, case_sensitive: bool = False, lowered: Column | None = None) -> Column:
    """``lowered`` is the lower-cased text where the caller has it already."""
    if case_sensitive:
        return F.contains(text, F.lit(phrase))
    return F.contains(F.lower(text) if lowered is None else lowered, F.lower(F.lit(phrase)))


def match_contains(
    text: Column, any_of: Sequence[str] = (), all_of: Sequence[str] = (), none_of: Sequence[str] = ()
) -> Column:
    """Any of / all of the phrases present, none of the excluded; null text matches nothing."""
    text = F.coalesce(text, F.lit(""))
    verdict = F.lit(True)
    if any_of:
        hit = F.lit(False)
        for phrase in any_of:
            hit = hit | contains_phrase(text, phrase)
        verdict = verdict & hit
    for phrase in all_of:
        verdict = verdict & contains_phrase(text, phrase)
    for phrase in none_of:
        verdict = verdict & ~contains_phrase(text, phrase)
    return verdict


def match_regex(text: Column, pattern: str, case_sensitive: bool = True) -> Column:
    """Java regular expression search; null text matches nothing."""
    flagged = pattern if case_sensitive else f"(?i){pattern}"
    return F.coalesce(text.rlike(flagged), F.lit(False))


def match_condition(condition: Condition, sources: dict[str, Column]) -> Column:
    """One condition over the union of its sources, negated as a whole."""
    hit = F.lit(False)
    for name in condition.sources:
        text = F.coalesce(sources[name], F.lit(""))
        if condition.detector == "regex":
            hit = hit | match_regex(text, condition.value, condition.case_sensitive)
        else:
            hit = hit | contains_phrase(text, condition.value, condition.case_sensitive, sources.get(f"{name}.lower"))
    return ~hit if condition.negate else hit


def match_conditions(conditions: Sequence[Condition], sources: dict[str, Column]) -> Column:
    """Fold left to right without precedence: ``a or b and c`` is ``(a or b) and c``."""
    verdict = None
    for condition in conditions:
        hit = match_condition(condition, sources)
        if verdict is None:
            verdict = hit
        else:
            verdict = (verdict | hit) if condition.connector == "or" else (verdict & hit)
    return F.lit(False) if verdict is None else verdict


def scope_agents(agent: Column, agent_ids: Sequence[str] | None) -> Column:
    return F.lit(True) if agent_ids is None else F.coalesce(agent.isin(*agent_ids), F.lit(False))


def restrict_ids(pattern_ids: Column, key: str, built_in_or_enabled: bool) -> Column:
    """Given ids fully define what runs; otherwise the built-in and enabled patterns run."""
    return F.when(pattern_ids.isNotNull(), F.array_contains(pattern_ids, key)).otherwise(built_in_or_enabled)
