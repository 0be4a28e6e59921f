"""Registries: agents, tools, prompts and their versions; key sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanquarry.operators import sliced


def oldest_by_name(agents: DataFrame) -> DataFrame:
    """Duplicate names converge on the oldest entry."""
    age = F.struct("created_at", "agent_id")
    return agents.groupBy("name").agg(F.min_by("agent_id", age).alias("agent_id"), F.min("created_at").alias("created_at"))


def resolve_agent(spans: DataFrame, agents: DataFrame) -> DataFrame:
    known = oldest_by_name(agents).select(F.col("name").alias("agent"), "agent_id")
    return spans.join(known, "agent", "left")


def unregistered_tools(calls: DataFrame, registry: DataFrame) -> DataFrame:
    """Tools seen in traffic but not registered, with one captured definition if there is any."""
    seen = calls.groupBy("name").agg(F.count("*").alias("calls"), F.max("definition").alias("definition"))
    return seen.join(registry.select("name"), "name", "left_anti")


def register_if_absent(registry: DataFrame, incoming: DataFrame) -> DataFrame:
    """The stored row wins by name; among new rows of one name the first by ``arrival``."""
    fields = [c for c in registry.columns if c != "name"]
    first = incoming.groupBy("name").agg(F.min_by(F.struct(*fields), "arrival").alias("r"))
    fresh = first.join(registry.select("name"), "name", "left_anti").select("name", "r.*")
    return registry.unionByName(fresh)


def version_lookup(versions: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted(request_id, key, version)`` to one version row: a name match comes before an id match,
    the version asked for or else the latest."""
    def side(key: str, prefix: str) -> tuple[DataFrame, DataFrame]:
        exact = versions.groupBy(F.col(key).alias("key"), "version").agg(F.max("text").alias("text"))
        latest = exact.groupBy("key").agg(
            F.max("version").alias(f"{prefix}_version"), F.max_by("text", "version").alias(f"{prefix}_text")
        )
        return exact, latest

    exact_name, latest_name = side("name", "n")
    exact_id, latest_id = side("prompt_id", "i")
    # one row per request from here on: the version lists are reduced before they are joined
    r = wanted.withColumnRenamed("version", "asked").join(latest_name, "key", "left").join(latest_id, "key", "left")
    r = r.withColumn("by_name", F.col("n_version").isNotNull()).where("n_version IS NOT NULL OR i_version IS NOT NULL")
    newest = r.where("asked IS NULL").select(
        "request_id", F.coalesce("n_version", "i_version").alias("version"), F.when(F.col("by_name"), F.col("n_text")).otherwise(F.col("i_text")).alias("text")
    )
    named = r.where("asked IS NOT NULL AND by_name").select("request_id", "key", F.col("asked").alias("version"))
    by_id = r.where("asked IS NOT NULL AND NOT by_name").select("request_id", "key", F.col("asked").alias("version"))
    return (
        newest.unionByName(named.join(exact_name, ["key", "version"]).select("request_id", "version", "text"))
        .unionByName(by_id.join(exact_id, ["key", "version"]).select("request_id", "version", "text"))
    )


def version_number(log: DataFrame, slice_seconds: int = 30 * 86400) -> DataFrame:
    """Version per name in publication order and the text it replaces."""
    return sliced.sliced_window(
        log,
        ["name"],
        sliced.time_slice(F.col("published_at"), slice_seconds),
        ["published_at", "entry_id"],
        [sliced.row_number("version"), sliced.previous("prev_text", F.col("text"))],
    )


def enable_keys(enabled: DataFrame, given: DataFrame) -> DataFrame:
    return enabled.select("key").union(given.select("key")).distinct().orderBy("key")


def disable_keys(enabled: DataFrame, given: DataFrame) -> DataFrame:
    return enabled.select("key").subtract(given.select("key")).orderBy("key")


def missing_columns(df: DataFrame, required: set[str]) -> list[str]:
    return sorted(required - set(df.columns))


def template_split(patterns: DataFrame) -> DataFrame:
    """Built-in patterns are templates, the others custom."""
    kind = F.when(F.col("source") == "builtin", "template").otherwise("custom")
    return patterns.withColumn("kind", kind)


def union_sources(*frames: DataFrame) -> DataFrame:
    """Spans of several importers in one table; what a source does not know is null."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out
