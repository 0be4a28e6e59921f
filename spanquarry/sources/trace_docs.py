"""Nested trace documents (info + spans) to span rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Id and session prefixes, session keys in order, and the source label.
TRACE_PREFIX = "dbx:"
SESSION_PREFIX = "dbx_"
SOURCE = "databricks"

SPAN = (
    "STRUCT<span_id: STRING, parent_id: STRING, name: STRING, span_type: STRING, start_time_ns: BIGINT, end_time_ns: BIGINT, "
    "inputs: STRING, outputs: STRING, status: STRUCT<status_code: STRING, description: STRING>>"
)
TRACE = (
    "info STRUCT<trace_id: STRING, experiment_id: STRING, state: STRING, request_time: BIGINT, "
    "trace_metadata: MAP<STRING, STRING>, tags: MAP<STRING, STRING>>, data STRUCT<spans: ARRAY<" + SPAN + ">>"
)


def wire_span_id(trace_id: Column, span_id: Column, is_root: Column) -> Column:
    root = F.concat(F.lit(TRACE_PREFIX), trace_id)
    return F.when(is_root, root).otherwise(F.concat_ws(":", root, span_id))


SESSION_KEYS = ("mlflow.trace.session", "mlflow.trace.session_id", "session_id")


def in_sync_window(docs: DataFrame, since_ms: int, until_ms: int) -> DataFrame:
    """``[since, until)`` by request time; documents without a time pass, as specified."""
    t = F.col("info.request_time")
    return docs.where(t.isNull() | ((t >= since_ms) & (t < until_ms)))


def skip_in_progress(docs: DataFrame) -> DataFrame:
    return docs.where(~F.upper(F.coalesce("info.state", F.lit(""))).contains("IN_PROGRESS"))


def import_traces(docs: DataFrame, override: str | None = None) -> DataFrame:
    """Span rows with stable ids, sessions and, on the root, the tool-call mirror.

    Everything a span needs is in its own document, so the whole import is one projection and one
    explode, without a shuffle. Parents that the document does not hold are found by one hashed set difference, so
    a span is not compared with the ids of all others; in sound documents none are.
    """
    spans = F.col("data.spans")
    sound = docs.where((F.coalesce("info.trace_id", F.lit("")) != "") & (F.size(spans) > 0))
    no_parent = F.filter(spans, lambda s: F.coalesce(s["parent_id"], F.lit("")) == "")
    root = F.when(F.size(no_parent) > 0, F.element_at(no_parent, 1)).otherwise(F.element_at(spans, 1))
    # tags overwrite trace metadata of the same key
    tags, meta = F.col("info.tags"), F.col("info.trace_metadata")
    named = [F.nullif(F.when(F.map_contains_key(tags, k), tags[k]).otherwise(meta[k]), F.lit("")) for k in SESSION_KEYS]

    def failed(s: Column) -> Column:
        return F.upper(F.coalesce(s["status"]["status_code"], F.lit(""))).contains("ERROR")

    def took(s: Column) -> Column:
        start, end = s["start_time_ns"], s["end_time_ns"]
        return F.when((start > 0) & (end > start), F.floor((end - start) / 1_000_000).cast("long"))

    tools = F.transform(
        F.filter(spans, lambda s: F.upper(F.coalesce(s["span_type"], F.lit(""))) == "TOOL"),
        lambda s: F.struct(
            F.coalesce(s["name"], F.lit("tool")).alias("name"), s["inputs"].alias("input"), s["outputs"].alias("output"),
            took(s).alias("latency_ms"), (~failed(s)).alias("success"),
        ),
    )
    flat = sound.select(
        F.col("info.trace_id").alias("trace"),
        F.col("info.experiment_id").alias("experiment_id"),
        F.concat(F.lit(SESSION_PREFIX), F.coalesce(*named)).alias("session_id"),
        F.coalesce(F.nullif(root["span_id"], F.lit("")), F.lit("root")).alias("root_id"),
        F.array_position(spans, root).alias("root_pos"),
        F.array_except(F.transform(spans, lambda s: s["parent_id"]), F.transform(spans, lambda s: s["span_id"])).alias("lost"),
        tools.alias("tools"),
        spans.alias("spans"),
    ).select("*", F.posexplode("spans").alias("pos", "s"))
    s = F.col("s")
    is_root = F.col("pos") + 1 == F.col("root_pos")
    own_id = F.coalesce(F.nullif(s["span_id"], F.lit("")), F.lit("span"))
    parent = F.coalesce(s["parent_id"], F.lit(""))
    known_parent = ~F.array_contains("lost", parent) & (parent != "") & (parent != F.col("root_id"))
    return flat.select(
        F.when(is_root & F.lit(override is not None), F.lit(override)).otherwise(F.coalesce(s["name"], F.lit("span"))).alias("name"),
        F.lit(SOURCE).alias("framework"),
        wire_span_id(F.col("trace"), own_id, is_root).alias("span_id"),
        F.when(~is_root, wire_span_id(F.col("trace"), parent, ~known_parent)).alias("parent_span_id"),
        "session_id",
        F.when(s["start_time_ns"] > 0, s["start_time_ns"]).alias("started_at_ns"),
        took(s).alias("latency_ms"),
        s["inputs"].alias("input"),
        s["outputs"].alias("output"),
        F.when(failed(s), F.coalesce(F.nullif(s["status"]["description"], F.lit("")), F.lit("error"))).alias("error"),
        F.when(is_root, F.col("trace")).alias("source_trace_id"),
        F.when(is_root, F.nullif("experiment_id", F.lit(""))).alias("experiment_id"),
        F.when(is_root & (F.size("tools") > 0), F.col("tools")).alias("tool_calls"),
    )
