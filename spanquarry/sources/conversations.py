"""Exported conversations, interactions and plugin calls to trace rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanquarry.functions.normalize import agent_name, first_field
from spanquarry.functions.times import epoch_time, latency_ms, parse_mixed_time

# Name and id formats of this source.
NAME_PREFIX = "moveworks-"
DEFAULT_NAME = "moveworks-assistant"
FRAMEWORK = "moveworks"
SPAN_PREFIX = "mw:"
SESSION_PREFIX = "mw_"
DEFAULT_TOOL = "moveworks-plugin"
# Candidate columns in order.
TEXT_FIELDS = ("utterance", "user_input", "text", "message", "query", "content")
RESPONSE_FIELDS = ("response", "bot_response", "reply", "answer")
START_FIELDS = ("created_time", "created_at", "timestamp", "event_time", "time", "start_time")
END_FIELDS = ("resolved_time", "completed_time", "end_time", "updated_time")


def record_time(df: DataFrame, *names: str) -> Column:
    """Instant of the first of these columns that is not blank in the row; null if it is no time.

    Columns may hold timestamps, epoch seconds or milliseconds, or text of either kind.
    """
    cases = []
    for name in (n for n in names if n in df.columns):
        value, kind = F.col(name), df.schema[name].dataType
        if isinstance(kind, T.StringType):
            cases.append((value.isNotNull() & (value != ""), parse_mixed_time(value)))
        else:
            cases.append((value.isNotNull(), epoch_time(value) if isinstance(kind, T.NumericType) else value.cast("timestamp")))
    if not cases:
        return F.lit(None).cast("timestamp")
    return reduce(lambda chain, case: chain.when(*case), cases[1:], F.when(*cases[0]))


def enrich_conversation(interactions: DataFrame, conversations: DataFrame) -> DataFrame:
    """Domain and route of an interaction, else of its conversation.

    Of several rows of one conversation the last counts: the one of the largest ``pos`` where there is such a column, else of the
    largest values. The conversation side is as large as the traffic, so the strategy is left to the optimizer.
    """
    fields = F.struct(first_field(conversations.columns, "domain").alias("c_domain"), first_field(conversations.columns, "route").alias("c_route"))
    last = F.struct(F.col("pos"), fields) if "pos" in conversations.columns else fields
    c = (
        conversations.where("conversation_id IS NOT NULL")
        .groupBy(F.col("conversation_id").cast("string").alias("c_id"))
        .agg(F.max_by(fields, last).alias("c"))
        .select("c_id", "c.c_domain", "c.c_route")
    )
    joined = interactions.join(c, F.col("conversation_id").cast("string") == F.col("c_id"), "left")
    keep = [x for x in interactions.columns if x not in ("domain", "route")]
    return joined.select(
        *keep,
        F.coalesce(first_field(interactions.columns, "domain"), "c_domain").alias("domain"),
        F.coalesce(first_field(interactions.columns, "route"), "c_route").alias("route"),
    )


def call_key(calls: DataFrame) -> DataFrame:
    """A call is indexed by its interaction, or else by its conversation."""
    return calls.withColumn("calls_key", first_field(calls.columns, "interaction_id", "conversation_id")).where("calls_key IS NOT NULL")


def named_calls(calls: DataFrame) -> DataFrame:
    """The long table of calls: ``calls_key``, position, name, and whether the result was served and used."""
    name = F.coalesce(first_field(calls.columns, "plugin_name", "name"), F.lit(DEFAULT_TOOL))
    # served and used say whether a result was shown, not whether the call succeeded
    flags = [first_field(calls.columns, f"is_{c}", c).cast("boolean").alias(c) for c in ("served", "used")]
    return call_key(calls).select("calls_key", "pos", name.alias("name"), *flags)


def attach_calls(interactions: DataFrame, calls: DataFrame) -> DataFrame:
    """Interactions with the key and number of their plugin calls.

    An interaction takes its own calls, or else those of its conversation, which several interactions
    may share. Calls are referred to by ``calls_key`` and stay in the long table of :func:`named_calls`, however many.
    """
    sizes = call_key(calls).groupBy("calls_key").agg(F.count("*").alias("n_calls"))
    own = sizes.select(F.col("calls_key").alias("own_key"))
    pick = interactions.join(own, F.col("interaction_id").cast("string") == F.col("own_key"), "left").withColumn(
        "calls_key", F.coalesce(F.col("own_key"), F.col("conversation_id").cast("string"))
    )
    out = pick.join(sizes, "calls_key", "left")
    return out.select(
        *interactions.columns,
        F.when(F.col("n_calls").isNotNull(), F.col("calls_key")).alias("calls_key"),
        F.coalesce("n_calls", F.lit(0)).alias("n_calls"),
    )


def import_conversations(interactions: DataFrame, conversations: DataFrame, calls: DataFrame, override: str | None = None) -> DataFrame:
    """Trace rows of the interactions that have a time; the others are skipped.

    ``metadata`` is JSON of the source and of those of conversation, interaction, type, domain, route and user that are known.
    """
    started, ended = record_time(interactions, *START_FIELDS), record_time(interactions, *END_FIELDS)
    timed = interactions.withColumns({"__started": started, "__ended": ended}).where("__started IS NOT NULL")
    rich = attach_calls(enrich_conversation(timed, conversations), calls)
    columns = rich.columns
    conversation = F.nullif(F.col("conversation_id").cast("string"), F.lit(""))
    interaction = F.nullif(F.col("interaction_id").cast("string"), F.lit(""))
    kind = first_field(columns, "interaction_type", "type")
    known = {
        "conversationId": F.when(conversation.isNotNull(), F.col("conversation_id")),
        "interactionId": interaction,
        "interactionType": kind,
        "domain": F.col("domain"),
        "route": F.col("route"),
        "userId": first_field(columns, "user_id"),
    }
    return rich.select(
        agent_name(override, F.col("domain"), NAME_PREFIX, DEFAULT_NAME).alias("name"),
        F.lit(FRAMEWORK).alias("framework"),
        F.concat(F.lit(SPAN_PREFIX), interaction).alias("span_id"),
        F.concat(F.lit(SESSION_PREFIX), conversation).alias("session_id"),
        (F.unix_micros("__started") * 1000).alias("started_at_ns"),
        latency_ms(F.col("__started"), F.col("__ended")).alias("latency_ms"),
        F.coalesce(
            first_field(columns, *TEXT_FIELDS), F.to_json(F.struct(F.coalesce(kind, F.lit("unknown")).alias("interaction_type")))
        ).alias("input"),
        first_field(columns, *RESPONSE_FIELDS).alias("output"),
        "domain",
        "route",
        F.to_json(F.struct(F.lit(FRAMEWORK).alias("source"), *[v.alias(k) for k, v in known.items()])).alias("metadata"),
        "calls_key",
        "n_calls",
    )


def sync_report(raw: DataFrame, imported: DataFrame, existing: DataFrame) -> DataFrame:
    """Counters of an import: read, skipped, stored, deduplicated, calls attached, sessions."""
    known = existing.select("span_id").distinct().withColumn("__known", F.lit(True))
    nil = F.lit(None)
    stored = imported.join(known, "span_id", "left").select(
        nil.cast("boolean").alias("timed"), F.col("__known").isNotNull().alias("known"), "n_calls", "session_id"
    )
    read = raw.select(record_time(raw, *START_FIELDS).isNotNull().alias("timed"), nil.cast("boolean").alias("known"), nil.cast("long").alias("n_calls"), nil.cast("string").alias("session_id"))
    return read.unionByName(stored).agg(
        F.count("timed").alias("interactions"),
        F.count_if(~F.col("timed")).alias("skipped_no_time"),
        F.count_if(~F.col("known")).alias("ingested"),
        F.count_if("known").alias("deduped"),
        F.sum("n_calls").alias("calls_attached"),
        F.countDistinct("session_id").alias("sessions"),
    )
