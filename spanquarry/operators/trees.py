"""Span trees: ancestors, parents, sessions and root roll-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanquarry.lineage import cut_lineage
from spanquarry.operators import sliced


def climb(nodes: DataFrame, node_id: str, parent_id: str, stop: Column) -> DataFrame:
    """Nearest strict ancestor satisfying ``stop``: ``(id, found, steps)``; null where there is none.

    Pointer doubling: each round every unresolved pointer jumps to its target's pointer, so a tree
    of depth d takes log2(d) joins on the unique node id. A node whose chain ends, leaves the table
    or runs in a cycle gets null. Cycles never resolve; they are recognised because a round that
    resolves nothing proves that no finite chain is left (every chain contains all shorter ones).
    """
    key = nodes.schema[node_id].dataType
    state = nodes.select(
        F.col(node_id).alias("id"),
        F.col(parent_id).cast(key).alias("ptr"),
        F.coalesce(stop, F.lit(False)).alias("stop"),
        F.lit(None).cast(key).alias("found"),
        F.when(F.col(parent_id).isNotNull(), 1).otherwise(0).cast("int").alias("steps"),
    )
    pending = F.col("ptr").isNotNull() & F.col("found").isNull()
    left = None
    while True:
        target = state.select(
            F.col("id").alias("t_id"),
            F.col("ptr").alias("t_ptr"),
            F.col("steps").alias("t_steps"),
            F.when(F.col("stop"), F.col("id")).otherwise(F.col("found")).alias("t_found"),
            F.when(F.col("stop"), 0).otherwise(F.col("steps")).alias("t_add"),
        )
        moved = (
            state.where(pending)
            .join(target, F.col("ptr") == F.col("t_id"), "left")
            .select(
                "id",
                F.when(F.col("t_found").isNull(), F.col("t_ptr")).otherwise(F.col("ptr")).alias("ptr"),
                "stop",
                F.col("t_found").alias("found"),
                (F.col("steps") + F.coalesce(F.when(F.col("t_found").isNotNull(), F.col("t_add")), F.col("t_steps"), F.lit(0)))
                .cast("int")
                .alias("steps"),
            )
        )
        state = cut_lineage(state.where(~pending).unionByName(moved))
        now_left = state.where(pending).count()
        if now_left == 0 or now_left == left:
            break
        left = now_left
    return state.select("id", "found", F.when(F.col("found").isNotNull(), F.col("steps")).alias("steps"))


def climb_all(nodes: DataFrame, node_id: str, parent_id: str, stops: dict[str, Column]) -> DataFrame:
    """Nearest strict ancestor for several conditions in one climb: ``id`` and one column per name, null where there is none.

    As :func:`climb`, but the pointer goes on until every target is found, so n targets take the joins and checkpoints of one.
    """
    key = nodes.schema[node_id].dataType
    state = nodes.select(
        F.col(node_id).alias("id"),
        F.col(parent_id).cast(key).alias("ptr"),
        *[F.coalesce(stop, F.lit(False)).alias(f"stop_{n}") for n, stop in stops.items()],
        *[F.lit(None).cast(key).alias(n) for n in stops],
    )
    missing = F.lit(False)
    for n in stops:
        missing = missing | F.col(n).isNull()
    pending, left = F.col("ptr").isNotNull() & missing, None
    while True:
        target = state.select(
            F.col("id").alias("t_id"), F.col("ptr").alias("t_ptr"),
            *[F.when(F.col(f"stop_{n}"), F.col("id")).otherwise(F.col(n)).alias(f"t_{n}") for n in stops],
        )
        moved = state.where(pending).join(target, F.col("ptr") == F.col("t_id"), "left").select(
            "id", F.col("t_ptr").alias("ptr"), *[f"stop_{n}" for n in stops], *[F.coalesce(n, f"t_{n}").alias(n) for n in stops]
        )
        state = cut_lineage(state.where(~pending).unionByName(moved))
        now_left = state.where(pending).count()
        if now_left == 0 or now_left == left:
            break
        left = now_left
    return state.select("id", *stops)


def root_of(spans: DataFrame) -> DataFrame:
    """``span_id, root_id, depth``; a root is its own root at depth 0, orphans and cycles get null."""
    found = climb(spans, "span_id", "parent_span_id", F.col("parent_span_id").isNull())
    roots = spans.select(F.col("span_id").alias("id"), F.col("parent_span_id").isNull().alias("is_root"))
    return roots.join(found, "id").select(
        F.col("id").alias("span_id"),
        F.when(F.col("is_root"), F.col("id")).otherwise(F.col("found")).alias("root_id"),
        F.when(F.col("is_root"), F.lit(0)).otherwise(F.col("steps")).cast("long").alias("depth"),
    )


def nearest_kept_ancestor(spans: DataFrame, noise: Column) -> DataFrame:
    """Re-parent every kept span past noise ancestors; with none kept, to the trace root."""
    kept = spans.withColumn("__kept", ~F.coalesce(noise, F.lit(False)))
    found = climb(kept, "span_id", "parent_span_id", F.col("__kept"))
    return (
        kept.where("__kept")
        .join(found, F.col("span_id") == F.col("id"), "left")
        .select(
            "span_id",
            F.when(F.col("parent_span_id").isNotNull(), F.coalesce("found", "trace_id")).alias("parent_span_id"),
        )
    )


def parent_child(spans: DataFrame) -> DataFrame:
    """Parent link per span; a parent that is not in the trace becomes the trace root."""
    known = spans.select(F.col("trace_id").alias("p_trace"), F.col("span_id").alias("p_id"))
    return spans.join(
        known, (F.col("parent_span_id") == F.col("p_id")) & (F.col("trace_id") == F.col("p_trace")), "left"
    ).select(
        "span_id",
        "trace_id",
        F.when(F.col("parent_span_id").isNotNull(), F.coalesce("p_id", "trace_id")).alias("parent_span_id"),
    )


def roots(spans: DataFrame) -> DataFrame:
    return spans.where(F.col("parent_span_id").isNull())


def inherit_session(spans: DataFrame) -> DataFrame:
    """A child takes its root's session unless it names its own."""
    owner = roots(spans).select(F.col("trace_id").alias("r_trace"), F.col("session_id").alias("r_session"))
    return spans.join(owner, F.col("trace_id") == F.col("r_trace"), "left").select(
        *[F.coalesce("session_id", "r_session").alias(c) if c == "session_id" else F.col(c) for c in spans.columns]
    )


def session_id_derive(spans: DataFrame) -> DataFrame:
    """Own session, else the root's, else one made from the trace id."""
    return inherit_session(spans).withColumn(
        "session_id", F.coalesce("session_id", F.concat(F.lit("auto_"), F.col("trace_id").cast("string")))
    )


def span_offset(spans: DataFrame) -> DataFrame:
    """Milliseconds from the root's start; an unknown start counts as 0."""
    start = roots(spans).select(F.col("trace_id").alias("r_trace"), F.col("started_at").alias("r_start"))
    micros = F.unix_micros(F.col("started_at")) - F.unix_micros(F.col("r_start"))
    return spans.join(start, F.col("trace_id") == F.col("r_trace"), "left").select(
        "span_id", "trace_id", F.coalesce(F.floor(micros / 1000), F.lit(0)).cast("long").alias("offset_ms")
    )


def eval_stamp(spans: DataFrame, run_traces: DataFrame) -> DataFrame:
    """Spans made inside a run: source ``eval-run``, monitor off unless asked for, run id kept."""
    inside = run_traces.select(F.col("trace_id").alias("e_trace"), F.col("run_id").alias("e_run"))
    made = F.col("e_run").isNotNull()
    return spans.join(inside, F.col("trace_id") == F.col("e_trace"), "left").select(
        "span_id",
        "trace_id",
        F.when(made, F.lit("eval-run")).otherwise(F.col("source")).alias("source"),
        F.when(made, F.coalesce("monitor", F.lit(False))).otherwise(F.col("monitor")).alias("monitor"),
        F.col("e_run").alias("eval_run_id"),
    )


def root_token_sum(spans: DataFrame) -> DataFrame:
    """Token totals of a root over the children merged into it; absent stays null, never 0."""
    return (
        spans.where(F.col("parent_span_id").isNotNull())
        .groupBy("trace_id")
        .agg(
            F.sum(F.nullif("input_tokens", F.lit(0))).alias("input_tokens"),
            F.sum(F.nullif("output_tokens", F.lit(0))).alias("output_tokens"),
        )
    )


def tool_call_mirror(spans: DataFrame, slice_seconds: int = 3600) -> DataFrame:
    """The flat tool list of each root, one row per call with its position.

    Long form on purpose: a root that owns a third of all calls is spread over many tasks;
    :func:`nest_calls` makes arrays of bounded blocks of it.
    """
    calls = spans.where((F.col("span_kind") == "tool") & F.col("parent_span_id").isNotNull()).select(
        "trace_id",
        "span_id",
        "started_at",
        "latency_ms",
        F.col("error").isNull().alias("success"),
    )
    return sliced.sliced_window(
        calls,
        ["trace_id"],
        sliced.time_slice(F.col("started_at"), slice_seconds),
        ["started_at", "span_id"],
        [sliced.row_number("pos")],
    )


def nest_calls(calls: DataFrame, key: str, block: int = 1_000) -> DataFrame:
    """Ordered call arrays of each root, one row per ``block`` consecutive calls: every call is nested, and no array or
    task holds more than a block of a hot root."""
    fields = [c for c in calls.columns if c not in (key, "pos")]
    blocked = calls.withColumn("block", F.floor((F.col("pos") - 1) / block))
    return blocked.groupBy(key, "block").agg(
        F.count("*").alias("n_calls"), F.array_sort(F.collect_list(F.struct("pos", *fields))).alias("tool_calls")
    )


def root_summary(spans: DataFrame) -> DataFrame:
    """Per trace: first input, last output, first model and first error, by start time.

    ``min_by``/``max_by`` combine on the map side, so a hot trace sends one row per task.
    """
    at = F.struct("started_at", "span_id")

    def pick(fn, column):
        return fn(F.col(column), F.when(F.col(column).isNotNull(), at)).alias(column)

    return spans.groupBy("trace_id").agg(
        pick(F.min_by, "input"), pick(F.max_by, "output"), pick(F.min_by, "model"), pick(F.min_by, "error")
    )


def attach_pending(pending: DataFrame, root_ends: DataFrame, slice_seconds: int = 86400) -> DataFrame:
    """Records without an active parent ride on the next root sent after them.

    ``pending(record_id, scope, kind, at)`` and ``root_ends(root_id, scope, at)``, where a root is sent
    when it *ends*. Memory records are dropped; a record with no later root gets null.
    """
    both = (
        pending.where(F.col("kind").isin("tool", "retrieval"))
        .select("scope", "at", F.lit(0).alias("side"), F.col("record_id").alias("row_id"), F.lit(None).cast(root_ends.schema["root_id"].dataType).alias("root_id"))
        .unionByName(root_ends.select("scope", "at", F.lit(1).alias("side"), F.col("root_id").alias("row_id"), "root_id"))
    )
    return (
        sliced.sliced_window(
            both,
            ["scope"],
            sliced.time_slice(F.col("at"), slice_seconds),
            ["at", "side", "row_id"],
            [sliced.next_known("next_root", F.col("root_id"))],
        )
        .where("side = 0")
        .select(F.col("row_id").alias("record_id"), F.col("next_root").alias("root_id"))
    )


def auto_number(spans: DataFrame, shared_counter: bool = True, slice_seconds: int = 3600) -> DataFrame:
    """Names for unnamed model and retrieval spans: ``LLM Call N`` / ``Retrieval N`` in a trace.

    Only unnamed spans take a number. With ``shared_counter`` both kinds draw from one counter.
    """
    unnamed = spans.where(F.col("name").isNull() & F.col("span_kind").isin("llm", "retrieval"))
    keys = ["trace_id"] if shared_counter else ["trace_id", "span_kind"]
    numbered = sliced.sliced_window(
        unnamed, keys, sliced.time_slice(F.col("started_at"), slice_seconds), ["started_at", "span_id"], [sliced.row_number("n")]
    )
    label = F.when(F.col("span_kind") == "llm", "LLM Call ").otherwise("Retrieval ")
    return numbered.select("span_id", "trace_id", F.concat(label, F.col("n").cast("string")).alias("name"))
