"""Callback event logs of three frameworks to spans, and model calls to the span they ran in.

``events(run_id, parent_id, kind, event, at, name, payload, model, input_tokens, output_tokens, error,
docs)``: one row per start, end or error callback.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanquarry.functions.messages import chain_input_text, chain_output_text
from spanquarry.functions.normalize import is_noise_chain, retrieval_join_text
from spanquarry.lineage import cut_lineage
from spanquarry.operators import sliced
from spanquarry.operators.trees import climb, climb_all

# Event kinds that can open a trace.
ROOT_KINDS = ("query", "agent_step", "llm", "retrieval")


def pair_events(events: DataFrame) -> DataFrame:
    """One row per run that started: start fields joined with its end or error.

    A run without an end (``ended`` is false) ends where it starts, so what ran under it keeps its place.
    """
    start = F.col("event") == "start"
    end = F.col("event").isin("end", "error")

    def at_start(c: str) -> Column:
        return F.max_by(c, F.when(start, F.col("at"))).alias(c)

    def at_end(c: str, name: str | None = None) -> Column:
        return F.max_by(c, F.when(end, F.col("at"))).alias(name or c)

    docs = [at_end("docs")] if "docs" in events.columns else []
    return (
        events.groupBy("run_id")
        .agg(
            at_start("parent_id"), at_start("kind"), at_start("name"), at_start("payload").alias("input"),
            F.min(F.when(start, F.col("at"))).alias("start_at"), F.max(F.when(end, F.col("at"))).alias("end_at"),
            at_end("payload", "output"), at_end("error"), F.coalesce(F.max(F.when(start, F.col("model"))), F.max("model")).alias("model"),
            at_end("input_tokens"), at_end("output_tokens"), *docs,
        )
        .where("start_at IS NOT NULL")
        .withColumn("ended", F.col("end_at").isNotNull())
        .withColumn("end_at", F.coalesce("end_at", "start_at"))
    )


def _took() -> Column:
    return F.floor((F.unix_micros("end_at") - F.unix_micros("start_at")) / 1000).cast("long")


def _numbered(runs: DataFrame, kind: str, label: str) -> DataFrame:
    """Counter names per root in the order the steps ended."""
    steps = sliced.sliced_window(
        runs.where(F.col("kind") == kind), ["root_id"], sliced.time_slice(F.col("end_at"), 3600), ["end_at", "run_id"], [sliced.row_number("__n")]
    )
    return steps.withColumn("name", F.coalesce("name", F.concat(F.lit(f"{label} "), F.col("__n").cast("string")))).drop("__n")


SPAN_FIELDS = ("run_id", "root_id", "parent_span_id", "span_kind", "name", "input", "output", "error", "model", "input_tokens", "output_tokens", "start_at", "latency_ms")


CHAIN_FIELDS = (*SPAN_FIELDS, "end_at", "doc_count")


def norm_chain_log(events: DataFrame) -> DataFrame:
    """Chain callbacks to a span tree.

    The root is the top-level chain; plumbing chains vanish and what ran under them hangs on the
    nearest kept chain, or on the root. Model calls and retrievals are numbered when unnamed; an
    unnamed tool is ``Tool call``; a failed tool keeps its output as its error. A chain that never
    ended stays, ending where it starts; calls and tools are spans once they have ended. A retrieval that returned
    documents (``docs``, an array of texts) has their joined text as output and their number as ``doc_count``.
    """
    runs = cut_lineage(pair_events(events))  # read by the climb and the join below
    top = (F.col("kind") == "chain") & F.col("parent_id").isNull()
    kept = (F.col("kind") == "chain") & (F.col("parent_id").isNull() | ~is_noise_chain(F.col("name")))
    above = climb_all(runs, "run_id", "parent_id", {"root_found": top, "kept_parent": kept}).withColumnRenamed("id", "run_id")
    placed = (
        runs.join(above, "run_id")
        .withColumn("root_id", F.when(top, F.col("run_id")).otherwise(F.col("root_found")))
        .where(F.col("root_id").isNotNull() & F.when(F.col("kind") == "chain", kept).otherwise(F.col("ended")))
        .withColumn("parent_span_id", F.when(~top, F.coalesce("kept_parent", "root_id")))
        .withColumn("span_kind", F.when(top, "agent").otherwise(F.col("kind")))
    )
    is_kind = lambda kind: F.col("kind") == kind
    docs = F.col("docs") if "docs" in runs.columns else F.lit(None).cast("array<string>")
    found = is_kind("retrieval") & docs.isNotNull()
    text = retrieval_join_text(docs)[0]
    fields = {
        "name": F.when(is_kind("tool"), F.coalesce("name", F.lit("Tool call"))).otherwise(F.col("name")),
        "error": F.when(is_kind("tool") & F.col("error").isNotNull(), F.coalesce("output", "error")).otherwise(F.col("error")),
        "output": F.when(found, text).otherwise(F.col("output")),
        "doc_count": F.when(found, F.size(docs).cast("bigint")),
        "latency_ms": _took(),
    }
    placed = cut_lineage(placed.select(*[c for c in placed.columns if c not in fields], *[c.alias(n) for n, c in fields.items()]))
    counted = placed.where(is_kind("llm") | is_kind("retrieval"))
    label = F.when(is_kind("llm"), "LLM Call").otherwise("Retrieval")
    steps = sliced.sliced_window(
        counted, ["root_id", "kind"], sliced.time_slice(F.col("end_at"), 3600), ["end_at", "run_id"], [sliced.row_number("number")]
    ).withColumn("name", F.coalesce("name", F.concat(label, F.lit(" "), F.col("number").cast("string"))))
    # not under a condition, where the parsed text would be parsed again for each use
    chains = placed.where(is_kind("chain")).withColumns({"input": chain_input_text(F.col("input")), "output": chain_output_text(F.col("output"))})
    return chains.select(*CHAIN_FIELDS).unionByName(placed.where(is_kind("tool")).select(*CHAIN_FIELDS)).unionByName(steps.select(*CHAIN_FIELDS))


def chain_tool_calls(spans: DataFrame) -> DataFrame:
    """The tool calls mirrored on each root of a normalised chain log, in the order they ended: one row per call with its position.

    Long form, as :func:`~spanquarry.operators.trees.tool_call_mirror`; ``nest_calls`` makes arrays of bounded blocks.
    """
    calls = spans.where("span_kind = 'tool'").select(
        "root_id", "run_id", "name", "input", F.coalesce("error", "output").alias("output"), F.col("error").isNull().alias("success"), "latency_ms", "end_at"
    )
    return sliced.sliced_window(calls, ["root_id"], sliced.time_slice(F.col("end_at"), 3600), ["end_at", "run_id"], [sliced.row_number("pos")])


def norm_query_log(events: DataFrame) -> DataFrame:
    """Query-engine callbacks to a root and its steps.

    A root is the first root-type event on its chain; every model call, retrieval and function below
    it becomes a direct child once it has ended. A failed step says so in its output; a root that never
    ended ends where it starts.
    """
    runs = cut_lineage(pair_events(events))
    rooting = F.col("kind").isin(*ROOT_KINDS)
    above = climb(runs, "run_id", "parent_id", rooting).select(F.col("id").alias("run_id"), F.col("found").alias("rooting_above"))
    marked = runs.join(above, "run_id").withColumn("is_root", rooting & F.col("rooting_above").isNull())
    found = climb(marked, "run_id", "parent_id", F.col("is_root")).select(F.col("id").alias("run_id"), F.col("found").alias("root_above"))
    placed = marked.join(found, "run_id").withColumn("root_id", F.when(F.col("is_root"), F.col("run_id")).otherwise(F.col("root_above"))).where("root_id IS NOT NULL")
    placed = cut_lineage(placed)
    ended = placed.where("ended")

    failed = F.concat(F.lit("ERROR: "), F.col("error"))
    llm = _numbered(ended, "llm", "LLM Call").withColumn("output", F.coalesce(F.nullif("output", F.lit("")), failed))
    retrieval = _numbered(ended, "retrieval", "Retrieval").withColumn("output", F.coalesce(failed, "output"))
    function = ended.where("kind = 'function'").withColumn("name", F.coalesce("name", F.lit("unknown"))).withColumn("output", F.coalesce(failed, "output"))
    steps = llm.unionByName(retrieval).unionByName(function)
    kind = F.when(F.col("kind") == "function", "tool").otherwise(F.col("kind"))
    # a root-type event that is itself a step appears both as the trace and as its own step
    step_id = F.when(F.col("is_root"), F.concat("run_id", F.lit(":step"))).otherwise(F.col("run_id"))
    children = (
        steps.withColumn("span_kind", kind).withColumn("parent_span_id", F.col("root_id")).withColumn("run_id", step_id)
        .withColumn("latency_ms", _took()).select(*SPAN_FIELDS)
    )

    known = lambda c: F.when(F.col(c).isNotNull(), F.struct("end_at", "run_id"))
    begun = F.when(F.col("input").isNotNull() & F.col("kind").isin("query", "llm", "retrieval"), F.struct("start_at", "run_id"))
    last_said = F.when(F.col("kind").isin("query", "llm") & (F.coalesce("output", F.lit("")) != ""), F.struct("end_at", "run_id"))
    roots = placed.groupBy("root_id").agg(
        F.min_by("input", begun).alias("input"),
        F.max_by("output", last_said).alias("output"),
        F.max_by("error", known("error")).alias("error"),
        F.min_by("model", F.when((F.col("kind") == "llm") & F.col("model").isNotNull(), F.struct("end_at", "run_id"))).alias("model"),
        F.nullif(F.sum(F.when(F.col("kind") == "llm", F.col("input_tokens"))), F.lit(0)).alias("input_tokens"),
        F.nullif(F.sum(F.when(F.col("kind") == "llm", F.col("output_tokens"))), F.lit(0)).alias("output_tokens"),
        F.min(F.when(F.col("is_root"), F.col("start_at"))).alias("start_at"),
        F.max(F.when(F.col("is_root"), F.col("end_at"))).alias("end_at"),
    )
    root_rows = (
        roots.withColumn("run_id", F.col("root_id")).withColumn("parent_span_id", F.lit(None).cast(runs.schema["run_id"].dataType))
        .withColumn("span_kind", F.lit("agent")).withColumn("name", F.lit("query")).withColumn("latency_ms", _took()).select(*SPAN_FIELDS)
    )
    return root_rows.unionByName(children)


def norm_agents_log(spans: DataFrame) -> DataFrame:
    """Agent SDK spans ``(trace_id, span_id, kind, name, input, output, model, input_tokens, output_tokens,
    error_message, error_data, start_at, end_at)`` to a root and direct children.

    Generation and response spans are numbered model calls; functions are tools. The root takes the
    first input, last output, first model and first error by end time, and the token sums.
    """
    text = F.when(
        F.col("error_message").isNotNull(),
        F.when(F.coalesce("error_data", F.lit("")) != "", F.concat("error_message", F.lit(" ("), "error_data", F.lit(")"))).otherwise(F.col("error_message")),
    )
    rows = spans.withColumn("error", text).withColumn("is_call", F.col("kind").isin("generation", "response"))
    order = F.struct("end_at", "span_id")

    def when_known(c: str) -> Column:
        return F.when(F.col("is_call") & (F.coalesce(c, F.lit("")) != ""), order)

    root = rows.groupBy("trace_id").agg(
        F.min_by("input", when_known("input")).alias("input"),
        F.max_by("output", when_known("output")).alias("output"),
        F.min_by("model", when_known("model")).alias("model"),
        F.min_by("error", F.when(F.col("error").isNotNull(), order)).alias("error"),
        F.coalesce(F.sum(F.when(F.col("is_call"), F.col("input_tokens"))), F.lit(0)).alias("input_tokens"),
        F.coalesce(F.sum(F.when(F.col("is_call"), F.col("output_tokens"))), F.lit(0)).alias("output_tokens"),
        F.min("start_at").alias("start_at"),
        F.max("end_at").alias("end_at"),
    )
    took = F.greatest(F.lit(0).cast("long"), _took())
    root = root.select("trace_id", F.lit("root").alias("span_id"), F.lit("agent").alias("span_kind"), F.lit("agent").alias("name"), "input", "output", "model", "error", "input_tokens", "output_tokens", "start_at", took.alias("latency_ms"))
    timed = rows.where("is_call AND start_at IS NOT NULL AND end_at IS NOT NULL")
    calls = sliced.sliced_window(timed, ["trace_id"], sliced.time_slice(F.col("end_at"), 3600), ["end_at", "span_id"], [sliced.row_number("__n")])
    sid = F.col("span_id").cast("string").alias("span_id")
    calls = calls.select("trace_id", sid, F.lit("llm").alias("span_kind"), F.concat(F.lit("LLM Call "), F.col("__n").cast("string")).alias("name"), "input", "output", "model", F.lit(None).cast("string").alias("error"), "input_tokens", "output_tokens", "start_at", took.alias("latency_ms"))
    none = F.lit(None)
    tools = rows.where("kind = 'function'").select("trace_id", sid, F.lit("tool").alias("span_kind"), "name", "input", "output", none.cast("string").alias("model"), "error", none.cast("long").alias("input_tokens"), none.cast("long").alias("output_tokens"), "start_at", took.alias("latency_ms"))
    return root.unionByName(calls).unionByName(tools)


def _covered(first: str, last: str, levels: int = 9) -> Column:
    """The slices first..last - 1 as an array of blocks (level, block) of 8^level slices.

    At most 14 blocks a level, so a span adds rows by the logarithm of its duration.
    """
    out = []
    for level in range(levels):
        x, y = ((f(F.col(c) / 8**level)).cast("long") for f, c in ((F.ceil, first), (F.floor, last)))
        up, down = ((f(F.col(c) / 8 ** (level + 1)) * 8).cast("long") for f, c in ((F.ceil, first), (F.floor, last)))
        split = F.lit(level + 1 < levels) & (up < down)
        for a, b in ((x, F.when(split, up).otherwise(y)), (F.when(split, down).otherwise(y), y)):
            blocks = F.when(a < b, F.sequence(a, b - 1)).otherwise(F.array().cast("array<bigint>"))
            out.append(F.transform(blocks, lambda n: F.struct(F.lit(level).alias("level"), n.alias("block"))))  # noqa: B023  called at once
    return F.flatten(F.array(*out))


def active_span(calls: DataFrame, spans: DataFrame, slice_seconds: int = 60) -> DataFrame:
    """Innermost span of the same scope that was running when a call was made: ``(call_id, span_id)``.

    ``calls(call_id, scope, at)``, ``spans(span_id, scope, start_at, end_at)``, half-open intervals, ids of any
    type that can be ordered; the innermost is the one that started last (ties: the largest id).

    Time is cut into slices. A span is sent to the slice it starts in and the one it ends in; the slices between are
    covered by few blocks of 8^n slices, and of the spans that cover a block only the one that started last can matter, which
    is found by a map-side combined maximum. Sorted slices then stream through one sweep that holds only the
    spans open at the time. No pairs are built, and a busy scope is spread over its slices.
    """
    width, levels = slice_seconds * 1_000_000, 9
    s = spans.select("scope", "span_id", F.unix_micros("start_at").alias("a"), F.unix_micros("end_at").alias("b")).where("b > a")
    s = s.withColumn("sa", F.floor(F.col("a") / width)).withColumn("sb", F.floor(F.col("b") / width))
    ends = s.withColumn("slice", F.explode(F.array_distinct(F.array("sa", "sb"))))
    cover = (
        s.where("sb - sa > 1")
        .withColumn("from", F.col("sa") + 1)
        .select("scope", "a", "span_id", F.inline(_covered("from", "sb", levels)))
        .groupBy("scope", "level", "block")
        .agg(F.max(F.struct("a", "span_id")).alias("c"))
    )
    c = calls.select("scope", "call_id", F.unix_micros("at").alias("a")).withColumn("slice", F.floor(F.col("a") / width))
    span_type, call_type = spans.schema["span_id"].dataType, calls.schema["call_id"].dataType
    rows = c.select("scope", "slice", "a", F.lit(None).cast("long").alias("b"), F.lit(True).alias("is_call"), "call_id", F.lit(None).cast(span_type).alias("span_id")).unionByName(
        ends.select("scope", "slice", "a", "b", F.lit(False).alias("is_call"), F.lit(None).cast(call_type).alias("call_id"), "span_id")
    )

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, open_spans, seen = None, [], 0
        for batch in batches:
            found, names = [], ("scope", "slice", "a", "b", "is_call", "call_id", "span_id")
            for scope, slice_no, a, b, is_call, call_id, span_id in zip(*(batch.column(n).to_pylist() for n in names)):
                if (scope, slice_no) != group:
                    group, open_spans = (scope, slice_no), []
                if not is_call:
                    seen += 1  # rows come in ascending order of start and id
                    heapq.heappush(open_spans, (-seen, a, b, span_id))
                    continue
                while open_spans and open_spans[0][2] <= a:
                    heapq.heappop(open_spans)
                top = open_spans[0] if open_spans else (None, None, None, None)
                found.append((call_id, scope, slice_no, top[1], top[3]))
            kinds = [batch.schema.field(n).type for n in ("call_id", "scope", "slice", "a", "span_id")]
            columns = zip(*found) if found else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds)], names=["call_id", "scope", "slice", "a", "span_id"])

    kinds = {"call_id": call_type, "scope": calls.schema["scope"].dataType, "span_id": span_type}
    ddl = {k: v.simpleString() for k, v in kinds.items()}
    # spans come before calls of the same moment; a batch may hold many slices and a slice many batches
    ordered = rows.repartition("scope", "slice").sortWithinPartitions("scope", "slice", "a", "is_call", "span_id")
    near = ordered.mapInArrow(sweep, f"call_id {ddl['call_id']}, scope {ddl['scope']}, slice BIGINT, a BIGINT, span_id {ddl['span_id']}")
    blocks = F.array(*[F.struct(F.lit(n).alias("level"), F.floor(F.col("slice") / 8**n).alias("block")) for n in range(levels)])
    over = (
        c.select("scope", "call_id", F.inline(blocks)).join(cover, ["scope", "level", "block"]).groupBy("call_id").agg(F.max("c").alias("c"))
    )
    best = F.greatest(F.when(F.col("a").isNotNull(), F.struct("a", "span_id")), F.col("c"))
    return near.join(over, "call_id", "left").select("call_id", best["span_id"].alias("span_id"))


def norm_call_log(calls: DataFrame, spans: DataFrame) -> DataFrame:
    """A model call is a child of the span active when it was made, else its own root of kind llm."""
    found = active_span(calls.select("call_id", "scope", "at"), spans).withColumnRenamed("span_id", "parent_span_id")
    return calls.join(found, "call_id").withColumn("span_kind", F.lit("llm")).withColumn("is_root", F.col("parent_span_id").isNull())
