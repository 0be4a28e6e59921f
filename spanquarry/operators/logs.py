"""Exported callback logs to spans: pairing, timing, assembly."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanquarry.operators import sliced


def pair_tool_calls(requests: DataFrame, responses: DataFrame, slice_size: int = 10_000) -> DataFrame:
    """Responses with the request of their call id.

    A response takes the latest request of its id since the response before, so a call that is asked again is paired
    again; an unmatched response keeps its own name and step start. ``requests(run_id, call_id, pos, name, input,
    start_at)``, ``responses(run_id, call_id, pos, name, output, is_error, start_at, end_at)``.
    """
    asked = F.struct("name", "input", "start_at")
    events = responses.withColumn("__req", F.lit(None).cast(requests.select(asked.alias("r")).schema["r"].dataType)).unionByName(
        requests.where("call_id IS NOT NULL").select("run_id", "call_id", "pos", asked.alias("__req")), allowMissingColumns=True
    )
    # requests have no output flag; at one position they come first
    events = events.withColumn("__side", F.when(F.col("__req").isNull(), 1).otherwise(0))
    matched = sliced.sliced_window(
        events, ["run_id", "call_id"], sliced.position_slice(F.col("pos"), slice_size), ["pos", "__side", "name", "output"],
        [sliced.previous("__before", F.col("__req"))],
    ).where("__side = 1").drop("__req").withColumn("req", F.when(F.col("call_id").isNotNull(), F.col("__before")))
    req = F.col("req")
    text = F.when(F.col("is_error"), F.concat(F.lit("ERROR: "), F.coalesce("output", F.lit("None")))).otherwise(F.col("output"))
    start = F.coalesce(req["start_at"], "start_at")
    return matched.select(
        "run_id",
        "call_id",
        "pos",
        F.when(req.isNotNull(), req["name"]).otherwise(F.coalesce("name", F.lit("unknown"))).alias("name"),
        req["input"].alias("input"),
        text.alias("output"),
        (~F.col("is_error")).alias("success"),
        start.alias("start_at"),
        "end_at",
    )


def pair_fifo(starts: DataFrame, ends: DataFrame, keys: Sequence[str], slice_seconds: int = 3600) -> DataFrame:
    """Every end with the earliest start of its key that no end before it took; ``n`` numbers the ends of a key.

    Each side has ``keys, at, event_id`` and the same other columns, returned as ``start_...`` and ``end_...``. An end
    that finds no start open keeps null start fields and shifts no later pair: the ends lost so far are the running maximum of
    ends less starts (at least 0), and an end's start has the number of the end less those.
    """
    order = ["at", "event_id"]
    by = sliced.time_slice(F.col("at"), slice_seconds)
    both = starts.withColumn("__end", F.lit(0).cast("long")).unionByName(ends.withColumn("__end", F.lit(1).cast("long")))
    counted = sliced.sliced_window(
        both, keys, by, order, [sliced.running_sum("__ends", F.col("__end")), sliced.running_sum("__starts", 1 - F.col("__end"))]
    )
    excess = F.greatest(F.col("__ends") - F.col("__starts"), F.lit(0))
    lost = sliced.sliced_window(counted, keys, by, order, [sliced.running_max("__lost", excess, inclusive=False)])
    lost = lost.withColumn("__lost", F.coalesce("__lost", F.lit(0).cast("long")))
    fields = [c for c in starts.columns if c not in keys]
    s = lost.where("__end = 0").select(*keys, F.col("__starts").alias("__n"), *[F.col(c).alias(f"start_{c}") for c in fields])
    found = F.when(F.col("__ends") - F.col("__starts") <= F.col("__lost"), F.col("__ends") - F.col("__lost"))
    e = lost.where("__end = 1").select(
        *keys, F.col("__ends").alias("n"), found.alias("__n"), *[F.col(c).alias(f"end_{c}") for c in fields]
    )
    return e.join(s, [*keys, "__n"], "left").drop("__n")


def chain_timing(messages: DataFrame, slice_size: int = 10_000) -> DataFrame:
    """Step times of a message list ``(run_id, pos, created_at, run_start)``: a step starts when the
    message before it ended, the first one at the run's start; a missing time repeats the last one."""
    out = sliced.sliced_window(
        messages,
        ["run_id"],
        sliced.position_slice(F.col("pos"), slice_size),
        ["pos"],
        [
            sliced.last_known("__before", F.col("created_at"), inclusive=False),
            sliced.last_known("__upto", F.col("created_at")),
        ],
    )
    return out.withColumn("start_at", F.coalesce("__before", "run_start")).withColumn(
        "end_at", F.coalesce("__upto", "run_start")
    ).drop("__before", "__upto")


def even_split(steps: DataFrame, runs: DataFrame, slice_size: int = 10_000) -> DataFrame:
    """Consecutive equal slices of a run's latency for steps without times.

    ``steps(run_id, pos, …)``, ``runs(run_id, start_ms, latency_ms)``; times in epoch milliseconds.
    """
    numbered = sliced.sliced_window(
        steps, ["run_id"], sliced.position_slice(F.col("pos"), slice_size), ["pos"], [sliced.row_number("__i")]
    )
    counts = steps.groupBy("run_id").agg(F.count("*").alias("__n"))
    each = F.col("latency_ms") / F.col("__n")
    return (
        numbered.join(counts, "run_id")
        .join(runs, "run_id")
        .select(
            *steps.columns,
            each.alias("duration_ms"),
            (F.col("start_ms") + (F.col("__i") - 1) * each).alias("start_ms"),
            (F.col("start_ms") + F.col("__i") * each).alias("end_ms"),
        )
    )


def task_order(timings: DataFrame, slice_seconds: int = 3600) -> DataFrame:
    """Tasks by real start, not insertion; a missing end is the start; durations are at least 0."""
    end = F.coalesce("end_at", "start_at")
    micros = F.unix_micros(end) - F.unix_micros(F.col("start_at"))
    ordered = sliced.sliced_window(
        timings, ["run_id"], sliced.time_slice(F.col("start_at"), slice_seconds), ["start_at", "pos"], [sliced.row_number("step")]
    )
    return ordered.withColumn("duration_ms", F.greatest(micros / 1000.0, F.lit(0.0))).withColumn("end_at", end)


def pair_positional(ordered: DataFrame, outputs: DataFrame, slice_size: int = 10_000) -> DataFrame:
    """The i-th task by start gets the i-th output."""
    numbered = sliced.sliced_window(
        outputs, ["run_id"], sliced.position_slice(F.col("pos"), slice_size), ["pos"], [sliced.row_number("step")]
    ).drop("pos")
    return ordered.join(numbered, ["run_id", "step"], "left")


def ttft(chunks: DataFrame, starts: DataFrame) -> DataFrame:
    """Milliseconds to the first chunk of each call and the time of its last; no chunk, nulls.

    ``chunks(call_id, at)``, ``starts(call_id, started_at)``.
    """
    edges = chunks.groupBy("call_id").agg(F.min("at").alias("first_at"), F.max("at").alias("end_at"))
    wait = F.floor((F.unix_micros("first_at") - F.unix_micros("started_at")) / 1000)
    return starts.join(edges, "call_id", "left").select("call_id", wait.cast("long").alias("ttft_ms"), "end_at")


def _joined(value: Column, *order: str) -> Column:
    """Ordered concatenation of a group's non-null strings."""
    listed = F.array_sort(F.collect_list(F.when(value.isNotNull(), F.struct(*order, value.alias("v")))))
    return F.transform(listed, lambda x: x["v"])


def assemble_chunks(chunks: DataFrame, slice_size: int = 1000) -> DataFrame:
    """Streamed chunks to one row per call.

    ``chunks(call_id, seq, choice, delta, tool_index, tool_name, tool_args, model, input_tokens,
    output_tokens, has_usage, error)``. Text is joined per choice in sequence order, choices by newline
    in index order; without any text the merged tool calls are described. Usage comes from the last
    block, the model from the first chunk naming one, and a partial stream keeps its error.

    Fragments are joined per slice of the sequence first, so the tasks that build a long answer get
    a few strings per call instead of all of its chunks.
    """
    part = F.floor(F.col("seq") / slice_size)
    text = (
        chunks.where(F.coalesce("delta", F.lit("")) != "")
        .groupBy("call_id", F.coalesce("choice", F.lit(0)).alias("choice"), part.alias("part"))
        .agg(F.array_join(_joined(F.col("delta"), "seq"), "").alias("t"))
        .groupBy("call_id", "choice")
        .agg(F.array_join(_joined(F.col("t"), "part"), "").alias("t"))
        .groupBy("call_id")
        .agg(F.array_join(_joined(F.col("t"), "choice"), "\n").alias("output_text"))
    )
    tools = (
        chunks.where(F.col("tool_index").isNotNull())
        .groupBy("call_id", "tool_index", part.alias("part"))
        .agg(
            F.max_by("tool_name", F.when(F.coalesce("tool_name", F.lit("")) != "", F.col("seq"))).alias("name"),
            F.array_join(_joined(F.col("tool_args"), "seq"), "").alias("args"),
        )
        .groupBy("call_id", "tool_index")
        .agg(
            F.max_by("name", F.when(F.col("name").isNotNull(), F.col("part"))).alias("name"),
            F.array_join(_joined(F.col("args"), "part"), "").alias("args"),
        )
        .withColumn("d", F.concat(F.coalesce("name", F.lit("unknown")), F.lit("("), F.col("args"), F.lit(")")))
        .groupBy("call_id")
        .agg(F.concat(F.lit("[tool call] "), F.array_join(_joined(F.col("d"), "tool_index"), ", ")).alias("tool_text"))
    )
    usage_at = F.when(F.col("has_usage"), F.col("seq"))
    facts = chunks.groupBy("call_id").agg(
        F.min_by("model", F.when(F.coalesce("model", F.lit("")) != "", F.col("seq"))).alias("model"),
        F.max_by("input_tokens", usage_at).alias("input_tokens"),
        F.max_by("output_tokens", usage_at).alias("output_tokens"),
        F.max_by("error", F.when(F.col("error").isNotNull(), F.col("seq"))).alias("error"),
    )
    return facts.join(text, "call_id", "left").join(tools, "call_id", "left").select(
        "call_id", F.coalesce("output_text", "tool_text").alias("output"), "model", "input_tokens", "output_tokens", "error"
    )


def ttl_sweep(starts: DataFrame, ends: DataFrame, now: str, ttl_seconds: int = 3600) -> DataFrame:
    """Runs older than the limit whose end never came.

    Where ``ends`` has ``ended_at``, an end later than the limit finds the run dropped already, so it does not count.
    """
    limit = F.make_dt_interval(secs=F.lit(ttl_seconds))
    old = starts.where(F.col("started_at") < F.lit(now).cast("timestamp") - limit)
    if "ended_at" not in ends.columns:
        return old.join(ends.select("run_id"), "run_id", "left_anti")
    came = ends.select(F.col("run_id").alias("r"), "ended_at")
    within = (F.col("run_id") == F.col("r")) & F.col("ended_at").between(F.col("started_at"), F.col("started_at") + limit)
    return old.join(came, within, "left_anti")


def norm_team_log(messages: DataFrame) -> DataFrame:
    """Team messages to spans.

    ``messages(run_id, pos, kind, created_at, run_start, source, text, call_id, call_name, call_args,
    is_error, input_tokens, output_tokens)``. A message with token counts is a step named after its
    speaker (then an agent turn) or numbered; a tool result is a tool span paired with its request.
    Requests carry tokens that are not summed, as specified.
    """
    timed = chain_timing(messages)
    asked = timed.where("kind = 'request'").select(
        "run_id", "call_id", "pos", F.col("call_name").alias("name"), F.col("call_args").alias("input"), "start_at"
    )
    done = timed.where("kind = 'execution'").select(
        "run_id", "call_id", "pos", F.col("call_name").alias("name"), F.col("text").alias("output"), "is_error", "start_at", "end_at"
    )
    tools = pair_tool_calls(asked, done).select(
        "run_id", "pos", F.lit("tool").alias("span_kind"), "name", "input", "output", "success", "start_at", "end_at",
        F.lit(None).cast("long").alias("input_tokens"), F.lit(None).cast("long").alias("output_tokens"),
    )
    spoken = timed.where("kind = 'text' AND (input_tokens IS NOT NULL OR output_tokens IS NOT NULL)")
    numbered = sliced.sliced_window(
        spoken, ["run_id"], sliced.position_slice(F.col("pos")), ["pos"], [sliced.row_number("__n")]
    )
    named = F.coalesce("source", F.lit("")) != ""
    steps = numbered.select(
        "run_id", "pos",
        F.when(named, "agent").otherwise("llm").alias("span_kind"),
        F.when(named, F.col("source")).otherwise(F.concat(F.lit("LLM Call "), F.col("__n").cast("string"))).alias("name"),
        F.lit(None).cast("string").alias("input"), F.col("text").alias("output"), F.lit(None).cast("boolean").alias("success"),
        "start_at", "end_at", "input_tokens", "output_tokens",
    )
    return steps.unionByName(tools)


def team_totals(messages: DataFrame) -> DataFrame:
    """Per run: last text and token sums over text messages only."""
    text = F.col("kind") == "text"
    return messages.groupBy("run_id").agg(
        F.max_by("text", F.when(text & (F.coalesce("text", F.lit("")) != ""), F.col("pos"))).alias("output"),
        F.coalesce(F.sum(F.when(text, F.col("input_tokens"))), F.lit(0)).alias("input_tokens"),
        F.coalesce(F.sum(F.when(text, F.col("output_tokens"))), F.lit(0)).alias("output_tokens"),
    )


def norm_crew_log(timings: DataFrame, outputs: DataFrame, name_limit: int | None = None) -> DataFrame:
    """Crew tasks to agent spans in real start order; names keep their first ``name_limit`` characters (default: all).

    ``timings(run_id, pos, name, start_at, end_at, error)``, ``outputs(run_id, pos, description, raw)``.
    """
    paired = pair_positional(task_order(timings), outputs)
    label = F.coalesce(F.nullif("name", F.lit("")), F.nullif("description", F.lit("")), F.concat(F.lit("Task "), F.col("step").cast("string")))
    failed = F.coalesce("error", F.lit("")) != ""
    return paired.select(
        "run_id", "step", (label if name_limit is None else F.left(label, F.lit(name_limit))).alias("name"), F.lit("agent").alias("span_kind"),
        F.col("description").alias("input"),
        F.when(failed, F.concat(F.lit("ERROR: "), F.col("error"))).otherwise(F.col("raw")).alias("output"),
        "start_at", "end_at", "duration_ms",
    )


def norm_plugin_log(events: DataFrame) -> DataFrame:
    """Plugin callbacks ``(run_id, event, tool, at, event_id, payload, error)`` to model and tool spans.

    Model ends pair with model starts per run, tool ends with tool starts per run and tool, first in
    first out; an end without a start has no start time and latency; a failed tool has success = false.
    """

    def side(event: str, keys: list[str]) -> DataFrame:
        return events.where(F.col("event") == event).select(*keys, "at", "event_id", "payload", "error")

    model = pair_fifo(side("model_start", ["run_id"]), side("model_end", ["run_id"]), ["run_id"])
    tool = pair_fifo(side("tool_start", ["run_id", "tool"]), side("tool_end", ["run_id", "tool"]), ["run_id", "tool"])
    took = F.floor((F.unix_micros("end_at") - F.unix_micros("start_at")) / 1000).cast("long")
    fields = [
        F.col("start_payload").alias("input"), F.col("end_payload").alias("output"), F.col("end_error").alias("error"),
        F.col("start_at"), took.alias("latency_ms"),
    ]
    no_flag = F.lit(None).cast("boolean").alias("success")
    m = model.select("run_id", F.lit("llm").alias("span_kind"), F.concat(F.lit("LLM Call "), F.col("n").cast("string")).alias("name"), *fields, no_flag)
    t = tool.select("run_id", F.lit("tool").alias("span_kind"), F.col("tool").alias("name"), *fields, F.col("end_error").isNull().alias("success"))
    return m.unionByName(t)


def alert_states(ticks: DataFrame, operator: str, threshold: float, slice_seconds: int = 86400) -> DataFrame:
    """Ticks of incidents: (subject, tick, firing, was, previous_tick, incident, started_at).

    ``ticks(subject, tick, value)``; a null value holds the state. ``was`` is the state at the previous tick, ``started_at`` the first tick of
    the incident; from the first incident on, quiet ticks belong to the incident before them.

    Each slice of time is windowed once and says how it changes the state: the last known breach, the incidents that begin within it, the start
    of the latest, and its first known tick if that breaches, which begins an incident only where the slice is entered quiet. These
    transitions are composed slice by slice, and each tick combines its own part with the state its slice is entered in.
    """
    v = F.col("value")
    breach = {"gt": v > threshold, "gte": v >= threshold, "lt": v < threshold, "lte": v <= threshold}[operator]
    tick = F.col("tick")
    own = Window.partitionBy("subject", "slice").orderBy("tick")
    before, upto = (own.rowsBetween(Window.unboundedPreceding, n) for n in (-1, 0))
    known = ticks.select("subject", "tick", breach.alias("breach"), sliced.time_slice(tick, slice_seconds).alias("slice")).withColumns(
        {"held": F.last("breach", ignorenulls=True).over(before), "own_previous": F.lag("tick").over(own)}
    )
    local = known.withColumns(
        {
            "begins": F.count(F.when(F.col("breach") & ~F.col("held"), tick)).over(upto),
            "began": F.last(F.when(F.col("breach") & ~F.col("held"), tick), ignorenulls=True).over(upto),
            "lead": F.max(F.when(F.col("breach") & F.col("held").isNull(), tick)).over(upto),
        }
    )
    last = F.max(F.struct("tick", F.coalesce("breach", "held").alias("held"), "begins", "began", "lead")).alias("last")
    slices = local.groupBy("subject", "slice").agg(last).select("subject", "slice", "last.*")
    across = Window.partitionBy("subject").orderBy("slice")
    past = across.rowsBetween(Window.unboundedPreceding, -1)
    entered = slices.withColumn("entered", F.coalesce(F.last("held", ignorenulls=True).over(past), F.lit(False)))
    led = F.col("lead").isNotNull() & ~F.col("entered")
    start = F.coalesce("began", F.when(led, F.col("lead")))
    carried = entered.select(
        F.col("subject").alias("s"), F.col("slice").alias("n"), "entered",
        F.coalesce(F.sum(F.col("begins") + led.cast("long")).over(past), F.lit(0)).alias("incidents"),
        F.last(start, ignorenulls=True).over(past).alias("since"),
        F.lag("tick").over(across).alias("tick_before"),
    )
    was = F.coalesce("held", "entered")
    return local.join(carried, F.col("subject").eqNullSafe(F.col("s")) & (F.col("slice") == F.col("n"))).select(
        "subject", "tick", F.coalesce(F.col("breach"), was).alias("firing"), was.alias("was"),
        F.coalesce("own_previous", "tick_before").alias("previous_tick"),
        (F.col("incidents") + F.col("begins") + led.cast("long")).alias("incident"), F.coalesce(start, "since").alias("started_at"),
    ).where("incident > 0")


def breach_islands(states: DataFrame) -> DataFrame:
    """Incidents: ``resolved_at`` is the first tick back in bounds, null while firing."""
    on = F.col("firing")
    return states.groupBy("subject", "incident").agg(
        F.min(F.when(on, F.col("tick"))).alias("started_at"),
        F.max(F.when(on, F.col("tick"))).alias("last_firing_at"),
        F.count_if(on).alias("firing_ticks"),
        F.min(F.when(~on, F.col("tick"))).alias("resolved_at"),
    )


def alert_events(states: DataFrame, cooldown_minutes: int = 60) -> DataFrame:
    """Triggered at the first firing tick, repeat at the first tick of every further cooldown
    period while firing, resolved at the first tick back in bounds. Each tick tells by itself and the one before it."""
    period = lambda c: F.floor((F.unix_seconds(c) - F.unix_seconds("started_at")) / (cooldown_minutes * 60))
    kind = (
        F.when(F.col("firing") & ~F.col("was"), "triggered")
        .when(F.col("firing") & (period("tick") > period("previous_tick")), "repeat")
        .when(~F.col("firing") & F.col("was"), "resolved")
    )
    return states.select("subject", "incident", kind.alias("kind"), F.col("tick").alias("at")).where("kind IS NOT NULL")


def sliding_kpi(facts: DataFrame, minutes: int, slide_minutes: int = 1) -> DataFrame:
    """Failure rate per agent over the last ``minutes`` at every tick: ``(subject, tick, runs, value)``.

    Rows are first counted per slide step, so what is repeated for the overlapping windows is one
    row per agent and step, however many traces fall into it.
    """
    width = slide_minutes * 60
    if minutes % slide_minutes:
        raise ValueError("the window must be a multiple of the slide")
    step = F.floor(F.unix_seconds("started_at") / width) + 1
    per_step = facts.groupBy(F.col("agent").alias("subject"), step.alias("step")).agg(
        F.count("*").alias("n"), F.count_if("failed").alias("f")
    )
    spread = per_step.withColumn("tick", F.explode(F.sequence(F.col("step"), F.col("step") + minutes // slide_minutes - 1)))
    return spread.groupBy("subject", F.timestamp_seconds(F.col("tick") * width).alias("tick")).agg(
        F.sum("n").alias("runs"), F.round(F.sum("f") / F.sum("n"), 6).alias("value")
    )
