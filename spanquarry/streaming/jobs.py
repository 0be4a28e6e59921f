"""Structured Streaming jobs. Each uses the same column functions as its batch twin; those with timers are in ``processors``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanquarry.functions.matching import Pattern
from spanquarry.operators import monitoring as M
from spanquarry.operators.routing import Rule, route_rules
from spanquarry.streaming import epochs


def monitor_stream(spans: DataFrame, patterns: Sequence[Pattern], sources: dict[str, str]) -> DataFrame:
    """Hits of every arriving production root; stateless."""
    return M.span_pattern(M.production_roots(spans), patterns, sources)


def dedupe_stream(spans: DataFrame, watermark: str = "24 hours", ts: str = "started_at", keys=("span_id",)) -> DataFrame:
    """At-least-once in, once stored; state is kept for the watermark only."""
    return spans.withWatermark(ts, watermark).dropDuplicatesWithinWatermark(list(keys))


def late_data(spans: DataFrame, stored: DataFrame, now: str, watermark_hours: int = 24) -> DataFrame:
    """Rows that came later than the stream's watermark at ``now``, for the batch path: not stored yet."""
    horizon = F.lit(now).cast("timestamp") - F.make_dt_interval(hours=F.lit(watermark_hours))
    return spans.where(F.col("started_at") < horizon).join(stored.select("span_id"), "span_id", "left_anti")


def rating_tumble(verdicts: DataFrame, width: str, watermark: str = "24 hours") -> DataFrame:
    return (
        verdicts.withWatermark("scored_at", watermark)
        .groupBy(F.window("scored_at", width))
        .agg(F.round(F.avg("rating"), 6).alias("average_rating"), F.count("rating").alias("n"))
        .select(F.unix_millis("window.start").alias("ts"), "average_rating", "n")
    )


def sliding_kpi_stream(facts: DataFrame, minutes: int, slide_minutes: int, watermark: str = "10 minutes") -> DataFrame:
    """Failure rate per agent over the last minutes at every slide."""
    return (
        facts.withWatermark("started_at", watermark)
        .groupBy(F.window("started_at", f"{minutes} minutes", f"{slide_minutes} minutes"), F.col("agent").alias("subject"))
        .agg(F.count("*").alias("runs"), F.count_if("failed").alias("f"))
        .select("subject", F.col("window.end").alias("tick"), "runs", F.round(F.col("f") / F.col("runs"), 6).alias("value"))
    )


def alert_stream(inputs: DataFrame) -> DataFrame:
    """Alert state machine per (rule, subject).

    ``inputs(rule_id, subject, kind, at, value, operator, threshold, cooldown_minutes)`` carries metric
    ticks and, as ``edit`` / ``delete`` rows, rule changes; a ``test`` tick changes nothing. A breach
    triggers, repeats each cooldown while it lasts and resolves on the first tick back in bounds; a
    null value holds the state; an edit or delete resolves a firing alert. Inputs are aggregated
    ticks, a few per minute and subject, so the state work does not grow with the traffic.
    """

    def step(key, batches, state):
        import pandas as pd

        firing, since, told = state.get if state.exists else (False, None, 0)
        since = None if since is None else pd.Timestamp(since)
        out = []
        compare = {"gt": lambda v, t: v > t, "gte": lambda v, t: v >= t, "lt": lambda v, t: v < t, "lte": lambda v, t: v <= t}
        for r in pd.concat(list(batches)).sort_values("at").itertuples():
            if r.kind == "test":
                continue
            if r.kind in ("edit", "delete"):
                if firing:
                    out.append(("resolved", r.at))
                firing, since, told = False, None, 0
                continue
            breach = firing if pd.isna(r.value) else compare[r.operator](r.value, r.threshold)
            if breach and not firing:
                out.append(("triggered", r.at))
                firing, since, told = True, r.at, 0
            elif breach:
                due = (r.at - since) // pd.Timedelta(minutes=int(r.cooldown_minutes))
                if due > told:
                    out.append(("repeat", r.at))
                    told = due
            elif firing:
                out.append(("resolved", r.at))
                firing, since, told = False, None, 0
        state.update((bool(firing), None if since is None else since.to_pydatetime(), int(told)))
        yield pd.DataFrame({"rule_id": [key[0]] * len(out), "subject": [key[1]] * len(out), "kind": [k for k, _ in out], "at": [a for _, a in out]})

    return inputs.groupBy("rule_id", "subject").applyInPandasWithState(
        step,
        "rule_id STRING, subject STRING, kind STRING, at TIMESTAMP",
        "firing BOOLEAN, since TIMESTAMP, told BIGINT",
        "append",
        "NoTimeout",
    )


def downvote_stream(feedback: DataFrame, roots: DataFrame) -> DataFrame:
    """Each down vote becomes a signal with the comment as summary; roots are a table."""
    r = roots.select(F.col("span_id").alias("trace_id"), "agent")
    return feedback.where("rating = 'down'").join(r, "trace_id").select(
        "trace_id", "agent", F.lit("downvote").alias("pattern_key"), F.col("comment").alias("summary"), "created_at"
    )


# -- sinks -------------------------------------------------------------------------------------


#: What a person may set a signal or a review to; signals are ``open`` and reviews ``pending`` until then.
SIGNAL_STATES, REVIEW_STATES = ("open", "acknowledged", "resolved", "muted"), ("pending", "labelled", "dismissed")


def signal_upsert(folder: str):
    """``foreachBatch`` writer that merges the hits of a micro-batch into the signals table.

    Every epoch writes a new complete version from the latest earlier one, so a retried batch
    produces the same table. Signals are one row per (pattern, agent), whatever the traffic. Hits never touch what people said of a signal:
    that is in the table of :func:`set_states`, which :func:`read_signals` joins.
    """

    def write(hits: DataFrame, epoch: int) -> None:
        merged = M.signal_rollup(hits)
        stored = epochs.version_before(hits.sparkSession, folder, epoch)
        if stored is not None:
            newest = F.struct("last_seen", "representative")
            merged = stored.unionByName(merged).groupBy("pattern_key", "agent").agg(
                F.min("first_seen").alias("first_seen"),
                F.max("last_seen").alias("last_seen"),
                F.sum("n").alias("n"),
                F.max_by("representative", newest).alias("representative"),
                F.max_by("polarity", newest).alias("polarity"),
                F.max_by("severity", newest).alias("severity"),
                F.max_by("status", newest).alias("status"),
            )
        merged.write.mode("overwrite").parquet(f"{folder}/epoch={epoch}")

    return write


def set_states(folder: str, changes: DataFrame, epoch: int, allowed: Sequence[str]) -> None:
    """Log state changes (keys, status, changed_at) as one epoch; an unknown status fails before anything is stored."""
    known = F.col("status").isin(*allowed)
    checked = changes.withColumn("status", F.when(known, F.col("status")).otherwise(F.raise_error(F.concat(F.lit("unknown status "), F.col("status")))))
    checked.write.mode("overwrite").parquet(f"{folder}/epoch={epoch}")


def latest_states(spark: SparkSession, folder: str | None, keys: Sequence[str]) -> DataFrame | None:
    """keys, set_to, changed_at of the latest change of each; None where nothing was ever changed."""
    logged = epochs.epochs(spark, folder) if folder else []
    if not logged:
        return None
    last = F.max_by("status", F.struct("changed_at", "status")).alias("set_to")
    return epochs.read(spark, folder, logged).groupBy(*keys).agg(last, F.max("changed_at").alias("changed_at"))


def read_signals(spark: SparkSession, folder: str, states: str | None = None) -> DataFrame:
    """The latest version; with ``states``, a signal has the status it was last set to, and ``recurred`` says whether a hit came after that.

    A resolved signal that is hit again stays resolved and recurred: opening it is for the people who closed it.
    """
    signals = epochs.latest(spark, folder)
    if states is None:
        return signals
    changed = latest_states(spark, states, ["pattern_key", "agent"])
    if changed is None:
        return signals.withColumn("recurred", F.lit(False))
    changed = changed.select(F.col("pattern_key").alias("k"), F.col("agent").alias("a"), "set_to", "changed_at")
    both = signals.join(changed, (F.col("pattern_key") == F.col("k")) & F.col("agent").eqNullSafe(F.col("a")), "left")
    recurred = F.coalesce((F.col("set_to") == "resolved") & (F.col("last_seen") > F.col("changed_at")), F.lit(False))
    kept = [F.coalesce("set_to", "status").alias(c) if c == "status" else F.col(c) for c in signals.columns]
    return both.select(*kept, recurred.alias("recurred"))


def pending_reviews(spark: SparkSession, folder: str, states: str | None, before: int | None = None) -> DataFrame | None:
    """Queued reviews (span_id, epoch) that wait: not labelled or dismissed. A change names the span and the epoch it was queued in."""
    some = [e for e in epochs.epochs(spark, folder) if before is None or e < before]
    if not some:
        return None
    queued = epochs.read(spark, folder, some).where("action = 'review'").select("span_id", "epoch").distinct()
    changed = latest_states(spark, states, ["span_id", "queued_in"])
    if changed is None:
        return queued
    done = changed.where("set_to <> 'pending'").select("span_id", F.col("queued_in").alias("epoch"))
    return queued.join(done, ["span_id", "epoch"], "left_anti")


def route_sink(folder: str, rules: list[Rule], states: str | None = None):
    """``foreachBatch`` writer: matches of every rule, one partition per epoch and action.

    A trace whose review waits is not queued again; one that was labelled or dismissed (``states``, by :func:`set_states`) is, when it matches anew.
    """

    def write(roots: DataFrame, epoch: int) -> None:
        waiting = pending_reviews(roots.sparkSession, folder, states, epoch)
        queued = None if waiting is None else waiting.select("span_id", F.lit("pending").alias("status"))
        routed = route_rules(roots, rules, queued)
        routed.write.mode("overwrite").partitionBy("action").parquet(f"{folder}/epoch={epoch}")

    return write


def cursor_sync(source: DataFrame, target: str, checkpoint: str, mapper=lambda df: df):
    """Pull what is new since the last run and stop; the checkpoint moves only when the batch is stored."""
    query = (
        mapper(source).writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query
