"""Judge calibration against real outcomes, tuning, evidence and review."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanquarry.operators import sliced
from spanquarry.operators.monitoring import ratio

# A review label outranks a reported outcome, which outranks a vote.
TRUTH_RANK = {"review": 1, "outcome": 2, "vote": 3}


def truth(outcomes: DataFrame, feedback: DataFrame, reviews: DataFrame) -> DataFrame:
    """One truth per subject out of reported outcomes, votes and review labels.

    ``outcomes(subject_id, truth_bad)`` carries trace or result ids; a down vote and a ``bad`` label say bad.
    """
    parts = [
        outcomes.where("truth_bad IS NOT NULL").select("subject_id", F.lit("outcome").alias("origin"), "truth_bad"),
        feedback.select(F.col("trace_id").alias("subject_id"), F.lit("vote").alias("origin"), (F.col("rating") == "down").alias("truth_bad")),
        reviews.where("label IS NOT NULL").select("subject_id", F.lit("review").alias("origin"), (F.col("label") == "bad").alias("truth_bad")),
    ]
    rank = F.lit(9)
    for name, value in TRUTH_RANK.items():
        rank = F.when(F.col("origin") == name, value).otherwise(rank)
    # Among votes of one subject a single bad one decides.
    best = F.struct(rank, ~F.col("truth_bad"))
    return (
        parts[0].unionByName(parts[1]).unionByName(parts[2])
        .groupBy("subject_id")
        .agg(F.min_by("origin", best).alias("origin"), F.min_by("truth_bad", best).alias("truth_bad"))
    )


def verdict_truth(verdicts: DataFrame, truths: DataFrame, bad_below: float = 5.0) -> DataFrame:
    """Truths with the judge's mark; ``judge_bad`` is null where no verdict was given."""
    v = verdicts.select("subject_id", (F.col("rating") < bad_below).alias("judge_bad"))
    return truths.join(v, "subject_id", "left")


def alpha(n: Column, disagreements: Column, n1: Column) -> Column:
    """Krippendorff's alpha of two binary coders in closed form; null if all labels are equal."""
    spread = n1 * (2 * n - n1)
    return F.when(spread > 0, 1.0 - disagreements * (2 * n - 1) / spread)


def alpha_band(a: Column) -> Column:
    return (
        F.when(a < 0, "poor").when(a <= 0.2, "slight").when(a <= 0.4, "fair").when(a <= 0.6, "moderate")
        .when(a <= 0.8, "substantial").when(a.isNotNull(), "near-perfect")
    )


def calibration(pairs: DataFrame, alpha_min_items: int = 10, keys: tuple[str, ...] = ()) -> DataFrame:
    """Agreement of judge and truth. Positive means that the verdict says bad."""
    j, b = F.col("judge_bad"), F.col("truth_bad")
    counts = pairs.groupBy(*keys).agg(
        F.count_if(j.isNotNull()).alias("compared"),
        F.count_if(j & b).alias("tp"),
        F.count_if(j & ~b).alias("fp"),
        F.count_if(~j & b).alias("fn"),
        F.count_if(~j & ~b).alias("tn"),
        F.count_if(F.col("origin") != "review").alias("reported"),
        F.count_if(F.col("origin") == "review").alias("review_labels"),
        F.count_if(j.isNull()).alias("no_verdict"),
    )
    tp, fp, fn, tn, n = (F.col(c) for c in ("tp", "fp", "fn", "tn", "compared"))
    a = F.when(n >= alpha_min_items, alpha(n, fp + fn, 2 * tp + fp + fn))
    return counts.select(
        *keys,
        "compared",
        F.round(ratio(tp + tn, n), 6).alias("agreement"),
        F.round(ratio(fp, fp + tn), 6).alias("false_positive_rate"),
        F.round(ratio(fn, fn + tp), 6).alias("false_negative_rate"),
        F.round(a, 6).alias("alpha"),
        alpha_band(a).alias("alpha_band"),
        "reported",
        "review_labels",
        "no_verdict",
    )


def rating_mae(verdicts: DataFrame) -> DataFrame:
    """Mean absolute error of the judge against corrected scores, over pairs with both numbers."""
    error = F.abs(F.col("rating") - F.col("corrected_score"))
    return verdicts.agg(F.round(F.avg(error), 6).alias("mae"), F.count(error).alias("n"))


def tuning_delta(old: DataFrame, new: DataFrame, truths: DataFrame) -> DataFrame:
    """What a changed rubric fixes and breaks against the truth."""
    both = (
        truths.select("subject_id", "truth_bad")
        .join(old.select("subject_id", F.col("judge_bad").alias("old_bad")), "subject_id")
        .join(new.select("subject_id", F.col("judge_bad").alias("new_bad")), "subject_id")
    )
    was, now = F.col("old_bad") == F.col("truth_bad"), F.col("new_bad") == F.col("truth_bad")
    out = both.agg(
        F.count("*").alias("compared"), F.count_if(~was & now).alias("fixed"), F.count_if(was & ~now).alias("broken")
    )
    net = F.col("fixed") - F.col("broken")
    return out.select("*", net.alias("net"), (net < 0).alias("regressed"))


def prompt_evidence(rows: DataFrame, current: DataFrame, min_rows: int, k: int) -> DataFrame:
    """Worst-rated rows per prompt: of its current version, or of all versions when that one has
    fewer than ``min_rows``. The rank filter also runs before the shuffle, so a hot prompt is cheap."""
    tagged = rows.join(current, "prompt_id").withColumn("is_current", F.col("version") == F.col("current_version"))
    counts = tagged.groupBy("prompt_id").agg(F.count_if("is_current").alias("n_current"))
    eligible = tagged.join(counts, "prompt_id").where(F.col("is_current") | (F.col("n_current") < min_rows))
    worst = Window.partitionBy("prompt_id").orderBy("rating", "row_id")
    ranked = eligible.where("rating IS NOT NULL").withColumn("pos", F.row_number().over(worst).cast("long"))
    return ranked.where(F.col("pos") <= k).select("prompt_id", "row_id", "version", "rating", "pos")


def tool_evidence(calls: DataFrame, results: DataFrame, low: float = 5.0) -> DataFrame:
    """Failed calls of a tool and low-rated results whose trace called it."""
    failed = calls.where(~F.col("success")).select("tool", F.col("trace_id").alias("subject_id"), F.lit("failure").alias("why"))
    users = calls.select("tool", "trace_id").distinct()
    rated = (
        results.where(F.col("rating") <= low)
        .join(users, "trace_id")
        .select("tool", F.col("trace_id").alias("subject_id"), F.lit("low rating").alias("why"))
    )
    return failed.distinct().unionByName(rated)


def confirmed_batches(confirmed: DataFrame, reports: DataFrame, slice_seconds: int = 86400) -> DataFrame:
    """Confirmed failures by batch: failures after the n-th sealed report belong to batch n, and the
    batch after the last report is still open."""
    both = confirmed.select("agent", "at", F.lit(1).alias("side"), F.col("failure_id").alias("row_id")).unionByName(
        reports.select("agent", F.col("sealed_at").alias("at"), F.lit(0).alias("side"), F.col("report_id").alias("row_id"))
    )
    is_report = F.when(F.col("side") == 0, 1).otherwise(0).cast("long")
    stepped = sliced.sliced_window(
        both, ["agent"], sliced.time_slice(F.col("at"), slice_seconds), ["at", "side", "row_id"], [sliced.running_sum("batch", is_report)]
    )
    sealed = reports.groupBy("agent").agg(F.count("*").alias("n_reports"))
    return (
        stepped.where("side = 1")
        .groupBy("agent", "batch")
        .agg(F.count("*").alias("failures"), F.min("at").alias("first_at"))
        .join(sealed, "agent", "left")
        .select("agent", "batch", "failures", "first_at", (F.col("batch") == F.coalesce("n_reports", F.lit(0))).alias("is_open"))
    )


def latest_verdict(verdicts: DataFrame, sessions: DataFrame) -> DataFrame:
    """Newest verdict per (session, kind), stale if the session was active afterwards."""
    newest = F.struct("scored_at", "verdict_id")
    v = verdicts.groupBy("session_id", "kind").agg(
        F.max_by("rating", newest).alias("rating"), F.max("scored_at").alias("scored_at")
    )
    s = sessions.select(F.col("session_id"), F.col("last_at"))
    return v.join(s, "session_id", "left").withColumn("stale", F.coalesce(F.col("last_at") > F.col("scored_at"), F.lit(False)))


def review_filter(items: DataFrame, status: str = "pending", source: str = "all") -> DataFrame:
    out = items if status == "all" else items.where(F.col("status") == status)
    return out if source == "all" else out.where(F.col("source") == source)


def review_counts(items: DataFrame) -> DataFrame:
    return items.groupBy("source", "status").agg(F.count("*").alias("n"))


def scorer_events(verdicts: DataFrame, scorer: str, since: str, until: str) -> DataFrame:
    """History of one check in a window."""
    inside = (F.col("scored_at") >= F.lit(since).cast("timestamp")) & (F.col("scored_at") < F.lit(until).cast("timestamp"))
    return verdicts.where((F.col("scorer") == scorer) & inside)
