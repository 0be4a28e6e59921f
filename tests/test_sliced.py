"""Sliced windows equal plain ones, whatever the slice width and however hot one key is."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from spanquarry.operators import sliced


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(7)
    data = []
    for i in range(600):
        key = "hot" if rng.random() < 0.5 else rng.choice(["a", "b", None])
        at = datetime(2024, 1, 1) + timedelta(seconds=rng.randrange(200_000))
        data.append((i, key, at, rng.choice([None, rng.randrange(100)])))
    return spark.createDataFrame(data, "id BIGINT, key STRING, at TIMESTAMP, v BIGINT").repartition(5).cache()


@pytest.mark.parametrize("width", [60, 3600, 10_000_000])
def test_equals_plain_window(rows, width):
    specs = [
        sliced.row_number("rn"),
        sliced.running_sum("total", F.coalesce("v", F.lit(0))),
        sliced.previous("prev", F.col("v")),
        sliced.following("next", F.col("v")),
        sliced.last_known("last", F.col("v")),
        sliced.last_known("last_before", F.col("v"), inclusive=False),
        sliced.next_known("first", F.col("v")),
        sliced.next_known("first_after", F.col("v"), inclusive=False),
    ]
    got = sliced.sliced_window(rows, ["key"], sliced.time_slice(F.col("at"), width), ["at", "id"], specs)
    w = Window.partitionBy("key").orderBy("at", "id")
    upto, before = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    on, after = w.rowsBetween(0, Window.unboundedFollowing), w.rowsBetween(1, Window.unboundedFollowing)
    want = rows.select(
        "*",
        F.row_number().over(w).alias("rn"),
        F.sum(F.coalesce("v", F.lit(0))).over(upto).alias("total"),
        F.lag("v").over(w).alias("prev"),
        F.lead("v").over(w).alias("next"),
        F.last("v", True).over(upto).alias("last"),
        F.last("v", True).over(before).alias("last_before"),
        F.first("v", True).over(on).alias("first"),
        F.first("v", True).over(after).alias("first_after"),
    )
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(got.columns).collect()))


def test_no_window_is_keyed_by_the_bare_key_alone(rows):
    """The row-level window is partitioned by key and slice; only slice summaries by the key."""
    out = sliced.sliced_window(rows, ["key"], sliced.time_slice(F.col("at"), 60), ["at", "id"], [sliced.row_number("rn")])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "[key#" in plan and "__slice" in plan
    assert out.count() == rows.count()


def test_fifo_pairs_like_a_queue(spark):
    import random

    from spanquarry.operators.logs import pair_fifo

    r, rows, want = random.Random(5), [], []
    for key in ("a", "b", "c"):
        queue, ends = [], 0
        for n in range(120):
            at, is_end = f"2024-01-01 0{n // 30}:{n % 30:02d}:00", r.random() < 0.55
            rows.append((key, at, n, is_end))
            if is_end:
                ends += 1
                want.append((key, ends, queue.pop(0) if queue else None, n))
            else:
                queue.append(n)
    df = spark.createDataFrame(rows, "k string, at string, event_id bigint, is_end boolean").selectExpr("k", "cast(at as timestamp) at", "event_id", "is_end")
    got = pair_fifo(df.where("NOT is_end").drop("is_end"), df.where("is_end").drop("is_end"), ["k"], 900)
    assert sorted(tuple(x) for x in got.select("k", "n", "start_event_id", "end_event_id").collect()) == sorted(want)
    assert got.where("start_at > end_at").isEmpty()


def test_late_vote_counts_in_its_window(spark):
    from spanquarry.operators.monitoring import kpis, production_roots, run_facts

    spans = spark.sql(
        "SELECT i AS span_id, CAST(NULL AS BIGINT) AS parent_span_id, i AS trace_id, 'a' AS agent, ts AS started_at, 'agent' AS span_kind, CAST(NULL AS STRING) AS error, 5L AS latency_ms, CAST(NULL AS STRING) AS source "
        "FROM VALUES (1L, TIMESTAMP '2024-01-01 00:00:00'), (2L, TIMESTAMP '2024-01-30 00:00:00') AS t(i, ts)"
    )
    votes = spark.sql("SELECT i AS trace_id, r AS rating, TIMESTAMP '2024-01-30 10:00:00' AS created_at FROM VALUES (1L, 'down'), (2L, 'up') AS t(i, r)")
    now = "2024-01-31 00:00:00"
    rates = [
        kpis(run_facts(spans, since=since), votes, now, 7 * 86400, production_roots(spans)).first()["downvote_rate"]
        for since in (None, "2024-01-24 00:00:00")
    ]
    assert rates == [0.5, 0.5]


def test_tool_calls_pair_like_pending_requests(spark):
    import random

    from spanquarry.operators.logs import pair_tool_calls

    r, asked, answered, want = random.Random(8), [], [], []
    for run in range(6):
        pending = {}
        for pos in range(60):
            call = r.choice(["a", "b", "c", None])
            if r.random() < 0.5:
                asked.append((run, call, pos, f"q{pos}", f"in{pos}", pos))
                if call:
                    pending[call] = f"in{pos}"
            else:
                answered.append((run, call, pos, "r", f"out{pos}", False, pos, pos))
                want.append((run, pos, pending.pop(call, None) if call else None))
    req = spark.createDataFrame(asked, "run_id int, call_id string, pos bigint, name string, input string, start_at int")
    res = spark.createDataFrame(answered, "run_id int, call_id string, pos bigint, name string, output string, is_error boolean, start_at int, end_at int")
    got = pair_tool_calls(req, res, 16).select("run_id", "pos", "input").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
