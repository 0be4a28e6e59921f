"""Tables written epoch by epoch: life cycles of signals and reviews, sketches, clean-up."""

import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from spanquarry.operators import sketches as S
from spanquarry.operators.routing import Rule
from spanquarry.streaming import epochs as E
from spanquarry.streaming import jobs as J

T0 = datetime(2024, 1, 1)
HIT = "span_id BIGINT, agent STRING, started_at TIMESTAMP, pattern_key STRING, polarity STRING, severity STRING"


def hits(spark, *rows):
    return spark.createDataFrame([(i, "a", T0 + timedelta(hours=h), key, "failure", "low") for i, h, key in rows], HIT)


def test_a_handled_signal_stays_handled(spark, tmp_path):
    folder, states = str(tmp_path / "signals"), str(tmp_path / "states")
    write = J.signal_upsert(folder)
    write(hits(spark, (1, 1, "x"), (2, 2, "y"), (3, 3, "z")), 0)
    said = [("x", "a", "acknowledged", T0 + timedelta(hours=4)), ("x", "a", "resolved", T0 + timedelta(hours=5)), ("y", "a", "resolved", T0 + timedelta(hours=5))]
    J.set_states(states, spark.createDataFrame(said, "pattern_key STRING, agent STRING, status STRING, changed_at TIMESTAMP"), 0, J.SIGNAL_STATES)
    write(hits(spark, (4, 6, "x"), (5, 6, "z")), 1)
    write(hits(spark, (4, 6, "x"), (5, 6, "z")), 1)  # delivered again
    got = {r.pattern_key: (r.status, r.n, r.recurred) for r in J.read_signals(spark, folder, states).collect()}
    assert got == {"x": ("resolved", 2, True), "y": ("resolved", 1, False), "z": ("open", 2, False)}
    with pytest.raises(Exception, match="unknown status"):
        J.set_states(states, spark.createDataFrame([("x", "a", "gone", T0)], "pattern_key STRING, agent STRING, status STRING, changed_at TIMESTAMP"), 1, J.SIGNAL_STATES)
    assert {r.status for r in J.read_signals(spark, folder, states).collect()} == {"resolved", "open"}


def test_old_versions_go_and_the_last_can_be_run_again(spark, tmp_path):
    folder = str(tmp_path / "signals")
    write = J.signal_upsert(folder)
    for epoch in range(5):
        write(hits(spark, (epoch, epoch, "x")), epoch)
    os.makedirs(f"{folder}/epoch=9")  # a job that did not commit
    assert E.vacuum(spark, folder) == [0, 1, 2] and E.epochs(spark, folder) == [3, 4]
    write(hits(spark, (4, 4, "x")), 4)
    assert J.read_signals(spark, folder).first()["n"] == 5
    with pytest.raises(ValueError):
        E.vacuum(spark, folder, 1)


def test_a_labelled_review_can_be_queued_again(spark, tmp_path):
    folder, states = str(tmp_path / "routes"), str(tmp_path / "states")
    write = J.route_sink(folder, [Rule("r", "review", status="error"), Rule("d", "dataset")], states)
    roots = spark.createDataFrame([(1, "a", "m", "boom", "x"), (2, "a", "m", "boom", "y")], "span_id BIGINT, agent STRING, model STRING, error STRING, output STRING")
    queued = lambda: sorted((r.span_id, r.epoch) for r in J.pending_reviews(spark, folder, states).collect())
    write(roots, 0)
    write(roots, 1)
    assert queued() == [(1, 0), (2, 0)]
    J.set_states(states, spark.createDataFrame([(1, 0, "labelled", T0)], "span_id BIGINT, queued_in BIGINT, status STRING, changed_at TIMESTAMP"), 0, J.REVIEW_STATES)
    assert queued() == [(2, 0)]
    write(roots, 2)
    write(roots, 2)
    write(roots, 3)
    assert queued() == [(1, 2), (2, 0)]
    log = E.read(spark, folder, E.epochs(spark, folder))
    assert log.where("action = 'dataset'").count() == 8 and log.where("action = 'review'").count() == 3


def test_sketches_merge_to_the_same_estimates(spark, tmp_path):
    r = random.Random(1)
    rows = [(f"g{i % 3}", r.randrange(3000), T0 + timedelta(minutes=r.randrange(6000)), int(r.expovariate(1 / 500))) for i in range(20_000)]
    spans = spark.createDataFrame(rows, "agent STRING, user_id BIGINT, started_at TIMESTAMP, latency_ms BIGINT").cache()
    folder = str(tmp_path / "sketches")
    write = S.sketch_sink(folder)
    for epoch in range(6):
        write(spans.where(F.pmod(F.xxhash64("user_id", "latency_ms"), F.lit(6)) == epoch), epoch)
    write(spans.where(F.pmod(F.xxhash64("user_id", "latency_ms"), F.lit(6)) == 5), 5)

    def checked():
        for keys in (["agent"], []):
            for row in S.estimates(S.read_sketches(spark, folder), keys, (0.1, 0.5, 0.95)).collect():
                own = [x for x in rows if not keys or x[0] == row["agent"]]
                assert row["n"] == len(own)
                exact = len({x[1] for x in own})
                assert abs(row["users"] - exact) <= S.SIGMAS * S.COUNT_ERROR * exact
                for name, prob in (("p10", 0.1), ("p50", 0.5), ("p95", 0.95)):
                    below, upto = (sum(x[3] < row[name] for x in own), sum(x[3] <= row[name] for x in own))
                    assert below / len(own) <= prob + S.RANK_ERROR and upto / len(own) >= prob - S.RANK_ERROR

    checked()
    assert S.compact_sketches(spark, folder) == 3 and E.epochs(spark, folder) == [3, 4, 5]
    assert E.read(spark, folder, [3]).count() == 3 * 5
    checked()
    assert S.compact_sketches(spark, folder) is None
