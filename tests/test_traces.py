"""Nested trace documents and whole-trace scorers."""

import random
from datetime import datetime, timedelta

from spanquarry.functions import callables as K
from spanquarry.sources import trace_docs as D

T0 = datetime(2024, 1, 1)


def span(key, parent, kind="CHAIN", status="OK"):
    return (key, parent, f"n{key}", kind, 1_000_000, 9_000_000, "in", "out", (status, None))


def documents(spark):
    spans = [
        [span("r", None), span("a", "r", "TOOL"), span("b", "a", "tool", "ERROR"), span("c", "lost"), span("d", ""), span(None, "b")],
        [span("x", "gone"), span("y", "x")],
        [span("r", ""), *[span(f"s{i}", f"s{i - 1}" if i else "r") for i in range(40)]],
    ]
    rows = [((f"t{i}", "e", "OK", 5, None, None), (own,)) for i, own in enumerate(spans)]
    rows += [(("t9", "e", "OK", 5, None, None), ([],)), ((None, "e", "OK", 5, None, None), ([span("r", None)],))]
    return spark.createDataFrame(rows, D.TRACE)


def test_parents_lost_and_found(spark):
    got = {r.span_id: r for r in D.import_traces(documents(spark)).collect()}
    assert len(got) == 6 + 2 + 41
    assert got["dbx:t0"].parent_span_id is None and [t.success for t in got["dbx:t0"].tool_calls] == [True, False]
    assert got["dbx:t0:a"].parent_span_id == "dbx:t0" and got["dbx:t0:b"].parent_span_id == "dbx:t0:a" and got["dbx:t0:c"].parent_span_id == "dbx:t0"
    assert got["dbx:t0:b"].error == "error" and got["dbx:t0:span"].parent_span_id == "dbx:t0:b"
    assert got["dbx:t2:s39"].parent_span_id == "dbx:t2:s38" and got["dbx:t1"].name == "nx"


def path_reducer():
    class Path:
        """The ids of a trace in the order they were read, with a count of the parts that were merged."""

        def start(self):
            return [1, []]

        def step(self, state, span):
            state[1].append(int(span["span_id"]))
            return state

        def merge(self, left, right):
            return [left[0] + right[0], left[1] + right[1]]

        def finish(self, state):
            return {"path": state[1], "parts": state[0]}

    return Path()  # a local class travels by value


def test_a_trace_is_reduced_in_slices_and_in_order(spark):
    r, rows = random.Random(3), []
    for trace in range(5):
        for i in range(200 if trace == 0 else 3):
            rows.append((trace, 1000 * trace + i, None if i == 7 or (trace and i == 2) else 1, T0 + timedelta(minutes=r.randrange(3000))))
    rows.append((None, 99_999, None, T0))
    spans = spark.createDataFrame(rows, "trace_id BIGINT, span_id BIGINT, parent_span_id BIGINT, started_at TIMESTAMP")
    got = {x.trace_id: x for x in K.reduce_traces(spans, path_reducer(), "path ARRAY<BIGINT>, parts BIGINT").collect()}
    assert set(got) == set(range(5))
    for trace, row in got.items():
        own = [x for x in rows if x[0] == trace]
        want = sorted(own, key=lambda x: (x[2] is not None, x[3], x[1]))
        assert row.path == [x[1] for x in want]
        assert row.parts == 1 + len({(x[3] - T0) // timedelta(hours=1) for x in own if x[2] is not None})


def test_scorers_read_roots_first_and_may_stop_early(spark):
    rows = [(t, 10 * t + i, None if i == 3 else 1, T0 + timedelta(minutes=i)) for t in range(4) for i in range(5)]
    spans = spark.createDataFrame(rows, "trace_id BIGINT, span_id BIGINT, parent_span_id BIGINT, started_at TIMESTAMP")

    def first(own):
        return {"score": next(own)["span_id"], "matched": True}

    got = {x.trace_id: (x.score, x.matched) for x in K.external_scorer(spans, first, invert_match=True).collect()}
    assert got == {t: (10.0 * t + 3, False) for t in range(4)}
