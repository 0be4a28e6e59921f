"""The alert machine: composed transitions, whatever the slices, equal a walk over the ticks."""

import random
from datetime import datetime, timedelta

import pytest

from spanquarry.operators import logs as L

T0 = datetime(2024, 1, 1)


def walk(ticks, threshold, cooldown):
    """Events of one subject's ticks in order, as a machine that looks at one tick after another."""
    firing, since, told, incident, out = False, None, 0, 0, []
    for at, value in ticks:
        breach = firing if value is None else value > threshold
        if breach and not firing:
            firing, since, told, incident = True, at, 0, incident + 1
            out.append((incident, "triggered", at))
        elif breach:
            due = (at - since) // timedelta(minutes=cooldown)
            if due > told:
                told = due
                out.append((incident, "repeat", at))
        elif firing:
            firing = False
            out.append((incident, "resolved", at))
    return out


def example():
    r, rows = random.Random(5), []
    for subject in ("a", "b", "c", "all null", "always", None):
        minute = 0
        for _ in range(120):
            minute += r.choice([1, 1, 5, 60, 400])
            value = {"all null": None, "always": 1.0}.get(subject, r.choice([None, None, 0.2, 0.2, 0.9, 0.9, 0.9]))
            rows.append((subject, T0 + timedelta(minutes=minute), value))
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seconds", [60, 3600, 86400, 10**9])
def test_events_equal_a_walk_whatever_the_slices(spark, seconds):
    rows = example()
    ticks = spark.createDataFrame(rows, "subject STRING, tick TIMESTAMP, value DOUBLE")
    got = L.alert_events(L.alert_states(ticks, "gt", 0.5, seconds), 90).collect()
    want = [
        (subject, *event)
        for subject in {r[0] for r in rows}
        for event in walk(sorted(((at, v) for s, at, v in rows if s == subject), key=lambda x: x[0]), 0.5, 90)
    ]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want)) and len(want) > 100


def test_alert_plan_deals_the_ticks_once(spark):
    """Local windows and the slices' transitions read one exchange of the ticks; no state is windowed three times over."""
    ticks = spark.createDataFrame(example(), "subject STRING, tick TIMESTAMP, value DOUBLE")
    states = L.alert_states(ticks, "gt", 0.5)
    plan = L.alert_events(states)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") <= 2 and plan.count("Join") == 1
