"""Rows kept by day: replaced, pruned, expired and appended once."""

import os
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from spanquarry.sources import conversations as C
from spanquarry.sources import store as S

T0 = datetime(2024, 3, 1, 23, 30)
ROW = "id BIGINT, started_at TIMESTAMP, what STRING"


def rows(spark, *some):
    return spark.createDataFrame([(i, None if d is None else T0 + timedelta(days=d), w) for i, d, w in some], ROW)


def files(folder):
    return {os.path.join(a, f): os.stat(os.path.join(a, f)).st_mtime_ns for a, _, c in os.walk(folder) for f in c if f.endswith(".parquet")}


def test_a_replaced_day_leaves_the_others_alone(spark, tmp_path):
    folder = str(tmp_path / "days")
    S.replace_days(rows(spark, (1, 0, "a"), (2, 0, "a"), (3, 1, "a"), (4, 2, "a"), (5, None, "a")), folder, "started_at")
    before = files(folder)
    S.replace_days(rows(spark, (9, 1, "b")), folder, "started_at")
    S.replace_days(rows(spark), folder, "started_at")  # nothing replaces nothing
    same = [f for f, t in files(folder).items() if before.get(f) == t]
    assert len(same) == len(before) - 1
    assert {(r.id, r.what) for r in S.read_days(spark, folder, "started_at").collect()} == {(1, "a"), (2, "a"), (9, "b"), (4, "a"), (5, "a")}


def test_days_are_those_of_utc(spark, tmp_path):
    folder, zone = str(tmp_path / "days"), spark.conf.get("spark.sql.session.timeZone")
    frame = spark.range(1).select(F.timestamp_seconds(F.lit(1709335800)).alias("started_at"))  # 2024-03-01 23:30 UTC
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        S.replace_days(frame, folder, "started_at")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert S.stored_days(spark, folder) == ["2024-03-01"]


def test_expired_days_go_as_folders_and_reads_are_pruned(spark, tmp_path):
    folder = str(tmp_path / "days")
    S.replace_days(rows(spark, *[(d, d, "x") for d in range(40)], (99, None, "x")), folder, "started_at")
    now = (T0 + timedelta(days=39, minutes=5)).isoformat(sep=" ")
    want = set(range(10, 40))
    before = files(folder)
    kept = S.retained(spark, folder, "started_at", now)
    assert {r.id for r in kept.collect()} == want
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and len(kept.inputFiles()) >= len(want)
    assert S.expire(spark, folder, now) == [(T0 + timedelta(days=d)).date().isoformat() for d in range(9)]
    after = files(folder)
    assert set(after) < set(before) and all(before[f] == t for f, t in after.items())
    assert {r.id for r in S.retained(spark, folder, "started_at", now).collect()} == want
    assert {r.id for r in S.read_days(spark, folder, "started_at").collect()} >= {99}
    inside = S.read_days(spark, folder, "started_at", "2024-03-20 23:30:00", "2024-03-22 23:30:00")
    assert {r.id for r in inside.collect()} == {19, 20}
    assert S.expire(spark, folder, now) == [] and S.expire(spark, str(tmp_path / "none"), now) == []


def test_results_are_appended_once(spark, tmp_path):
    folder = str(tmp_path / "results")
    schema = "idempotency_key STRING, arrival BIGINT, output STRING, error STRING, at TIMESTAMP"
    batch = spark.createDataFrame(
        [("a", 1, "x", None, T0), ("a", 2, "y", None, T0), ("b", 3, " ", None, T0), ("c", 4, None, "boom", T0 + timedelta(days=1)), ("d", 5, "z", None, None)], schema
    )
    assert S.append_batch(spark, batch, folder, "at") == {"accepted": 3, "duplicate": 1, "invalid": 1}
    assert S.append_batch(spark, batch, folder, "at") == {"accepted": 0, "duplicate": 4, "invalid": 1}
    more = spark.createDataFrame([("e", 1, "x", None, T0), ("a", 2, "late", None, T0)], schema)
    assert S.append_batch(spark, more, folder, "at") == {"accepted": 1, "duplicate": 1, "invalid": 0}
    assert sorted((r.idempotency_key, r.output) for r in S.read_days(spark, folder, "at").collect()) == [("a", "x"), ("c", None), ("d", "z"), ("e", "x")]


def test_times_of_exported_records(spark):
    raw = spark.createDataFrame(
        [(1, "", "1700000000", None), (2, "2023-11-14T22:13:20Z", "x", None), (3, "soon", "1700000000000", 1), (4, None, None, 1700000000000), (5, None, None, None), (6, "2023-11-15T00:13:20+02:00", None, 5)],
        "interaction_id INT, created_time STRING, created_at STRING, timestamp BIGINT",
    )
    got = {r[0]: r[1] for r in raw.select("interaction_id", F.unix_seconds(C.record_time(raw, *C.START_FIELDS))).collect()}
    assert got == {1: 1700000000, 2: 1700000000, 3: None, 4: 1700000000, 5: None, 6: 1700000000}
    assert raw.select(C.record_time(raw, "nothing")).distinct().collect() == [(None,)]
