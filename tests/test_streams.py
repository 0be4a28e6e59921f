"""Streams over several micro-batches equal their batch twins."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from spanquarry.functions.matching import Condition, Pattern
from spanquarry.operators import logs as L
from spanquarry.operators import monitoring as M
from spanquarry.streaming import jobs as J
from spanquarry.streaming import processors as P

T0 = datetime(2024, 1, 1)


def minutes(n):
    return T0 + timedelta(minutes=n)


def feed(spark, folder, batches, schema):
    """One file per batch, read one file per micro-batch in order."""
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder / f"b{i:02d}"))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(folder))


def drain(stream, folder, sink=None):
    writer = stream.writeStream.option("checkpointLocation", str(folder / "ckpt")).trigger(availableNow=True)
    if sink:
        writer.foreachBatch(sink).start().awaitTermination()
        return None
    writer.format("parquet").option("path", str(folder / "out")).start().awaitTermination()
    return stream.sparkSession.read.parquet(str(folder / "out"))


def ended(spark, batches, schema, column):
    """The batches, and one with the row that ends the input."""
    empty = spark.createDataFrame([], schema)
    return [*batches, [tuple(r) for r in P.end_marker(spark, empty.schema, column).collect()]]


def test_idle_sessions_resume_as_a_whole(spark, tmp_path):
    schema = "session_id BIGINT, started_at TIMESTAMP, span_id BIGINT"
    big = 2**60 + 1  # no float holds it
    batches = [
        [(big, minutes(1), 2), (big, minutes(0), 1), (7, minutes(0), 3), (None, minutes(3), 9)],
        [(big, minutes(60), 4), (8, minutes(61), 5)],
        [(8, minutes(58), 7), (8, minutes(60), 8), (8, minutes(63), 6)],  # out of order; exactly the idle time later
        [(8, minutes(600), 10)],
    ]
    (tmp_path / "in").mkdir()
    got = drain(P.idle_sessions(feed(spark, tmp_path / "in", ended(spark, batches, schema, "started_at"), schema), 120), tmp_path)
    everything = spark.createDataFrame([r for b in batches for r in b if r[0] is not None], schema)
    want = M.idle_points(everything, 120, now="2024-01-02 10:00:00")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert (big, minutes(62), 3) in [tuple(r) for r in got.collect()]


CHUNK = "call_id BIGINT, seq BIGINT, at TIMESTAMP, choice INT, delta STRING, tool_index INT, tool_name STRING, tool_args STRING, model STRING, input_tokens BIGINT, output_tokens BIGINT, has_usage BOOLEAN, error STRING, last BOOLEAN"


def chunk(call, seq, at, text=None, choice=None, tool=None, model=None, usage=None, error=None, last=None):
    return (call, seq, minutes(at), choice, text, *(tool or (None, None, None)), model, usage, usage, usage is not None, error, last)


def test_calls_are_assembled_over_batches_and_pauses(spark, tmp_path):
    batches = [
        [chunk(1, 1, 1, "b"), chunk(1, 0, 0, "a", model="m"), chunk(2, 0, 0, tool=(0, "find", "{")), chunk(3, 0, 0, "half")],
        [chunk(1, 1, 1, "b"), chunk(1, 4, 200, usage=9, last=True), chunk(2, 1, 201, tool=(1, None, "[1")), chunk(2, 2, 201, tool=(0, "find", "}"))],
        [chunk(1, 3, 202, "d", choice=1), chunk(1, 2, 202, "c", choice=1), chunk(2, 3, 202, tool=(1, "rank", "]"), usage=3)],  # the pause is longer than the watermark
        [chunk(1, 2, 203, "c", choice=1), chunk(3, 1, 203, error="cut"), chunk(4, 0, 203, "", model="n")],
    ]
    (tmp_path / "in").mkdir()
    stream = P.assemble_chunks_stream(feed(spark, tmp_path / "in", ended(spark, batches, CHUNK, "at"), CHUNK), slice_size=2)
    got = drain(stream, tmp_path)
    everything = spark.createDataFrame([r for b in batches for r in b], CHUNK).dropDuplicates(["call_id", "seq"])
    want = L.assemble_chunks(everything, slice_size=2)
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))
    rows = {r.call_id: r for r in got.collect()}
    assert rows[1].output == "ab\ncd" and rows[1].complete and rows[1].end_at == minutes(202)
    assert rows[2].output == "[tool call] find({}), rank([1])" and not rows[2].complete
    assert rows[3].output == "half" and rows[3].error == "cut" and rows[4].output is None


def test_open_runs_are_swept_and_counted(spark, tmp_path):
    starts = [[(1, minutes(0)), (2, minutes(0)), (3, minutes(5))], [(4, minutes(300)), (1, minutes(0))], [(5, minutes(1500))]]
    ends = [[(1, minutes(30))], [(2, minutes(61)), (4, minutes(310))], [(3, minutes(65))]]
    frames = []
    for name, column, rows in (("starts", "started_at", starts), ("ends", "ended_at", ends)):
        schema = f"run_id BIGINT, {column} TIMESTAMP"
        (tmp_path / name).mkdir()
        frames.append(feed(spark, tmp_path / name, ended(spark, rows, schema, column), schema))
    (tmp_path / "a").mkdir()
    got = drain(P.ttl_sweep_stream(*frames), tmp_path / "a")
    flat = [spark.createDataFrame([r for b in rows for r in b], f"run_id BIGINT, {c} TIMESTAMP") for c, rows in (("started_at", starts), ("ended_at", ends))]
    want = L.ttl_sweep(flat[0].distinct(), flat[1], "2024-01-05 00:00:00")
    swept, plain = {r.run_id for r in got.collect()}, {r.run_id for r in want.collect()}
    assert plain == {2, 5}
    # the end of run 3 came in time, but in a batch before which the watermark had passed its limit
    assert plain <= swept <= plain | {3}
    (tmp_path / "b").mkdir()
    counts = drain(P.dropped_counts(P.ttl_sweep_stream(*frames)), tmp_path / "b")
    assert sum(r.n for r in counts.collect()) == got.count()


def test_alert_states_across_batches(spark, tmp_path):
    schema = "rule_id STRING, subject STRING, kind STRING, at TIMESTAMP, value DOUBLE, operator STRING, threshold DOUBLE, cooldown_minutes INT"
    tick = lambda m, v, kind="tick": ("r", "a", kind, minutes(m), v, "gt", 0.1, 30)
    batches = [
        [tick(0, 0.05), tick(1, 0.5), tick(2, 0.5)],
        [tick(31, 0.5), tick(32, None), tick(33, 0.5)],
        [tick(40, 0.0), tick(41, 0.9)],
        [tick(42, None, "edit"), tick(43, 0.9, "test"), tick(44, 0.9)],
    ]
    (tmp_path / "in").mkdir()
    out = drain(J.alert_stream(feed(spark, tmp_path / "in", batches, schema)), tmp_path)
    got = [(r["kind"], int((r["at"] - T0).total_seconds() // 60)) for r in out.orderBy("at").collect()]
    assert got == [("triggered", 1), ("repeat", 31), ("resolved", 40), ("triggered", 41), ("resolved", 42), ("triggered", 44)]


def test_signals_merge_over_batches_and_retries(spark, tmp_path):
    schema = "span_id BIGINT, agent STRING, started_at TIMESTAMP, parent_span_id BIGINT, source STRING, response STRING"
    rows = [[(i * 10 + j, f"g{j % 2}", minutes(i * 10 + j), None, None, "refund now") for j in range(4)] for i in range(3)]
    patterns = [Pattern("refund", (Condition("refund"),))]
    (tmp_path / "in").mkdir()
    hits = J.monitor_stream(feed(spark, tmp_path / "in", rows, schema), patterns, {"response": "response"})
    write = J.signal_upsert(str(tmp_path / "signals"))

    def twice(df, epoch):
        write(df, epoch)
        write(df, epoch)

    drain(hits, tmp_path, sink=twice)
    got = J.read_signals(spark, str(tmp_path / "signals"))
    whole = spark.createDataFrame([r for b in rows for r in b], schema)
    want = M.signal_rollup(M.span_pattern(M.production_roots(whole), patterns, {"response": "response"}))
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_dedupe_over_batches(spark, tmp_path):
    schema = "span_id BIGINT, started_at TIMESTAMP"
    batches = [[(1, minutes(0)), (2, minutes(1))], [(1, minutes(0)), (3, minutes(2))]]
    (tmp_path / "in").mkdir()
    out = drain(J.dedupe_stream(feed(spark, tmp_path / "in", batches, schema)), tmp_path)
    assert sorted(r["span_id"] for r in out.collect()) == [1, 2, 3]


def test_reviews_are_queued_once(spark, tmp_path):
    from spanquarry.operators.routing import Rule

    schema = "span_id BIGINT, agent STRING, model STRING, error STRING, output STRING"
    batches = [[(1, "a", "m", "boom", "x")], [(1, "a", "m", "boom", "x"), (2, "a", "m", "boom", "y")]]
    (tmp_path / "in").mkdir()
    sink = J.route_sink(str(tmp_path / "routes"), [Rule("r", "review", status="error"), Rule("d", "dataset")])
    drain(feed(spark, tmp_path / "in", batches, schema), tmp_path, sink=sink)
    stored = spark.read.parquet(str(tmp_path / "routes"))
    assert sorted(r["span_id"] for r in stored.where("action = 'review'").collect()) == [1, 2]
    assert stored.where(F.col("action") == "dataset").count() == 3


def test_tables_that_are_folders_are_streamed_whole(spark, tmp_path):
    from catalog import streams
    from catalog.base import Tables

    rows = spark.createDataFrame([(i, f"t{i}") for i in range(20)], "doc_id BIGINT, text STRING")
    rows.repartition(3).write.parquet(str(tmp_path / "a" / "documents.parquet"))
    rows.toPandas().to_parquet(tmp_path / "documents.parquet")
    for folder in (tmp_path / "a", tmp_path):
        t = Tables(spark, str(folder))
        got = streams.finish(t, streams.Streamed(t).documents)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows.collect()))


class Store:
    """A stand-in for the handle of a processor that counts the calls."""

    def __init__(self):
        self.calls, self.value, self.timers = 0, None, []

    def getValueState(self, name, schema):
        return self

    def getMapState(self, name, key, value):
        self.map = Places(self)
        return self.map

    def exists(self):
        self._count()
        return self.value is not None

    def _count(self):
        self.calls += 1

    def get(self):
        self._count()
        return self.value

    def update(self, value):
        self._count()
        self.value = value

    def clear(self):
        self._count()
        self.value = None

    def listTimers(self):
        self._count()
        return iter(list(self.timers))

    def registerTimer(self, at):
        self._count()
        self.timers.append(at)

    def deleteTimer(self, at):
        self._count()
        self.timers.remove(at)


class Places(dict):
    """Map state of a :class:`Store`."""

    def __init__(self, store):
        self.store = store

    def containsKey(self, key):
        self.store._count()
        return key in self

    def getValue(self, key):
        self.store._count()
        return self.get(key)

    def updateValue(self, key, value):
        self.store._count()
        self[key] = value

    def iterator(self):
        self.store._count()
        return iter(list(self.items()))

    def clear(self):
        self.store._count()
        super().clear()


class At:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def test_open_runs_of_a_bucket_are_one_state(spark):
    import pandas as pd

    store, ttl, n = Store(), 3600, 5000
    processor = P.OpenRuns(ttl * 1_000_000, "bigint")
    processor.init(store)
    start = pd.Timestamp(T0)
    ids = [2**60 + i for i in range(n)]
    frame = lambda ids, at, end: pd.DataFrame({"run_id": ids, "at": pd.Series([at] * len(ids), dtype="datetime64[ns]"), "is_end": end})
    assert not list(processor.handleInputRows((1,), iter([frame(ids[:3000], start, False), frame(ids[3000:], start, False)]), At(0)))
    assert not list(processor.handleInputRows((1,), iter([frame(ids[::2], start + pd.Timedelta(seconds=ttl), True)]), At(0)))
    later = start + pd.Timedelta(seconds=ttl + 1)
    assert not list(processor.handleInputRows((1,), iter([frame(ids[:2], later, True), frame([7], later, False)]), At(0)))
    told = pd.concat(processor.handleExpiredTimer((1,), At((start.value // 10**6) + ttl * 1000), None))
    assert sorted(told["run_id"]) == ids[1::2]
    assert set(told["dropped_at"]) == {start + pd.Timedelta(seconds=ttl)}
    assert store.value[0] == [7] and store.calls < 30


def test_sessions_of_a_bucket_are_one_state(spark):
    import pandas as pd

    store, n = Store(), 2000
    processor = P.IdleSessions(120 * 1_000_000, "bigint")
    processor.init(store)
    at = lambda m: pd.Series([minutes(m)] * n, dtype="datetime64[us]")
    frame = lambda m: pd.DataFrame({"session_id": range(n), "first_at": at(m), "last_at": at(m), "n": [2] * n})
    low = int(pd.Timestamp(T0).value // 10**6)
    assert not list(processor.handleInputRows((1,), iter([frame(0), frame(1)]), At(low)))
    assert store.calls < 10  # nothing by session before it settles
    told = pd.concat(processor.handleExpiredTimer((1,), At(low + 3 * 60_000), None))
    assert len(told) == n and set(told["turns"]) == {4} and set(told["idle_at"]) == {pd.Timestamp(minutes(3))}
    assert not list(processor.handleInputRows((1,), iter([frame(30)]), At(low + 4 * 60_000)))
    told = pd.concat(processor.handleExpiredTimer((1,), At(low + 40 * 60_000), None))
    assert set(told["turns"]) == {6} and store.value is None


def test_a_call_in_one_batch_costs_few_calls_to_the_store(spark):
    import pandas as pd

    store = Store()
    processor = P.ChunkAssembler(3600 * 1_000_000, 2)
    processor.init(store)
    names = [f.split()[0] for f in CHUNK.split(", ")]

    def frame(rows):
        return pd.DataFrame(rows, columns=names).astype({"at": "datetime64[us]"})

    whole = [chunk(5, n, n, f"t{n}", choice=n % 2, tool=(n % 3, f"f{n}", f"a{n}"), model=f"m{n}", usage=n, last=n == 5) for n in range(6)]
    whole += whole[::2]
    (row,) = pd.concat(processor.handleInputRows((5,), iter([frame(whole)]), At(0))).to_dict("records")
    assert row["complete"] and row["output"] == "t0t2t4\nt1t3t5" and row["model"] == "m0" and row["output_tokens"] == 5
    assert store.calls <= 4 and not store.map
    store.__init__()
    processor.init(store)
    for rows in (whole[:1], whole[3:6], whole[:2]):
        rows = [r[:4] + (None,) + r[5:] for r in rows]
        done = list(processor.handleInputRows((5,), iter([frame(rows[:1]), frame(rows[1:])] if rows[1:] else [frame(rows)]), At(0)))
    assert not done
    (row,) = pd.concat(processor.handleInputRows((5,), iter([frame([r[:4] + (None,) + r[5:] for r in whole[2:3]])]), At(0))).to_dict("records")
    assert row["complete"] and row["output"] == "[tool call] f3(a0a3), f4(a1a4), f5(a2a5)" and not store.map
