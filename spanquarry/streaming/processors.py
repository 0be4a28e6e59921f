"""Streams with state per key and event-time timers.

They run on ``transformWithStateInPandas``, which needs the RocksDB state store (``session.SETTINGS`` names it). Timers fire when
the watermark passes them; :func:`end_marker` is the row that moves the watermark past everything when an input ends, so
the last calls, sessions and runs come out as well. Rows without a key only move the watermark.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import StructType

FAR = "2200-01-01 00:00:00"


def end_marker(spark: SparkSession, schema: StructType, event_time: str, at: str = FAR) -> DataFrame:
    """One row of nulls but for its time, to be written to an input that ends."""
    fields = [F.lit(at if f.name == event_time else None).cast(f.dataType).alias(f.name) for f in schema]
    return spark.range(1).select(fields)


def keyed(stream: DataFrame, key: str, event_time: str, delay: str) -> DataFrame:
    """The stream behind its watermark, without the end marker and rows of a null key, which state cannot be kept for.

    One condition that reads the event time: the optimizer would move another one below the watermark, and the marker would not move it.
    """
    before = F.col(event_time) < F.lit(FAR).cast("timestamp")
    return stream.withWatermark(event_time, delay).where(F.when(before, F.col(key).isNotNull()).otherwise(False))


def micros(times: pd.Series) -> pd.Series:
    return times.to_numpy("datetime64[us]").astype("int64")


def moment(value: int) -> pd.Timestamp:
    return pd.Timestamp(value, unit="us")


class Timed(StatefulProcessor):
    """One timer per key."""

    def init(self, handle) -> None:
        self.handle = handle

    def set_timer(self, at_micros: int | None, before: int | None = None) -> None:
        """The key's only timer; ``before`` is the one it replaces, None where that has fired: the engine removes it, and doing so earlier upsets
        the walk over the others."""
        wanted, old = (None if x is None else -(-x // 1000) for x in (at_micros, before))
        if old is not None and old != wanted:
            self.handle.deleteTimer(old)
        if wanted is not None and old != wanted:
            self.handle.registerTimer(wanted)

    def close(self) -> None:
        pass


class ChunkAssembler(Timed):
    """Chunks of a call in any order to one row; see :func:`assemble_chunks_stream`."""

    OUTPUT = "output STRING, model STRING, input_tokens BIGINT, output_tokens BIGINT, error STRING, complete BOOLEAN, first_at TIMESTAMP, end_at TIMESTAMP"
    FACTS = (
        "closed BOOLEAN, n BIGINT, last_seq BIGINT, model STRING, model_seq BIGINT, input_tokens BIGINT, output_tokens BIGINT, usage_seq BIGINT, "
        "error STRING, error_seq BIGINT, first_at BIGINT, end_at BIGINT"
    )
    EMPTY = (False, 0, None, None, None, None, None, None, None, None, None, None)

    def __init__(self, expire_micros: int, slice_size: int):
        self.expire, self.slice_size = expire_micros, slice_size

    def init(self, handle) -> None:
        super().init(handle)
        self.facts = handle.getValueState("facts", self.FACTS)
        # by slice of the sequence: whether all of it came, else the numbers seen; fragments: text of a choice, arguments or name of a tool
        self.parts = handle.getMapState(
            "parts", "slice BIGINT", "full BOOLEAN, seen ARRAY<BIGINT>, kinds ARRAY<STRING>, places ARRAY<BIGINT>, seqs ARRAY<BIGINT>, texts ARRAY<STRING>"
        )

    def _slice(self, number: int, touched: dict, stored: bool) -> dict:
        if number not in touched:
            value = self.parts.getValue((number,)) if stored else None
            full, seen, *parts = value or (False, [], [], [], [], [])
            touched[number] = {"full": full, "seen": set(seen), "parts": list(zip(*parts))}
        return touched[number]

    def _store(self, touched: dict) -> None:
        for number, held in touched.items():
            parts = held["parts"]
            if held["full"]:  # nothing of this slice can come any more
                joined: dict = {}
                for kind, place, seq, text in sorted(parts, key=lambda p: p[2]):
                    joined[kind, place] = text if kind == "name" else joined.get((kind, place), "") + text
                seqs = {(kind, place): seq for kind, place, seq, _ in sorted(parts, key=lambda p: p[2])}
                parts = [(*of, seqs[of], text) for of, text in joined.items()]
            lists = list(map(list, zip(*parts))) or [[], [], [], []]
            self.parts.updateValue((number,), (held["full"], [] if held["full"] else sorted(held["seen"]), *lists))

    def _fed(self, facts: dict, frame: pd.DataFrame, touched: dict, stored: bool) -> dict:
        """The facts after the chunks of new sequence numbers, whose fragments go to ``touched``."""
        known = lambda v: v is not None and v == v
        columns = ("seq", "choice", "delta", "tool_index", "tool_name", "tool_args", "model", "input_tokens", "output_tokens", "has_usage", "error", "last")
        ended = []
        for at, seq, choice, delta, index, name, args, model, given, made, usage, error, last in zip(micros(frame["at"]).tolist(), *(frame[c].tolist() for c in columns)):
            if not known(seq):
                continue
            seq = int(seq)
            held = self._slice(seq // self.slice_size, touched, stored)
            if held["full"] or seq in held["seen"]:
                continue  # a chunk delivered again
            held["seen"].add(seq)
            held["full"] = len(held["seen"]) == self.slice_size
            if known(delta) and delta != "":
                held["parts"].append(("text", int(choice) if known(choice) else 0, seq, delta))
            if known(index):
                held["parts"].append(("tool", int(index), seq, args if known(args) else ""))
                if known(name) and name != "":
                    held["parts"].append(("name", int(index), seq, name))
            if known(model) and model != "" and (facts["model_seq"] is None or seq < facts["model_seq"]):
                facts |= {"model": model, "model_seq": seq}
            if known(usage) and usage and (facts["usage_seq"] is None or seq > facts["usage_seq"]):
                facts |= {"input_tokens": int(given) if known(given) else None, "output_tokens": int(made) if known(made) else None, "usage_seq": seq}
            if known(error) and (facts["error_seq"] is None or seq > facts["error_seq"]):
                facts |= {"error": error, "error_seq": seq}
            if known(last) and last:
                ended.append(seq)
            facts["first_at"] = at if facts["first_at"] is None else min(at, facts["first_at"])
            facts["end_at"] = at if facts["end_at"] is None else max(at, facts["end_at"])
            facts["n"] += 1
        if ended:
            facts["last_seq"] = max(ended)
        return facts

    def _row(self, key: tuple, facts: dict, complete: bool, touched: dict, stored: bool) -> pd.DataFrame:
        parts = [p for held in touched.values() for p in held["parts"]]
        if stored:
            for (number,), (_, _, *lists) in self.parts.iterator():
                if number not in touched:
                    parts += zip(*lists)
        texts, args, names = {}, {}, {}
        for kind, place, _, text in sorted(parts, key=lambda p: p[2]):
            if kind == "name":
                names[place] = text
            else:
                (texts if kind == "text" else args).setdefault(place, []).append(text)
        output = "\n".join("".join(texts[c]) for c in sorted(texts)) or None
        if output is None and args:
            output = "[tool call] " + ", ".join(f"{names.get(i, 'unknown')}({''.join(args[i])})" for i in sorted(args))
        counts = {n: pd.array([facts[n]], "Int64") for n in ("input_tokens", "output_tokens")}
        times = {n: [moment(facts[n])] for n in ("first_at", "end_at")}
        return pd.DataFrame({"call_id": [key[0]], "output": [output], "model": [facts["model"]], **counts, "error": [facts["error"]], "complete": [complete], **times})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        names = [f.split()[0] for f in self.FACTS.split(", ")]
        held = self.facts.get()
        facts, stored, touched = dict(zip(names, held or self.EMPTY)), held is not None, {}
        if facts["closed"]:
            return  # chunks delivered again
        before = facts["end_at"]
        for frame in rows:
            if touched:  # no more than the slices of a frame are held
                self._store(touched)
                touched, stored = {}, True
            facts = self._fed(facts, frame, touched, stored)
        if facts["last_seq"] is not None and facts["n"] > facts["last_seq"]:
            yield self._row(key, facts, True, touched, stored)
            if stored:
                self.parts.clear()
            facts = dict(zip(names, self.EMPTY)) | {"closed": True, "end_at": facts["end_at"]}
        else:
            self._store(touched)
        if facts["end_at"] is not None:
            self.facts.update(tuple(facts.values()))
            self.set_timer(facts["end_at"] + self.expire, None if before is None else before + self.expire)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        names = [f.split()[0] for f in self.FACTS.split(", ")]
        held = self.facts.get()
        if held is not None:
            facts = dict(zip(names, held))
            if not facts["closed"]:
                yield self._row(key, facts, False, {}, True)
                self.parts.clear()
            self.facts.clear()


def assemble_chunks_stream(chunks: DataFrame, watermark: str = "10 minutes", expire_seconds: int = 86400, slice_size: int = 1000) -> DataFrame:
    """The streaming twin of :func:`~spanquarry.operators.logs.assemble_chunks`: one row per call.

    ``chunks`` has its columns, ``at`` and ``last`` (true on a call's final chunk; it may be null throughout). Sequence numbers start
    at zero; chunks may come in any order and more than once. A call is given out with ``complete`` once all chunks
    up to the last one are there, however long it paused; without an end it is given out, not complete, when no chunk has come for
    ``expire_seconds``. State is kept per slice of the sequence and text choice or tool, and joined where a slice is full.
    """
    kind = chunks.schema["call_id"].dataType.simpleString()
    return (
        keyed(chunks, "call_id", "at", watermark)
        .groupBy("call_id")
        .transformWithStateInPandas(
            ChunkAssembler(expire_seconds * 1_000_000, slice_size), f"call_id {kind}, {ChunkAssembler.OUTPUT}", "Append", "EventTime"
        )
    )


def local_bursts(turns: DataFrame, idle_seconds: int) -> DataFrame:
    """Turns of a session that follow each other within the idle time, as one row per task: first_at, last_at, n.

    Turns of other tasks in between only make gaps smaller, so no idle moment is lost and a hot session is a few rows.
    """
    kind = turns.schema["session_id"].dataType.simpleString()

    def collapse(frames):
        for frame in frames:
            rows = frame.sort_values(["session_id", "started_at"], na_position="last")
            same = rows["session_id"] == rows["session_id"].shift()
            gap = rows["started_at"] - rows["started_at"].shift() >= pd.Timedelta(seconds=idle_seconds)
            burst = (~same | gap).cumsum()
            yield rows.groupby(burst).agg(
                session_id=("session_id", "first"), first_at=("started_at", "first"), last_at=("started_at", "last"), n=("started_at", "size")
            )

    slim = turns.select(F.col("session_id").cast("string").alias("session_id"), "started_at")  # pandas would make large ids with nulls floats
    made = slim.mapInPandas(collapse, "session_id STRING, first_at TIMESTAMP, last_at TIMESTAMP, n BIGINT")
    return made.withColumn("session_id", F.col("session_id").cast(kind))


class IdleSessions(Timed):
    """The bursts of a bucket of sessions that may still grow, and the number of turns of each session before them; see :func:`idle_sessions`."""

    def __init__(self, idle_micros: int, kind: str):
        self.idle, self.kind = idle_micros, kind

    def init(self, handle) -> None:
        super().init(handle)
        self.open = handle.getValueState("open", f"ids ARRAY<{self.kind}>, firsts ARRAY<BIGINT>, lasts ARRAY<BIGINT>, counts ARRAY<BIGINT>")
        self.settled = handle.getMapState("settled", f"session_id {self.kind}", "turns BIGINT")

    def _timer(self, bursts: list) -> int | None:
        return min(b[2] for b in bursts) + self.idle if bursts else None

    def _settle(self, bursts: list, watermark: int, before: int | None = None) -> Iterator[pd.DataFrame]:
        """``bursts`` (session, first, last, n), those of a session in order of time."""
        turns, out, left = {}, [], []
        for burst in bursts:
            session, _, last, n = burst
            if last + self.idle <= watermark:
                if session not in turns:
                    held = self.settled.getValue((session,))
                    turns[session] = held[0] if held else 0
                turns[session] += n
                if turns[session] >= 2:
                    out.append((session, last + self.idle, turns[session]))
            else:
                left.append(burst)
        for session, n in turns.items():
            self.settled.updateValue((session,), (n,))
        if left:
            self.open.update(tuple(map(list, zip(*left))))
        else:
            self.open.clear()
        self.set_timer(self._timer(left), before)
        if out:
            ids, at, n = zip(*out)
            yield pd.DataFrame({"session_id": ids, "idle_at": pd.Series(at, dtype="int64").to_numpy().view("datetime64[us]"), "turns": n})

    def _held(self) -> list:
        return list(zip(*(self.open.get() or ())))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = self._held()
        own: dict = {}
        for session, *burst in held:
            own.setdefault(session, []).append(tuple(burst))
        for frame in rows:
            for session, *burst in zip(frame["session_id"].tolist(), micros(frame["first_at"]).tolist(), micros(frame["last_at"]).tolist(), map(int, frame["n"])):
                own.setdefault(session, []).append(tuple(burst))
        merged = []
        for session, bursts in own.items():
            first, last, n = None, None, 0
            for a, b, k in sorted(bursts):
                if n and a - last < self.idle:
                    last, n = max(b, last), n + k
                    continue
                if n:
                    merged.append((session, first, last, n))
                first, last, n = a, b, k
            merged.append((session, first, last, n))
        yield from self._settle(merged, timerValues.getCurrentWatermarkInMs() * 1000, self._timer(held))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._settle(self._held(), timerValues.getCurrentWatermarkInMs() * 1000)


def idle_sessions(turns: DataFrame, idle_seconds: int = 120, watermark: str = "10 minutes", buckets: int = 1024) -> DataFrame:
    """The streaming twin of :func:`~spanquarry.operators.monitoring.idle_points`: session_id, idle_at, turns.

    A session of at least two turns is told each time it has been quiet for ``idle_seconds``, with all its turns so far: one that resumes
    is told again as a whole. Sessions are dealt into ``buckets`` by a hash of their id. The state of a bucket is the bursts that the
    watermark has not passed, read whole when a turn comes, under one timer, and for each session the count of settled turns, read when one settles.
    """
    kind = turns.schema["session_id"].dataType.simpleString()
    return (
        keyed(local_bursts(turns, idle_seconds), "session_id", "last_at", watermark)
        .withColumn("bucket", F.pmod(F.xxhash64("session_id"), F.lit(buckets)))
        .groupBy("bucket")
        .transformWithStateInPandas(IdleSessions(idle_seconds * 1_000_000, kind), f"session_id {kind}, idle_at TIMESTAMP, turns BIGINT", "Append", "EventTime")
    )


class OpenRuns(Timed):
    """The open runs of a bucket until their limits: what is delivered again by then changes nothing; see :func:`ttl_sweep_stream`."""

    NEVER = 2**63 - 1

    def __init__(self, ttl_micros: int, kind: str):
        self.ttl, self.kind = ttl_micros, kind

    def init(self, handle) -> None:
        super().init(handle)
        self.runs = handle.getValueState("runs", f"ids ARRAY<{self.kind}>, started ARRAY<BIGINT>, ended ARRAY<BIGINT>")

    def _held(self) -> pd.DataFrame:
        ids, started, ended = self.runs.get() or ([], [], [])
        return pd.DataFrame({"run_id": list(ids), "started": pd.Series(list(started), dtype="int64"), "ended": pd.Series(list(ended), dtype="int64")})

    @staticmethod
    def _first(frames: list[pd.DataFrame]) -> pd.DataFrame:
        """The earliest start and end of each run."""
        return pd.concat([f for f in frames if len(f)]).groupby("run_id", sort=False, dropna=False).min().reset_index()

    def _due(self, runs: pd.DataFrame) -> pd.Series:
        return runs["started"].where(runs["started"] != self.NEVER, runs["ended"]) + self.ttl

    def _timer(self, runs: pd.DataFrame) -> int | None:
        return int(self._due(runs).min()) if len(runs) else None

    def _keep(self, runs: pd.DataFrame, before: int | None = None) -> None:
        if len(runs):
            self.runs.update((runs["run_id"].tolist(), runs["started"].tolist(), runs["ended"].tolist()))
        else:
            self.runs.clear()
        self.set_timer(self._timer(runs), before)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        yield from ()
        held = self._held()
        frames = [held]
        for frame in rows:
            at, end = micros(frame["at"]), frame["is_end"].to_numpy(bool)
            started, ended = at.copy(), at.copy()
            started[end], ended[~end] = self.NEVER, self.NEVER
            frames.append(self._first([pd.DataFrame({"run_id": frame["run_id"].to_numpy(), "started": started, "ended": ended})]))
        self._keep(self._first(frames), self._timer(held))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        runs = self._held()
        over = -(-self._due(runs) // 1000) <= timerValues.getCurrentWatermarkInMs()
        self._keep(runs[~over])
        told = runs[over]
        told = told[(told["started"] != self.NEVER) & ((told["ended"] < told["started"]) | (told["ended"] - self.ttl > told["started"]))]
        if len(told):
            started = told["started"].to_numpy()
            yield pd.DataFrame({"run_id": told["run_id"].to_numpy(), "started_at": started.view("datetime64[us]"), "dropped_at": (started + self.ttl).view("datetime64[us]")})


def ttl_sweep_stream(starts: DataFrame, ends: DataFrame, ttl_seconds: int = 3600, watermark: str = "10 minutes", buckets: int = 1024) -> DataFrame:
    """Runs (run_id, started_at, dropped_at) whose end did not come within the limit, told and forgotten when it has passed.

    ``starts(run_id, started_at)``, ``ends(run_id, ended_at)``; an end that comes later finds nothing, as in
    :func:`~spanquarry.operators.logs.ttl_sweep` with ``ended_at``.

    Runs are dealt into ``buckets`` by a hash of their id and the open ones of a bucket are one state under one timer: a state per run costs
    a dozen calls to the store. A bucket is read whole when one of its runs comes, so it should hold some thousand open runs.
    """
    kind = starts.schema["run_id"].dataType.simpleString()
    both = starts.select("run_id", F.col("started_at").alias("at"), F.lit(False).alias("is_end")).unionByName(
        ends.select("run_id", F.col("ended_at").alias("at"), F.lit(True).alias("is_end"))
    )
    return (
        keyed(both, "run_id", "at", watermark)
        .withColumn("bucket", F.pmod(F.xxhash64("run_id"), F.lit(buckets)))
        .groupBy("bucket")
        .transformWithStateInPandas(
            OpenRuns(ttl_seconds * 1_000_000, kind), f"run_id {kind}, started_at TIMESTAMP, dropped_at TIMESTAMP", "Append", "EventTime",
            eventTimeColumnName="dropped_at",
        )
    )


def dropped_counts(dropped: DataFrame, width: str = "1 day") -> DataFrame:
    """How many runs were dropped in each span of time (ts: its start in ms); of a table or of :func:`ttl_sweep_stream`."""
    return dropped.groupBy(F.window("dropped_at", width)).agg(F.count("*").alias("n")).select(F.unix_millis("window.start").alias("ts"), "n")
