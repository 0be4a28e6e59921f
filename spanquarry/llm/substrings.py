"""Removal of repeated word sequences with suffix automata of reference shards.

A window is ``length`` consecutive words. Each window is keyed by the smallest hash among the short word
n-grams in it; neighbouring windows with one key make a *run*. Equal windows have equal keys, so all earlier
occurrences of a window lie in runs of its key. Runs whose key occurs once in the corpus hold no repeats. The distinct word
sequences of the other runs are the reference text: they are dealt into shards by key, a suffix automaton of each shard
is built in the task that streams the shard's spans, and the matching statistics at least ``length`` long
whose first occurrence is earlier give the spans to remove. Copies of a run need no streaming: every
window of a copy starts earlier in the run's first occurrence.

The automata are not broadcast: their total size grows with the repeated text of the corpus, so each goes to the
one shard of spans that can match it.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanquarry.llm.tables import batch_of, stored
from spanquarry.llm.words import Words, parts, sliding_min

#: White space of the word rule `[^\x20\x09-\x0D]+`.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
#: Words of the n-grams whose smallest hash keys a window.
GRAM = 6
#: Keys with more distinct runs than this are settled window by window.
FINE = 256
#: Words in an automaton before the next key starts a new shard.
SHARD_WORDS = 50_000

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_RUN = np.dtype([("key", "<u8"), ("text", "<u8"), ("doc", "<i8"), ("twin", "<i4"), ("start", "<i4"), ("n", "<i4")])
_NO_ID = -(2**63)
FOUND = pa.schema(
    [("kind", pa.int8()), ("key", pa.int64()), ("doc", pa.int64()), ("twin", pa.int32()), ("start", pa.int32()), ("n", pa.int32())]
)
FOUND_DDL = "kind tinyint, key bigint, doc bigint, twin int, start int, n int"
COVERED, REFERENCE, HOT = 0, 1, 2


class Automaton:
    """Suffix automaton of several word sequences, added in order of their first place.

    ``first`` of a state is the place (document, word) where the first added occurrence of its words ends.
    """

    def __init__(self):
        self.go: list[dict] = [{}]
        self.link, self.size, self.first = [-1], [0], [(0, 0)]

    def _state(self, go, link, size, first) -> int:
        self.go.append(go)
        self.link.append(link)
        self.size.append(size)
        self.first.append(first)
        return len(self.go) - 1

    def _split(self, p: int, word, q: int) -> int:
        """The state of the words of p followed by ``word``, cut off from the longer ones of q."""
        go, link, size = self.go, self.link, self.size
        if size[p] + 1 == size[q]:
            return q
        copy = self._state(dict(go[q]), link[q], size[p] + 1, self.first[q])
        while p >= 0 and go[p].get(word) == q:
            go[p][word] = copy
            p = link[p]
        link[q] = copy
        return copy

    def add(self, words: list[str], doc: int, start: int) -> None:
        go, link, last = self.go, self.link, 0
        for n, word in enumerate(words):
            q = go[last].get(word)
            if q is not None:
                last = self._split(last, word, q)
                continue
            new, p = self._state({}, 0, self.size[last] + 1, (doc, start + n)), last
            while p >= 0 and word not in go[p]:
                go[p][word] = new
                p = link[p]
            if p >= 0:
                link[new] = self._split(p, word, go[p][word])
            last = new

    def repeats(self, words: list[str], doc: int, start: int, length: int):
        """Starts of the windows whose words end at an earlier place as well: matching statistics cut at ``length``."""
        go, link, size, first = self.go, self.link, self.size, self.first
        state = held = 0
        for n, word in enumerate(words):
            while state and word not in go[state]:
                state = link[state]
                held = size[state]
            if word in go[state]:
                state, held = go[state][word], held + 1
            while held > length and size[link[state]] >= length:
                state = link[state]
                held = size[state]
            if held >= length and first[state] < (doc, start + n):
                yield start + n - length + 1


def _intervals(starts) -> list[tuple[int, int]]:
    """Maximal stretches (start, n) of ascending numbers."""
    out: list[list[int]] = []
    for x in starts:
        if out and x == out[-1][0] + out[-1][1]:
            out[-1][1] += 1
        else:
            out.append([x, 1])
    return [tuple(x) for x in out]


def _packed(rows: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Runs as one binary value per bucket of keys."""
    bucket = (rows["key"] >> np.uint64(20)) % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    bucket, rows = bucket[order], rows[order]
    cut = np.flatnonzero(np.diff(bucket)) + 1
    edges = [0, *cut.tolist(), len(rows)] if len(rows) else [0]
    schema = pa.schema([("bucket", pa.int32()), ("runs", pa.binary())])
    return batch_of(
        schema, bucket[edges[:-1]].astype(np.int32), [rows[a:b].tobytes() for a, b in zip(edges, edges[1:])]
    )


def _lowest(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows sorted by key, run and place, and whether each is the first place of its run."""
    rows = rows[np.lexsort((rows["start"], rows["doc"], rows["text"], rows["key"]))]
    first = np.ones(len(rows), bool)
    first[1:] = (rows["key"][1:] != rows["key"][:-1]) | (rows["text"][1:] != rows["text"][:-1])
    head = np.maximum.accumulate(np.where(first, np.arange(len(rows)), 0))
    # rows of one doc_id may share a place; neither comes before the other
    return rows, (rows["doc"] == rows["doc"][head]) & (rows["start"] == rows["start"][head])


def _runs(length: int, buckets: int):
    reach = length - GRAM + 1

    def part(texts: pa.Array, doc: np.ndarray, twin: np.ndarray):
        words = Words(texts, SPACES)
        if len(words.hash) < length:
            return
        grams = words.grams(GRAM)
        key = sliding_min(grams, reach)
        at = np.flatnonzero(words.whole(length))
        if not len(at):
            return
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(at) > 1) | (key[at[1:]] != key[at[:-1]]) | (words.doc[at[1:]] != words.doc[at[:-1]])
        head = np.flatnonzero(new)
        count = np.diff(np.append(head, len(at)))
        start = at[head]
        rows = np.empty(len(head), _RUN)
        row = words.doc[start]
        rows["key"], rows["n"] = key[start], np.where(_twice(grams, key[start], start, count + reach - 1), -count, count)
        rows["text"] = words.span_hashes(start, start + count + length - 1)
        rows["doc"], rows["twin"] = doc[row], twin[row]
        rows["start"] = start - words.of_doc[row]
        del words, grams, key, at, new, head, count, start, row  # of the size of the texts; the consumer works meanwhile
        # of equal runs in this part only the first place and one later place are passed on
        rows, lead = _lowest(rows)
        yield from _told(rows[~lead])
        yield _both(_packed(_with_count(rows, lead), buckets))

    def find(batches):
        for batch in batches:
            texts = batch.column("text")
            doc, twin = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc", "twin"))
            for begin, n in parts(texts):
                yield from part(texts.slice(begin, n), doc[begin : begin + n], twin[begin : begin + n])
        pa.default_memory_pool().release_unused()  # the worker lives on

    return find


def _twice(grams: np.ndarray, key: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Whether a run holds its key at two places, so that one of its windows may repeat another."""
    first = np.cumsum(count) - count
    at = np.arange(int(count.sum())) + np.repeat(start - first, count)
    return np.add.reduceat(grams[at] == np.repeat(key, count), first, dtype=np.int32) > 1


def _with_count(rows: np.ndarray, lead: np.ndarray) -> np.ndarray:
    """The leading rows; n is negative where the key occurs again in the batch or within the run."""
    out = rows[lead].copy()
    again = np.unique(rows["key"][~lead])
    out["n"] = np.where(np.isin(out["key"], again), -np.abs(out["n"]), out["n"])
    return out


_STEP = pa.schema([("bucket", pa.int32()), ("runs", pa.binary()), *FOUND])
_STEP_DDL = "bucket int, runs binary, " + FOUND_DDL


def _both(packed: pa.RecordBatch) -> pa.RecordBatch:
    none = [pa.nulls(packed.num_rows, f.type) for f in FOUND]
    return pa.RecordBatch.from_arrays([*packed.columns, *none], schema=_STEP)


def _joined(rows: np.ndarray) -> np.ndarray:
    """Single windows of one text that follow each other as one run."""
    if not len(rows):
        return rows
    rows = rows[np.lexsort((rows["start"], rows["twin"], rows["doc"]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows["doc"][1:] != rows["doc"][:-1]) | (rows["twin"][1:] != rows["twin"][:-1]) | (np.diff(rows["start"]) > 1)
    head = np.flatnonzero(new)
    out = rows[head].copy()
    last = np.append(head[1:], len(rows)) - 1
    out["n"] = rows["start"][last] - out["start"] + 1
    return out


def _told(rows: np.ndarray):
    """Runs that are copies of an earlier one."""
    if len(rows):
        found = _found(COVERED, rows)
        none = [pa.nulls(len(rows), f.type) for f in list(_STEP)[:2]]
        yield pa.RecordBatch.from_arrays([*none, *found.columns], schema=_STEP)


def _found(kind, rows: np.ndarray) -> pa.RecordBatch:
    kinds = np.full(len(rows), kind, np.int8) if np.isscalar(kind) else kind.astype(np.int8)
    return batch_of(FOUND, kinds, rows["key"].view(np.int64) if rows["key"].flags.contiguous else rows["key"].astype(np.int64), rows["doc"], rows["twin"], rows["start"], np.abs(rows["n"]))


def _settle():
    def settle(table: pa.Table) -> pa.Table:
        rows = np.concatenate([np.frombuffer(x.as_buffer(), _RUN) for c in table.column("runs").chunks for x in c])
        rows, lead = _lowest(rows)
        _, of, places = np.unique(rows["key"], return_inverse=True, return_counts=True)
        again = (places > 1) | (np.bincount(of, rows["n"] < 0) > 0)
        texts = np.bincount(of, lead)
        ask = lead & again[of]
        kind = np.where(lead, np.where(texts[of] > FINE, HOT, REFERENCE), COVERED)
        keep = ask | ~lead
        return pa.Table.from_batches([_found(kind[keep], np.ascontiguousarray(rows[keep]))])

    return settle


def _spans(length: int):
    """The words of asked runs, each with its key."""
    schema = pa.schema([("key", pa.int64()), ("doc", pa.int64()), ("twin", pa.int32()), ("start", pa.int32()), ("words", pa.string())])

    def cut(batches):
        for batch in batches:
            out = []
            texts, asked = batch.column("text"), batch.column("asked")
            docs, twins = batch.column("doc").to_pylist(), batch.column("twin").to_pylist()
            for doc, twin, text, runs in zip(docs, twins, texts, asked):
                words = _WORD.findall(text.as_py())
                for run in runs.as_py():
                    a = run["start"]
                    out.append((run["key"], doc, twin, a, " ".join(words[a : a + run["n"] + length - 1])))
                if len(out) > 20_000:
                    yield batch_of(schema, *zip(*out))
                    out = []
            if out:
                yield batch_of(schema, *zip(*out))

    return cut, "key bigint, doc bigint, twin int, start int, words string"


def _windows(length: int, buckets: int):
    """Single windows of the runs of hot keys, keyed by their own words."""

    def cut(batches):
        for batch in batches:
            doc, twin = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc", "twin"))
            texts, asked = batch.column("text"), batch.column("asked")
            for begin, size in parts(texts):
                words = Words(texts.slice(begin, size), SPACES)
                of, at = [], []
                for i, runs in enumerate(asked.slice(begin, size).to_pylist()):
                    for run in runs:
                        of += [i] * run["n"]
                        at += range(run["start"], run["start"] + run["n"])
                of, at = np.array(of, np.int64), np.array(at, np.int64)
                place = words.of_doc[of] + at
                rows = np.empty(len(at), _RUN)
                rows["text"] = words.span_hashes(place, place + length)
                rows["key"] = words.grams(length)[place]
                rows["doc"], rows["twin"], rows["start"], rows["n"] = doc[begin + of], twin[begin + of], at, 1
                rows, lead = _lowest(rows)
                yield from _told(_joined(rows[~lead]))
                yield _both(_packed(rows[lead], buckets))

    return cut


def _stream(length: int):
    """Spans sorted by key and place, shard by shard."""
    schema = pa.schema([("doc", pa.int64()), ("twin", pa.int32()), ("start", pa.int32()), ("n", pa.int32())])

    def shard(spans):
        automaton, words = Automaton(), [s[3].split(" ") for s in spans]
        for (doc, twin, start, _), w in zip(spans, words):
            automaton.add(w, doc, start)
        out = []
        for (doc, twin, start, _), w in zip(spans, words):
            for a, n in _intervals(automaton.repeats(w, doc, start, length)):
                out.append((doc, twin, a, n))
        return batch_of(schema, *(zip(*out) if out else [[]] * 4))

    def stream(batches):
        spans, held, key = [], 0, None
        for batch in batches:
            for k, *span in zip(*(c.to_pylist() for c in batch.columns)):
                if k != key and held >= SHARD_WORDS:
                    yield shard(spans)
                    spans, held = [], 0
                key = k
                spans.append(span)
                held += span[3].count(" ") + 1
        if spans:
            yield shard(spans)

    return stream, "doc bigint, twin int, start int, n int"


def repeated_spans(docs: DataFrame, length: int = 20) -> tuple[DataFrame, DataFrame]:
    """The documents with keys ``doc`` and ``twin``, and the repeated stretches (doc, twin, start, n) of window starts."""
    spark = docs.sparkSession
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = docs.select(
        F.coalesce("doc_id", F.lit(_NO_ID)).alias("doc"),
        F.hash(F.coalesce("text", F.lit(""))).alias("twin"),
        "text",
        F.struct(*(c for c in docs.columns if c != "text")).alias("row"),
    )

    def settled(step: DataFrame, name: str) -> DataFrame:
        step = stored(step, name)
        packed = step.where("bucket IS NOT NULL").select("bucket", "runs")
        return step.where("bucket IS NULL").select(FOUND.names).unionByName(
            packed.groupBy("bucket").applyInArrow(_settle(), FOUND_DDL)
        )

    found = stored(settled(keyed.select("doc", "twin", "text").mapInArrow(_runs(length, buckets), _STEP_DDL), "runs"), "found")

    def asked(kind: int) -> DataFrame:
        lists = found.where(F.col("kind") == kind).groupBy("doc", "twin").agg(F.collect_list(F.struct("start", "n", "key")).alias("asked"))
        return keyed.join(lists.hint("shuffle_hash"), ["doc", "twin"])

    cut, ddl = _spans(length)
    spans = asked(REFERENCE).mapInArrow(cut, ddl).repartition("key").sortWithinPartitions("key", "doc", "start")
    stream, stream_ddl = _stream(length)
    streamed = spans.select("key", "doc", "twin", "start", "words").mapInArrow(stream, stream_ddl)
    fine = settled(asked(HOT).mapInArrow(_windows(length, max(1, buckets // 4)), _STEP_DDL), "windows").where(F.col("kind") == COVERED)
    names = ["doc", "twin", "start", "n"]
    copies = found.where(F.col("kind") == COVERED).select(names)
    return keyed, copies.unionByName(streamed).unionByName(fine.select(names))


def drop_repeats(docs: DataFrame, length: int = 20) -> DataFrame:
    """Documents without the words covered by a window of ``length`` words that also starts earlier.

    Earlier means a smaller doc_id, or the same doc_id and an earlier start; windows are judged on the input.
    Returns every column of ``docs`` (text: the kept words joined by one space, or the text itself where nothing is
    removed) with ``n_words``, ``n_removed`` and ``kept`` (always the kept words joined by one space), which replace columns of
    these names.

    Null text has no words and stays null; a null doc_id comes before all others; rows of one doc_id and one start
    do not remove each other; empty tables give no rows.
    """
    keyed, spans = repeated_spans(docs, length)
    lists = spans.groupBy("doc", "twin").agg(F.collect_list(F.struct("start", "n")).alias("asked"))
    joined = keyed.join(lists.hint("shuffle_hash"), ["doc", "twin"], "left")
    extra = pa.schema([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])

    def clean(batches):
        for batch in batches:
            out = []
            for text, runs in zip(batch.column("text"), batch.column("asked")):
                words = _WORD.findall(text.as_py() or "")
                n, cover = len(words), runs.as_py()
                if cover:
                    edge = np.zeros(n + 1, np.int32)
                    for run in cover:
                        edge[run["start"]] += 1
                        edge[run["start"] + run["n"] + length - 1] -= 1
                    words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:n]) == 0).tolist()]
                out.append((n, n - len(words), " ".join(words)))
            made = batch_of(extra, *(zip(*out) if out else [[]] * 3))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("text"), *made.columns], names=["row", "text", *extra.names]
            )

    kind = joined.schema["row"].dataType.simpleString()
    out = joined.select("row", "text", "asked").mapInArrow(clean, f"row {kind}, text string, n_words bigint, n_removed bigint, kept string")
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text")).alias("text")
    return out.select(*(text if c == "text" else F.col("row")[c].alias(c) for c in docs.columns if c not in extra.names), *extra.names)
