"""Best-fit decreasing packing of tokenised documents into sequences of a fixed capacity."""

from __future__ import annotations

import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanquarry.llm.encoding import encoded
from spanquarry.llm.tables import batch_of, stored

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


class Capacities:
    """Segment tree over remaining capacities 0..n: which of them some open bin has.

    ``tightest(need)`` is the smallest one of at least ``need``, found in O(log n).
    """

    def __init__(self, n: int):
        self.size = 1 << n.bit_length()
        self.open = [False] * (2 * self.size)

    def set(self, capacity: int, value: bool) -> None:
        node = self.size + capacity
        self.open[node] = value
        while node > 1:
            node //= 2
            self.open[node] = self.open[2 * node] or self.open[2 * node + 1]

    def tightest(self, need: int) -> int | None:
        node = self.size + need
        if self.open[node]:
            return need
        while node > 1:  # up to the first right sibling that holds an open bin, then down its left edge
            if node % 2 == 0 and self.open[node + 1]:
                node += 1
                while node < self.size:
                    node = 2 * node + (not self.open[2 * node])
                return node - self.size
            node //= 2
        return None


def pack_lengths(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over a histogram of lengths.

    Items of one length are alike and bins of one remaining capacity are alike, so whole ranges are placed
    at once. Returns rows (length, first rank, items, first bin, items per bin, offset): item ``rank`` of
    ``length`` goes to bin ``first bin + i // per``, at ``offset + i % per * length`` with i = rank - first.
    Work and rows depend on the capacity, not on the number of documents.
    """
    tree, bins, made, out = Capacities(capacity), [deque() for _ in range(capacity + 1)], 0, []

    def put(room: int, first: int, n: int) -> None:
        if n:
            bins[room].append((first, n))
            tree.set(room, True)

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                n = -(-left // (capacity // length))
                put(capacity, made, n)
                made, room = made + n, capacity
            first, n = bins[room].popleft()
            if not bins[room]:
                tree.set(room, False)
            per = room // length
            full = min(n, left // per)
            if full:
                out.append((length, rank, full * per, first, per, capacity - room))
                put(room - per * length, first, full)
                rank, left, first, n = rank + full * per, left - full * per, first + full, n - full
            if left and n:
                some = min(left, per)
                out.append((length, rank, some, first, some, capacity - room))
                put(room - some * length, first, 1)
                rank, left, first, n = rank + some, left - some, first + 1, n - 1
            put(room, first, n)
    return out


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, keep_ids: bool = False) -> DataFrame:
    """Every document's ids with ``end_id`` appended, cut into pieces of ``capacity`` where longer.

    The first piece of a long document takes the remainder, so every other one fills a sequence.
    Null text counts as empty. With ``keep_ids`` the ids come along as little-endian unsigned 32-bit bytes.
    """
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    schema = pa.schema(fields + [("ids", pa.binary())] * keep_ids)

    def cut(batches):
        for keys, values, ends in encoded(batches, tokenizer, end_id):
            raw, rows, ends = memoryview(values).cast("B"), [], ends.tolist()
            for key, begin, end in zip(keys, [0, *ends], ends):
                n = end - begin
                edges = [*range(n % capacity or capacity, n + 1, capacity)]
                for piece, (x, y) in enumerate(zip([0, *edges], edges)):
                    ids = raw[4 * (begin + x) : 4 * (begin + y)]
                    rows.append((key, piece, x, y - x, zlib.crc32(ids), bytes(ids) if keep_ids else None))
            yield batch_of(schema, *list(zip(*rows))[: len(schema)])

    return docs.select("doc_id", "text").mapInArrow(cut, PIECES + ", ids binary" * keep_ids)


def best_fit_pack(
    docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, keep_ids: bool = False
) -> DataFrame:
    """Pack all documents: the pieces of :func:`token_pieces` with ``sequence_id`` and ``offset``.

    The histogram of lengths (at most ``capacity`` rows) is all the driver sees; it lays out the whole best-fit
    decreasing packing as ranges of ranks. A piece finds its rank among pieces of its length by numbering
    them per (input partition, length) and adding the counts of earlier partitions, so a length that a third of
    all pieces share is numbered in as many tasks as there are partitions.

    Null or repeated doc_ids are packed like others; empty and null texts are the end id alone; an empty table
    gives no rows; other columns are ignored.
    """
    pieces = stored(
        token_pieces(docs, tokenizer, capacity, end_id, keep_ids).withColumn("part", F.spark_partition_id()), "pieces"
    )
    counts = pieces.groupBy("part", "length").count()
    layout = pack_lengths({r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}, capacity)
    before = counts.select(
        "part",
        "length",
        F.coalesce(
            F.sum("count").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("before"),
    )
    order = Window.partitionBy("part", "length").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        pieces.withColumn("n", F.row_number().over(order) - 1)
        .join(before, ["part", "length"])
        .withColumn("rank", F.col("before") + F.col("n"))
        .drop("part", "n", "before")
    )
    first_key = np.array([(x[0] << 48) + x[1] for x in layout] or [0], np.int64)
    by_key = np.argsort(first_key)
    first_key = first_key[by_key]
    bins = np.array([x[3:] for x in layout] or [(0, 1, 0)], np.int64)[by_key]

    def place(batches):
        for batch in batches:
            length, rank = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("length", "rank"))
            key = (length << 48) + rank
            at = np.searchsorted(first_key, key, "right") - 1
            i, (first, per, offset) = key - first_key[at], bins[at].T
            kept = batch.drop_columns(["rank"])
            yield kept.append_column("sequence_id", pa.array(first + i // per)).append_column(
                "offset", pa.array(offset + i % per * length)
            )

    columns = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * keep_ids]
    kinds = PIECES + ", ids binary" * keep_ids + ", sequence_id bigint, offset bigint"
    return ranked.select(*columns, "rank").mapInArrow(place, kinds)
