"""Trie of conversation prefixes, with subtree totals by time-forward processing.

A node is a sequence of first turns; its key is a chained 128-bit digest of them, so equal prefixes of any two conversations
have one key. Members of a node are counted by a plain aggregation. Totals of subtrees travel upwards: a node's *time*
is its place in reverse level order (deepest first), and a processed node sends its totals forward to the time of its parent
through a priority queue that spills sorted runs.

Nodes of more than ``limit`` members are *heavy*; they are closed under parents. The subtrees that hang below heavy
nodes are the shards, each with ``limit`` members at most: every shard is sorted by time and processed in a stream. The totals of the shard
roots are summed by parent, and the heavy nodes go on as a smaller trie with a limit that is ``limit`` times as large, until none is left.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanquarry.llm.ordered import EMPTY_SHA256, crc32_sql, joined_sha256
from spanquarry.llm.tables import stored

#: Members of a shard at most, in the first round; messages that a queue holds before it spills.
LIMIT, HELD = 1024, 500_000
#: Ids joined to one string before the ends of a node are streamed.
CHUNK = 4096
#: Messages read back at once from a spilled run.
PORTION = 5000
ROOT = bytes(16)

TOTALS = ["n_children", "n_leaves", "saved"]


class SpillingQueue:
    """Messages (time, total, ...) in order of time. Beyond ``held`` of them, those in memory become a sorted run in an
    unlinked file, as with a spill of Spark's own: nothing is left and nobody else reads it."""

    def __init__(self, held: int):
        self.held, self.heap, self.runs = held, [], []

    def push(self, message: tuple) -> None:
        heapq.heappush(self.heap, message)
        if len(self.heap) > self.held:
            run = self._spilled(sorted(self.heap))
            heapq.heappush(self.runs, (next(run), len(self.runs), run))
            self.heap = []

    @staticmethod
    def _spilled(messages: list):
        file = tempfile.TemporaryFile()
        for i in range(0, len(messages), PORTION):
            pickle.dump(messages[i : i + PORTION], file)
        file.seek(0)
        n = -(-len(messages) // PORTION)
        messages.clear()

        def read():
            with file:
                for _ in range(n):
                    yield from pickle.load(file)

        return read()

    def pop_at(self, time: tuple):
        """All messages addressed to ``time``, which none of the remaining ones precedes."""
        while True:
            if self.heap and self.heap[0][0] == time:
                yield heapq.heappop(self.heap)
            elif self.runs and self.runs[0][0][0] == time:
                message, number, run = self.runs[0]
                after = next(run, None)
                if after is None:
                    heapq.heappop(self.runs)
                else:
                    heapq.heapreplace(self.runs, (after, number, run))
                yield message
            else:
                return

    def __bool__(self) -> bool:
        return bool(self.heap or self.runs)


def turn_keys(conversations: DataFrame) -> DataFrame:
    """conv_id, at (1, 2, ... in order of turn, null first, then role and text), digest and n_chars (code points) of every turn.

    Null role or text is empty; rows without conv_id belong to no conversation.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = conversations.where("conv_id IS NOT NULL").select("conv_id", "turn", role.alias("role"), text.alias("text"))
    digest = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))
    return rows.select("conv_id", F.row_number().over(order).alias("at"), digest.alias("digest"), F.length("text").cast("bigint").alias("n_chars"))


def rebuilt(keys: DataFrame, family: int = 100, variants: int = 6) -> DataFrame:
    """Conversations (``turn_keys``) that begin with the first turns of the first one of their family.

    Conversation c takes the first h turns of c - c % ``family`` (all if fewer), then its own behind its first h;
    h = crc32(decimal c) % ``variants``. Returns conv_id, part, at, digest, n_chars; a row of part 0 stands for each conversation itself.
    """
    keys = stored(keys, "turn-keys")  # read three times below
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % variants
    ids = keys.where("at = 1").select("conv_id", head.alias("h"), (F.col("conv_id") - F.col("conv_id") % family).alias("source"))
    lent = keys.where((F.col("at") < variants) & (F.col("conv_id") % family == 0)).withColumnRenamed("conv_id", "source")
    names = ["conv_id", "part", "at", "digest", "n_chars"]
    taken = ids.join(lent, "source").where("at <= h").withColumn("part", F.lit(1)).select(names)
    own = keys.where(F.col("at") > head).withColumn("part", F.lit(2)).select(names)
    none = ids.select("conv_id", F.lit(0).alias("part"), F.lit(0).alias("at"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("bigint").alias("n_chars"))
    return none.unionByName(taken).unionByName(own)


def _chains():
    """Nodes along each conversation; the rows of a conversation follow each other in order."""
    names = ["conv_id", "depth", "node", "parent", "n_chars", "last"]

    def chains(batches):
        held = None
        for batch in batches:
            kind = batch.schema.field("conv_id").type
            schema = pa.schema(list(zip(names, [kind, pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.bool_()])))
            out = []
            for conv, digest, n in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "digest", "n_chars"))):
                if held is not None:
                    out.append((*held, held[0] != conv))
                if digest is None:
                    held = (conv, 0, ROOT, None, 0)
                else:
                    held = (conv, held[1] + 1, hashlib.blake2b(held[2] + digest, digest_size=16).digest(), held[2], n)
            yield pa.RecordBatch.from_pylist([dict(zip(names, x)) for x in out], schema=schema)
        if held is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(names, (*held, True)))], schema=schema)

    return chains


def _forward(held: int):
    """Totals of the nodes of each shard, which come in reverse level order."""

    def forward(batches):
        queue, shard = SpillingQueue(held), None
        for batch in batches:
            columns = {c: batch.column(c).to_pylist() for c in ("shard", "node", "parent", "depth", *TOTALS)}
            out = [[], [], []]
            for root, node, parent, depth, children, leaves, saved in zip(*columns.values()):
                if root != shard:
                    assert not queue, "a message is left for a node that never came"
                    shard = root
                for _, n, m, s in queue.pop_at((-depth, node)):
                    children, leaves, saved = children + n, leaves + m, saved + s
                leaves = leaves if children else 1
                if node != root:
                    queue.push(((1 - depth, parent), 1, leaves, saved))
                for column, value in zip(out, (children, leaves, saved)):
                    column.append(value)
            for name, column in zip(TOTALS, out):
                batch = batch.set_column(batch.schema.get_field_index(name), name, pa.array(column, pa.int64()))
            yield batch
        assert not queue, "a message is left for a node that never came"

    return forward


def prefix_trie(turns: DataFrame, limit: int = LIMIT, held: int = HELD) -> tuple[DataFrame, DataFrame]:
    """Nodes and ends of the trie of conversations given as ``rebuilt`` gives them.

    Nodes: node (key), parent (its key; root: null), depth, conv_id (smallest member), parent_conv_id, n_convs (members), n_chars (of the last
    turn), n_children, n_leaves (childless nodes in the subtree), saved (sum over the subtree of (n_convs - 1) * n_chars).
    Ends: node, conv_id of every member that has no further turn. Without conversations there is no node.
    """
    kind = turns.schema["conv_id"].dataType.simpleString()
    # a hash of its own: an exchange on the bare column may be planned away where a union is thought to have it already
    ordered = turns.repartition(F.xxhash64("conv_id")).sortWithinPartitions("conv_id", "part", "at").select("conv_id", "digest", "n_chars")
    paths = stored(
        ordered.mapInArrow(_chains(), f"conv_id {kind}, depth int, node binary, parent binary, n_chars bigint, last boolean"), "trie-paths"
    )
    counted = paths.groupBy("node").agg(
        F.min("parent").alias("parent"), F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"), F.max("n_chars").alias("n_chars"),
    )
    zero = F.lit(0).cast("bigint")
    start = counted.withColumns({"n_children": zero, "n_leaves": zero, "saved": (F.col("n_convs") - 1) * F.col("n_chars")})
    todo = nodes = stored(start, "trie-nodes")
    done, most = [], limit
    while not todo.isEmpty():
        heavy = todo.where(F.col("n_convs") > most)
        light = todo.where(F.col("n_convs") <= most)
        roots = (
            paths.join(light.select("conv_id").distinct(), "conv_id", "left_semi")
            .join(heavy.select("node", F.lit(True).alias("heavy")), "node", "left")
            .where("heavy IS NULL").groupBy("conv_id").agg(F.min_by("node", "depth").alias("shard"))
        )
        sharded = light.join(roots, "conv_id").repartition("shard").sortWithinPartitions("shard", F.desc("depth"), "node")
        ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in sharded.schema)
        done.append(stored(sharded.mapInArrow(_forward(held), ddl), "trie-totals"))
        up = done[-1].where("node = shard AND parent IS NOT NULL").groupBy(F.col("parent").alias("node"))
        sums = up.agg(F.count("*").alias("c"), F.sum("n_leaves").alias("l"), F.sum("saved").alias("s"))
        more = {n: F.col(n) + F.coalesce(m, zero) for n, m in zip(TOTALS, ("c", "l", "s"))}
        todo, most = stored(heavy.join(sums, "node", "left").withColumns(more).drop("c", "l", "s"), "trie-nodes"), most * limit
    names = ["node", "parent", "depth", "conv_id", "n_convs", "n_chars", *TOTALS]
    every = nodes.limit(0).select(names)
    for part in done:
        every = every.unionByName(part.select(names))
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return every.join(above, "parent", "left"), paths.where("last").select("node", "conv_id")


def ends_sha256(ends: DataFrame) -> DataFrame:
    """node, sha256 of the ends' decimal ids, ascending, comma-joined; a hot node's ids are joined by ranges before they are streamed."""
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",")
    chunks = ends.groupBy("node", F.floor(F.col("conv_id") / CHUNK).alias("chunk")).agg(ids.alias("ids"))
    return joined_sha256(chunks, "node", ["chunk"], "ids", ",")


def trie_report(conversations: DataFrame) -> DataFrame:
    """The trie of rebuilt conversations, one row per node."""
    nodes, ends = prefix_trie(rebuilt(turn_keys(conversations)))
    digests = ends_sha256(ends)
    longs = {"depth": F.col("depth").cast("bigint"), "saved_tokens": F.col("saved"), "ends_sha256": F.coalesce("sha256", F.lit(EMPTY_SHA256))}
    return nodes.join(digests, "node", "left").withColumns(longs).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )


def oracle() -> str:
    """DuckDB: members are rows, subtrees are found by the ancestors of each node's smallest member."""
    return f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, {crc32_sql('conv_id::VARCHAR')} % 6 AS h, conv_id - conv_id % 100 AS source FROM (SELECT DISTINCT conv_id FROM t)),
r AS (
  SELECT c.conv_id, 1 AS part, t.pos, t.role, t.text FROM c JOIN t ON t.conv_id = c.source AND t.pos <= c.h
  UNION ALL SELECT c.conv_id, 2, t.pos, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos > c.h),
s AS (
  SELECT c.conv_id, coalesce(l.turns, []) AS turns FROM c
  LEFT JOIN (SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY part, pos) AS turns FROM r GROUP BY conv_id) l USING (conv_id)),
m AS (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS depth FROM s),
p AS (
  SELECT conv_id, depth, depth = len(turns) AS last, CASE WHEN depth > 0 THEN length(turns[depth].text) ELSE 0 END AS chars,
    sha256(to_json(turns[1:depth])::VARCHAR) AS node, CASE WHEN depth > 0 THEN sha256(to_json(turns[1:depth - 1])::VARCHAR) END AS parent
  FROM m),
n AS (
  SELECT node, min(parent) AS parent, min(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(chars) AS own,
    sha256(coalesce(string_agg(CASE WHEN last THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends_sha256
  FROM p GROUP BY node),
k AS (SELECT parent AS node, count(*) AS n_children FROM n WHERE parent IS NOT NULL GROUP BY parent),
w AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM n LEFT JOIN k USING (node)),
u AS (
  SELECT p.node, sum(CASE WHEN w.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(w.own) AS saved
  FROM w JOIN p ON p.conv_id = w.conv_id AND p.depth <= w.depth GROUP BY p.node)
SELECT w.conv_id, w.depth::BIGINT AS depth, a.conv_id AS parent_conv_id, w.n_convs::BIGINT AS n_convs, w.n_children::BIGINT AS n_children,
  u.n_leaves::BIGINT AS n_leaves, u.saved::BIGINT AS saved_tokens, w.ends_sha256
FROM w JOIN u USING (node) LEFT JOIN n a ON a.node = w.parent"""
