"""Approximate nearest neighbours by inner product: hierarchical k-means tree, best bin first.

One more coordinate makes all vectors equally long, so that the largest inner product is the smallest distance. The tree is
fitted on a bounded sample; every vector is filed under its leaf. A query walks the tree with a priority queue, always
opening the bin whose centre is nearest, and visits leaves in that order. The number of leaves
visited is widened until a sample of queries finds the wanted share of its true neighbours, which are computed against all rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanquarry.llm.tables import batch_of, stored

#: Vectors the tree is fitted on at most.
MOST_SAMPLED = 20_000
#: Children of a node, and sampled vectors below which a node is a leaf.
BRANCHES, LEAF = 8, 40
#: Queries by which the number of visits is calibrated, and the share of true neighbours they must find.
CALIBRATION, RECALL = 100, 0.97
#: Rows of neighbouring leaves (a shelf) compared in one group; a larger shelf is dealt into blocks.
BLOCK = 4_096
#: Queries, about, that one group compares with a block.
PORTION = 8_192


class Tree:
    """Centres of a hierarchical k-means tree. Node 0 is the root; ``leaf[node]`` is its leaf number or -1."""

    def __init__(self, sample: np.ndarray, longest: float, seed: int = 7):
        self.longest = longest
        self.children: list[np.ndarray] = [np.zeros(0, np.int64)]
        self.leaf = [-1]
        self.leaves = 0
        centres = [np.zeros(sample.shape[1] + 1)]
        random = np.random.default_rng(seed)
        todo = [(0, self.lifted(sample))]
        while todo:
            node, rows = todo.pop()
            parts = self._split(rows, random) if len(rows) > LEAF else []
            if len(parts) < 2:
                self.leaf[node] = self.leaves
                self.leaves += 1
                continue
            self.children[node] = np.arange(len(centres), len(centres) + len(parts))
            for part in parts:
                centres.append(part.mean(axis=0))
                self.children.append(np.zeros(0, np.int64))
                self.leaf.append(-1)
                todo.append((len(centres) - 1, part))
        self.centres = np.array(centres)
        self.kids = [c.tolist() for c in self.children]

    @staticmethod
    def _split(rows: np.ndarray, random) -> list[np.ndarray]:
        """Lloyd's algorithm from random distinct rows; equal rows cannot be split."""
        different = np.unique(rows, axis=0)
        centres = different[random.permutation(len(different))[:BRANCHES]]
        for _ in range(8):
            near = (np.square(centres).sum(axis=1) - 2 * rows @ centres.T).argmin(axis=1)
            used = np.unique(near)
            centres = np.array([rows[near == k].mean(axis=0) for k in used])
        near = (np.square(centres).sum(axis=1) - 2 * rows @ centres.T).argmin(axis=1)
        return [rows[near == k] for k in np.unique(near)]

    def lifted(self, rows: np.ndarray) -> np.ndarray:
        rows = rows.astype(np.float64) / self.longest
        return np.column_stack([rows, np.sqrt(np.maximum(0, 1 - np.square(rows).sum(axis=1)))])

    def file(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of each vector: the nearest child at every node."""
        rows, node = self.lifted(rows), np.zeros(len(rows), np.int64)
        while True:
            open_ = [n for n in np.unique(node).tolist() if len(self.children[n])]
            if not open_:
                return np.array(self.leaf)[node]
            for n in open_:
                at = np.flatnonzero(node == n)
                c = self.centres[self.children[n]]
                node[at] = self.children[n][(np.square(c).sum(axis=1) - 2 * rows[at] @ c.T).argmin(axis=1)]

    @classmethod
    def of(cls, state: dict) -> Tree:
        """The tree of a broadcast state, which holds arrays and lists only, as executors may not be able to import this class."""
        tree = cls.__new__(cls)
        tree.__dict__.update(state)
        return tree

    def far(self, queries: np.ndarray) -> np.ndarray:
        """Squared distance of each query, scaled to the sphere, from every centre, but for a constant of the query."""
        q = queries.astype(np.float64)
        q = q / np.maximum(np.linalg.norm(q, axis=1), 1e-300)[:, None]
        return np.square(self.centres).sum(axis=1) - 2 * q @ self.centres[:, :-1].T

    def walk(self, far: np.ndarray, most: int) -> list[int]:
        """Leaves in the order best bin first, of one query's distances."""
        far, kids, leaf = far.tolist(), self.kids, self.leaf
        queue, out = [(0.0, 0)], []
        while queue and len(out) < most:
            _, node = heapq.heappop(queue)
            if not kids[node]:
                out.append(leaf[node])
            for kid in kids[node]:
                heapq.heappush(queue, (far[kid], kid))
        return out

    def visits(self, queries: np.ndarray, most: int) -> Iterator[list[int]]:
        """The walk of each query; distances are computed for some hundred queries at a time."""
        for at in range(0, len(queries), 256):
            for far in self.far(queries[at : at + 256]):
                yield self.walk(far, most)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def top(ids: np.ndarray, rows: np.ndarray, query: np.ndarray, own: int, k: int, rough: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The k rows of largest inner product in double precision, ties to the smaller id, without the query's own id.

    ``rough`` are the products as a matrix product gave them; rows at -inf are left out.
    """
    keep = np.flatnonzero((ids != own) & (rough > -np.inf))
    ids, rows, rough = ids[keep], rows[keep], rough[keep]
    if not len(ids):
        return ids, np.zeros(0)
    if len(ids) > k:
        # the matrix product may round equal rows differently, so what is close to the k-th is computed again
        edge = np.partition(rough, -k)[-k]
        near = np.flatnonzero(rough >= edge - 1e-9 * max(1.0, abs(edge)))
        ids, rows = ids[near], rows[near]
    score = (rows * query).sum(axis=1)
    best = np.lexsort((ids, -score))[:k]
    return ids[best], score[best]


def usable(vectors: DataFrame, key: str, column: str) -> DataFrame:
    """Rows with an id whose vector is not null, not all zero and holds only finite numbers."""
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.select(F.col(key).alias("vec_id"), F.col(column).alias("vector")).where(
        F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists("vector", lambda x: x != 0)
    )


RESULT = "query_id bigint, ids array<bigint>, scores array<double>"
_RESULT = pa.schema([("query_id", pa.int64()), ("ids", pa.list_(pa.int64())), ("scores", pa.list_(pa.float64()))])


def _exact(queries: dict[int, np.ndarray], k: int):
    """The nearest rows of each batch for a bounded set of queries."""

    def search(batches):
        for batch in batches:
            ids, rows = batch.column("vec_id").to_numpy(), _matrix(batch.column("vector")).astype(np.float64)
            found = [(key, *top(ids, rows, q, key, k, rows @ q)) for key, q in queries.items()]
            yield batch_of(_RESULT, *(zip(*[(a, b.tolist(), c.tolist()) for a, b, c in found]) if found else [[]] * 3))

    return search


def _merged(parts: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score from lists of candidates."""
    pairs = F.transform(F.arrays_zip("scores", "ids"), lambda x: F.struct((-x["scores"]).alias("low"), x["ids"].alias("vec_id")))
    best = parts.select("query_id", pairs.alias("found")).groupBy("query_id").agg(F.slice(F.array_sort(F.flatten(F.collect_list("found"))), 1, k).alias("found"))
    return best.select("query_id", F.posexplode("found").alias("at", "x")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), "x.vec_id", (-F.col("x.low")).alias("score")
    )


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 20, recall: float = RECALL, key: str = "vec_id", column: str = "embedding"
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` rows found of largest inner product for every query.

    ``queries`` has the columns of ``vectors``. Rows without an id and null, zero and non-finite vectors take no part; a query never
    finds rows of its own id; ties go to the smaller id; equal ids are expected not to occur; a table without usable
    vectors gives no rows. Vectors must be of one length.
    """
    spark = vectors.sparkSession
    rows, asked = usable(vectors, key, column), usable(queries, key, column)
    size = rows.agg(F.count("*").alias("n"), F.max(F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))).alias("longest")).first()
    if not size["n"]:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    mixed = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30))
    share = min(1.0, 1.2 * MOST_SAMPLED / size["n"])
    sample = rows.where(mixed < int(share * (1 << 30))).select("vector").limit(MOST_SAMPLED).toArrow().column("vector").combine_chunks()
    tree = Tree(_matrix(sample), size["longest"])
    held = spark.sparkContext.broadcast(vars(tree))

    def file(batches):
        for batch in batches:
            if batch.num_rows:
                leaf = Tree.of(held.value).file(_matrix(batch.column("vector"))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(leaf), batch.column("vector")], names=["vec_id", "leaf", "vector"])

    kind = rows.schema["vector"].dataType.simpleString()
    filed = stored(rows.mapInArrow(file, f"vec_id bigint, leaf int, vector {kind}"), "filed")

    # the calibration queries, their true neighbours and the leaves these lie in
    some = asked.orderBy(F.xxhash64("vec_id"), "vec_id").limit(CALIBRATION).toArrow()
    points = _matrix(some.column("vector").combine_chunks()).astype(np.float64) if some.num_rows else []
    lookup = dict(zip(some.column("vec_id").to_pylist(), points))
    true = _merged(rows.mapInArrow(_exact(lookup, k), RESULT), k)
    homes = true.join(filed.select("vec_id", "leaf"), "vec_id").select("query_id", "leaf").toArrow()
    places = []
    orders = {q: {leaf: n for n, leaf in enumerate(order)} for q, order in zip(lookup, tree.visits(np.array(list(lookup.values())), tree.leaves))}
    for q, leaf in zip(homes.column("query_id").to_pylist(), homes.column("leaf").to_pylist()):
        places.append(orders[q][leaf])
    visits = int(np.sort(places)[int(np.ceil(recall * len(places))) - 1]) + 1 if places else 1

    # neighbouring leaves share a group, so a query gives one list per shelf it enters, not one per leaf
    leaves = max(1, tree.leaves * BLOCK // (2 * size["n"]))
    shelf = F.floor(F.col("leaf") / leaves).cast("int").alias("shelf")
    blocks = filed.groupBy(shelf).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    members = filed.withColumn("shelf", shelf).join(blocks, "shelf")
    members = members.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int")).select("shelf", "block", "leaf", "vec_id", "vector")

    names = ["shelf", "query_id", "query", "wanted"]

    def walk(batches):
        """One row for each shelf that a query enters, with the leaves it wants there."""
        for part in (batch.slice(at, 256) for batch in batches for at in range(0, batch.num_rows, 256)):
            shelves, asker, wanted = [], [], []
            for n, order in enumerate(Tree.of(held.value).visits(_matrix(part.column("vector")), visits)):
                order = np.sort(np.array(order, np.int32))
                entered, begin = np.unique(order // leaves, return_index=True)
                shelves.append(entered)
                asker.append(np.full(len(entered), n))
                wanted.extend(np.split(order, begin[1:]))
            one = part.take(pa.array(np.concatenate(asker)))
            shelf = pa.array(np.concatenate(shelves).astype(np.int32))
            yield pa.RecordBatch.from_arrays([shelf, one.column("vec_id"), one.column("vector"), pa.array(wanted, pa.list_(pa.int32()))], names=names)

    walks = asked.mapInArrow(walk, f"shelf int, query_id bigint, query {kind}, wanted array<int>")
    walks = walks.join(blocks, "shelf").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))

    def search(shelved: pa.Table, queries: pa.Table) -> pa.Table:
        if not shelved.num_rows or not queries.num_rows:
            return _RESULT.empty_table()
        ids, base = shelved.column("vec_id").to_numpy(), _matrix(shelved.column("vector").combine_chunks()).astype(np.float64)
        # leaves of the shelf by number; rows of the others are at -inf
        own, of_leaf = np.unique(shelved.column("leaf").to_numpy(), return_inverse=True)
        out = []
        for part in queries.to_batches(max_chunksize=256):
            keys, points = part.column("query_id").to_pylist(), _matrix(part.column("query")).astype(np.float64)
            wanted = part.column("wanted")
            asker = np.repeat(np.arange(len(keys)), pc.list_value_length(wanted).to_numpy(zero_copy_only=False))
            leaf = wanted.flatten().to_numpy(zero_copy_only=False)
            at = np.minimum(np.searchsorted(own, leaf), len(own) - 1)
            enters = np.zeros((len(keys), len(own)), bool)
            enters[asker[own[at] == leaf], at[own[at] == leaf]] = True
            rough = np.where(enters[:, of_leaf], points @ base.T, -np.inf)
            found = [(q, *(x.tolist() for x in top(ids, base, p, q, k, r))) for q, p, r in zip(keys, points, rough)]
            out.append(batch_of(_RESULT, *zip(*found)))
        return pa.Table.from_batches(out)

    # a shelf may be entered by every query, so the queries are dealt into portions and each meets the shelf's rows on its own
    portions = -(-asked.count() // PORTION)
    members = members.withColumn("portion", F.explode(F.sequence(F.lit(0), F.lit(max(portions, 1) - 1))))
    walks = walks.withColumn("portion", F.pmod(F.xxhash64("query_id"), F.lit(max(portions, 1))).cast("int"))
    walks = walks.select("shelf", "block", "portion", "query_id", "query", "wanted")
    keys = ["shelf", "block", "portion"]
    parts = members.groupBy(*keys).cogroup(walks.toDF(*walks.columns).groupBy(*keys))
    return _merged(parts.applyInArrow(search, RESULT), k)
