"""Op 2: nearest neighbours by inner product through a hierarchical k-means tree.

The largest inner product becomes the smallest distance by one more dimension,
sqrt(M^2 - |x|^2) for vectors and 0 for queries. A tree of k-means splits is
fitted on at most ``SAMPLE`` vectors (first by hash of vec_id); every vector is then
taken down to one leaf and stored with it. A query walks the tree best bin first:
a priority queue holds open nodes by distance to their centre, each step opens
the nearest, and leaves are visited in that order. The number of leaves to visit
is widened until queries of the sample, compared with brute force over the
sample, reach ``RECALL``; a query goes on while its leaves hold fewer vectors than
asked for. Queries and leaf rows meet in one shuffle by leaf, leaves being cut at
``LEAF_ROWS``; each task keeps the best of a leaf part, and the best of all parts
remain. Scores are computed on the original vectors in double precision.

A vector takes no part if it is null, empty, zero, or holds a null or non-finite
component, or if its length isn't the commonest (ties: the shorter). Repeated
vec_ids are candidates row by row and a query once per row; a null vec_id is no
query and comes last among ties. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assetweave.llm.tasks import Batches, map_batches
from assetweave.session import stored

K = 20
EVERY = 20
#: vectors that the tree and the number of visits are fitted on; queries among them
SAMPLE, SAMPLE_QUERIES = 20_000, 200
RECALL = 0.97
BRANCHES, ROUNDS = 8, 12
#: vectors of the sample in a leaf of the tree; vectors of a leaf part
LEAF_SAMPLE, LEAF_ROWS = 60, 20_000


@dataclass
class Node:
    centre: np.ndarray
    leaf: int = -1
    children: list[int] = field(default_factory=list)


def kmeans(x: np.ndarray, k: int, rounds: int, random: np.random.Generator) -> np.ndarray:
    """Number of the nearest of up to ``k`` centres for every row."""
    centres = x[random.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = (((centres**2).sum(1) - 2 * x @ centres.T)).argmin(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        count = np.bincount(near, minlength=k)
        centres = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centres)
    return near


class Tree:
    """k-means tree over vectors that carry the extra dimension."""

    def __init__(self, x: np.ndarray, leaf: int = LEAF_SAMPLE, branches: int = BRANCHES, seed: int = 7):
        self.random, self.leaf_size, self.branches = np.random.default_rng(seed), leaf, branches
        self.nodes: list[Node] = []
        self.leaves = 0
        self._grow(x)

    def _grow(self, x: np.ndarray) -> int:
        at = len(self.nodes)
        self.nodes.append(Node(x.mean(axis=0)))
        near = kmeans(x, min(self.branches, len(x)), ROUNDS, self.random) if len(x) > self.leaf_size else np.zeros(len(x), int)
        if len(x) <= self.leaf_size or (near == near[0]).all():  # small, or all vectors alike
            self.nodes[at].leaf = self.leaves
            self.leaves += 1
            return at
        self.nodes[at].children = [self._grow(x[near == i]) for i in np.unique(near)]
        return at

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf of every vector, going down to the nearest child."""
        out = np.zeros(len(x), np.int32)

        def down(at: int, rows: np.ndarray) -> None:
            node = self.nodes[at]
            if node.leaf >= 0:
                out[rows] = node.leaf
                return
            centres = np.stack([self.nodes[c].centre for c in node.children])
            near = ((centres**2).sum(1) - 2 * x[rows] @ centres.T).argmin(1)
            for i, child in enumerate(node.children):
                if len(some := rows[near == i]):
                    down(child, some)

        down(0, np.arange(len(x)))
        return out

    def leaves_for(self, query: np.ndarray):
        """Leaves, best bin first."""
        queue = [(0.0, 0)]
        while queue:
            _, at = heapq.heappop(queue)
            node = self.nodes[at]
            if node.leaf >= 0:
                yield node.leaf
            for child in node.children:
                gap = self.nodes[child].centre - query
                heapq.heappush(queue, (float(gap @ gap), child))

    def visit(self, query: np.ndarray, visits: int, sizes: np.ndarray, least: int) -> list[int]:
        out, held = [], 0
        for leaf in self.leaves_for(query):
            if len(out) >= visits and held >= least:
                break
            if sizes[leaf]:
                out.append(leaf)
                held += int(sizes[leaf])
        return out


def lifted(x: np.ndarray, longest: float) -> np.ndarray:
    """Vectors with the dimension that makes all equally long."""
    return np.hstack([x, np.sqrt(np.maximum(longest**2 - (x**2).sum(1), 0))[:, None]])


def _query(x: np.ndarray) -> np.ndarray:
    """Queries with 0 there, scaled to unit length, which changes no order."""
    return np.hstack([x / np.linalg.norm(x, axis=1, keepdims=True), np.zeros((len(x), 1))])


def calibrated(tree: Tree, x: np.ndarray, leaf: np.ndarray, longest: float, k: int, recall: float, queries: int) -> int:
    """The smallest number of visits, doubling then halving the step, with that recall on the sample."""
    some = np.linspace(0, len(x) - 1, min(queries, len(x))).astype(int)
    asked = _query(x[some]) * longest
    products = x[some] @ x.T
    products[np.arange(len(some)), some] = -np.inf
    k = min(k, len(x) - 1)
    if k < 1:
        return 1
    best = np.argpartition(-products, k - 1, axis=1)[:, :k]
    order = []
    for q in asked:
        rank = np.empty(tree.leaves, np.int64)
        rank[list(tree.leaves_for(q))] = np.arange(tree.leaves)
        order.append(rank)
    # a neighbour is found by as many visits as its leaf's turn
    turn = np.sort(np.concatenate([rank[leaf[b]] for rank, b in zip(order, best)]))
    return int(turn[min(len(turn) - 1, int(np.ceil(recall * len(turn))) - 1)]) + 1


def _valid(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) with v as finite, non-zero doubles of the commonest length."""
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    rows = rows.where(F.col("v").isNotNull() & finite & F.exists("v", lambda c: c != 0))
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (sizes["n"] if sizes else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


_FOUND = ["query_id", "query_row", "vec_id", "none", "row", "score"]
#: found rows that a task holds before it keeps the best of them
HELD = 200_000


def _best(found: pd.DataFrame, k: int) -> pd.DataFrame:
    """The ``k`` best rows of every query; ties to the smaller vec_id, one without an id last."""
    order = np.lexsort([found[c] * sign for c, sign in (("row", 1), ("vec_id", 1), ("none", 1), ("score", -1), ("query_row", 1))])
    found = found.iloc[order]
    return found[found.groupby("query_row").cumcount().to_numpy() < k]


def _candidates(ids: np.ndarray, x: np.ndarray, asked: np.ndarray, q: np.ndarray, k: int) -> pd.DataFrame:
    """For a block of queries the rows of a leaf part that may be among their ``k`` best."""
    products = q @ x.T
    if len(x) > k + 1:  # the query's own row may be among them
        least = np.partition(products, len(x) - k - 1, axis=1)[:, len(x) - k - 1, None]
        # a margin for the matrix product's rounding, so that ties stay together
        at, place = np.nonzero(products >= least - 1e-9 * (1 + np.abs(least)))
    else:
        at, place = np.divmod(np.arange(products.size), len(x))
    other = ids[place, 1] != asked[at, 1]
    at, place = at[other], place[other]
    score = (q[at] * x[place]).sum(axis=1)
    columns = [asked[at, 0], asked[at, 1], ids[place, 0], ids[place, 2], ids[place, 1], score]
    return _best(pd.DataFrame(dict(zip(_FOUND, columns))), k)


def _search(k: int):
    """The best ``k`` rows for every query, over a task's leaf parts; a part's rows come before its queries."""

    def out(found: pd.DataFrame) -> pa.RecordBatch:
        vec = pa.array(found["vec_id"].to_numpy(), pa.int64(), mask=found["none"].to_numpy() == 1)
        columns = [pa.array(found["query_id"].to_numpy()), pa.array(found["query_row"].to_numpy()), vec]
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array(found["score"].to_numpy())], ["query_id", "query_row", "vec_id", "score"]
        )

    def parts(batches: Batches):
        """(leaf and part, whether queries, ids, vectors), in the order they come."""
        for batch in batches:
            ids = np.stack(
                [
                    batch.column(0).to_numpy(),
                    batch.column(1).to_numpy(),
                    batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64),
                    batch.column(3).fill_null(0).to_numpy(),
                    batch.column(4).to_numpy(),
                    batch.column(3).is_null().to_numpy(zero_copy_only=False).astype(np.int64),
                ],
                1,
            )
            v = _matrix(batch.column(5))
            cuts = np.flatnonzero((np.diff(ids[:, :3], axis=0) != 0).any(axis=1)) + 1
            for i, x in zip(np.split(ids, cuts), np.split(v, cuts)):
                if len(i):
                    yield tuple(i[0, :2].tolist()), bool(i[0, 2]), i[:, 3:], x

    def run(batches: Batches) -> Batches:
        from itertools import groupby

        held: list[pd.DataFrame] = []
        for _, some in groupby(parts(batches), key=lambda p: p[0]):
            members, x = [], []
            for _, query, ids, v in some:
                if not query:
                    members.append(ids)
                    x.append(v)
                    continue
                if len(members) > 1:
                    members, x = [np.concatenate(members)], [np.concatenate(x)]
                # as many queries at a time as make a block of products of a few MB
                step = max(1, 1_000_000 // len(x[0])) if members else 1
                for a in range(0, len(ids), step) if members else ():
                    held.append(_candidates(members[0], x[0], ids[a : a + step, :2], v[a : a + step], k))
                if sum(map(len, held)) > HELD:
                    held = [_best(pd.concat(held), k)]
                    if len(held[0]) > HELD // 2:
                        yield out(held.pop())
        if held:
            yield out(_best(pd.concat(held), k))

    return run


def neighbours(vectors: DataFrame, k: int = K, every: int = EVERY, sample: int = SAMPLE, recall: float = RECALL) -> DataFrame:
    """For each row whose vec_id is divisible by ``every`` its ``k`` nearest others found."""
    rows = stored(_valid(vectors).withColumn("row", F.monotonically_increasing_id()), "vectors")
    empty = rows.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score")).limit(0)
    longest = rows.agg(F.max(F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c))).first()[0]
    if longest is None:
        return empty
    longest = float(np.sqrt(longest))
    first = rows.orderBy(F.xxhash64("vec_id", "row"), "row").limit(sample).select("v").toPandas()["v"]
    x = np.stack(first.to_numpy()).astype(np.float64)
    tree = Tree(lifted(x, longest))
    visits = calibrated(tree, x, tree.assign(lifted(x, longest)), longest, k, recall, SAMPLE_QUERIES)
    shared = vectors.sparkSession.sparkContext.broadcast(tree)  # bounded by the sample

    def to_leaf(batches: Batches) -> Batches:
        for batch in batches:
            if batch.num_rows:
                leaf = shared.value.assign(lifted(_matrix(batch.column(2)), longest))
                yield pa.RecordBatch.from_arrays([pa.array(leaf, pa.int32()), *batch.columns], ["leaf", *batch.schema.names])

    indexed = map_batches(rows.select("vec_id", "row", "v"), to_leaf, "leaf int, vec_id long, row long, v array<double>")
    indexed = stored(indexed, "leaves")
    counts = indexed.groupBy("leaf").count().collect()  # one row per leaf
    sizes = np.zeros(tree.leaves, np.int64)
    for row in counts:
        sizes[row["leaf"]] = row["count"]
    parts = -(-sizes // LEAF_ROWS)

    def to_leaves(batches: Batches) -> Batches:
        for batch in batches:
            if not batch.num_rows:
                continue
            v = _matrix(batch.column(2))
            leaves = [shared.value.visit(q, visits, sizes, k + 1) for q in _query(v) * longest]
            place = [(i, leaf, part) for i, some in enumerate(leaves) for leaf in some for part in range(parts[leaf])]
            at = pa.array([p[0] for p in place], pa.int32())
            columns = [pa.array([p[1] for p in place], pa.int32()), pa.array([p[2] for p in place], pa.int32())]
            columns += [pa.array(np.ones(len(place), bool)), *(c.take(at) for c in batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, ["leaf", "part", "query", *batch.schema.names])

    schema = "leaf int, part int, query boolean, vec_id long, row long, v array<double>"
    asked = rows.where(F.col("vec_id") % every == 0).select("vec_id", "row", "v")
    queries = map_batches(asked, to_leaves, schema)
    cut = F.element_at(F.array(*map(F.lit, np.maximum(parts, 1).tolist())), F.col("leaf") + 1)
    members = indexed.select(
        "leaf", F.pmod(F.xxhash64("row"), cut).cast("int").alias("part"), F.lit(False).alias("query"), "vec_id", "row", "v"
    )
    both = members.unionByName(queries).repartition("leaf", "part").sortWithinPartitions("leaf", "part", "query")
    found = map_batches(both, _search(k), "query_id long, query_row long, vec_id long, score double")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")


def op2_kmeans_tree_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
