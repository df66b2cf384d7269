"""Approximate nearest neighbours by a forest of random-projection trees.

Every node of a tree splits by the difference of two points that are drawn far apart from its sample,
at the median of their projections. The trees are fitted on at most ``SAMPLE`` distinct vectors, those
with the smallest hash, until a node holds at most ``LEAF`` of them. Every vector of the table is then
dealt to its leaf of each tree. A query goes down all trees at once: one priority queue holds the
branches not taken, by the smallest distance to a splitting plane on the way to them, until the
leaves found hold ``SEARCH`` points of the sample, counting each tree, or ``SHARE`` times the sample if that
is more: vectors without structure in many dimensions need so much for a recall of 0.9. In each leaf all its
vectors are compared with the queries that came there, in double precision, and only the nearest of
each query leave the task.

A leaf of a large table is cut into blocks by a hash of the vector, and a question goes to all blocks of its
leaf, so that what stands in one task does not grow with the table.

Equal vectors are indexed once with as many of their smallest ids as a query can use, which loses
nothing: no query returns more of them. So a hot vector does not make a hot leaf.

Cases: null, zero and non-finite vectors, those of another length than the most frequent one and
rows without an id take no part; equal rows count once; of rows that share an id but not the vector
each counts. Ties go to the smaller id. With fewer candidates than asked for, all found are returned.
Extra columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import written

TREES = 12
LEAF = 128
SAMPLE = 20_000
SEARCH = 4_000
SHARE = 1.0
NEAREST = 10
#: Vectors of a leaf that are compared in one task, about.
GROUP = 2_000
SEED = 5


class Tree:
    """Planes and children of one tree; leaves are numbered from 0, and children below 0 are leaves."""

    def __init__(self, points: np.ndarray, leaf: int, rng: np.random.Generator):
        self.normals: list[np.ndarray] = []
        self.offsets: list[float] = []
        self.children: list[list[int]] = []
        self.sizes: list[int] = []
        self.root = self.grow(points, np.arange(len(points)), leaf, rng)
        self.planes = np.array(self.normals).reshape(len(self.normals), points.shape[1])

    def grow(self, points: np.ndarray, own: np.ndarray, leaf: int, rng: np.random.Generator) -> int:
        if len(own) <= leaf:
            self.sizes.append(len(own))
            return -len(self.sizes)
        first = points[own[rng.integers(len(own))]]
        others = points[own[rng.integers(len(own), size=8)]]
        normal = others[np.argmax(((others - first) ** 2).sum(axis=1))] - first
        length = np.linalg.norm(normal)
        normal = normal / length if length else rng.normal(size=points.shape[1])
        along = points[own] @ normal
        cut = float(np.median(along))
        right = along > cut
        if not right.any() or right.all():
            right = np.arange(len(own)) % 2 == 1  # all on one plane: any halves will do
        node = len(self.normals)
        self.normals.append(normal)
        self.offsets.append(cut)
        self.children.append([0, 0])
        self.children[node] = [self.grow(points, own[~right], leaf, rng), self.grow(points, own[right], leaf, rng)]
        return node

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector."""
        out = np.empty(len(vectors), dtype=np.int32)
        stack = [(self.root, np.arange(len(vectors)))]
        while stack:
            node, own = stack.pop()
            if node < 0:
                out[own] = -node - 1
            elif len(own):
                right = vectors[own] @ self.planes[node] > self.offsets[node]
                stack += [(self.children[node][0], own[~right]), (self.children[node][1], own[right])]
        return out


class Forest:
    def __init__(self, sample: np.ndarray, trees: int = TREES, leaf: int = LEAF, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.size, self.width = sample.shape
        self.trees = [Tree(sample, leaf, rng) for _ in range(trees)] if len(sample) else []

    def search(self, query: np.ndarray, enough: int) -> list[tuple[int, int]]:
        """(tree, leaf) in the order of one queue over all trees, until they hold ``enough`` points."""
        sides = [(tree.planes @ query - np.array(tree.offsets)).tolist() for tree in self.trees]
        queue = [(-np.inf, k, tree.root) for k, tree in enumerate(self.trees)]
        heapq.heapify(queue)
        found, held = [], 0
        while queue and held < enough:
            margin, k, node = heapq.heappop(queue)
            tree = self.trees[k]
            while node >= 0:
                side = sides[k][node]
                near, far = (1, 0) if side > 0 else (0, 1)
                heapq.heappush(queue, (max(margin, abs(side)), k, tree.children[node][far]))
                node = tree.children[node][near]
            found.append((k, -node - 1))
            held += tree.sizes[-node - 1]
        return found


def usable(vector: Column) -> Column:
    """Neither null nor zero, and of finite components."""
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return vector.isNotNull() & F.coalesce(~bad, F.lit(False)) & F.exists(vector, lambda v: v != 0)


def matrix(column: pa.Array, size: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, size)


def components(frame: DataFrame, vector: str) -> str:
    return "array<float>" if frame.schema[vector].dataType.simpleString() == "array<float>" else "array<double>"


def distinct(frame: DataFrame, key: str, vector: str, most: int) -> DataFrame:
    """(vec, ids): each distinct vector with at most ``most`` of its ids, the smallest."""
    rows = frame.select(F.col(f"`{key}`").cast("bigint").alias("id"), F.col(f"`{vector}`").alias("vec"))
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("vec")))
    positive = F.transform("vec", lambda v: v + F.lit(0.0))  # no negative zeros
    rows = rows.withColumn("vec", positive.cast(components(frame, vector)))
    sizes = rows.groupBy(F.size("vec").alias("n")).agg(F.count(F.lit(1)).alias("times")).orderBy(F.desc("times"), "n").limit(1)
    length = sizes.collect()
    rows = rows.where(F.size("vec") == (length[0]["n"] if length else 0))
    rows = rows.withColumn("h", F.xxhash64("vec"))
    order = Window.partitionBy("h", "vec").orderBy("id")
    first = rows.withColumn("place", F.dense_rank().over(order)).where(F.col("place") <= most)
    return first.groupBy("h", "vec").agg(F.sort_array(F.collect_set("id")).alias("ids")).drop("h")


def fit(vectors: DataFrame, trees: int = TREES, leaf: int = LEAF, sample: int = SAMPLE) -> Forest:
    """A forest fitted on at most ``sample`` of the distinct vectors."""
    rows = vectors.select("vec", F.xxhash64(F.lit(SEED), "vec").alias("h")).orderBy("h", "vec").limit(sample)
    points = rows.select("vec").toArrow().column(0).combine_chunks()
    return Forest(matrix(points, len(points[0]) if len(points) else 1), trees, leaf)


def nearest(
    frame: DataFrame, queries: Column, key: str = "vec_id", vector: str = "embedding", k: int = NEAREST, search: int = SEARCH, share: float = SHARE
) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest found of each row for which ``queries`` holds."""
    vectors = written(distinct(frame, key, vector, k + 1), "forest-vectors")
    forest = fit(vectors)
    if not forest.size:
        return frame.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    kind = components(frame, vector)
    shared = frame.sparkSession.sparkContext.broadcast(forest)
    enough = max(search, int(share * forest.size * len(forest.trees) / TREES))
    asked = frame.where(queries).select(F.col(f"`{key}`").cast("bigint").alias("id"), F.col(f"`{vector}`").cast(kind).alias("vec"))
    asked = asked.where(F.col("id").isNotNull() & usable(F.col("vec"))).distinct()
    asked = asked.where(F.size("vec") == forest.width)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value.trees
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                part = batch.slice(start, 2000)
                points = matrix(part.column(0), len(part.column(0)[0]))
                for number, tree in enumerate(trees):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(points), number, np.int32)), pa.array(tree.leaves(points)), part.column(0), part.column(1)],
                        names=["tree", "leaf", "vec", "ids"],
                    )

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                query = np.array(batch.column(1)[i].as_py())
                found = shared.value.search(query, enough)
                row = batch.slice(i, 1)
                again = pa.array(np.zeros(len(found), np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([t for t, _ in found], pa.int32()), pa.array([f for _, f in found], pa.int32()), row.column(0).take(again), row.column(1).take(again)],
                    names=["tree", "leaf", "query_id", "query"],
                )

    def rank(points: pa.Table, asking: pa.Table) -> pa.Table:
        query_ids, vec_ids, scores = [], [], []
        if points.num_rows and asking.num_rows:
            column = points.column("vec").combine_chunks()
            own = matrix(column, len(column[0]))
            ids = points.column("ids").combine_chunks()
            sizes = np.diff(np.asarray(ids.offsets))
            flat, owner = np.asarray(ids.flatten()), np.repeat(np.arange(len(own)), sizes)
            for query_id, query in zip(asking.column("query_id").to_pylist(), asking.column("query"), strict=True):
                far = np.sqrt(((own - np.array(query.as_py())) ** 2).sum(axis=1))[owner]
                best = np.lexsort((flat, far))[: k + 1]
                best = best[flat[best] != query_id][:k]
                query_ids.append(np.full(len(best), query_id))
                vec_ids.append(flat[best])
                scores.append(far[best])
        joined = [np.concatenate(c) if c else np.zeros(0) for c in (query_ids, vec_ids, scores)]
        return pa.table({"query_id": pa.array(joined[0].astype(np.int64)), "vec_id": pa.array(joined[1].astype(np.int64)), "score": pa.array(joined[2].astype(float))})

    dealt = vectors.select("vec", "ids").mapInArrow(deal, f"tree int, leaf int, vec {kind}, ids array<bigint>")
    asking = asked.mapInArrow(ask, f"tree int, leaf int, query_id bigint, query {kind}")
    # The trees have a fixed number of leaves, so what lies in one grows with the table and is cut into blocks.
    blocks = max(1, -(-vectors.count() // (GROUP * min(len(t.sizes) for t in forest.trees))))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("vec"), F.lit(blocks)))
    asking = asking.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))))
    group = ("tree", "leaf", "block")
    found = dealt.groupBy(*group).cogroup(asking.groupBy(*group)).applyInArrow(rank, "query_id bigint, vec_id bigint, score double")
    single = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = single.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
