"""Approximate nearest neighbours (operator 6): a forest of random-projection trees.

Nearness is the largest inner product. For the trees, vectors get one more component,
``sqrt(M^2 - |x|^2)`` with M the largest norm of all rows, which turns it into the smallest angle.
Each node of a tree splits a bounded sample (``SAMPLE`` vectors) by a hyperplane midway between two
of its vectors, at the median; every row is then sent down every tree. A query descends all trees
at once through one priority queue, ordered by the least margin to the planes passed on the wrong
side, until ``visits`` leaves have come up. The leaves' rows are reranked by their exact inner
products in double precision.

How many leaves: ``calibrated`` takes up to ``PROBES`` queries, finds their true neighbours by
brute force over all rows, and reads off how far down the queue the first leaf with each of them
comes; ``visits`` covers ``COVER`` of them. So the recall is measured at every size.

A leaf's rows and its queries are dealt into blocks of bounded size, and a task sees one block of
rows and one of queries, so leaves full of copies (or of a third of all rows) are many small tasks.
Each gives every query of the block its ``k`` best; those are merged by query.

Defined cases: vectors that are NULL, empty, zero or have NULL or non-finite components take no
part, nor do those with a NULL id. Vectors of another length than the first of the sample are compared
with all vectors of their own length. Queries with fewer than ``k`` candidates return all of them. Of repeated rows with one id, one takes part. Ties
go to the smaller id.
"""

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from terrace.llm.registry import query, table
from terrace.workspace import materialise

TREES, SAMPLE, LEAF = 6, 4096, 32
PROBES, COVER = 48, 0.97
ROWS, QUERIES = 2048, 512


def usable(rows, id_column, vector_column):
    """``id, vector`` (doubles) of the rows that take part, one per id."""
    v = F.transform(F.col(vector_column), lambda x: x.cast("double"))
    good = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    return (rows.select(F.col(id_column).cast("long").alias("id"), v.alias("vector")).where(F.col("id").isNotNull() & F.coalesce(good, F.lit(False)))
            .groupBy("id").agg(F.min("vector").alias("vector")))


def matrix(column):
    """A list column of equal lengths as a matrix."""
    flat = column.flatten() if hasattr(column, "flatten") else pa.concat_arrays([c.flatten() for c in column.chunks])
    return flat.to_numpy(zero_copy_only=False).reshape(len(column), -1)


class Tree:
    """Planes of one tree as arrays: children are node numbers, or leaves as ``-1 - leaf``."""

    def __init__(self, points, rng):
        self.normals, self.offsets, self.children = [], [], []
        self.leaves = 0
        self.root = self._grow(points, rng)
        self.normals, self.offsets = np.array(self.normals), np.array(self.offsets)

    def _grow(self, points, rng):
        if len(points) > LEAF:
            for _ in range(3):
                a, b = points[rng.choice(len(points), 2, replace=False)]
                normal = a - b
                length = np.linalg.norm(normal)
                if length > 1e-12:
                    normal = normal / length
                    along = points @ normal
                    offset = np.median(along)
                    right = along > offset
                    if 0 < right.sum() < len(points):
                        node = len(self.normals)
                        self.normals.append(normal)
                        self.offsets.append(offset)
                        self.children.append(None)
                        self.children[node] = self._grow(points[~right], rng), self._grow(points[right], rng)
                        return node
        self.leaves += 1
        return -self.leaves

    def leaf_of(self, points):
        """The leaf of every point."""
        out = np.zeros(len(points), "i4")
        todo = [(self.root, np.arange(len(points)))]
        while todo:
            node, which = todo.pop()
            if node < 0:
                out[which] = -1 - node
            elif len(which):
                right = points[which] @ self.normals[node] > self.offsets[node]
                todo += [(self.children[node][0], which[~right]), (self.children[node][1], which[right])]
        return out


class Forest:
    def __init__(self, sample, largest, seed=6):
        rng = np.random.default_rng(seed)
        self.size, self.largest = sample.shape[1], largest
        points = self.lifted(sample)
        self.trees = [Tree(points, rng) for _ in range(TREES)]

    def lifted(self, vectors):
        extra = np.sqrt(np.maximum(0, self.largest ** 2 - (vectors ** 2).sum(axis=1)))
        return np.c_[vectors, extra] / self.largest

    def leaves_of(self, vectors):
        """Leaves of rows: (rows, trees)."""
        points = self.lifted(vectors)
        return np.stack([t.leaf_of(points) for t in self.trees], 1)

    def queue(self, vector, limit):
        """(tree, leaf) of a query in the order of the shared priority queue."""
        point = np.r_[vector / np.linalg.norm(vector), 0.0]
        margins = [t.normals @ point - t.offsets if len(t.normals) else t.offsets for t in self.trees]
        heap = [(-np.inf, k, t.root) for k, t in enumerate(self.trees)]
        heapq.heapify(heap)
        out = []
        while heap and len(out) < limit:
            worst, k, node = heapq.heappop(heap)
            while node >= 0:
                margin = margins[k][node]
                near, far = self.trees[k].children[node][::-1] if margin > 0 else self.trees[k].children[node]
                heapq.heappush(heap, (max(worst, abs(margin)), k, far))
                node = near
            out.append((k, -1 - node))
        return out


def top(scores, ids, own, k):
    """Places of the ``k`` largest scores per row, ties by id, without the query itself."""
    scores = np.where(ids[None, :] == own[:, None], -np.inf, scores)
    if scores.shape[1] > 4 * k:
        least = -np.partition(-scores, k, axis=1)[:, k]
    else:
        least = np.full(len(scores), -np.inf)
    for row, bound in zip(scores, least, strict=True):
        some = np.flatnonzero((row >= bound) & (row > -np.inf))
        yield some[np.lexsort((ids[some], -row[some]))][:k]


def fit(rows, sample=SAMPLE):
    """A forest from a sample of bounded size (the rows with the smallest hashed ids); None without rows."""
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    stats = rows.agg(F.count("*"), F.max(norm)).first()
    if not stats[0]:
        return None
    share = min(1.0, 1.3 * sample / stats[0])
    chosen = rows.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    found = chosen.orderBy(F.xxhash64("id")).limit(sample).collect()
    if not found:
        found = rows.limit(sample).collect()
    size = len(found[0].vector)
    return Forest(np.array([r.vector for r in found if len(r.vector) == size]), stats[1])


def _own_queries(rows, forest, k, probes):
    """The probes' true neighbours, by brute force over all rows: {id: (vector, neighbour ids)}."""
    ids = np.array([r.id for r in probes], "i8")
    vectors = np.array([r.vector for r in probes])
    size = forest.size

    def best(parts):
        for part in parts:
            names, found = part.column(0).to_numpy(), matrix(part.column(1))
            scores = vectors @ found.T
            out = [(int(ids[q]), int(names[i]), float(scores[q, i]), found[i].tolist())
                   for q, places in enumerate(top(scores, names, ids, k)) for i in places]
            columns = list(zip(*out, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.float64())), strict=True)],
                names=["query", "id", "score", "vector"])

    found = rows.where(F.size("vector") == size).mapInArrow(best, "query long, id long, score double, vector array<double>")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query", "vector").collect()


def calibrated(forest, rows, queries, k, probes=PROBES, cover=COVER):
    """How many leaves of the queue hold ``cover`` of the true neighbours of some of the queries."""
    chosen = queries.where(F.size("vector") == forest.size).orderBy(F.xxhash64("id")).limit(probes).collect()
    if not chosen:
        return 1
    most = sum(t.leaves for t in forest.trees)
    ranks = []
    order = {r.id: {leaf: i for i, leaf in enumerate(forest.queue(np.array(r.vector), most))} for r in chosen}
    for query, vector in _own_queries(rows, forest, k, chosen):
        leaves = forest.leaves_of(np.array([vector]))[0]
        ranks.append(min(order[query][t, int(leaf)] for t, leaf in enumerate(leaves)))
    return int(np.quantile(ranks, cover, method="higher")) + 1 if ranks else 1


def search(rows, queries, k=20, visits=None):
    """``query_id, rank, vec_id, score``: each query's ``k`` nearest of ``rows`` (both ``id, vector``), itself left out."""
    schema = "query_id long, rank int, vec_id long, score double"
    rows, queries = materialise(rows, "vectors"), materialise(queries, "queries")
    forest = fit(rows)
    if forest is None:
        return rows.sparkSession.createDataFrame([], schema)
    visits = visits or calibrated(forest, rows, queries, k)
    shared = rows.sparkSession.sparkContext.broadcast(forest)

    def index(parts):
        for part in parts:
            leaves = shared.value.leaves_of(matrix(part.column(1)))
            n, trees = leaves.shape
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.tile(np.arange(trees, dtype="i4"), n)), pa.array(leaves.ravel()), pa.array(np.repeat(part.column(0).to_numpy(), trees))],
                names=["tree", "leaf", "id"])

    def descend(parts):
        for part in parts:
            found = [(tree, leaf, name) for name, v in zip(part.column(0).to_pylist(), matrix(part.column(1)), strict=True)
                     for tree, leaf in shared.value.queue(v, visits)]
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], t) for i, t in ((0, pa.int32()), (1, pa.int32()), (2, pa.int64()))],
                                             names=["tree", "leaf", "id"])

    fitting = F.size("vector") == forest.size
    spread = "tree int, leaf int, id long"
    # The few vectors of another length than the trees' are one leaf for each length: all of them meet, in blocks.
    apart = [F.lit(-1).alias("tree"), F.size("vector").alias("leaf"), "id"]
    placed = rows.where(fitting).mapInArrow(index, spread).union(rows.where(~fitting).select(*apart))
    asked = queries.where(fitting).mapInArrow(descend, spread).union(queries.where(~fitting).select(*apart))
    sizes = materialise(placed.groupBy("tree", "leaf").agg(F.ceil(F.count("*") / ROWS).cast("int").alias("row_blocks"))
                        .join(asked.groupBy("tree", "leaf").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("query_blocks")), ["tree", "leaf"]), "leaves")
    block = lambda of: F.pmod(F.xxhash64("id"), F.col(of)).cast("int")
    every = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
    key = ["tree", "leaf", "i", "j"]
    here = placed.join(sizes, ["tree", "leaf"]).withColumn("i", block("row_blocks")).withColumn("j", every("query_blocks")).select(*key, "id").join(rows, "id")
    there = asked.join(sizes, ["tree", "leaf"]).withColumn("j", block("query_blocks")).withColumn("i", every("row_blocks")).select(*key, "id").join(queries, "id")

    def rerank(left, right):
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(left) and len(right):
            ids, own = left.id.to_numpy(), right.id.to_numpy()
            scores = np.stack(right.vector.to_numpy()) @ np.stack(left.vector.to_numpy()).T
            for q, places in enumerate(top(scores, ids, own, k)):
                out["query_id"].append(np.full(len(places), own[q]))
                out["vec_id"].append(ids[places])
                out["score"].append(scores[q, places])
        return pd.DataFrame({c: np.concatenate([*v, np.zeros(0, "f8" if c == "score" else "i8")]) for c, v in out.items()})

    found = here.groupBy(*key).cogroup(there.groupBy(*key)).applyInPandas(rerank, "query_id long, vec_id long, score double")
    # A candidate met in several trees is one candidate.
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


@query("op6_nearest_neighbours")
def op6_nearest_neighbours(spark, sf):
    rows = usable(table(spark, sf, "embeddings"), "vec_id", "embedding")
    return search(rows, rows.where("id % 20 = 0"))
