"""Connected components of a link table by contraction, in Spark alone."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from terrace.workspace import materialise

#: Links that one task reduces to a forest: 16 MB.
BLOCK = 1_000_000


def _forest(parts):
    """Every node of one block of links with the smallest id it reaches there."""
    ends = [(p.column(0).to_numpy(), p.column(1).to_numpy()) for p in parts]
    a, b = (np.concatenate([*(e[k] for e in ends), np.zeros(0, "i8")]) for k in (0, 1))
    nodes, place = np.unique(np.r_[a, b], return_inverse=True)
    a, b = place[:len(a)], place[len(a):]
    parent = np.arange(len(nodes))
    while True:
        low = np.minimum(parent[a], parent[b])
        before = parent.copy()
        np.minimum.at(parent, parent[a], low)
        np.minimum.at(parent, parent[b], low)
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up
        if (parent == before).all():
            break
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[parent])], names=["a", "b"])


def components(links, a="a", b="b"):
    """``node, component`` of every id in the links; a component is named by its smallest id.

    Blocks of ``BLOCK`` links at most are reduced to forests first, each in a task of its own; where
    there is one block, that is the result. Otherwise rounds follow: each gives every node the
    neighbour (or itself) whose hashed id is smallest and contracts the links by that choice.
    Hashing keeps long chains from moving by one node a round, so the number of rounds grows with
    the logarithm of the nodes. Every round is a written table.
    """
    edges = materialise(links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
                        .where("a IS NOT NULL AND b IS NOT NULL"), "links")
    blocks = -(-edges.count() // BLOCK) or 1
    edges = (edges.coalesce(1) if blocks == 1 else edges.repartition(blocks)).mapInArrow(_forest, "a long, b long")
    edges = materialise(edges, "forests")
    if blocks == 1:
        return edges.toDF("node", "component")
    nodes = materialise(edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
                        .select("node", F.col("node").alias("root")), "roots")
    while True:
        edges = edges.where("a <> b")
        if edges.isEmpty():
            break
        both = edges.union(edges.select("b", "a"))
        best = F.min(F.struct(F.xxhash64("b").alias("h"), F.col("b").alias("to")))
        choice = both.groupBy("a").agg(best.alias("best")).select(
            F.col("a").alias("root"), F.when(F.col("best.h") < F.xxhash64("a"), F.col("best.to")).otherwise(F.col("a")).alias("to"))
        choice = materialise(choice, "choices")
        edges = materialise(edges.join(choice.toDF("a", "x"), "a").join(choice.toDF("b", "y"), "b")
                            .where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
                            .distinct(), "links")
        nodes = materialise(nodes.join(choice, "root", "left").select("node", F.coalesce("to", "root").alias("root")), "roots")
    smallest = materialise(nodes.groupBy("root").agg(F.min("node").alias("component")), "components")
    return nodes.join(smallest, "root").select("node", "component")
