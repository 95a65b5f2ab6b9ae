"""Embedding near-dedup (operator 3): a robust-pruned flat graph over overlapping shards.

Vectors are compared only under equal labels. Equal vectors are one node from the start. Cluster
centres are fitted on a bounded sample (``SAMPLE``); every node joins its ``OVERLAP`` nearest
clusters, and a shard is one cluster of one label. Each shard gives its nodes robust-pruned
neighbours (near ones, some at random, and those that chose them); the lists of a node from all its
shards are united. Every node then searches each of its shards in the united graph: greedily from
the medoid with a beam, and from whatever reaches the similarity on to all its neighbours until
nothing new does. Cosines are taken in double precision, so a link that is found is verified.

A cluster of over ``BLOCK`` nodes (near copies of one vector, say) is dealt into blocks by hash and
every pair of blocks is a shard, so no task sees more than ``2 * BLOCK`` nodes and all pairs of the
cluster meet. A pair that meets in several shards is counted in one: the smallest common cluster,
and there the shard of its two blocks. Shards return numbers of links and one link per node to its
group, never the pairs of a group.

The audit compares the links of nodes with brute force over all rows: nodes are taken by hash, alike
from all labels, until ``AUDIT`` of them have links. While those got back less than ``ENOUGH`` of their
links (averaged by node), everything is repeated with one more cluster per node, ``REPEATS`` times.
If that does not help, or ``AUDIT_MOST`` nodes have too few links to tell, an exact pass finds all
pairs: a node meets, in blocks of ``EXACT``, all nodes that can be similar to any in its cluster.
Its work grows with the square of a label's nodes where vectors have no structure.

Defined cases: vectors that are NULL, empty, zero or have NULL or non-finite components link with
nothing, nor do rows with a NULL label or id (a NULL id has a NULL component and is kept). Vectors are
compared with those of their own length; lengths between two powers of two share a run, in which shorter
vectors are filled up with zeros. Repeated rows of one id are one vector, returned as often as
they occur; of several vectors under one id the smallest is compared.
"""

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.components import components
from terrace.llm.forest import matrix
from terrace.llm.registry import query, table
from terrace.workspace import materialise

SIMILARITY = 0.93
SAMPLE, CENTRES, PER_SHARD, BLOCK = 4096, 4096, 1200, 2048
OVERLAP, REPEATS = 3, 3
DEGREE, CANDIDATES, RANDOM, ALPHA, BEAM = 16, 48, 16, 1.2, 24
AUDIT, AUDIT_FIRST, AUDIT_MOST, ENOUGH = 256, 1024, 12_000, 0.995
EXACT = 8192


def _nodes(rows, id_column, vector_column, label_column):
    """``id, node`` of the rows that take part, and ``node, label, vector, copies`` of distinct vectors."""
    vector = F.transform(F.col(vector_column), lambda x: x.cast("double"))
    good = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    found = (rows.select(F.col(id_column).cast("long").alias("id"), F.col(label_column).cast("string").alias("label"), vector.alias("vector"))
             .where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(good, F.lit(False)))
             .groupBy("id").agg(F.min(F.struct("vector", "label")).alias("v")).select("id", "v.label", "v.vector"))
    # Vectors of different lengths are never compared: their length is part of the label from here on.
    found = found.withColumn("label", F.concat_ws("/", F.size("vector"), "label"))
    digest = F.sha2(F.concat_ws(",", "label", F.col("vector").cast("array<string>")), 256)
    found = materialise(found.withColumn("digest", digest), "vectors")
    nodes = materialise(found.groupBy("digest").agg(F.min("id").alias("node"), F.count("*").alias("copies"), F.min("label").alias("label"),
                                                    F.min("vector").alias("vector")), "nodes")
    members = found.select("id", "digest").join(nodes.select("digest", "node", "copies"), "digest").select("id", "node", "copies")
    return materialise(members, "members"), nodes.drop("digest")


def unit(vectors):
    vectors = np.asarray(vectors, "f8")
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # no overflow of squares
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def centres(points, k, rng, rounds=8):
    """Spherical k-means of a sample."""
    found = points[rng.choice(len(points), min(k, len(points)), replace=False)]
    for _ in range(rounds):
        near = (points @ found.T).argmax(axis=1)
        sums = np.zeros_like(found)
        np.add.at(sums, near, points)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        found = np.where(length > 1e-9, sums / np.maximum(length, 1e-9), found)
    return found


def prune(points, own, candidates, similar, degree=DEGREE, alpha=ALPHA):
    """Robust pruning of one node's candidates: nearest first, dropping what a kept one is nearer to by ``alpha``."""
    order = np.argsort(-similar, kind="stable")
    candidates, apart = candidates[order], np.sqrt(np.maximum(0, 2 - 2 * similar[order]))
    between = np.sqrt(np.maximum(0, 2 - 2 * points[candidates] @ points[candidates].T))
    alive, kept = np.ones(len(candidates), bool), []
    while len(kept) < degree:
        left = np.flatnonzero(alive)
        if not len(left):
            break
        k = left[0]
        kept.append(k)
        alive &= alpha * between[k] > apart
        alive[k] = False
    return candidates[kept]


def build(points, rng):
    """Adjacency of a shard: a list of arrays of places."""
    n = len(points)
    if n < 2:
        return [np.zeros(0, "i8")] * n
    near = min(CANDIDATES, n - 1)
    out = [[] for _ in range(n)]
    for a in range(0, n, 512):
        similar = points[a:a + 512] @ points.T
        similar[np.arange(len(similar)), np.arange(a, a + len(similar))] = -2
        best = np.argpartition(-similar, near - 1, axis=1)[:, :near]
        for i, row in enumerate(best):
            far = rng.integers(0, n, RANDOM)
            some = np.unique(np.r_[row, far[far != a + i]])
            for b in prune(points, a + i, some, similar[i, some]):
                out[a + i].append(b)
                out[b].append(a + i)
    return [np.unique(np.array(x, "i8")) for x in out]


def search(points, lists, similarity=SIMILARITY, beam=BEAM):
    """Pairs (query, node) of a shard with at least the similarity, found by all its nodes searching at once."""
    n = len(points)
    width = max([1, *map(len, lists)])
    graph = np.full((n, width), -1, "i8")
    for i, x in enumerate(lists):
        graph[i, :len(x)] = x
    seen, near = np.zeros((n, n), bool), np.zeros((n, n), bool)
    every = np.arange(n)
    medoid = int((points @ points.mean(axis=0)).argmax())
    ids = np.full((n, beam), -1, "i8")
    ids[:, 0] = medoid
    score = np.full((n, beam), -2.0)
    score[:, 0] = points @ points[medoid]
    seen[:, medoid] = True
    near[:, medoid] = score[:, 0] >= similarity
    open_ = ids >= 0
    seen[every, every] = True
    if beam > 1:
        ids[:, 1], score[:, 1], open_[:, 1] = every, 1.0, True
    while open_.any():
        at = np.where(open_, score, -3).argmax(axis=1)
        active = np.flatnonzero(open_.any(axis=1))
        at = at[active]
        nodes = ids[active, at]
        open_[active, at] = False
        step = graph[nodes]
        new = (step >= 0) & ~seen[active[:, None], step]
        rows, columns = np.nonzero(new)
        q, found = active[rows], step[rows, columns]
        seen[q, found] = True
        value = np.einsum("ij,ij->i", points[q], points[found])
        near[q, found] |= value >= similarity
        more_ids = np.full(step.shape, -1, "i8")
        more = np.full(step.shape, -2.0)
        more_ids[rows, columns], more[rows, columns] = found, value
        all_ids, all_score = np.c_[ids[active], more_ids], np.c_[score[active], more]
        all_open = np.c_[open_[active], more_ids >= 0]
        best = np.argpartition(-all_score, beam - 1, axis=1)[:, :beam]
        ids[active], score[active] = np.take_along_axis(all_ids, best, 1), np.take_along_axis(all_score, best, 1)
        open_[active] = np.take_along_axis(all_open, best, 1)
    near[every, every] = False
    todo = np.argwhere(near)
    while len(todo):
        fresh = []
        for a in range(0, len(todo), 50_000):
            q, node = todo[a:a + 50_000].T
            step = graph[node]
            rows, columns = np.nonzero((step >= 0) & ~seen[q[:, None], step])
            pairs = np.unique(q[rows] * np.int64(n) + step[rows, columns])
            q, found = pairs // n, pairs % n
            seen[q, found] = True
            hit = np.einsum("ij,ij->i", points[q], points[found]) >= similarity
            near[q[hit], found[hit]] = True
            fresh.append(np.stack([q[hit], found[hit]], 1))
        todo = np.concatenate(fresh)
    return np.argwhere(near | near.T)


def groups(n, pairs):
    """The smallest place of each place's group."""
    parent = np.arange(n)
    while len(pairs):
        low = np.minimum(parent[pairs[:, 0]], parent[pairs[:, 1]])
        before = parent.copy()
        np.minimum.at(parent, pairs[:, 0], low)
        np.minimum.at(parent, pairs[:, 1], low)
        parent = parent[parent]
        if (parent == before).all():
            break
    return parent


def _shards(nodes, found, overlap):
    """``label, cluster, i, j, node, vector, copies, clusters, mine``: every node in all its shards."""
    shared = nodes.sparkSession.sparkContext.broadcast(found)

    def place(parts):
        for part in parts:
            near = unit(matrix(part.column(2))) @ shared.value.T
            k = min(overlap, near.shape[1])
            best = np.sort(np.argpartition(-near, k - 1, axis=1)[:, :k], axis=1).astype("i4")
            flat = pa.array(best.ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, k, dtype="i4")), flat)
            yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(4)), lists], names=["node", "label", "vector", "copies", "clusters"])

    placed = nodes.where(F.size("vector") == found.shape[1]).select("node", "label", "vector", "copies").mapInArrow(
        place, "node long, label string, vector array<double>, copies long, clusters array<int>")
    placed = materialise(placed.withColumn("cluster", F.explode("clusters")), "placed")
    sizes = materialise(placed.groupBy("label", "cluster").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")), "shards")
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return (placed.join(sizes, ["label", "cluster"]).withColumn("mine", mine).withColumn("other", other)
            .withColumn("i", F.least("mine", "other")).withColumn("j", F.greatest("mine", "other")).drop("other", "blocks"))


KEY = ["label", "cluster", "i", "j"]


def _graph(shards):
    """``node, near``: the united adjacency lists of all shards."""
    def lists(frame):
        frame = frame.sort_values("node")
        names = frame.node.to_numpy()
        rng = np.random.default_rng(int(names[0] % (1 << 31)))
        return pd.DataFrame({"node": names, "near": [names[x] for x in build(unit(np.stack(frame.vector)), rng)]})

    found = shards.groupBy(*KEY).applyInPandas(lists, "node long, near array<long>")
    return materialise(found.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")), "graph")


def _links(shards, graph, similarity):
    """``node, links, root``: links of a node counted in one shard, and one member of its group there."""
    def find(frame):
        frame = frame.sort_values("node")
        names, mine, copies = frame.node.to_numpy(), frame.mine.to_numpy(), frame.copies.to_numpy()
        i, j, cluster = int(frame.i.iloc[0]), int(frame.j.iloc[0]), int(frame.cluster.iloc[0])
        lists = []
        for near in frame.near:
            near = np.asarray(near, "i8")
            at = np.minimum(np.searchsorted(names, near), len(names) - 1)
            lists.append(at[names[at] == near])
        pairs = search(unit(np.stack(frame.vector)), lists, similarity)
        clusters = np.stack(frame.clusters)
        q, node = pairs.T if len(pairs) else (np.zeros(0, "i8"),) * 2
        common = (clusters[q][:, :, None] == clusters[node][:, None, :]).any(axis=2)
        first = np.where(common, clusters[q], np.iinfo("i4").max).min(axis=1) if len(q) else np.zeros(0, "i8")
        counted = (first == cluster) & (np.minimum(mine[q], mine[node]) == i) & (np.maximum(mine[q], mine[node]) == j)
        pairs = pairs[counted]  # numbers of links and groups come from the same pairs
        links = np.bincount(q[counted], weights=copies[node[counted]], minlength=len(names)).astype("i8")
        root = names[groups(len(names), pairs)]
        some = (links > 0) | (root != names)
        return pd.DataFrame({"node": names[some], "links": links[some], "root": root[some]})

    rows = shards.join(graph, "node")
    return materialise(rows.groupBy(*KEY).applyInPandas(find, "node long, links long, root long"), "links")


def _truth(nodes, size, similarity):
    """``{node: (label, links)}`` of nodes that have links, by brute force over all rows, and whether they are enough.

    Nodes are taken by hash, about as many of every label, in doubling rounds until ``AUDIT`` of them
    have links or all were looked at; after ``AUDIT_MOST`` nodes the links are too rare to audit.
    """
    counts = materialise(nodes.groupBy("label").agg(F.count("*").alias("n")), "labels")
    labels, most = counts.agg(F.count("*"), F.max("n")).first()
    each = AUDIT_FIRST / labels
    turn = F.pmod(F.xxhash64("node"), F.lit(1 << 30)) / F.lit(1 << 30) * F.col("n") / F.lit(each)
    dealt = materialise(nodes.where(F.size("vector") == size).join(counts, "label").select("node", "label", "vector", turn.alias("turn")), "probes")
    found, looked, low, high = {}, 0, 0, 1
    while True:
        probes = dealt.where((F.col("turn") >= low) & (F.col("turn") < high)).select("node", "label", "vector").collect()
        looked += len(probes)
        if probes:
            found |= _brute(nodes, probes, size, similarity)
        if high * each >= most or len(found) >= AUDIT:
            return found, True
        if looked >= AUDIT_MOST:
            return found, False
        low, high = high, 2 * high + 1


def _brute(nodes, probes, size, similarity):
    """``{node: (label, links)}`` of the probes that have links."""
    shared = nodes.sparkSession.sparkContext.broadcast(
        (np.array([r.node for r in probes], "i8"), np.array([r.label for r in probes], object), unit([r.vector for r in probes])))

    def count(parts):
        names, labels, vectors = shared.value
        total = np.zeros(len(names), "i8")
        for part in parts:
            node, copies, label = part.column(0).to_numpy(), part.column(3).to_numpy(), np.array(part.column(1).to_pylist(), object)
            points = unit(matrix(part.column(2)))
            for name in set(label):
                mine, theirs = np.flatnonzero(labels == name), np.flatnonzero(label == name)
                for a in range(0, len(theirs), 1024):
                    some = theirs[a:a + 1024]
                    hit = (vectors[mine] @ points[some].T >= similarity) & (names[mine][:, None] != node[some])
                    total[mine] += hit @ copies[some]
        some = total > 0
        yield pa.RecordBatch.from_arrays([pa.array(names[some]), pa.array(total[some])], names=["node", "links"])

    rows = nodes.where(F.size("vector") == size).select("node", "label", "vector", "copies")
    true = rows.mapInArrow(count, "node long, links long").groupBy("node").agg(F.sum("links").alias("links")).collect()
    label = {r.node: r.label for r in probes}
    shared.unpersist()
    return {r.node: (label[r.node], r.links) for r in true}


def _recall(links, truth):
    """The mean share of its links that a node of the audit got back (1.0 where no node has any)."""
    if not truth:
        return 1.0
    names = links.sparkSession.createDataFrame([(int(n),) for n in truth], "node long")
    got = {r.node: r.links for r in links.join(F.broadcast(names), "node").groupBy("node").agg(F.sum("links").alias("links")).collect()}
    return float(np.mean([min(1.0, got.get(n, 0) / true) for n, (_, true) in truth.items()]))


def _exact(nodes, found, similarity):
    """``node, links, root`` like ``_links``, of all pairs: no link is missed.

    A node is at home in its nearest cluster and a guest wherever it is near enough to the plane between the
    two centres for a node beyond it to be similar. At home it meets all members of the cluster.
    """
    shared = nodes.sparkSession.sparkContext.broadcast(found)
    reach = np.sqrt(1 - similarity ** 2) + 1e-9 if similarity > 0 else np.inf

    def place(parts):
        square = (shared.value ** 2).sum(axis=1)
        between = np.sqrt(np.maximum(0, square[:, None] + square - 2 * shared.value @ shared.value.T)) + 1e-6
        for part in parts:
            near = unit(matrix(part.column(2))) @ shared.value.T
            home = near.argmax(axis=1)
            member = near.max(axis=1)[:, None] - near <= reach * between[home]
            member[np.arange(len(home)), home] = True
            row, cluster = np.nonzero(member)
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays([*(part.column(i).take(at) for i in range(4)), pa.array(cluster.astype("i4")), pa.array(home[row] == cluster)],
                                             names=["node", "label", "vector", "copies", "cluster", "home"])

    placed = materialise(nodes.where(F.size("vector") == found.shape[1]).select("node", "label", "vector", "copies").mapInArrow(
        place, "node long, label string, vector array<double>, copies long, cluster int, home boolean"), "members")
    sizes = materialise(placed.groupBy("label", "cluster").agg(F.ceil(F.count("*") / EXACT).cast("int").alias("members"),
                                                               F.ceil(F.count_if("home") / EXACT).cast("int").alias("homes"))
                        .where("homes > 0"), "sizes")
    rows = placed.join(sizes, ["label", "cluster"])
    block = lambda of: F.pmod(F.xxhash64("node"), F.col(of)).cast("int")
    every = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
    columns = [*KEY, "node", "vector", "copies", "asks"]
    homes = rows.where("home").withColumn("asks", F.lit(True)).withColumn("i", block("homes")).withColumn("j", every("members"))
    others = rows.withColumn("asks", F.lit(False)).withColumn("j", block("members")).withColumn("i", every("homes"))

    def find(frame):
        mine, other = frame[frame.asks], frame[~frame.asks]
        if not len(mine) or not len(other):
            return pd.DataFrame({"node": [], "links": [], "root": []}).astype("i8")
        names, node, copies = mine.node.to_numpy(), other.node.to_numpy(), other.copies.to_numpy()
        points, theirs = unit(np.stack(mine.vector)), unit(np.stack(other.vector))
        ids = np.union1d(names, node)
        left, right = np.searchsorted(ids, names), np.searchsorted(ids, node)
        links, parent = np.zeros(len(ids), "i8"), np.arange(len(ids))
        for a in range(0, len(names), 512):
            hit = (points[a:a + 512] @ theirs.T >= similarity) & (names[a:a + 512, None] != node)
            links[left[a:a + 512]] = hit @ copies
            q, found = np.nonzero(hit)
            pairs = np.stack([left[a + q], right[found]], 1)
            parent = groups(len(ids), np.concatenate([pairs, np.stack([np.arange(len(ids)), parent], 1)]))
        some = (links > 0) | (parent != np.arange(len(ids)))
        return pd.DataFrame({"node": ids[some], "links": links[some], "root": ids[parent[some]]})

    dealt = homes.select(*columns).union(others.select(*columns))
    return materialise(dealt.groupBy(*KEY).applyInPandas(find, "node long, links long, root long"), "links")


def _found(nodes, similarity):
    """``node, links, root`` of nodes whose vectors have one length, and the audited recall."""
    count, labels = nodes.agg(F.count("*"), F.approx_count_distinct("label")).first()
    share = min(1.0, 1.3 * SAMPLE / count)
    sample = nodes.where(F.pmod(F.xxhash64("node"), F.lit(1 << 30)) < int(share * (1 << 30))).orderBy(F.xxhash64("node")).limit(SAMPLE).collect()
    sample = sample or nodes.limit(SAMPLE).collect()
    sample = unit([r.vector for r in sample if len(r.vector) == len(sample[0].vector)])
    truth, enough = _truth(nodes, sample.shape[1], similarity)
    recall = 0.0
    for overlap in range(OVERLAP, OVERLAP + REPEATS + 1) if enough else ():
        k = min(CENTRES, max(1, -(-overlap * count // (labels * PER_SHARD))))
        found = centres(sample, k, np.random.default_rng(3))
        shards = materialise(_shards(nodes, found, overlap), "shard_rows")
        links = _links(shards, _graph(shards), similarity)
        recall = _recall(links, truth)
        if recall >= ENOUGH:
            break
    if recall < ENOUGH:
        found = centres(sample, min(CENTRES, -(-count // (labels * EXACT))), np.random.default_rng(3))
        links, recall = _exact(nodes, found, similarity), 1.0
    return links, recall


def near_duplicates(rows, similarity=SIMILARITY, id_column="vec_id", vector_column="embedding", label_column="label"):
    """``vec_id, n_links, component_id, kept, audit_recall`` of every row."""
    members, nodes = _nodes(rows, id_column, vector_column, label_column)
    every = rows.select(F.col(id_column).cast("long").alias("vec_id"))
    if nodes.isEmpty():
        return every.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                            F.lit(True).alias("kept"), F.lit(1.0).alias("audit_recall"))
    kind = F.ceil(F.log2(F.size("vector"))).cast("int")
    longest = {r.kind: r.longest for r in nodes.groupBy(kind.alias("kind")).agg(F.max(F.size("vector")).alias("longest")).collect()}  # 32 rows at most
    found = [_found(nodes.where(kind == k).withColumn("vector", F.concat("vector", F.array_repeat(F.lit(0.0), F.lit(size) - F.size("vector")))),
                    similarity) for k, size in longest.items()]
    links, recall = reduce(DataFrame.union, [x for x, _ in found]), min(x for _, x in found)
    together = components(links.where("root <> node"), "root", "node")
    by_node = materialise(links.groupBy("node").agg(F.sum("links").alias("links")).join(together, "node", "full"), "by_node")
    known = (members.join(by_node, "node", "left")
             .select(F.col("id").alias("vec_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                     F.coalesce("component", "node").alias("component_id")))
    return (every.join(known, "vec_id", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
            .withColumn("audit_recall", F.lit(float(recall))))


@query("op3_embedding_neardup")
def op3_embedding_neardup(spark, sf):
    return near_duplicates(table(spark, sf, "embeddings"))
