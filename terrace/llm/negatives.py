"""Hard negatives by threshold joins with an inverted index (operator 12).

Every component becomes an integer (``floor(SCALE * x)``), and a score is an exact integer inner
product. The join works on cells: a shard of anchors against a shard of rows, dealt by Spark. In a
cell the dimensions are taken in the order of their energy. For the threshold of a block of anchors
the inverted index leaves out the last dimensions of every row whose suffix norm, times that of any
anchor, stays below the threshold: a pair that meets in no indexed dimension cannot reach it. Rows are
sorted by how many dimensions they are indexed in, so that the postings of a dimension are the first
rows. Partial scores are accumulated over groups of dimensions; after each, rows are dropped that no
anchor can bring to its threshold with the norms that remain. What survives is scored exactly.

Every window (an interval of scores, and how many rows it wants of the anchor's label or of others)
starts with a threshold near its upper end, which is lowered until the window is full or its lower end is
reached. A cell gives at most as many rows for a window as the window wants; the best of all cells follow
by one ranking per window. Positives are one window without ends, negatives one window per positive.

Scores of a cell are one matrix of ``ANCHORS`` by the rows of a shard; a shard holds ``VALUES`` components
of vectors of one length, so memory does not depend on the table, on a label or on a vector's copies.

Defined cases: rows with a NULL label, a NULL vector or a NULL or non-finite component take no part; neither
do rows whose integer vector has a norm of 2^29 or more, as scores might leave 64 bits. Vectors of different
lengths are compared as if the shorter one went on with zeros; zero and empty vectors score 0. Equal scores
are ordered by id (NULL last), then by row. Repeated rows are rows of their own, as anchors, positives (a
copy of the anchor is another row) and negatives. A NULL id is no anchor. A positive with a negative score
has no window. An empty table gives no rows.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from terrace.llm.registry import query, table
from terrace.workspace import materialise

SCALE = 256
#: Components in a shard of rows, and anchors in a shard of anchors.
VALUES, ANCHORS_SHARD = 1 << 21, 4096
#: Anchors of a cell that are joined together.
ANCHORS = 128
#: Dimensions added between two prunings.
GROUP = 16
#: How far a window is opened from its upper end, one step after another.
STEPS = (1 / 8, 1 / 4, 1 / 2, 1)
NORM = float(1 << 29)


def prepared(rows, id_column, vector_column, label):
    """``row, id, label, length, vec`` of the rows that take part, as a written table."""
    x = F.col("vec")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = rows.select(F.col(id_column).cast("long").alias("id"), label.cast("long").alias("label"),
                       F.col(vector_column).cast("array<double>").alias("vec"))
    rows = rows.where(F.col("label").isNotNull() & x.isNotNull() & finite)
    rows = rows.withColumn("vec", F.transform(x, lambda v: F.floor(v * SCALE)).cast("array<double>"))
    norm = F.sqrt(F.aggregate(x, F.lit(0.0), lambda a, v: a + v * v))
    rows = rows.where(norm < NORM).withColumn("length", F.size(x)).withColumn("vec", x.cast("array<long>"))
    return materialise(rows.withColumn("row", F.monotonically_increasing_id()), "rows")


def sharded(rows):
    """Rows with their shard, and the number of shards. A shard has vectors of one length."""
    sizes = rows.groupBy("length").agg(F.count("*").alias("n"))
    shards = F.ceil(F.col("n") * F.greatest("length", F.lit(1)) / VALUES).cast("long")
    sizes = sizes.select("length", shards.alias("shards"))
    before = Window.partitionBy(F.lit(0)).orderBy("length").rowsBetween(Window.unboundedPreceding, -1)
    sizes = materialise(sizes.withColumn("first", F.coalesce(F.sum("shards").over(before), F.lit(0))), "lengths")
    total = sizes.agg(F.sum("shards")).first()[0] or 0
    shard = F.col("first") + F.pmod(F.xxhash64("row"), F.col("shards"))
    return rows.join(sizes, "length").select("row", "id", "label", "vec", shard.alias("shard")), total


def matrix(column, length=None):
    """A list column as a matrix; with ``length``, lists are cut or go on with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = column.flatten().to_numpy()
    counts = np.diff(column.offsets.to_numpy())
    if length is None:
        length = int(counts[0]) if len(counts) else 0
    if (counts == length).all():
        return values.reshape(len(counts), length)
    out = np.zeros((len(counts), length), values.dtype)
    at = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(values)) - np.repeat(np.cumsum(counts) - counts, counts)
    out[at[place < length], place[place < length]] = values[place < length]
    return out


def suffix_norms(vectors, edges):
    """Norm of what is left of every vector from each edge on (columns: edges), a little above the true one."""
    squares = np.cumsum((vectors * vectors)[:, ::-1], axis=1)[:, ::-1]
    squares = np.hstack([squares, np.zeros((len(vectors), 1))])
    return np.sqrt(squares[:, edges]) * (1 + 1e-9)


class Index:
    """Rows of a shard, their dimensions in the order of energy."""

    def __init__(self, vectors):
        self.whole = vectors
        self.order = np.argsort(-(vectors.astype("f8") ** 2).sum(axis=0), kind="stable")
        self.vectors = vectors[:, self.order].astype("f8")
        self.edges = np.unique(np.r_[np.arange(0, len(self.order), GROUP), len(self.order)])
        self.rest = suffix_norms(self.vectors, self.edges)

    def join(self, anchors, thresholds):
        """All pairs that score at least their anchor's threshold: ``(anchor, row, score)``."""
        x, least = anchors[:, self.order].astype("f8"), thresholds
        rest = suffix_norms(x, self.edges)
        thresholds = least - 1 - 1e-9 * rest[:, 0] * self.rest[:, 0].max(initial=0)  # more than rounding can move a sum
        depth = np.full(len(self.vectors), len(self.edges) - 1)  # groups of dimensions that a row is indexed in
        if (thresholds > 0).all():
            covered = self.rest * (rest / thresholds[:, None]).max(axis=0) < 1  # no suffix from here on is enough
            depth = covered.argmax(axis=1)
        rows = np.argsort(-depth, kind="stable")
        if (thresholds > 0).all():
            rows = rows[:np.count_nonzero(depth)]
        depth = depth[rows]
        scores = np.zeros((len(x), len(rows)))
        for k in range(len(self.edges) - 1):
            posted = np.searchsorted(-depth, -k, "left")  # rows indexed in this group of dimensions: depth > k
            if not posted:
                break
            a, b = self.edges[k], self.edges[k + 1]
            scores[:, :posted] += x[:, a:b] @ self.vectors[rows[:posted], a:b].T
            # Remaining norms: of the indexed rows after this group, of the others after their own last one.
            left = np.minimum(depth, k + 1)
            possible = scores + rest[:, left] * self.rest[rows, left]
            alive = (possible >= thresholds[:, None]).any(axis=0)
            if alive.mean() < 0.9:
                rows, depth, scores = rows[alive], depth[alive], np.ascontiguousarray(scores[:, alive])
        possible = scores + rest[:, depth] * self.rest[rows, depth]
        at, place = np.nonzero(possible >= thresholds[:, None])
        return self._exact(anchors, at, rows[place], least)

    def _exact(self, anchors, at, rows, least):
        scores = np.zeros(len(at), "i8")
        step = max(1, (1 << 22) // max(1, self.whole.shape[1]))
        for k in range(0, len(at), step):
            part = slice(k, k + step)
            scores[part] = np.einsum("ij,ij->i", anchors[at[part]], self.whole[rows[part]])
        keep = scores >= least[at]
        return at[keep], rows[keep], scores[keep]


def fill(index, ids, labels, row_ids, anchors, own, own_labels, windows, wanted, same):
    """Lower the thresholds of some anchors until their windows are full.

    ``windows`` are ``(anchor, low, high)`` arrays. Gives ``(window, row, score)`` arrays, ``wanted`` rows a
    window at most.
    """
    at, low, high = windows
    open_, found = np.arange(len(at)), []
    for step in STEPS:
        if not len(open_):
            break
        edge = high[open_] - np.floor((high[open_] - low[open_]) * step).astype("i8")
        edge = np.maximum(edge, low[open_]) if step < 1 else low[open_]
        lowest = np.full(len(anchors), np.iinfo("i8").max)
        np.minimum.at(lowest, at[open_], edge)
        used = np.flatnonzero(lowest < np.iinfo("i8").max)
        a, rows, scores = index.join(anchors[used], lowest[used])
        a = used[a]
        fits = (labels[rows] == own_labels[a]) if same else (labels[rows] != own_labels[a])
        fits &= row_ids[rows] != own[a]
        a, rows, scores = a[fits], rows[fits], scores[fits]
        order = np.lexsort((row_ids[rows], ids[rows], -scores, a))
        a, rows, scores = a[order], rows[order], scores[order]
        begin, end = np.searchsorted(a, at[open_], "left"), np.searchsorted(a, at[open_], "right")
        still = []
        for w, i, j, least in zip(open_, begin, end, edge):
            first = i + np.searchsorted(-scores[i:j], -high[w], "left")
            last = min(i + np.searchsorted(-scores[i:j], -least, "right"), first + wanted)
            if last - first < wanted and least > low[w]:
                still.append(w)
            elif last > first:
                found.append((np.full(last - first, w), rows[first:last], scores[first:last]))
        open_ = np.array(still, "i8")
    return [np.concatenate(c) if found else np.zeros(0, "i8") for c in (zip(*found) if found else ((),) * 3)]


def best_in_windows(rows, shards, asking, wanted, same):
    """The best rows of every window: ``anchor, window, rank, row, id, score``.

    ``asking`` has ``row, id, label, vec, windows`` (an array of ``window, low, high``; NULL ends: none) of the
    anchors. Every window gets ``wanted`` rows of the anchor's label (``same``) or of other labels, all if
    there are fewer.
    """
    count = asking.count()
    parts = -(-count // ANCHORS_SHARD)
    if not count or not shards:
        parts = shards = 1
    left = asking.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(parts))).withColumn(
        "shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
    right = rows.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))

    def join(asked, shard):
        out = [[] for _ in range(5)]
        if asked.num_rows and shard.num_rows:
            index = Index(matrix(shard.column("vec")))
            ids = shard.column("id").fill_null(np.iinfo("i8").max).to_numpy()
            labels, row_ids = shard.column("label").to_numpy(), shard.column("row").to_numpy()
            asked = asked.combine_chunks()
            for k in range(0, asked.num_rows, ANCHORS):
                part = asked.slice(k, ANCHORS).combine_chunks()
                anchors = matrix(part.column("vec"), index.whole.shape[1])
                own = part.column("row").to_numpy()
                limit = np.ceil(np.linalg.norm(anchors.astype("f8"), axis=1) * index.rest[:, 0].max()).astype("i8") + 1
                named, at, low, high = [], [], [], []
                for a, windows in enumerate(part.column("windows").to_pylist()):
                    for w in windows:
                        top = limit[a] if w["high"] is None else min(w["high"], limit[a])
                        bottom = -limit[a] if w["low"] is None else max(w["low"], -limit[a])
                        if bottom <= top:
                            named.append(w["window"]), at.append(a), low.append(bottom), high.append(top)
                if not at:
                    continue
                at = np.array(at, "i8")
                w, found, scores = fill(index, ids, labels, row_ids, anchors, own, part.column("label").to_numpy(),
                                        (at, np.array(low, "i8"), np.array(high, "i8")), wanted, same)
                for column, values in zip(out, (own[at[w]], np.array(named, "i8")[w], row_ids[found], ids[found], scores)):
                    column.append(values)
        names = ("anchor", "window", "row", "id", "score")
        return pa.table({n: pa.array(np.concatenate(c) if c else np.zeros(0, "i8"), pa.int64()) for n, c in zip(names, out)})

    met = left.groupBy("part", "shard").cogroup(right.groupBy("part", "shard")).applyInArrow(
        join, "anchor long, window long, row long, id long, score long")
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "id", "row")
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= wanted)


def hard_negatives(rows, anchors, positives=5, negatives=10, low=(30, 100), high=(90, 100),
                   id_column="vec_id", vector_column="embedding", label=None):
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``anchors`` is a condition over ``id``. For every anchor its ``positives`` best other rows of the same label,
    and for each of these the ``negatives`` best rows of other labels that score from ``low`` to ``high``
    (fractions as pairs) of the positive's score.
    """
    rows = prepared(rows, id_column, vector_column, F.col("label") if label is None else label)
    asking = materialise(rows.where(anchors), "anchors")
    split, shards = sharded(rows)
    everything = F.array(F.struct(F.lit(0).cast("long").alias("window"), F.lit(None).cast("long").alias("low"),
                                  F.lit(None).cast("long").alias("high")))
    found = materialise(best_in_windows(split, shards, asking.withColumn("windows", everything), positives, True), "positives")
    score = F.col("score").cast("decimal(20,0)")
    window = F.struct(F.col("rank").cast("long").alias("window"),
                      F.ceil(score * low[0] / low[1]).cast("long").alias("low"),
                      F.floor(score * high[0] / high[1]).cast("long").alias("high"))
    windows = found.groupBy(F.col("anchor").alias("row")).agg(F.collect_list(window).alias("windows"))  # `positives` at most
    worst = best_in_windows(split, shards, asking.join(windows, "row"), negatives, False)
    positive = found.select("anchor", F.col("rank").cast("long").alias("window"), F.col("id").alias("positive_id"),
                            F.col("score").alias("positive_score"))
    last = F.lit(int(np.iinfo("i8").max))
    return (worst.join(positive, ["anchor", "window"])
            .join(asking.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
            .select("anchor_id", F.nullif("positive_id", last).alias("positive_id"), "rank",
                    F.nullif(F.col("id"), last).alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))


SQL = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vec
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same, list_dot_product(a.vec, v.vec)::BIGINT AS score
    FROM v a JOIN v ON a.vec_id <> v.vec_id WHERE a.vec_id % 100 = 0
), p AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id, row_number() OVER w AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
 AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 10
"""


@query("op12_hard_negatives", SQL)
def op12_hard_negatives(spark, sf):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf, "embeddings"), F.col("id") % 100 == 0, label=moved)
