"""Merkle manifest of a dataset (operator 11): leaf digests, roots, and a proof for every leaf.

The nodes of a tree are labelled by (last leaf below, level), so that every child has a lower label
than its parent. The forward sweep is time-forward processing: nodes are taken in the order of their
labels, and a digest travels to its parent as a message in a priority queue ordered by the receiver's
label. The reversed sweep takes the same nodes from the highest label down; there a message carries
the proof suffix (all siblings from the receiver up to the root) to each child.

The queue has two parts. Messages between nodes of one block of ``2 ** LEVELS`` consecutive leaves
stay in a heap inside the task; sweeping by last leaf, it never holds more than a few messages for
each level. Messages that leave a block are the external part: rows of a table written to the shared
folder, dealt to the next sweep by the receiver's block and sorted there. So a sweep over ``n``
leaves takes ``log(n) / LEVELS`` rounds of Spark jobs, whatever group holds how many rows.

Positions come from a range partitioning by (group, order, digest, row), so one group or one repeated
id is cut into as many partitions as it needs.

Defined cases: NULL columns are written as ``-``; a NULL group is one tree of its own, the first one.
Leaves with equal ids (or NULL ids, which come first) follow by digest; fully equal rows take any order
among themselves, which no digest shows. NULL texts and empty texts differ (``-`` and ``0:``). Columns of
other names are not read. An empty table has no rows and no root.
"""

import hashlib
import heapq

import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from terrace.llm.registry import query, remainder, table
from terrace.workspace import materialise

#: Levels of a tree that one task sweeps: blocks of 4,096 leaves.
LEVELS = 12
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
LEFT, RIGHT = "<", ">"  # the side a sibling stands on


def digest(*inputs):
    return hashlib.sha256("".join(inputs).encode()).hexdigest()


# ---- one block ----

def sweep(leaves, levels=None):
    """Forward sweep over consecutive leaves: ``{(level, place): digest}`` of all nodes, and the top level.

    With ``levels`` the sweep goes that far, even where one node is left before; else to a single node.
    """
    if levels is None:
        levels = (len(leaves) - 1).bit_length()
    counts = [len(leaves)]
    for _ in range(levels):
        counts.append((counts[-1] + 1) // 2)

    def label(level, place):
        return min(((place + 1) << level) - 1, len(leaves) - 1), level

    nodes, queue = {}, []  # messages: (label of the receiver, place of the sender, digest)

    def done(level, place, value):
        nodes[level, place] = value
        if level < levels:
            heapq.heappush(queue, (label(level + 1, place >> 1), place, value))

    for place, leaf in enumerate(leaves):
        done(0, place, leaf)
        while queue and queue[0][0][0] <= place:  # the children of this receiver are all done
            receiver, sender, value = heapq.heappop(queue)
            inputs = [value]
            while queue and queue[0][0] == receiver:
                inputs.append(heapq.heappop(queue)[2])
            done(receiver[1], sender >> 1, digest(*inputs))
    return nodes, levels, counts


def proofs(leaves, levels, suffix):
    """Reversed sweep: ``(sides, siblings)`` of every leaf, by falling place.

    ``suffix`` is that of the block's own top node. Sides are ``<``, ``>`` or, where a run is one node, ``.``;
    siblings are hexadecimal digests, one after another.
    """
    nodes, levels, counts = sweep(leaves, levels)

    def label(level, place):  # negated: the heap gives the highest label first
        return -min(((place + 1) << level) - 1, len(leaves) - 1), -level

    queue = [(label(levels, 0), 0, *suffix)]
    while queue:
        (_, level), place, sides, siblings = heapq.heappop(queue)
        level = -level
        if not level:
            yield place, sides, siblings
            continue
        left = 2 * place
        if left + 1 < counts[level - 1]:
            first, second = nodes[level - 1, left], nodes[level - 1, left + 1]
            heapq.heappush(queue, (label(level - 1, left), left, RIGHT + sides, second + siblings))
            heapq.heappush(queue, (label(level - 1, left + 1), left + 1, LEFT + sides, first + siblings))
        else:
            heapq.heappush(queue, (label(level - 1, left), left, "." + sides, siblings))


def fold(leaf, sides, siblings):
    """The root that a leaf and its siblings give."""
    at = 0
    for side in sides:
        if side == ".":
            leaf = digest(leaf)
            continue
        sibling = siblings[at:at + 64]
        leaf = digest(leaf, sibling) if side == RIGHT else digest(sibling, leaf)
        at += 64
    return leaf


# ---- whole tables ----

def placed(rows, group, order):
    """Rows with ``place``, their position (from 0) within the group by ``order``. Rows that ``order`` does not
    tell apart follow in any order."""
    keys = [group, *order, "_row"]
    ordered = (rows.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*keys)
               .sortWithinPartitions(*keys).drop("_row").withColumn("_at", F.monotonically_increasing_id()))
    ordered = materialise(ordered, "placed").withColumn("_part", F.shiftright("_at", 33))
    runs = ordered.groupBy(F.col("_part").alias("_p"), F.col(group).alias("_g")).agg(
        F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy("_g").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    return (ordered.join(runs, (F.col("_part") == F.col("_p")) & F.col(group).eqNullSafe(F.col("_g")))
            .withColumn("place", F.col("_base") + F.col("_at") - F.col("_first"))
            .drop("_at", "_part", "_p", "_g", "_first", "_n", "_base"))


def _block(part):
    """The rows of a block in order, their digests, and how many levels it is swept."""
    part = part.sort_by("place")
    return part, part.column("digest").to_pylist(), part.column("levels")[0].as_py()


def rise(nodes, levels=LEVELS):
    """Forward sweep of many trees (``tree, place, digest``), ``levels`` of them a round: the nodes of every round,
    and ``tree, place, digest`` of the roots (place 0)."""
    def up(part):
        tree, block = part.column("tree")[:1], part.column("block")[:1]
        _, leaves, height = _block(part)
        found, height, _ = sweep(leaves, height)
        return pa.table({"tree": tree, "place": block, "digest": pa.array([found[height, 0]])})

    rounds, largest = [], 2
    while largest > 1:
        sizes = nodes.groupBy("tree").agg(F.count("*").alias("size"))
        # A tree that fits a block is swept to its end, every block of a larger one as many levels.
        height = F.when(F.col("size") > 1 << levels, levels).alias("levels")
        rounds.append(nodes.withColumn("block", F.shiftright("place", levels)).join(sizes.select("tree", height), "tree"))
        inner = rounds[-1].select("tree", "block", "place", "levels", "digest")
        nodes = materialise(inner.groupBy("tree", "block").applyInArrow(up, "tree long, place long, digest string"), "nodes")
        largest = nodes.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    return rounds, nodes


def descend(nodes, suffixes):
    """One round of the reversed sweep: the nodes with ``sides`` and ``siblings`` up to the root. Every block meets
    the one suffix of its top node."""
    def down(part, top):
        part, leaves, height = _block(part)
        suffix = top.column("sides")[0].as_py(), top.column("siblings")[0].as_py()
        found = sorted(proofs(leaves, height, suffix))
        return (part.append_column("sides", pa.array([f[1] for f in found]))
                .append_column("siblings", pa.array([f[2] for f in found])))

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema) + ", sides string, siblings string"
    tops = suffixes.select("tree", F.col("place").alias("block"), "sides", "siblings")
    return nodes.groupBy("tree", "block").cogroup(tops.groupBy("tree", "block")).applyInArrow(down, schema)


def fall(rounds, suffixes):
    """Reversed sweep through all rounds, from the suffixes of the roots to the nodes of the first round."""
    for nodes in reversed(rounds[1:]):
        suffixes = materialise(descend(nodes.select("tree", "block", "place", "levels", "digest"), suffixes)
                               .select("tree", "place", "sides", "siblings"), "suffixes")
    return descend(rounds[0], suffixes)


def manifest(leaves, levels=LEVELS):
    """A tree for each group and one over the groups' roots, from ``id, grp, digest`` and any other columns.

    Returns the rows with ``subroot``, ``root``, and the proof: ``sides`` (one character a level, ``<`` or ``>`` where
    the sibling stands, ``.`` without one) and ``siblings`` (digests from the leaf up, one after another).
    """
    nodes = placed(leaves, "grp", ["id", "digest"])
    groups = placed(nodes.select("grp").distinct().withColumn("all", F.lit(0)), "all", ["grp"])
    groups = materialise(groups.select(F.col("grp").alias("_grp"), F.col("place").alias("tree")), "groups")
    nodes = nodes.join(groups, F.col("grp").eqNullSafe(F.col("_grp"))).drop("_grp")
    rounds, subroots = rise(nodes, levels)
    top = materialise(subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("place"), "digest"), "nodes")
    over, roots = rise(top, levels)
    root = roots.first()
    ends = fall(over, roots.select("tree", "place", F.lit("").alias("sides"), F.lit("").alias("siblings")))
    ends = materialise(ends.select(F.col("place").alias("tree"), F.lit(0).cast("long").alias("place"), "sides", "siblings"),
                       "suffixes")
    proved = fall(rounds, ends).drop("block", "levels")
    return (proved.join(subroots.select("tree", F.col("digest").alias("subroot")), "tree")
            .withColumn("root", F.lit(root.digest if root else None).cast("string")).drop("tree"))


@F.arrow_udf(StringType())
def folded(leaf: pa.Array, sides: pa.Array, siblings: pa.Array) -> pa.Array:
    """The root that a leaf digest and its proof give."""
    return pa.array(map(fold, *(column.to_pylist() for column in (leaf, sides, siblings))), pa.string())


def record(*values):
    """What a leaf digests: of every value its bytes in UTF-8, a colon and the text, ``-`` for NULL."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
                             for t in texts)).cast("binary"), 256)


def _part(value):
    return f"coalesce(strlen(({value})::VARCHAR)::VARCHAR || ':' || ({value})::VARCHAR, '-')"


def _record(**changed):
    return "sha256(" + " || ".join(_part(changed.get(f, f)) for f in FIELDS) + ")"


#: crc32 of an id as text, bit by bit.
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(doc_id::VARCHAR, ''),
    lambda ch: [ascii(ch)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
    lambda c, x: CASE WHEN xor(c, x) % 2 = 1 THEN xor(xor(c, x) // 2, 3988292384) ELSE xor(c, x) // 2 END))"""

#: Both kinds of trees level by level, every leaf's siblings, then its fold step by step.
SQL = f"""
WITH RECURSIVE docs AS (
    SELECT doc_id, lang, {_record()} AS leaf,
           CASE WHEN {_CRC} % 7 = 0 THEN {_record(n_chars="n_chars::HUGEINT + 1")} ELSE {_record()} END AS claim
    FROM documents
), groups AS (
    SELECT lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree FROM (SELECT DISTINCT lang FROM docs)
), leaves AS (
    SELECT d.*, g.tree, row_number() OVER (PARTITION BY g.tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
    FROM docs d JOIN groups g ON d.lang IS NOT DISTINCT FROM g.lang
), low AS (
    SELECT tree, 0 AS level, pos, leaf AS digest, count(*) OVER (PARTITION BY tree) AS n FROM leaves
    UNION ALL
    SELECT tree, level + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(n) + 1) // 2
    FROM low WHERE n > 1 GROUP BY tree, level, pos // 2
), subroots AS (SELECT tree, digest, level AS height FROM low WHERE n = 1),
high AS (
    SELECT 0 AS level, tree AS pos, digest, count(*) OVER () AS n FROM subroots
    UNION ALL
    SELECT level + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(n) + 1) // 2
    FROM high WHERE n > 1 GROUP BY level, pos // 2
), steps AS (
    SELECT l.tree, l.pos, own.level AS step, own.pos % 2 AS side, sib.digest AS sibling
    FROM leaves l JOIN low own ON own.tree = l.tree AND own.n > 1 AND own.pos = l.pos >> own.level
    LEFT JOIN low sib ON sib.tree = own.tree AND sib.level = own.level AND sib.pos = xor(own.pos, 1)
    UNION ALL
    SELECT l.tree, l.pos, s.height + own.level, own.pos % 2, sib.digest
    FROM leaves l JOIN subroots s ON s.tree = l.tree JOIN high own ON own.n > 1 AND own.pos = l.tree >> own.level
    LEFT JOIN high sib ON sib.level = own.level AND sib.pos = xor(own.pos, 1)
), fold AS (
    SELECT tree, pos, 0 AS step, claim AS digest FROM leaves
    UNION ALL
    SELECT f.tree, f.pos, f.step + 1, sha256(CASE WHEN sibling IS NULL THEN f.digest
        WHEN side = 1 THEN sibling || f.digest ELSE f.digest || sibling END)
    FROM fold f JOIN steps s ON s.tree = f.tree AND s.pos = f.pos AND s.step = f.step
), proof AS (
    SELECT tree, pos, count(*) AS n, string_agg(coalesce(sibling, ''), '' ORDER BY step) AS siblings
    FROM steps GROUP BY tree, pos
)
SELECT l.doc_id, l.leaf, s.digest AS subroot, r.digest AS root, sha256(coalesce(p.siblings, '')) AS proof_sha256,
       f.digest AS folded_root, f.digest = r.digest AS verified
FROM leaves l JOIN subroots s USING (tree) JOIN high r ON r.n = 1
LEFT JOIN proof p ON p.tree = l.tree AND p.pos = l.pos
JOIN fold f ON f.tree = l.tree AND f.pos = l.pos AND f.step = coalesce(p.n, 0)
"""


def digests(docs, levels=LEVELS):
    """Proof digests of every document, and what its proof says of the record, in which one of seven has another ``n_chars``."""
    fields = [F.col(f) for f in FIELDS]
    more = F.col("n_chars").cast("decimal(38,0)") + 1
    changed = [more if f == "n_chars" else F.col(f) for f in FIELDS]
    leaves = docs.select(F.col("doc_id").alias("id"), F.col("lang").alias("grp"), record(*fields).alias("digest"),
                         F.when(remainder("doc_id", 7) == 0, record(*changed)).alias("changed"))
    rows = manifest(leaves, levels)
    return rows.select(
        F.col("id").alias("doc_id"), F.col("digest").alias("leaf"), "subroot", "root",
        F.sha2(F.col("siblings").cast("binary"), 256).alias("proof_sha256"),
        folded(F.coalesce("changed", "digest"), "sides", "siblings").alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


@query("op11_merkle_manifest", SQL)
def op11_merkle_manifest(spark, sf):
    return digests(table(spark, sf, "documents"))
