"""N-gram Jaccard join (operator 5): prefix filtering, rare n-grams first.

Documents are sets of distinct word n-grams (64-bit hashes). N-grams are ordered by how many
documents have them, counted over all documents in ``BUCKETS`` hash buckets (a table of fixed size;
which order is used never changes a result, only the number of candidates), then by hash. Two sets
that reach the similarity share an n-gram among their first ``n - ceil(t n) + 1``, so documents meet
in the buckets of these prefix n-grams. Length, positional and suffix filters (set sizes; what is
left behind the shared n-gram; n-grams counted by hash class, whose differences bound the overlap)
drop pairs before any set is looked at; a pair is verified once, with whole sets.

Groups of copies never become all their pairs:

1. documents with equal sets are one class from the start, joined on the digest of the set;
2. buckets of ``SMALL`` rows at most give all their pairs, larger ones those of neighbours by size; a
   bucket over ``HOT`` rows is dealt out by hash, its parts' first rows meet in a bucket of their own.
   Each pair, wherever it met, passes the filters once, before a set is made;
3. every class is first verified against one partner, the one it meets in most buckets. Links found so
   far make components; pairs that still join two components have their best one for each two
   components verified, after ``CHEAP`` such rounds more in each round (all, where no more are left than
   there were partners), until no pair is left;
4. what remains are larger buckets with several components. Rows without a counterpart there (by small
   sketches of 64 bytes) drop out; then each bucket looks for pairs of different components that
   pass all filters and merges as it finds them, so it returns a forest, not all pairs. These are
   verified and the components are renewed; buckets with a pair whose ends still lie apart look
   again, without the pairs that failed and with more partners for each row, until none is left.
   From its second look on a bucket merges only after a number of pairs in proportion to its rows, eight
   times as many in every further look; one that gave all its pairs before that is done.
   Large buckets are cut into blocks, and pairs of blocks are independent tasks; the rows of the
   largest component of such a bucket meet only the others, and only sets of near sizes meet.

A link inside a component cannot change it, so leaving those pairs out loses nothing.

Defined cases: NULL and empty texts, or texts of blanks, have 0 shingles and are linked with
nothing. Fewer words than ``n`` are one shingle, different from any of full length. Rows with a NULL
id are returned with a NULL component and take no part. Repeated rows are returned as often as they
occur. An id with several different texts is compared by the one whose set sorts first.
"""

import hashlib
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.components import components
from terrace.llm.memory import release_others
from terrace.llm.registry import query, table
from terrace.workspace import materialise

#: Counters of the rarity table: 2 MB, whatever the corpus.
BUCKETS = 1 << 19
HOT, BLOCK, SMALL, CHEAP = 20_000, 2_048, 16, 2
#: Bits of the filter that keeps unconcerned documents out of the verification's shuffle: 8 MB.
FILTER_BITS = 1 << 26
#: Bytes of text that a worker hashes at a time.
CHUNK = 300_000

_rng = np.random.default_rng(5)
BYTE = _rng.integers(1, 1 << 63, 256, "u8") * np.uint64(2) + np.uint64(1)
ODD = np.uint64(0x9E3779B97F4A7C15)
#: The value of every byte with A-Z taken as a-z, and whether it belongs to a word.
LOWERED = np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), np.roll(BYTE, -32), BYTE)
INSIDE = ~((np.arange(256) == 32) | ((np.arange(256) >= 9) & (np.arange(256) <= 13)))


def mix(x):
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_powers = [np.ones(1, "u8"), np.ones(1, "u8")]


def powers(size):
    """Powers of ``ODD`` and of its inverse modulo 2 ** 64, grown once per Python worker."""
    if len(_powers[0]) < size:
        with np.errstate(over="ignore"):
            for k, base in enumerate((ODD, np.uint64(pow(int(ODD), -1, 1 << 64)))):
                _powers[k] = np.cumprod(np.r_[np.uint64(1), np.full(size + (size >> 2), base, "u8")])
    return _powers


def word_hashes(texts):
    """64-bit hashes of all words, and the number of words of each text."""
    release_others("jaccard")
    data = [(t or "").encode("utf-8", "replace") for t in texts]
    flat = np.frombuffer(b"\n".join(data) + b"\n", "u1")
    inside = INSIDE[flat]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    edge = np.r_[0, edge] if inside[0] else edge
    starts, ends = edge[::2], edge[1::2]
    doc_ends = np.cumsum([len(d) + 1 for d in data])
    counts = np.diff(np.r_[0, np.searchsorted(starts, doc_ends)])
    ahead, inverse = powers(len(flat))
    with np.errstate(over="ignore"):
        sums = np.empty(len(flat) + 1, "u8")  # of byte values times the power of their place
        sums[0] = 0
        np.cumsum(LOWERED[flat] * ahead[:len(flat)], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * inverse[starts]), counts


def shingle_sets(texts, n=4):
    """A sorted array of distinct 64-bit shingle hashes for each text."""
    words, counts = word_hashes(texts)
    at, out = 0, []
    with np.errstate(over="ignore"):
        factors = mix(np.arange(1, n + 2, dtype="u8") * ODD) | np.uint64(1)
        whole = np.zeros(max(0, len(words) - n + 1), "u8")
        for k in range(n):
            whole += words[k:k + len(whole)] * factors[k]
        whole = mix(whole)
        for count in counts:
            if count >= n:
                out.append(np.unique(whole[at:at + count - n + 1]))
            elif count:
                short = (words[at:at + count] * factors[:count]).sum() + np.uint64(count) * factors[n]
                out.append(mix(np.array([short], "u8")))
            else:
                out.append(np.zeros(0, "u8"))
            at += count
    return out


def chunks(column, limit=CHUNK):
    """A text column in parts of bounded length, at least one text each: (first row, row after, texts)."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    start, size = 0, 0
    for i, n in enumerate(sizes):
        size += int(n)
        if size > limit or i + 1 == len(sizes):
            yield start, i + 1, column.slice(start, i + 1 - start).to_pylist()
            start, size = i + 1, 0


def needed(percent, size):
    """The least overlap of a set with any set that it is similar to."""
    return -(-percent * size // 100)


def overlap_needed(percent, a, b):
    """The least overlap that makes sets of these sizes similar: 100 o >= percent (a + b - o)."""
    return -(-percent * (a + b) // (100 + percent))


def _columns(docs, id_column, text_column):
    return docs.select(F.col(id_column).cast("long").alias("doc"), F.col(text_column).alias("text"))


def _profile(docs, n):
    """Rows ``doc, size, digest, sketch, small`` of all documents, and rows ``part, counts`` of the rarity table."""
    names = ["doc", "size", "digest", "sketch", "small", "part", "counts"]

    def read(parts):
        counts = np.zeros(BUCKETS, "i8")
        for part in parts:
            ids = part.column(0)
            for a, b, texts in chunks(part.column(1)):
                sets = shingle_sets(texts, n)
                every = np.concatenate([*sets, np.zeros(0, "u8")])
                counts += np.bincount((every % np.uint64(BUCKETS)).astype("i8"), minlength=BUCKETS)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                     pa.array([sketch(s).tobytes() for s in sets], pa.binary()), pa.array([small(s).tobytes() for s in sets], pa.binary()),
                     pa.nulls(b - a, pa.int32()), pa.nulls(b - a, pa.binary())], names=names)
        if counts.any():
            found = counts.astype("<i8").reshape(16, -1)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(16, pa.int64()), pa.nulls(16, pa.int64()), *[pa.nulls(16, pa.binary())] * 3,
                 pa.array(range(16), pa.int32()), pa.array([c.tobytes() for c in found], pa.binary())], names=names)

    out = materialise(docs.mapInArrow(read, "doc long, size long, digest binary, sketch binary, small binary, part int, counts binary"), "profile")
    return out.where("part IS NULL").select("doc", "size", "digest", "sketch", "small"), out.where("part IS NOT NULL").select("part", "counts")


def _rarity(counts):
    """The rarity table, added up by part in tasks: 2 MB on the driver whatever the corpus."""
    def add(parts):
        total = {}
        for part in parts:
            for k, data in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                total[k] = total.get(k, 0) + np.frombuffer(data, "<i8")
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())],
                                         names=["part", "counts"])

    schema = "part int, counts binary"
    by_task = counts.mapInArrow(add, schema)  # added up in each task first
    rows = by_task.repartition(16, "part").mapInArrow(add, schema).collect()
    out = np.zeros((16, BUCKETS // 16), "i8")
    for r in rows:
        out[r.part] += np.frombuffer(r.counts, "<i8")
    return np.minimum(out.ravel(), (1 << 20) - 1).astype("u4")


def ordered(hashes, rarity):
    """The n-grams of a set as 64-bit keys in the global order: 20 bits of count, 44 of hash."""
    count = rarity[(hashes % np.uint64(BUCKETS)).astype("i8")].astype("u8")
    return np.sort(count << np.uint64(44) | hashes >> np.uint64(20))


def _prefixes(docs, rarity, n, percent):
    """Rows ``token, part, digest, size, place -> doc``: the prefix n-grams of each class of equal sets."""
    shared = docs.sparkSession.sparkContext.broadcast(rarity)

    def read(parts):
        least = {}  # the smallest id of each class in this task so far: copies are passed on once
        for part in parts:
            ids = part.column(0).to_pylist()
            for a, b, texts in chunks(part.column(1)):
                fresh = {}
                for doc, s in zip(ids[a:b], shingle_sets(texts, n), strict=True):
                    if len(s) and doc is not None:
                        digest = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                        if digest not in least or doc < least[digest]:
                            least[digest], fresh[digest] = doc, (s, doc)
                rows = [(ordered(s, shared.value)[:len(s) - needed(percent, len(s)) + 1], int.from_bytes(digest[:8], "little", signed=True), len(s), doc)
                        for digest, (s, doc) in fresh.items()]
                if rows:
                    sizes = [len(r[0]) for r in rows]
                    keys = np.concatenate([r[0] for r in rows])
                    digests = np.repeat(np.array([r[1] for r in rows], "i8"), sizes)
                    dealt = ((keys >> np.uint64(44)).astype("i8") // HOT + 1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys.view("i8")), pa.array((np.abs(digests % (1 << 30)) % dealt).astype("i4")), pa.array(digests),
                         pa.array(np.repeat(np.array([r[2] for r in rows], "i4"), sizes)),
                         pa.array(np.concatenate([np.arange(k, dtype="i4") for k in sizes])),
                         pa.array(np.repeat(np.array([r[3] for r in rows], "i8"), sizes))],
                        names=["token", "part", "digest", "size", "place", "doc"])

    rows = docs.mapInArrow(read, "token long, part int, digest long, size int, place int, doc long")
    # dealt by bucket once: grouping and meeting both find whole buckets in a task
    return rows.repartition("token", "part").groupBy("token", "part", "digest", "size", "place").agg(F.min("doc").alias("doc"))


ROW = "token long, part int, doc long, size int, place int"
MET = "a long, b long, token long, part int, doc long, size int, place int"


def _meet(rows, percent):
    """Of rows dealt by bucket: all pairs of small buckets, in others those of neighbours by size and of each
    with the first (``a, b``), the first row of each part of a hot bucket (``part`` -1), and all rows of the
    buckets that are not small."""
    def read(parts):
        held = None
        for part in parts:
            frame = part.to_pandas()
            if held is not None:
                frame = pd.concat([held, frame], ignore_index=True)
            # the last bucket may go on in the next batch; a bucket has at most about HOT rows
            token, salt = frame.token.to_numpy(), frame.part.to_numpy()
            open_from = int(np.flatnonzero((token != token[-1]) | (salt != salt[-1]))[-1] + 1) if len(frame) and (
                token[0] != token[-1] or salt[0] != salt[-1]) else 0
            held = frame.iloc[open_from:]
            if open_from:
                yield from done(frame.iloc[:open_from])
        if held is not None and len(held):
            yield from done(held)

    def done(frame):
        token, salt = frame.token.to_numpy(), frame.part.to_numpy()
        doc, size, place = (frame[c].to_numpy() for c in ("doc", "size", "place"))
        new = np.r_[True, (token[1:] != token[:-1]) | (salt[1:] != salt[:-1])]
        first = np.maximum.accumulate(np.where(new, np.arange(len(frame)), 0))
        held = np.diff(np.r_[np.flatnonzero(new), len(frame)])
        hot = ((token.view("u8") >> np.uint64(44)).astype("i8") >= HOT) & (salt >= 0)
        many = (np.repeat(held, held) > SMALL) | hot
        lead = new & hot
        at = np.flatnonzero(~new)
        ends = [(first[at], at), (at - 1, at)]
        for back in range(2, SMALL):
            at = at[(at - first[at] >= back) & ~many[at]]
            ends.append((at - back, at))
        left, right = (np.concatenate(e) for e in zip(*ends, strict=True))
        ok = passes(percent, size[left], size[right], place[left], place[right]) & (doc[left] != doc[right])
        left, right = left[ok], right[ok]
        a, b = np.minimum(doc[left], doc[right]), np.maximum(doc[left], doc[right])
        k = len(a)
        blank = lambda n, t: pa.nulls(n, t)
        yield pa.RecordBatch.from_arrays(
            [pa.array(a), pa.array(b), blank(k, pa.int64()), blank(k, pa.int32()), blank(k, pa.int64()), blank(k, pa.int32()),
             blank(k, pa.int32())], schema=shape)
        for chosen, salts in ((many, salt), (lead, np.full(len(frame), -1, "i4"))):
            m = int(chosen.sum())
            yield pa.RecordBatch.from_arrays(
                [blank(m, pa.int64()), blank(m, pa.int64()), pa.array(token[chosen]), pa.array(salts[chosen].astype("i4")),
                 pa.array(doc[chosen]), pa.array(size[chosen].astype("i4")), pa.array(place[chosen].astype("i4"))], schema=shape)

    shape = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("token", pa.int64()), ("part", pa.int32()), ("doc", pa.int64()),
                       ("size", pa.int32()), ("place", pa.int32())])
    dealt = rows.select("token", "part", "doc", "size", "place")
    return materialise(dealt.sortWithinPartitions("token", "part", "size", "doc").mapInArrow(read, MET), "met")


def passes(percent, size_a, size_b, place_a, place_b):
    """Length and positional filters for pairs that share the n-gram at these places."""
    small, large = np.minimum(size_a, size_b).astype("i8"), np.maximum(size_a, size_b).astype("i8")
    rest = np.minimum(size_a - place_a, size_b - place_b) + np.minimum(place_a, place_b)
    return (100 * small >= percent * large) & (rest >= overlap_needed(percent, small, large))


def id_bits(ids):
    """A bit per hashed id, set where one of these ids (the first column) falls: 8 MB whatever the corpus."""
    def bits(parts):
        found = np.zeros(FILTER_BITS // 8, "u1")
        for part in parts:
            slot = (mix(np.asarray(part.column(0)).astype("i8").view("u8")) % np.uint64(FILTER_BITS)).astype("i8")
            np.bitwise_or.at(found, slot >> 3, (1 << (slot & 7)).astype("u1"))
        used = found.reshape(64, -1)
        rows = [k for k in range(64) if used[k].any()]
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int32()), pa.array([used[k].tobytes() for k in rows], pa.binary())], names=["k", "bits"])

    def unite(parts):
        total = {}
        for part in parts:
            for k, data in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                total[k] = total.get(k, 0) | np.frombuffer(data, "u1")
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())], names=["k", "bits"])

    filled = np.zeros((64, FILTER_BITS // 512), "u1")
    for r in ids.coalesce(8).mapInArrow(bits, "k int, bits binary").repartition(16, "k").mapInArrow(unite, "k int, bits binary").collect():
        filled[r.k] |= np.frombuffer(r.bits, "u1")
    return filled.ravel()


def in_bits(bits, ids):
    """Which of these ids the filter lets through: all that it was made of, and a few others."""
    slot = (mix(ids.astype("i8").view("u8")) % np.uint64(FILTER_BITS)).astype("i8")
    return (bits[slot >> 3] >> (slot & 7) & 1).astype(bool)


def _concerned(docs, ids, n):
    """``doc, grams`` of the documents with these ids: sorted shingle hashes as bytes."""
    shared = docs.sparkSession.sparkContext.broadcast(id_bits(ids))

    def grams(parts):
        for part in parts:
            part = part.filter(pa.array(in_bits(shared.value, part.column(0).fill_null(0).to_numpy(zero_copy_only=False))))
            for a, b, texts in chunks(part.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).slice(a, b - a), pa.array([s.tobytes() for s in shingle_sets(texts, n)], pa.binary())],
                    names=["doc", "grams"])

    sets = docs.mapInArrow(grams, "doc long, grams binary").join(ids, "doc", "left_semi")
    return materialise(sets.groupBy("doc").agg(F.min("grams").alias("grams")), "sets")


def _verified(docs, pairs, n, percent, store):
    """The pairs (each once) whose whole sets are similar.

    ``store`` keeps the sets that were made so far: texts are read again only for other documents.
    """
    concerned = materialise(pairs.select(F.col("a").alias("doc")).union(pairs.select("b")).distinct(), "concerned")
    ids = concerned
    for sets in store:
        ids = ids.join(sets.select("doc"), "doc", "left_anti")
    ids = materialise(ids, "concerned") if store else ids
    if not ids.isEmpty():
        store.append(_concerned(docs, ids, n))
    if not store:
        return pairs.select("a", "b").where("false")
    sets = store[0]
    if len(store) > 1 or ids is not concerned:  # only the sets that these pairs need are shuffled
        sets = reduce(DataFrame.union, store).join(concerned, "doc", "left_semi")

    def similar(parts):
        for part in parts:
            keep = []
            for x, y in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(x, "u8"), np.frombuffer(y, "u8")
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    joined = pairs.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b").select("a", "b", "x", "y")
    return materialise(joined.mapInArrow(similar, "a long, b long"), "links")


def sketch(hashes):
    """N-grams counted up to 3 by hash class, two to four classes an n-gram, four classes a byte."""
    classes = max(64, 1 << (2 * len(hashes)).bit_length())
    counts = np.minimum(np.bincount((hashes % np.uint64(classes)).astype("i8"), minlength=classes), 3).astype("u1")
    return counts[0::4] | counts[1::4] << 2 | counts[2::4] << 4 | counts[3::4] << 6


def small(hashes):
    """N-grams counted in 64 hash classes."""
    return np.minimum(np.bincount((hashes >> np.uint64(58)).astype("i8"), minlength=64), 255).astype("u1")


def unpacked(data):
    """The counts of a sketch."""
    packed = np.frombuffer(data, "u1")
    return np.stack([packed & 3, packed >> 2 & 3, packed >> 4 & 3, packed >> 6], 1).ravel()


def apart(one, many):
    """How many n-grams at least only one of two sets has, for the counts of one set and of several.

    A class counted up to 3 has at least so many; over classes that fall together such counts tell a
    difference only where the smaller one is exact.
    """
    width = min(len(one), min(map(len, many)))
    left, right = _folded(one, width), np.stack([_folded(m, width) for m in many])
    if all(len(x) == width for x in (one, *many)):
        return np.abs(right - left).sum(axis=1, dtype="i8")
    exact = [_exact(one, width), np.stack([_exact(m, width) for m in many])]
    more = right - left
    return np.where(np.where(more > 0, *exact), np.abs(more), 0).sum(axis=1, dtype="i8")


def _near(pairs, sketches, percent):
    """The pairs (with how often they met) that the sketches of their documents allow to be similar.

    An id with several texts has the sketch of one of them: its pairs are kept.
    """
    def allowed(parts):
        for part in parts:
            size = np.asarray(part.column(3)) + np.asarray(part.column(4))
            room = size - 2 * overlap_needed(percent, size, 0)
            x, y = (np.frombuffer(b"".join(part.column(k).to_pylist()), "u1").reshape(-1, 64).astype("i2") for k in (5, 6))
            keep = np.abs(x - y).sum(axis=1) <= room
            x, y = part.column(7), part.column(8)
            for k in np.flatnonzero(keep):
                keep[k] = apart(unpacked(x[k].as_py()), [unpacked(y[k].as_py())])[0] <= room[k]
            several = part.column(9).to_numpy(zero_copy_only=False)
            yield part.select(["a", "b", "n"]).filter(pa.array(keep | several, pa.bool_()))

    both = pairs
    for end, others in (("a", "x"), ("b", "y")):
        both = both.join(sketches.select(F.col("doc").alias(end), F.col("size").alias("size_" + others), F.col("small").alias("small_" + others),
                                         F.col("sketch").alias(others), F.col("several").alias("several_" + others)), end)
    both = both.select("a", "b", "n", "size_x", "size_y", "small_x", "small_y", "x", "y", F.expr("several_x OR several_y"))
    return materialise(both.mapInArrow(allowed, "a long, b long, n long"), "near")


def _folded(counts, width):
    """Counts over fewer classes: sums of those that fall together."""
    return counts.astype("i2") if len(counts) == width else counts.reshape(-1, width).sum(axis=0, dtype="i2")


def _exact(counts, width):
    """Whether none of the classes that fall together was counted up to 3, which may stand for more."""
    return (counts < 3).reshape(-1, width).all(axis=0)


def forest(doc, size, place, part, mine, sketches, failed, i, j, percent, depth, free=0):
    """Pairs of places that join the components of one bucket as far as the filters let them.

    A row is compared with the rows of components it is not merged with yet; of each
    such component the first ``depth`` that pass are paired with it, and the two are merged. Pairs in
    ``failed`` are known not to be similar. While there are fewer than ``free`` pairs, a row is paired with
    all that pass and nothing is merged: what a merger leaves out may have to be looked for
    again, once the pair behind it has failed.
    """
    order = np.lexsort((doc, size))
    _, label = np.unique(part, return_inverse=True)
    counts, out = {}, []

    def sketch_of(k):
        if k not in counts:
            counts[k] = unpacked(sketches[k])
        return counts[k]

    for at, k in enumerate(order):
        # Larger sets only (each pair once), while they can be similar.
        later = order[at + 1:]
        later = later[:np.searchsorted(size[later], 100 * int(size[k]) // percent, "right")]
        later = later[label[later] != label[k]]
        if i != j:
            later = later[mine[later] != mine[k]]
        later = later[passes(percent, size[k], size[later], place[k], place[later])]
        if len(failed[k]):
            later = later[~np.isin(doc[later], failed[k])]
        met, merges = {}, len(out) >= free
        while len(later):
            some, later = later[:64], later[64:]
            total = size[some].astype("i8") + size[k]
            near = apart(sketch_of(k), [sketch_of(m) for m in some]) <= total - 2 * overlap_needed(percent, total, 0)
            for m in some[near]:
                met[label[m]] = met.get(label[m], 0) + 1
                if not merges or met[label[m]] <= depth:
                    out.append((k, m))
            if merges:
                full = [x for x, times in met.items() if times >= depth]
                later = later[~np.isin(label[later], full)]
        if merges:
            for x in met:
                label[label == x] = label[k]
    return out


def _cut(rows, percent):
    """Rows of the buckets of several components, once for each pair of blocks ``i <= j`` that they are to meet in.

    A bucket over ``BLOCK`` rows is cut by the largest component against all others, by size class (sets
    that can be similar are of the same class or of neighbouring ones) and by hash. Rows of the largest
    component meet only the others, and all rows meet only their own and the neighbouring classes, so
    thousands of copies with a few strays are copied about once. ``mine`` is the block of the row itself.
    """
    sizes = rows.groupBy("token").agg(F.count("*").alias("n"), F.min("component").alias("x"), F.max("component").alias("y"))
    mixed = materialise(sizes.where("x <> y").select("token", "n"), "mixed")
    one = F.lit(0).cast("long")
    few = rows.join(mixed.where(F.col("n") <= BLOCK).select("token"), "token").withColumns({"i": one, "j": one, "mine": one})
    columns = ["token", "i", "j", "doc", "size", "place", "component", "mine"]
    if mixed.where(F.col("n") > BLOCK).isEmpty():
        return few.select(columns)
    large = rows.join(mixed.where(F.col("n") > BLOCK).select("token"), "token")
    width = max(np.log(100 / percent), 1e-6) * (1 + 1e-9)
    largest = (large.groupBy("token", "component").agg(F.count("*").alias("n"))
               .groupBy("token").agg(F.max(F.struct("n", "component")).alias("m")).select("token", F.col("m.component").alias("largest")))
    large = (large.join(materialise(largest, "largest"), "token")
             .withColumns({"rest": F.col("component") != F.col("largest"), "class": F.floor(F.ln("size") / F.lit(float(width)))}))
    groups = (large.groupBy("token", "rest", "class").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
              .groupBy("token").agg(F.collect_list(F.struct("rest", "class", "blocks")).alias("groups")))

    def number(rest, kind, k):
        return F.shiftleft(rest.cast("long"), 60).bitwiseOR(F.shiftleft(kind, 28)).bitwiseOR(k)

    def blocks(group):
        return F.transform(F.sequence(F.lit(0).cast("long"), group["blocks"] - 1), lambda k: number(group["rest"], group["class"], k))

    def meets(group):
        return (F.abs(group["class"] - F.col("class")) <= 1) & (group["rest"] | F.col("rest"))

    own = F.filter("groups", lambda g: (g["class"] == F.col("class")) & (g["rest"] == F.col("rest")))[0]
    cut = (large.join(materialise(groups, "groups"), "token")
           .withColumn("mine", number(F.col("rest"), F.col("class"), F.pmod(F.xxhash64("doc"), own["blocks"])))
           .withColumn("other", F.explode(F.flatten(F.transform(F.filter("groups", meets), blocks))))
           .withColumns({"i": F.least("mine", "other"), "j": F.greatest("mine", "other")}))
    return few.select(columns).unionByName(cut.select(columns))


def _forests(rows, sketches, failed, percent, depth):
    """``token, a, b, x, y, merged``: pairs of every bucket of several components, the components of their ends, and
    whether the bucket merged these."""
    columns = ["token", "i", "j", "doc", "size", "place", "component", "mine"]
    rows = _cut(rows, percent).join(sketches.select("doc", "small"), "doc").select(*columns, "small")
    none = np.zeros(0, "i8")

    def buckets(parts, each):
        """``each`` of runs of whole buckets, with their starts and the end; rows come sorted by bucket."""
        held = None
        for part in parts:
            frame = part.to_pandas()
            frame = frame if held is None else pd.concat([held, frame], ignore_index=True)
            key = frame[["token", "i", "j"]].to_numpy()
            starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1)])
            held = frame.iloc[starts[-1]:]  # the last bucket may go on
            yield each(frame, starts)
        if held is not None and len(held):
            yield each(held, np.array([0, len(held)]))

    def live(parts):
        """The rows that have a counterpart in their bucket as far as the small sketches tell."""
        return buckets(parts, hopeful)

    def hopeful(frame, starts):
        size, place, part, mine = (frame[c].to_numpy() for c in ("size", "place", "component", "mine"))
        within = (frame.i == frame.j).to_numpy()
        small = np.stack([np.frombuffer(x, "u1") for x in frame.small]).astype("i2") if len(frame) else None
        keep = np.zeros(len(frame), bool)
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            if (part[a:b] != part[a]).any():
                for at in range(a, b, 256):
                    k = np.arange(at, min(b, at + 256))[:, None]
                    other = np.arange(a, b)
                    x, y = np.nonzero((part[k] != part[other]) & (k < other) & (within[a] | (mine[k] != mine[other]))
                                      & passes(percent, size[k], size[other], place[k], place[other]))
                    for c in range(0, len(x), 20_000):
                        left, right = at + x[c:c + 20_000], a + y[c:c + 20_000]
                        total = size[left].astype("i8") + size[right]
                        near = np.abs(small[left] - small[right]).sum(axis=1) <= total - 2 * overlap_needed(percent, total, 0)
                        keep[left[near]] = keep[right[near]] = True
        table = pa.Table.from_pandas(frame[columns][keep[:len(frame)]], preserve_index=False).combine_chunks()
        return table.to_batches()[0] if table.num_rows else pa.RecordBatch.from_pandas(frame[columns][:0], preserve_index=False)

    schema = "token long, i long, j long, doc long, size int, place int, component long, mine long"
    rows = materialise(rows.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j").mapInArrow(live, schema), "live")
    rows = rows.join(sketches.select("doc", "sketch"), "doc")
    rows = rows.join(failed, "doc", "left") if failed is not None else rows.withColumn("failed", F.lit(None).cast("array<long>"))
    rows = rows.select(*columns, "sketch", "failed")

    def look(parts):
        return buckets(parts, found)

    def found(frame, starts):
        token, i, j, doc, size, place, part, mine = (
            frame[c].to_numpy() for c in ("token", "i", "j", "doc", "size", "place", "component", "mine"))
        sketches, lists = frame["sketch"].to_numpy(), [none if f is None else np.asarray(f, "i8") for f in frame.failed]
        out = []
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            part_of = part[a:b]
            if (part_of != part_of[0]).any():
                free, first = depth // 8 * (b - a), {}
                pairs = forest(doc[a:b], size[a:b], place[a:b], part_of, mine[a:b], sketches[a:b], lists[a:b], i[a], j[a], percent, depth, free)
                for at, (k, m) in enumerate(pairs):  # a row merges when its first pair comes after the free ones
                    out.append((a + k, a + m, first.setdefault(k, at) >= free))
        k, m, merged = np.array(out, "i8").reshape(-1, 3).T
        return pa.RecordBatch.from_arrays(
            [pa.array(token[k]), pa.array(np.minimum(doc[k], doc[m])), pa.array(np.maximum(doc[k], doc[m])),
             pa.array(np.minimum(part[k], part[m])), pa.array(np.maximum(part[k], part[m])), pa.array(merged.astype(bool))],
            names=["token", "a", "b", "x", "y", "merged"])

    dealt = rows.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")
    return materialise(dealt.mapInArrow(look, "token long, a long, b long, x long, y long, merged boolean"), "forests")


def _labelled(pairs, known):
    """The pairs whose ends lie in different components, with these components."""
    pairs = pairs.drop("x", "y")
    for end, label in (("a", "p"), ("b", "q")):
        pairs = pairs.join(known.toDF(end, label), end, "left").withColumn(label, F.coalesce(label, end))
    return pairs.where("p <> q").withColumns({"x": F.least("p", "q"), "y": F.greatest("p", "q")}).drop("p", "q")


def jaccard_components(docs, n=4, percent=85, id_column="doc_id", text_column="text"):
    """``doc_id, n_shingles, component_id`` of every row; documents link at ``100 |x & y| >= percent |x | y|``."""
    texts = _columns(docs, id_column, text_column)
    profile, counts = _profile(texts, n)
    met = _meet(_prefixes(texts, _rarity(counts), n, percent), percent)
    rows = met.where("token IS NOT NULL")
    pairs = met.where("a IS NOT NULL").select("a", "b")
    leads = rows.where("part = -1").select("token", "part", "doc", "size", "place")
    if not leads.isEmpty():
        pairs = pairs.union(_meet(leads.repartition("token", "part"), percent).where("a IS NOT NULL").select("a", "b"))
    shared = materialise(pairs.groupBy("a", "b").agg(F.count("*").alias("n")), "neighbours")
    rows = rows.where("part >= 0").select("token", "doc", "size", "place")
    concerned = shared.select(F.col("a").alias("doc")).union(shared.select("b")).union(rows.select("doc")).distinct()
    several = (F.min("digest") != F.max("digest")).alias("several")
    sketches = materialise(profile.join(concerned, "doc", "left_semi").groupBy("doc").agg(F.min(F.struct("sketch", "small", "size")).alias("s"), several)
                           .select("doc", "s.sketch", "s.small", "s.size", "several"), "sketches")
    near = _near(shared, sketches, percent)
    one = materialise(near.groupBy("b").agg(F.max(F.struct("n", "a")).alias("best")).select(F.col("best.a").alias("a"), "b"), "partners")
    store = []
    links = _verified(texts, one, n, percent, store)
    known = materialise(components(links), "known")
    between, depth, cheap, tested = near.join(one, ["a", "b"], "left_anti"), 1, 0, one.count()
    while True:
        turn = F.row_number().over(Window.partitionBy("x", "y").orderBy(F.desc("n"), "a", "b"))
        between = materialise(_labelled(between, known).withColumn("turn", turn), "between")
        left = between.count()
        if not left:
            break
        cheap += 1
        one = (between if left <= tested else between.where(F.col("turn") <= depth)).select("a", "b")  # no more than before: all at once
        links = materialise(links.union(_verified(texts, one, n, percent, store)), "links")
        known = materialise(components(links), "known")
        if left <= tested:
            break
        between = between.where(F.col("turn") > depth).drop("turn")
        depth = depth * 8 if cheap >= CHEAP else 1
    failed, depth = None, 1
    while not rows.isEmpty():
        placed = rows.join(known.toDF("doc", "component"), "doc", "left").withColumn("component", F.coalesce("component", "doc"))
        found = _forests(materialise(placed, "bucket_rows"), sketches, failed, percent, depth)
        one = materialise(found.select("a", "b").distinct(), "partners")
        if one.isEmpty():
            break
        depth *= 8
        good = _verified(texts, one, n, percent, store)
        bad = one.join(good, ["a", "b"], "left_anti")
        wrong = materialise(bad if failed is None else wrong.union(bad), "wrong")
        failed = materialise(wrong.union(wrong.select("b", "a")).toDF("doc", "other").groupBy("doc")
                             .agg(F.collect_set("other").alias("failed")), "failed")
        links = materialise(links.union(good), "links")
        known = materialise(components(links), "known")
        again = materialise(_labelled(found.where("merged"), known).select("token").distinct(), "again")
        rows = materialise(rows.join(again, "token", "left_semi"), "again_rows")
    classes = (profile.where("doc IS NOT NULL AND size > 0").groupBy("digest").agg(F.min("doc").alias("node"))
               .join(known, "node", "left").select("digest", F.coalesce("component", "node").alias("component")))
    classes = materialise(classes, "classes")
    return (profile.withColumn("digest", F.when(F.col("size") > 0, F.col("digest"))).join(classes, "digest", "left")
            .select(F.col("doc").alias("doc_id"), F.col("size").alias("n_shingles"),
                    F.when(F.col("doc").isNotNull(), F.coalesce("component", "doc")).alias("component_id")))


def keep_representatives(docs, n=4, percent=85, id_column="doc_id", text_column="text"):
    """The smallest id of each component, all columns as they are; rows with a NULL id stay."""
    found = jaccard_components(docs, n, percent, id_column, text_column)
    others = found.where("component_id <> doc_id").select(F.col("doc_id").alias(id_column)).distinct()
    return docs.join(materialise(others, "repeated"), id_column, "left_anti").select(docs.columns)


@query("op5_ngram_jaccard")
def op5_ngram_jaccard(spark, sf):
    return jaccard_components(table(spark, sf, "documents"))
